"""Session defaults, and where work files go."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import SparkSession


# A shuffle partition of this size sorts and aggregates in one task's memory.
PARTITION_BYTES = 128 * 1024 * 1024
# Where nothing is known of the size: half a terabyte in partitions of that size.
START_PARTITIONS = 4096


def build_session(
    app_name: str = "daybook", master: str | None = None, shuffle_bytes: int | None = None, **conf: str
) -> SparkSession:
    """A session with the settings these jobs are tuned for.

    Master, memory and credentials are the cluster's business: they come from
    its own configuration unless they are passed here. ``shuffle_bytes`` is the
    most that one exchange is expected to move, about the size of the columns a
    job reads. Adaptive execution merges partitions that turn out small, but it
    never makes more than it started with, so the start has to be high enough;
    beyond half a terabyte in one exchange, say how much it is.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # One order, customer or part may own a third of the facts: let the
        # join split that partition even where it costs one more exchange.
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        **conf,
    }
    if not shuffle_bytes and not (master or "").startswith("local"):
        settings.setdefault(
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(START_PARTITIONS)
        )
    if shuffle_bytes:
        settings.setdefault(
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum",
            str(max(200, math.ceil(shuffle_bytes / PARTITION_BYTES))),
        )
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh directory for files a job writes and reads back.

    It lies under ``spark.checkpoint.dir``, the folder all executors share. A
    local temporary folder serves only a local master, where driver and
    executors are one machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.gettempdir()
    return f"{root.rstrip('/')}/daybook/{name}-{uuid.uuid4().hex}"
