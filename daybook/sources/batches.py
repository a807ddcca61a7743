"""Finding the newest batch."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

# How a batch is named.
BATCH_PREFIX = "sales_data_aggregated_"
BATCH_SUFFIX = ".csv"
BATCH_TIME_FORMAT = "%Y%m%d_%H%M%S"
# The empty file that Spark's committer leaves once all parts are in place.
COMPLETE = "_SUCCESS"


def batch_name(run_ts: dt.datetime) -> str:
    return f"{BATCH_PREFIX}{run_ts.strftime(BATCH_TIME_FORMAT)}{BATCH_SUFFIX}"


def list_batches(spark: SparkSession, root: str) -> DataFrame:
    """One row per batch below ``root``: its path, size, files and newest change.

    A batch is one file, or a directory of part files that its job has marked as
    complete; the suffix is the directory's or each part's. A directory without
    the mark is still being written, or was given up, and is no batch. Files
    without a byte count: the newest batch may be an empty one.

    The driver asks for the names below ``root`` and for the marks. The part files are
    listed by a scan that takes their names, sizes and times, and none of their
    contents; with many batches Spark lists them in parallel.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    pattern = f"{root.rstrip('/')}/{BATCH_PREFIX}*"
    system = hadoop.Path(pattern).getFileSystem(spark._jsc.hadoopConfiguration())
    marks = system.globStatus(hadoop.Path(f"{pattern}/{COMPLETE}")) or []
    complete = {mark.getPath().getParent().toString() for mark in marks}
    tops = [
        (found.getPath().toString(), found.getModificationTime())
        for found in system.globStatus(hadoop.Path(pattern)) or []
        if found.isFile() or found.getPath().toString() in complete
    ]
    batches = spark.createDataFrame(tops, "batch string, changed long")
    if not tops:
        return batches.select(
            "batch", F.timestamp_millis("changed").alias("modified"), F.lit(0).cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_files")
        )
    parts = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(pattern)
    # A path is the batch itself, or the batch and what lies in it.
    inside = parts.select(
        F.regexp_extract("path", f"^(.*/{BATCH_PREFIX}[^/]*)", 1).alias("batch"),
        F.endswith("path", F.lit(BATCH_SUFFIX)).alias("is_named"),
        "modificationTime",
        "length",
    )
    summed = inside.groupBy("batch").agg(
        F.count("*").alias("n_files"),
        F.sum("length").alias("n_bytes"),
        F.max("modificationTime").alias("modified"),
        F.bool_and("is_named").alias("is_named"),
    )
    none = F.lit(0).cast("long")
    return (
        batches.join(summed, "batch", "left")
        .where(F.endswith("batch", F.lit(BATCH_SUFFIX)) | F.coalesce("is_named", F.lit(False)))
        .select(
            "batch",
            F.coalesce("modified", F.timestamp_millis("changed")).alias("modified"),
            F.coalesce("n_bytes", none).alias("n_bytes"),
            F.coalesce("n_files", none).alias("n_files"),
        )
    )


def latest_batch(spark: SparkSession, root: str) -> str | None:
    """Path of the newest batch; of equally new ones the greatest path. None if there is none."""
    newest = list_batches(spark, root).agg(F.max_by("batch", F.struct("modified", "batch")).alias("batch"))
    return newest.first()["batch"]
