"""Appending to the target."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, functions as F

BATCH_ROWS = 10_000


def append_table(
    rows: DataFrame,
    name: str,
    partition_by: Sequence[str] = ("region",),
    sort_by: Sequence[str] = ("category", "sale_date"),
    observation: Observation | None = None,
) -> None:
    """Append in the table's layout. Files appear when the job commits; a job
    that fails before that leaves the table as it was.

    ``observation`` receives rows, first_date and last_date. It sits above the
    exchange, in the last stage: below it, a stage run again after a lost
    executor would be counted twice.
    """
    laid_out = rows.hint("rebalance", *[F.col(c) for c in partition_by]).sortWithinPartitions(
        *partition_by, *sort_by
    )
    if observation is not None:
        laid_out = laid_out.observe(
            observation,
            F.count("*").alias("rows"),
            F.min("sale_date").alias("first_date"),
            F.max("sale_date").alias("last_date"),
        )
    (
        laid_out.write.mode("append")
        .format("parquet")
        .partitionBy(*partition_by)
        .saveAsTable(name)
    )


def append_jdbc(
    rows: DataFrame,
    url: str,
    table: str,
    batch_rows: int = BATCH_ROWS,
    num_partitions: int = 16,
    properties: dict[str, str] | None = None,
) -> None:
    """Append to a database table.

    ``num_partitions`` bounds the connections. Each partition is a transaction
    of its own and a retried task may insert again, so point this at a staging
    table and let the database move the rows over in one statement.
    """
    # The writer would merge partitions without a shuffle, and so narrow the
    # stage that computes the rows to as many tasks as there are connections.
    (
        rows.repartition(num_partitions)
        .write.format("jdbc")
        .options(**jdbc_write_options(url, table, batch_rows, num_partitions, properties))
        .mode("append")
        .save()
    )


def jdbc_write_options(
    url: str,
    table: str,
    batch_rows: int = BATCH_ROWS,
    num_partitions: int = 16,
    properties: dict[str, str] | None = None,
) -> dict[str, str]:
    return {
        **(properties or {}),
        "url": url,
        "dbtable": table,
        "batchsize": str(batch_rows),
        "numPartitions": str(num_partitions),
    }
