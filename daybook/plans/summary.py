"""The summary kept up to date: each batch adds its state, and reading merges them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from daybook.operators import aggregate

#: What a state holds, apart from its batch.
STATE = T.StructType(
    [
        T.StructField("category", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("days_count", T.LongType()),
        T.StructField("total_quantity_all_days", T.LongType()),
        T.StructField("total_revenue_all_days", T.DecimalType(38, 2)),
        T.StructField("price_total", T.DecimalType(38, 2)),
        T.StructField("price_count", T.LongType()),
        T.StructField("first_sale_date", T.DateType()),
        T.StructField("last_sale_date", T.DateType()),
    ]
)


def store_state(daily: DataFrame, root: str, batch: str) -> None:
    """Store what the batch adds, below its own name: storing it again replaces it.

    The state is as large as the batch has categories and regions, however many its rows are.
    """
    state = aggregate.summary_state(daily)
    state.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in STATE]).write.mode("overwrite").parquet(
        f"{root.rstrip('/')}/batch={batch}"
    )


def stored_summary(spark: SparkSession, root: str) -> DataFrame:
    """The summary of all batches stored below ``root``; their rows aren't read."""
    states = spark.read.schema(T.StructType([*STATE, T.StructField("batch", T.StringType())])).parquet(root)
    return aggregate.summary_from_states(states)


def compact_states(spark: SparkSession, root: str, into: str) -> None:
    """All states in one, at another place: the same summary from fewer rows."""
    states = spark.read.schema(STATE).option("recursiveFileLookup", "true").parquet(root)
    sums = ("days_count", "total_quantity_all_days", "total_revenue_all_days", "price_total", "price_count")
    merged = states.groupBy("category", "region").agg(
        *[F.sum(c).alias(c) for c in sums], F.min("first_sale_date").alias("first_sale_date"), F.max("last_sale_date").alias("last_sale_date")
    )
    merged.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in STATE]).write.mode("overwrite").parquet(f"{into.rstrip('/')}/batch=all")
