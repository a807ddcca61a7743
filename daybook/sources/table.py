"""The target table: create, look up, read."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from daybook.schema import DAILY, DAILY_WIDE


def target_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def create_target(
    spark: SparkSession,
    name: str,
    path: str | None = None,
    partition_by: Sequence[str] = ("region",),
    layout: T.StructType = DAILY_WIDE,
) -> None:
    """Drop the table and make it anew, empty. With ``layout=DAILY`` it declares
    narrow integers, and a load refuses totals beyond them.

    It is partitioned by a column of few values; an index has no counterpart
    here, so pruning and row-group statistics take its place.
    """
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    writer = spark.createDataFrame([], layout).write.format("parquet").mode("overwrite")
    if path:
        writer = writer.option("path", path)
    writer.partitionBy(*partition_by).saveAsTable(name)


def recreate_target(
    spark: SparkSession,
    name: str,
    root: str,
    rows: DataFrame | None = None,
    layout: T.StructType = DAILY_WIDE,
) -> str:
    """Make the table anew without a moment at which it is missing or half full; its new location.

    The new version is written and read back below ``root`` first, under a name of its own.
    Then the table's location is switched in one change of the catalog. A reader that
    opened the table before keeps the rows it saw, as nothing of the old version is
    touched; ``drop_versions`` removes old ones. A table made so isn't partitioned: a
    partitioned one would need a catalog change for each partition.
    """
    location = f"{root.rstrip('/')}/version-{uuid.uuid4().hex}"
    source = spark.createDataFrame([], layout) if rows is None else rows
    typed = source.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in layout])
    ordered = typed if rows is None else typed.sortWithinPartitions("region", "category", "sale_date")
    ordered.write.parquet(location)
    if spark.read.parquet(location).schema.names != layout.names:
        raise ValueError(f"{location} can't be read back")
    if target_exists(spark, name):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{location}'")
        spark.catalog.refreshTable(name)
    else:
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in layout)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet LOCATION '{location}'")
    return location


def drop_versions(spark: SparkSession, root: str, keep: str) -> int:
    """Remove all versions below ``root`` but ``keep``, once no reader needs them; how many went."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    pattern = hadoop.Path(f"{root.rstrip('/')}/version-*")
    system = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    kept = system.makeQualified(hadoop.Path(keep)).toString()
    old = [found.getPath() for found in system.globStatus(pattern) or [] if found.getPath().toString() != kept]
    return sum(bool(system.delete(path, True)) for path in old)


def target_location(spark: SparkSession, name: str) -> str:
    """The path below which the table's files lie."""
    facts = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()
    return facts["data_type"]


def target_layout(spark: SparkSession, name: str) -> T.StructType:
    """The eight fields in the types that the table declares."""
    declared = spark.table(name).schema
    return T.StructType([T.StructField(n, declared[n].dataType) for n in DAILY.names])


def read_target(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name).select(*DAILY.names)


def keys_between(target: DataFrame, first: Any, last: Any) -> DataFrame:
    """Target rows of the batch's dates: all that can hold an equal key. The
    filter reaches the scan."""
    return target.filter(F.col("sale_date").between(F.lit(first), F.lit(last)))


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    lower: str,
    upper: str,
    num_partitions: int,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """The target in a database, read in parallel ranges of ``sale_date``."""
    return (
        spark.read.format("jdbc")
        .options(**jdbc_read_options(url, table, lower, upper, num_partitions, properties))
        .load()
    )


def jdbc_read_options(
    url: str,
    table: str,
    lower: str,
    upper: str,
    num_partitions: int,
    properties: dict[str, str] | None = None,
) -> dict[str, str]:
    return {
        **(properties or {}),
        "url": url,
        "dbtable": table,
        "partitionColumn": "sale_date",
        "lowerBound": lower,
        "upperBound": upper,
        "numPartitions": str(num_partitions),
        "preferTimestampNTZ": "true",
    }
