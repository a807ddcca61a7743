"""Parallel file output to any path Spark can reach."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from daybook.operators.constraints import export_rules
from daybook.sources.csv_options import csv_options

ROWS_PER_FILE = 5_000_000


def write_csv(
    rows: DataFrame, path: str, mode: str = "overwrite", rows_per_file: int = ROWS_PER_FILE
) -> None:
    """Comma-separated with a header, one file per task; a long one is split."""
    (
        rows.write.mode(mode)
        .options(**csv_options(",", header=True))
        .option("maxRecordsPerFile", rows_per_file)
        .csv(path)
    )


def write_delimited(
    rows: DataFrame,
    path: str,
    sep: str = "|",
    mode: str = "overwrite",
    rows_per_file: int = ROWS_PER_FILE,
) -> None:
    """Delimited UTF-8 without a header. A text that holds the separator is
    quoted; for a reader that knows no quotes, see ``unquotable``."""
    (
        rows.write.mode(mode)
        .options(**csv_options(sep, header=False))
        .option("maxRecordsPerFile", rows_per_file)
        .csv(path)
    )


def unquotable(daily: DataFrame, sep: str = "|") -> DataFrame:
    """Rows that only a reader with quotes would get right."""
    test = F.lit(False)
    for name, rule in export_rules(sep).items():
        if name.startswith("separator:"):
            test = test | F.coalesce(rule, F.lit(False))
    return daily.filter(test)


def redelimit(
    rows: DataFrame, path: str, sep: str = "|", rows_per_file: int = ROWS_PER_FILE
) -> None:
    """Parsed rows out under another separator; swapping characters in the text
    would split values that hold one."""
    write_delimited(rows, path, sep, rows_per_file=rows_per_file)


def write_partitioned(
    rows: DataFrame,
    path: str,
    partition_by: Sequence[str] = ("region",),
    sort_by: Sequence[str] = ("category", "sale_date"),
    mode: str = "overwrite",
) -> None:
    """Parquet laid out for reading by region, then category, then date.

    The rebalance gathers each region into few files, yet splits one that holds
    a large share of the rows over as many tasks as its size needs. The sort
    keeps row groups narrow, so that their statistics prune.
    """
    (
        rows.hint("rebalance", *[F.col(c) for c in partition_by])
        .sortWithinPartitions(*partition_by, *sort_by)
        .write.mode(mode)
        .partitionBy(*partition_by)
        .parquet(path)
    )


#: Bits of each dimension in an interleaved order; bytes of a row group there.
ORDER_BITS, ORDER_GROUP_BYTES = 16, 16 * 1024 * 1024


def interleaved(places: Sequence[Column], bits: int = ORDER_BITS) -> Column:
    """One number from several, the highest bits of all first, then the next ones.

    Rows that are near in this order are near in every one of the dimensions.
    """
    n = len(places)
    out = F.lit(0).cast("long")
    for bit in range(bits):
        for k, place in enumerate(places):
            one = F.shiftright(place.cast("long"), bit).bitwiseAND(F.lit(1))
            out = out.bitwiseOR(F.shiftleft(one, bit * n + n - 1 - k))
    return out


def _with_places(rows: DataFrame, by: Sequence[str], bits: int) -> tuple[DataFrame, list[str]]:
    """Rows with the place of each of ``by`` among its distinct values, stretched over ``bits``.

    The places come from the distinct values alone, a table of which is joined back.
    A null comes first.
    """
    names = []
    for name in by:
        ordered = Window.orderBy(name)
        everything = Window.orderBy(name).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        share = (F.row_number().over(ordered) - 1) / F.greatest(F.count("*").over(everything) - 1, F.lit(1))
        place = F.floor(share * ((1 << bits) - 1)).cast("int")
        values = rows.select(name).distinct().select(F.col(name).alias(f"_value_{name}"), name).select(
            f"_value_{name}", place.alias(f"_place_{name}")
        )
        rows = rows.join(values, F.col(name).eqNullSafe(F.col(f"_value_{name}"))).drop(f"_value_{name}")
        names.append(f"_place_{name}")
    return rows, names


def write_interleaved(
    rows: DataFrame,
    path: str,
    by: Sequence[str] = ("category", "region", "sale_date"),
    mode: str = "overwrite",
    group_bytes: int = ORDER_GROUP_BYTES,
) -> None:
    """Parquet in which a filter on any one of ``by`` skips most row groups.

    Sorted by one column after another, only the first one's values lie together. In
    the interleaved order the row groups are small boxes in all of them, and the least
    and greatest values that Parquet keeps for each tell a reader which to leave out. The
    places are ranks, so that boxes hold about equally many rows, however a column's values are spread.
    """
    placed, names = _with_places(rows, by, ORDER_BITS)
    order = interleaved([F.col(c) for c in names])
    (
        placed.withColumn("_order", order)
        .drop(*names)
        .repartitionByRange("_order")
        .sortWithinPartitions("_order")
        .drop("_order")
        .write.mode(mode)
        .option("parquet.block.size", group_bytes)
        .parquet(path)
    )
