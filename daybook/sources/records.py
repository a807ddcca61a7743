"""Quoted records that span several lines, from files cut into many splits.

A record ends at the line end where the quotes seen since the start of the file are
even in number; a doubled quote counts twice and changes nothing. So a line is
described by one bit, whether its own quotes are odd. Each task counts the odd lines
as it reads them, and their numbers per split are summed up along the file: that
tells for each line how many odd ones its file has before it, and no line moves for
that. Odd lines open and close records in turn. Only the lines of a record of
several move, and meet by the number of its opening line.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from daybook.functions import text
from daybook.sources.lines import line_number, line_splits, read_lines, with_splits

#: Lines of the longest record that is put together; a stray quote can't gather more.
MAX_RECORD_LINES = 1000

# Why lines stay apart.
OPEN_QUOTE, TOO_LONG = "open_quote", "record_too_long"


def stage_quoted(spark: SparkSession, path: str, stage_path: str, quote: str = '"') -> DataFrame:
    """The files' lines, stored once, with whether their quotes are odd, and how many odd lines their task read before."""
    lines = read_lines(spark, path)
    odd = text.separator_count(F.col("line"), quote) % 2 == 1
    rows = lines.select("file", "block_start", "line_id", "line", odd.alias("odd"))

    def counted(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in source:
            odd = batch.column("odd").to_numpy(zero_copy_only=False).astype(np.int64)
            upto = seen + np.cumsum(odd)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(upto - odd)], names=[*batch.schema.names, "odds_read"])
            seen += int(odd.sum())

    schema = T.StructType([*rows.schema, T.StructField("odds_read", T.LongType())])
    rows.mapInArrow(counted, schema).write.mode("overwrite").option("compression", "zstd").parquet(stage_path)
    return spark.read.parquet(stage_path)


def quoted_records(stored: DataFrame, max_lines: int = MAX_RECORD_LINES) -> DataFrame:
    """``file, line_no, n_lines, record, problem`` of each record.

    ``line_no`` is the file's number of its first line. A quote that is never closed,
    or closed only after more than ``max_lines`` lines, leaves its lines apart, each
    as a record of its own with a ``problem``; nothing is dropped.
    """
    splits = line_splits(stored, {"odds_read_first": F.col("odds_read")}, odds=F.col("odd").cast("int"))
    # Odd lines of the file before this one; by turns they open and close.
    seen = F.col("odds_before") + F.col("odds_read") - F.col("odds_read_first")
    opened = F.ceil((seen + F.col("odd").cast("int")) / 2)
    inside = F.col("odd") | (seen % 2 == 1)
    marked = with_splits(stored, splits).select(
        "file",
        line_number().alias("line_no"),
        "line",
        "odd",
        F.when(inside, opened).alias("opener"),
        F.when(inside & (opened * 2 > F.col("odds_in_file")), F.lit(OPEN_QUOTE)).alias("problem"),
    )
    parts = marked.where("opener is not null and problem is null")
    by = ["file", "opener"]
    # The first and the last line of a record are odd, and no other, so that these tell its length.
    n_lines = F.max("line_no") - F.min("line_no") + 1
    long = parts.where("odd").groupBy(*by).agg(n_lines.alias("n")).where(F.col("n") > max_lines).select(*by)
    parts = parts.drop("odd")
    whole = (
        parts.join(long, by, "left_anti")
        .groupBy(*by)
        .agg(F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("lines"))
        .select(
            "file",
            F.col("lines")[0]["line_no"].alias("line_no"),
            F.size("lines").cast("long").alias("n_lines"),
            F.array_join(F.transform("lines", lambda x: x["line"]), "\n").alias("record"),
            F.lit(None).cast("string").alias("problem"),
        )
    )
    apart = ["file", "line_no", F.lit(1).cast("long").alias("n_lines"), F.col("line").alias("record")]
    return (
        marked.where("opener is null or problem is not null").select(*apart, "problem")
        .unionByName(whole)
        .unionByName(parts.join(long, by, "left_semi").select(*apart, F.lit(TOO_LONG).alias("problem")))
    )
