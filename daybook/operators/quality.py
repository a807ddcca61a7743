"""Checks on a batch's lines before they are parsed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from daybook.functions import text
from daybook.schema import DAILY
from daybook.sources.lines import header_line

# A smaller file draws a warning; eight fields need seven separators.
SMALL_FILE_BYTES = 10
SEPARATORS_PER_LINE = 7


def with_line_facts(lines: DataFrame, sep: str) -> DataFrame:
    """What the profile counts, per line, taken before any repair of the line."""
    line = F.col("line")
    return lines.withColumns(
        {
            "n_seps": text.separator_count(line, sep),
            "has_nul": text.has_nul(line),
            "has_cr": text.has_carriage_return(line),
            "binary": text.looks_binary(line),
            "header_like": text.looks_like_header(line),
        }
    )


def file_profile(facts: DataFrame) -> DataFrame:
    """One row per file. An empty file has no lines and no row: a batch is empty
    if it has no profile at all."""
    return (
        facts.groupBy("file")
        .agg(
            F.max("file_bytes").alias("n_bytes"),
            F.count("*").alias("n_lines"),
            F.min("n_seps").alias("min_seps"),
            F.max("n_seps").alias("max_seps"),
            F.count_if("has_nul").alias("nul_lines"),
            F.count_if("has_cr").alias("cr_lines"),
            F.count_if("binary").alias("binary_lines"),
            header_line().alias("header_line"),
        )
        .withColumn("is_small", F.col("n_bytes") < SMALL_FILE_BYTES)
    )


def separator_histogram(facts: DataFrame) -> DataFrame:
    """How many lines have how many separators, over whole files."""
    return (
        facts.groupBy("n_seps")
        .agg(F.count("*").alias("n_lines"))
        .withColumn("is_expected", F.col("n_seps") == SEPARATORS_PER_LINE)
    )


def load_reconciliation(checked: DataFrame) -> DataFrame:
    """Source, accepted and rejected rows, where the last two must add up to the
    first, and the dates the accepted rows span."""
    good = F.col("reasons") == ""
    return checked.agg(
        F.count("*").alias("source_rows"),
        F.count_if(good).alias("accepted_rows"),
        F.count_if(~good).alias("rejected_rows"),
        F.min(F.when(good, F.col("sale_date"))).alias("first_date"),
        F.max(F.when(good, F.col("sale_date"))).alias("last_date"),
    ).withColumn("is_balanced", F.expr("source_rows = accepted_rows + rejected_rows"))


def content_fingerprint(rows: DataFrame, names: Sequence[str] = tuple(DAILY.names)) -> DataFrame:
    """One row that stands for the multiset of ``rows``: their number, and two sums of row hashes.

    Order, partitions and files don't matter; a row that is missing, there twice, or
    changed in a field does, and so do two rows that swapped one. A value counts by its
    text with its place among the fields, and null is none of the texts. The sums are
    exact in 38 digits; by chance two different contents of equal size agree with a
    probability of about 2^-128. Fingerprints of disjoint parts add up.
    """
    cells = [F.coalesce(F.concat(F.lit("="), F.col(n).cast("string")), F.lit("null")) for n in names]
    sums = [
        F.coalesce(F.sum(F.xxhash64(F.lit(seed), *cells).cast("decimal(28,0)")), F.lit(0).cast("decimal(38,0)"))
        .cast("decimal(38,0)")
        .alias(f"hash{seed}")
        for seed in (1, 2)
    ]
    return rows.agg(F.count("*").alias("n_rows"), *sums)


def content_reconciliation(before: DataFrame, after: DataFrame, names: Sequence[str] = tuple(DAILY.names)) -> DataFrame:
    """Rows on both sides of a step, and whether these are the same rows with the same contents."""
    left, right = (
        content_fingerprint(rows, names).select(*[F.col(c).alias(f"{side}_{c}") for c in ("n_rows", "hash1", "hash2")])
        for side, rows in (("before", before), ("after", after))
    )
    equal = F.expr("before_n_rows = after_n_rows and before_hash1 = after_hash1 and before_hash2 = after_hash2")
    # One row on each side.
    return left.join(F.broadcast(right)).select(
        F.col("before_n_rows").alias("rows_before"), F.col("after_n_rows").alias("rows_after"), equal.alias("is_equal")
    )
