"""From raw documents to token ids, in five stages; each result is written and read back.

A stage takes ``(spark, docs, sf_dir)`` and works on all that the one before it
kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from daybook.llm import bpe, line_dedup, minhash, mixing, quality_rules
from daybook.llm.common import Work, text_key, whole_row
from daybook.llm.queries import table

#: Weights of the domains that the stage of quality rules leaves.
MIXED_TARGETS = {"clean": 0.95, "toxic": 0.05}

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _packed(docs: DataFrame) -> DataFrame:
    """``row``, a struct of all columns, beside ``id`` and ``key``: so no column's name can clash with them."""
    rows = docs.withColumn("text", F.col("text").cast("string"))
    return rows.select(whole_row(rows), F.col("doc_id").alias("id"), text_key().alias("key"))


def _unpacked(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.select(*(F.col("row").getField(c).alias(c) for c in columns))


def _packed_without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """Packed rows of ``docs`` without those with these ids and texts; rows without an id stay."""
    gone = gone.select(F.col("doc_id").alias("gone_id"), F.col("text_key").alias("gone_key"))
    here = F.col("id") == F.col("gone_id")
    return _packed(docs).join(gone, here & (F.col("key") == F.col("gone_key")), "left_anti")


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    return _unpacked(_packed_without(docs, gone), docs.columns)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or a learned rule reject go."""
    return quality_rules.accepted(docs, table(spark, sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of repeated three-line windows go, and documents left without text by that."""
    rows = line_dedup.rebuilt(docs).where((F.col("n_removed") == 0) | F.regexp_like("text", F.lit(r"\S")))
    own = {c: F.col("row").getField(c) for c in docs.columns} | {"text": F.col("text")}
    if "n_chars" in docs.columns:
        chars = F.when(F.col("n_removed") > 0, F.char_length("text").cast(docs.schema["n_chars"].dataType))
        own["n_chars"] = F.coalesce(chars, own["n_chars"])
    return rows.select(*(x.alias(c) for c, x in own.items()))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at 0.8 or more, the one with the smallest id stays."""
    found = minhash.near_duplicates(docs, width=5, percent=80, keyed=True)
    rows = _packed_without(docs, found.where(~F.col("kept")))
    # Rows that repeat an id and its text are copies too. They are few as a rule, so that
    # the join that sets them apart can broadcast them, and other texts need not move.
    work = Work(spark, "repeated-rows")
    repeated = work.keep(_packed(docs).groupBy("id", "key").count().where("count > 1"), "repeated")
    again = F.col("id").eqNullSafe(F.col("again_id")) & (F.col("key") == F.col("again_key"))
    marks = repeated.select(F.col("id").alias("again_id"), F.col("key").alias("again_key"))
    once = rows.join(marks, again, "left_anti")
    first = rows.join(marks, again, "left_semi").dropDuplicates(["id", "key"])
    return _unpacked(once.unionByName(first), docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Domains are thinned to their target weights; a document stays once if its rate gives it a copy.

    The domains are those that the stage of quality rules leaves: clean text, which keeps what it has, and
    toxic text, which is thinned to its weight. Documents are not repeated, so a domain
    below its weight keeps what it has.
    """
    labels = mixing.domain_labels(table(spark, sf_dir, "labels")).where(F.col("kind").isin(*MIXED_TARGETS))
    mixed = mixing.mixed(docs, labels, MIXED_TARGETS, tuple(MIXED_TARGETS), keyed=True)
    return _without(docs, mixed.where("copies = 0"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and whether they decode to it."""
    return bpe.encoded(docs).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "exact")


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("minhash_near_dedup", near_stage),
    ("mixing", mixing_stage),
    ("byte_bpe", token_stage),
]

#: The learned stages have no SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; a stage's table goes once the next one is stored."""
    work = Work(spark, "pipeline")
    rows, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        rows = work.keep(stage(spark, rows, sf_dir), name)
        if before:
            work.drop(before)
        before = name
    return rows
