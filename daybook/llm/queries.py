"""One query for each operator, over its whole table, with the parameters of production."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from daybook.llm import (
    bpe,
    collocations,
    embedding_dedup,
    html_text,
    langid,
    lexical,
    line_dedup,
    minhash,
    mixing,
    quality_rules,
    recurrent_lm,
    site_quality,
    warc,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict_languages(table(spark, sf_dir, "documents"))


def main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted(table(spark, sf_dir, "pages"))


def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_dedup.deduplicated(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "text", "n_removed")


def mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """To the full targets: documents of a scarce domain get more copies than one."""
    labels = mixing.domain_labels(table(spark, sf_dir, "labels"))
    return mixing.mixed(table(spark, sf_dir, "documents"), labels, repeats=True)


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source is the host; its texts of one language are a path."""
    labels = site_quality.good_labels(table(spark, sf_dir, "labels"))
    return site_quality.judged(table(spark, sf_dir, "documents"), labels, F.col("source"), F.col("lang"))


def near_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=4, percent=80)


def rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages"))


def near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recurrent_lm.scored(table(spark, sf_dir, "documents"))


def search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": languages,
    "op2_html_text": main_text,
    "op3_byte_bpe": byte_bpe,
    "op4_line_dedup": lines,
    "op5_mixing": mix,
    "op6_quality_classifier": quality,
    "op7_near_duplicates": near_documents,
    "op8_quality_rules": rules,
    "op9_warc": archives,
    "op10_embedding_near_duplicates": near_vectors,
    "op11_lm_scoring": language_model,
    "op12_lexical_search": search,
    "op13_collocations": phrases,
}
