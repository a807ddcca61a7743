"""A batch of delimited text into the target table."""

from __future__ import annotations

import uuid
import datetime as dt
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, Row, SparkSession, functions as F, types as T

from daybook.functions import text
from daybook.operators import constraints, key_filter, quality
from daybook.plans.claim import claimed
from daybook.plans.errors import BatchError
from daybook.plans.summary import store_state
from daybook.schema import CORRUPT, DAILY, DAILY_TEXT, with_corrupt
from daybook.sinks.table import append_table
from daybook.sources.csv_options import csv_options
from daybook.sources.delimited import split_fields
from daybook.sources.lines import drop_headers, line_splits, numbered, read_lines
from daybook.sources.table import keys_between, read_target, target_exists, target_layout, target_location


@dataclass(frozen=True)
class LoadResult:
    profile: Row
    source_rows: int
    accepted_rows: int
    rejected_rows: int
    loaded_rows: int
    first_date: dt.date | None
    last_date: dt.date | None
    rejects_path: str | None


def checked_lines(lines: DataFrame, sep: str, layout: T.StructType = DAILY) -> DataFrame:
    """Lines with their facts, their typed fields, and the reasons that keep a
    row out. The line itself is kept only where somebody will look at it again."""
    facts = quality.with_line_facts(lines, sep).withColumn("line", text.strip_nul(F.col("line")))
    parsed = constraints.computed_once(split_fields(F.col("line"), sep))
    fields = facts.withColumn("f", parsed).select(
        *facts.columns, *[F.col(f"f.{n}").alias(n) for n in [*DAILY_TEXT.names, CORRUPT]]
    )
    checked = constraints.conform_text(fields, layout)
    return checked.withColumn("line", F.when(F.col("reasons") != "", F.col("line")))


def stage_batch(
    spark: SparkSession, source: str, stage_path: str, sep: str = ",", layout: T.StructType = DAILY
) -> DataFrame:
    """Read, inspect and parse the batch in one scan, and store the outcome.

    Every later check reads a few columns of the stored copy.
    """
    checked_lines(read_lines(spark, source), sep, layout).write.mode("overwrite").parquet(stage_path)
    return spark.read.parquet(stage_path)


def store_profile(staged: DataFrame, path: str) -> DataFrame:
    """One row per file, stored: the report and the headers both come from it."""
    quality.file_profile(staged).write.mode("overwrite").parquet(path)
    return staged.sparkSession.read.parquet(path)


def batch_report(profile: DataFrame) -> DataFrame:
    """One row about the whole batch."""
    return profile.agg(
        F.count("*").alias("n_files"),
        F.count("header_line").alias("header_lines"),
        F.count_if("is_small").alias("small_files"),
        F.sum("n_bytes").alias("n_bytes"),
        F.sum("n_lines").alias("n_lines"),
        F.min("min_seps").alias("min_seps"),
        F.max("max_seps").alias("max_seps"),
        F.sum("nul_lines").alias("nul_lines"),
        F.sum("cr_lines").alias("cr_lines"),
        F.sum("binary_lines").alias("binary_lines"),
    )


def source_rows(
    spark: SparkSession, source: str, sep: str = ",", layout: T.StructType = DAILY
) -> DataFrame:
    """The loadable rows of the files by a second read that shares nothing with the staged lines."""
    read = (
        spark.read.options(**csv_options(sep))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("recursiveFileLookup", "true")
        .schema(with_corrupt(DAILY_TEXT))
        .csv(source)
    )
    clean = read.withColumns({n: text.strip_nul(F.col(n)) for n in DAILY_TEXT.names})
    return constraints.accepted(constraints.conform_text(clean, layout))


def loaded_rows(target: DataFrame, batch: DataFrame, n_keys: int, first: dt.date, last: dt.date) -> DataFrame:
    """Target rows with a key of the batch."""
    near = keys_between(target, first, last)
    bits = key_filter.filter_bits(n_keys)
    if bits:
        near = key_filter.possible_rows(near, key_filter.key_filter(batch, bits), bits)
    names = ["category_key", "region_key", "sale_date"]
    keyed = near.select(F.struct(*near.columns).alias("row"), *constraints.normal_key())
    found = keyed.join(batch.select(*constraints.normal_key()), names, "left_semi")
    return found.select(*[F.col("row").getField(n).alias(n) for n in DAILY.names])


def load_batch(
    spark: SparkSession,
    source: str,
    target: str,
    stage_root: str,
    sep: str = ",",
    max_errors: int = 0,
    summary_root: str | None = None,
) -> LoadResult:
    """Check the batch whole, then append it to ``target``.

    It is refused, with the target untouched, if it holds no rows or binary
    content, more than ``max_errors`` unloadable rows, a key twice, or a key
    the target has; if the rows made ready differ in number or content from a second
    read of the files; and if another load holds the target.

    After the append the batch's rows are read back from the target and compared with
    those made ready. An error there means that the target has changed, and says so.
    ``summary_root`` gets what the batch adds to the summary.
    """
    if not target_exists(spark, target):
        raise BatchError(f"target table {target} does not exist")
    # Two loads with one stage root must not overwrite each other's stage.
    name = uuid.uuid4().hex
    stage_root = f"{stage_root.rstrip('/')}/{name}"
    with claimed(spark, f"{target_location(spark, target).rstrip('/')}.claims", target) as claim:
        result, ready = _prepare(spark, source, target, stage_root, sep, max_errors)
        claim.check()
        loaded = Observation()
        append_table(ready, target, observation=loaded)
        _verify(spark, target, ready, result)
    if summary_root:
        store_state(ready, summary_root, name)
    return replace(
        result,
        loaded_rows=loaded.get["rows"],
        first_date=loaded.get["first_date"],
        last_date=loaded.get["last_date"],
    )


def _verify(spark: SparkSession, target: str, ready: DataFrame, result: LoadResult) -> None:
    found = loaded_rows(read_target(spark, target), ready, result.accepted_rows, result.first_date, result.last_date)
    same = quality.content_reconciliation(ready, found).first()
    if not same["is_equal"]:
        raise BatchError(
            f"{target} was written, but holds {same['rows_after']} rows for {same['rows_before']} of the batch, "
            "or others than these"
        )


def _prepare(
    spark: SparkSession, source: str, target: str, stage_root: str, sep: str, max_errors: int
) -> tuple[LoadResult, DataFrame]:
    """What is known of the batch, and its rows, stored and ready to be appended."""
    layout = target_layout(spark, target)
    try:
        staged = stage_batch(spark, source, f"{stage_root}/lines", sep, layout)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise BatchError(f"batch {source} does not exist") from error
        raise

    profile = store_profile(staged, f"{stage_root}/profile")
    report = batch_report(profile).first()
    if not report["n_lines"]:
        raise BatchError(f"batch {source} is empty")
    if report["binary_lines"]:
        raise BatchError(f"batch {source} holds binary content in {report['binary_lines']} lines")

    rows = drop_headers(staged, profile)
    counts = quality.load_reconciliation(rows).first()
    headers = profile.agg(F.count("header_line").alias("n")).first()["n"]
    if counts["source_rows"] != report["n_lines"] - headers or not counts["is_balanced"]:
        raise BatchError(
            f"batch {source} has {report['n_lines']} lines, {headers} of them headers, but "
            f"{counts['accepted_rows']} accepted and {counts['rejected_rows']} rejected rows"
        )
    rejects_path = None
    if counts["rejected_rows"]:
        rejects_path = f"{stage_root}/rejects"
        (
            numbered(constraints.rejected(rows), line_splits(staged))
            .select("file", "line_no", "reasons", F.col("line").alias("raw"))
            .write.mode("overwrite")
            .parquet(rejects_path)
        )
    if counts["rejected_rows"] > max_errors:
        raise BatchError(
            f"{counts['rejected_rows']} of {counts['source_rows']} rows cannot be loaded, see {rejects_path}"
        )
    if not counts["accepted_rows"]:
        raise BatchError(f"batch {source} holds no loadable row")

    good = constraints.accepted(rows)
    existing = keys_between(read_target(spark, target), counts["first_date"], counts["last_date"])
    keys = (
        key_filter.batch_key_status(good, existing, counts["accepted_rows"])
        .agg(
            F.count_if(F.col("n_rows") > 1).alias("duplicates"),
            F.count_if(F.col("in_target") == 1).alias("conflicts"),
        )
        .first()
    )
    if keys["duplicates"] or keys["conflicts"]:
        raise BatchError(
            f"batch {source}: {keys['duplicates']} keys occur twice, "
            f"{keys['conflicts']} are in {target} already"
        )

    ready = store_ready(good, f"{stage_root}/ready")
    same = quality.content_reconciliation(source_rows(spark, source, sep, layout), ready).first()
    if not same["is_equal"]:
        raise BatchError(
            f"batch {source} holds {same['rows_before']} loadable rows, but the {same['rows_after']} made ready "
            "are not the same"
        )
    result = LoadResult(
        report,
        counts["source_rows"],
        counts["accepted_rows"],
        counts["rejected_rows"],
        0,
        counts["first_date"],
        counts["last_date"],
        rejects_path,
    )
    return result, ready


def store_ready(rows: DataFrame, path: str) -> DataFrame:
    """The typed rows as they will be appended, stored, so that they can be compared before they are."""
    rows.write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
