"""Raw sales to a batch of daily aggregates in CSV."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from daybook.operators.aggregate import daily_sales
from daybook.operators.constraints import accepted, conform_export, rejected
from daybook.operators.expand import FIRST_DAY, expand_days
from daybook.operators.project import export_record
from daybook.plans.errors import BatchError
from daybook.schema import DAILY_WIDE
from daybook.sinks.files import write_csv
from daybook.sources import sales_csv
from daybook.sources.batches import batch_name


@dataclass(frozen=True)
class ExportResult:
    path: str
    rows: int
    rejected_rows: int
    rejects_path: str | None
    malformed_rows: int = 0
    malformed_path: str | None = None


def daily_batch(
    sales: DataFrame,
    run_ts: dt.datetime,
    num_days: int | None = 30,
    first_day: dt.date = FIRST_DAY,
    seed: int = 0,
    layout: T.StructType = DAILY_WIDE,
) -> DataFrame:
    """Daily aggregates in the types of ``layout`` with ``reasons``. ``num_days=None``
    takes the sales as they are."""
    if num_days is not None:
        sales = expand_days(sales, num_days, first_day, seed, price_parts=True)
    return conform_export(daily_sales(sales, run_ts), layout=layout)


def export_batch(
    spark: SparkSession,
    sales: DataFrame,
    out_root: str,
    stage_root: str,
    run_ts: dt.datetime,
    num_days: int | None = 30,
    first_day: dt.date = FIRST_DAY,
    seed: int = 0,
    max_errors: int = 0,
    layout: T.StructType = DAILY_WIDE,
) -> ExportResult:
    """Aggregate, check, then write the batch; too many bad rows stop it before
    any file of the batch exists.

    The checked aggregates are stored once, so the sales are read and shuffled
    once. The counts ride on that write: it is the job's last stage, in which a
    task that is run again is not counted again.
    """
    name = batch_name(run_ts)
    stage = f"{stage_root.rstrip('/')}/{name}.stage"
    counts = Observation()
    batch = daily_batch(sales, run_ts, num_days, first_day, seed, layout)
    bad = F.col("reasons") != ""
    batch.observe(
        counts, F.count("*").alias("rows"), F.count_if(bad).alias("bad_rows")
    ).write.mode("overwrite").parquet(stage)
    n_rows, n_bad = counts.get["rows"], counts.get["bad_rows"]

    stored = spark.read.parquet(stage)
    rejects_path = None
    if n_bad:
        rejects_path = f"{stage_root.rstrip('/')}/{name}.rejects"
        rejected(stored).write.mode("overwrite").parquet(rejects_path)
    if n_bad > max_errors:
        raise BatchError(f"{n_bad} of {n_rows} rows cannot be exported, see {rejects_path}")
    path = f"{out_root.rstrip('/')}/{name}"
    write_csv(export_record(accepted(stored)), path)
    return ExportResult(path, n_rows - n_bad, n_bad, rejects_path)


def export_files(
    spark: SparkSession,
    source: str,
    out_root: str,
    stage_root: str,
    run_ts: dt.datetime,
    num_days: int | None = 30,
    first_day: dt.date = FIRST_DAY,
    seed: int = 0,
    max_errors: int = 0,
    layout: T.StructType = DAILY_WIDE,
) -> ExportResult:
    """``export_batch`` from raw files.

    Malformed lines are stored with their reasons and counted; together with the
    aggregates that cannot be exported they may be ``max_errors``. The files are
    scanned twice, once for the malformed lines, which is less than a copy of them all.
    """
    scan = sales_csv.read_sales_csv(spark, source)
    path = f"{stage_root.rstrip('/')}/{batch_name(run_ts)}.malformed"
    counts = Observation()
    sales_csv.malformed(scan).observe(counts, F.count("*").alias("rows")).write.mode("overwrite").parquet(path)
    n_bad = counts.get["rows"]
    if n_bad > max_errors:
        raise BatchError(f"{n_bad} malformed rows in {source}, see {path}")
    done = export_batch(
        spark,
        sales_csv.well_formed(scan),
        out_root,
        stage_root,
        run_ts,
        num_days,
        first_day,
        seed,
        max_errors - n_bad,
        layout,
    )
    return replace(done, malformed_rows=n_bad, malformed_path=path if n_bad else None)
