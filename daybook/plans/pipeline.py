"""Export, find the newest batch, load it, report."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from daybook.operators.aggregate import pipeline_metrics
from daybook.operators.expand import FIRST_DAY
from daybook.plans.errors import BatchError
from daybook.plans.export_job import ExportResult, export_batch, export_files
from daybook.plans.load_job import LoadResult, load_batch
from daybook.sources.batches import latest_batch
from daybook.sources.table import read_target


@dataclass(frozen=True)
class PipelineConfig:
    out_root: str
    stage_root: str
    target: str
    run_ts: dt.datetime
    num_days: int | None = 30
    first_day: dt.date = FIRST_DAY
    seed: int = 0
    max_errors: int = 0


@dataclass(frozen=True)
class PipelineResult:
    exported: ExportResult
    loaded: LoadResult
    metrics: DataFrame


def run_export(spark: SparkSession, sales: DataFrame | str, config: PipelineConfig) -> ExportResult:
    """``sales`` is a frame, or the path of raw files."""
    export = export_files if isinstance(sales, str) else export_batch
    return export(
        spark,
        sales,
        config.out_root,
        f"{config.stage_root.rstrip('/')}/export",
        config.run_ts,
        config.num_days,
        config.first_day,
        config.seed,
        config.max_errors,
    )


def run_load(spark: SparkSession, config: PipelineConfig) -> LoadResult:
    newest = latest_batch(spark, config.out_root)
    if newest is None:
        raise BatchError(f"no batch below {config.out_root}")
    return load_batch(
        spark,
        newest,
        config.target,
        f"{config.stage_root.rstrip('/')}/load/{newest.rstrip('/').rsplit('/', 1)[-1]}",
        max_errors=config.max_errors,
    )


def run_pipeline(spark: SparkSession, sales: DataFrame | str, config: PipelineConfig) -> PipelineResult:
    """Both stages and the metrics of the target. An error in either stops the run."""
    exported = run_export(spark, sales, config)
    loaded = run_load(spark, config)
    return PipelineResult(exported, loaded, pipeline_metrics(read_target(spark, config.target)))
