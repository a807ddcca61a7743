"""The eight-field daily layout in delimited text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from daybook.schema import CORRUPT, DAILY, DAILY_TEXT, with_corrupt
from daybook.sources.csv_options import csv_options


def read_daily(spark: SparkSession, path: str, sep: str = "|", header: bool = False) -> DataFrame:
    """Typed scan of files this library wrote. Foreign files go through the load
    job, which says why a row was refused."""
    return spark.read.options(**csv_options(sep, header)).option("mode", "FAILFAST").schema(DAILY).csv(path)


def read_daily_text(spark: SparkSession, path: str, sep: str = ",", header: bool = True) -> DataFrame:
    """The same eight fields, left as text."""
    return spark.read.options(**csv_options(sep, header)).schema(DAILY_TEXT).csv(path)


def split_fields(line: Column, sep: str) -> Column:
    """One line as a struct of eight text fields; a line with more or fewer keeps
    itself in ``_corrupt_record``."""
    ddl = ", ".join(f"{f.name} string" for f in with_corrupt(DAILY_TEXT))
    return F.from_csv(
        line, ddl, {**csv_options(sep), "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    )
