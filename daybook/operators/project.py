"""Row-wise steps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from daybook.functions import dates, money, text
from daybook.schema import DAILY

# What stands in for a missing field.
DEFAULTS = {
    "product_id": 1,
    "product_name": "Unknown Product",
    "category": "General",
    "price": 0.0,
    "quantity_sold": 1,
    "customer_id": 1000,
    "region": "Unknown",
}


def with_sale_date(rows: DataFrame, column: str = "sale_date") -> DataFrame:
    """Text to date; unreadable text becomes null, for a later check to report."""
    return rows.withColumn(column, dates.parse_day(F.col(column)))


def with_revenue(sales: DataFrame) -> DataFrame:
    return sales.withColumn("revenue", money.line_revenue(F.col("price"), F.col("quantity_sold")))


def with_run_time(sales: DataFrame, run_ts: dt.datetime) -> DataFrame:
    return sales.withColumn("processed_timestamp", dates.run_time(run_ts))


def fill_defaults(sales: DataFrame) -> DataFrame:
    return sales.fillna({k: v for k, v in DEFAULTS.items() if k in sales.columns})


def export_record(daily: DataFrame) -> DataFrame:
    """The eight fields as they go into a file: all text, nulls spelled out."""
    as_text = {
        "sale_date": dates.day_text(F.col("sale_date")),
        "total_revenue": money.round_money(F.col("total_revenue")),
        "avg_price": money.round_money(F.col("avg_price")),
        "last_processed": dates.instant_text(F.col("last_processed")),
    }
    return daily.select(
        *[text.null_sentinel(as_text.get(name, F.col(name))).alias(name) for name in DAILY.names]
    )


def preview(rows: DataFrame, n: int = 10) -> DataFrame:
    """Any ``n`` rows."""
    return rows.limit(n)


def tail_by_key(rows: DataFrame, n: int, *keys: str) -> DataFrame:
    """The last ``n`` rows in key order, newest first; a top-n, not a full sort."""
    return rows.orderBy(*[F.col(k).desc() for k in keys]).limit(n)
