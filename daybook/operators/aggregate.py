"""Aggregates. Each scans its input once and combines inside the map tasks, so a
group that holds a third of all rows costs one partial row per task."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from daybook.functions import text
from daybook.functions.money import half_up_mean
from daybook.operators.expand import PART, PRICE_PARTS
from daybook.operators.project import with_revenue, with_run_time
from daybook.schema import DAILY_KEY


def daily_sales(sales: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """Sales by category, region and day.

    ``product_count`` counts rows with a product, not all rows; ``avg_price``
    is the plain mean over rows, not weighted by quantity. Sales with PRICE_PARTS
    are summed up by these, in whole numbers.
    """
    if set(PRICE_PARTS) <= set(sales.columns):
        sums, revenue, price = _sums_of_parts()
    else:
        sums = [F.sum("revenue").alias("revenue"), F.sum("price").alias("price"), F.count("price").alias("price_count")]
        revenue, price = F.col("revenue"), F.col("price")
    grouped = (
        with_run_time(with_revenue(sales), run_ts)
        .groupBy(*DAILY_KEY)
        .agg(
            F.sum("quantity_sold").alias("total_quantity"),
            F.count("product_id").alias("product_count"),
            *sums,
            F.max("processed_timestamp").alias("last_processed"),
        )
    )
    return grouped.select(
        *DAILY_KEY,
        "total_quantity",
        revenue.alias("total_revenue"),
        "product_count",
        half_up_mean(price, F.col("price_count"), 2).cast("decimal(22,2)").alias("avg_price"),
        "last_processed",
    )


def _sums_of_parts() -> tuple[list[Column], Column, Column]:
    """Sums of whole numbers, and total revenue and price as decimals made of them.

    No product leaves a bigint for any price and quantity, and the parts that are summed up are below
    2.4 * PART: like a sum of quantities, they hold for some billions of rows a group, and beyond end in an error.
    """
    high, low = (F.col(n) for n in PRICE_PARTS)
    quantity, part = F.col("quantity_sold"), F.lit(PART).cast("bigint")
    least = low * quantity
    rest = high * quantity + F.call_function("div", least, part)
    sums = {
        "revenue_low": least % part,
        "revenue_middle": rest % part,
        "revenue_high": F.call_function("div", rest, part),
        "price_high": high,
        "price_low": low,
    }

    def money(*names: str) -> Column:
        """The sums of these parts, the lowest first, as an amount with two places."""
        units = [F.lit(f"{PART**i / 100:.2f}" if not i else str(PART**i // 100)) for i in range(len(names))]
        kinds = ["decimal(2,2)", "decimal(8,0)", "decimal(17,0)"]
        amounts = [F.col(n).cast("decimal(20,0)") * u.cast(k) for n, u, k in zip(names, units, kinds, strict=False)]
        total = amounts[0].cast("decimal(38,2)")
        for amount in amounts[1:]:
            total = (total + amount.cast("decimal(38,2)")).cast("decimal(38,2)")
        return total

    columns = [F.sum(x).alias(n) for n, x in sums.items()] + [F.count(low).alias("price_count")]
    price = money("price_low", "price_high").cast("decimal(34,2)")
    return columns, money("revenue_low", "revenue_middle", "revenue_high"), price


def summary_state(daily: DataFrame) -> DataFrame:
    """What a batch adds to the summary: one row per category and region as they are spelled.

    States of several batches, unioned in any order, give the summary of all.
    """
    return daily.groupBy("category", "region").agg(
        F.count("*").alias("days_count"),
        F.sum("total_quantity").alias("total_quantity_all_days"),
        F.sum("total_revenue").cast("decimal(38,2)").alias("total_revenue_all_days"),
        F.sum("avg_price").cast("decimal(38,2)").alias("price_total"),
        F.count("avg_price").alias("price_count"),
        F.min("sale_date").alias("first_sale_date"),
        F.max("sale_date").alias("last_sale_date"),
    )


def sales_summary(daily: DataFrame) -> DataFrame:
    """One row per category and region over all days.

    Texts that the target holds for equal are one group, shown in the spelling that
    sorts first. The many rows are combined by their plain texts, which keeps
    the hash aggregate; the few groups meet afterwards.

    ``overall_avg_price`` is the mean of the daily means, each day weighing the
    same; that is the meaning of the view this replaces, not an oversight.
    """
    return summary_from_states(summary_state(daily))


def summary_from_states(states: DataFrame) -> DataFrame:
    """``sales_summary`` of all days that went into the states."""
    merged = states.groupBy(text.key_text(F.col("category")), text.key_text(F.col("region"))).agg(
        F.min("category").alias("category"),
        F.min("region").alias("region"),
        F.sum("days_count").alias("days_count"),
        F.sum("total_quantity_all_days").alias("total_quantity_all_days"),
        F.sum("total_revenue_all_days").cast("decimal(38,2)").alias("total_revenue_all_days"),
        F.sum("price_total").cast("decimal(38,2)").alias("price_total"),
        F.sum("price_count").alias("price_count"),
        F.min("first_sale_date").alias("first_sale_date"),
        F.max("last_sale_date").alias("last_sale_date"),
    )
    return merged.select(
        "category",
        "region",
        "days_count",
        "total_quantity_all_days",
        "total_revenue_all_days",
        half_up_mean(F.col("price_total"), F.col("price_count"), 6)
        .cast("decimal(38,6)")
        .alias("overall_avg_price"),
        "first_sale_date",
        "last_sale_date",
    )


def create_summary_view(daily: DataFrame, name: str = "sales_summary") -> None:
    sales_summary(daily).createOrReplaceTempView(name)


def load_verification(daily: DataFrame) -> DataFrame:
    return daily.agg(
        F.count("*").alias("record_count"),
        F.min("sale_date").alias("min_date"),
        F.max("sale_date").alias("max_date"),
    )


#: Registers of a sketch, as a power of two: a relative standard error of 1.04 / 2^6, 1.6 %.
SKETCH_BITS = 12
#: Three standard errors: what an estimate is expected to keep within.
SKETCH_ERROR = 3 * 1.04 / 2 ** (SKETCH_BITS / 2)


def distinct_state(rows: DataFrame, *columns: str) -> DataFrame:
    """One row of sketches, of some kilobytes each, that stand for the distinct values of ``columns``.

    Nulls don't count. Sketches of several batches unite without counting a value twice.
    """
    return rows.agg(*[F.hll_sketch_agg(F.col(c), F.lit(SKETCH_BITS)).alias(c) for c in columns])


def distinct_from_states(states: DataFrame) -> DataFrame:
    """About how many distinct values went into the states, in the columns of the sketches."""
    return states.agg(*[F.hll_sketch_estimate(F.hll_union_agg(F.col(c))).alias(c) for c in states.columns])


def pipeline_metrics(daily: DataFrame) -> DataFrame:
    """Four metrics as (metric, value) rows, every value as text.

    Grouping by both columns first leaves the exact distinct counts a handful of
    rows; counting them on the full table would triple it.
    """
    pairs = daily.groupBy("category", "region").agg(
        F.count("*").alias("n"),
        F.min("sale_date").alias("first"),
        F.max("sale_date").alias("last"),
    )
    totals = pairs.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
        F.countDistinct(text.key_text(F.col("category"))).alias("categories"),
        F.countDistinct(text.key_text(F.col("region"))).alias("regions"),
    )

    def day(name: str):
        return F.coalesce(F.col(name).cast("string"), F.lit(""))

    # The names of the metrics.
    return totals.select(
        F.stack(
            F.lit(4),
            F.lit("Total Records"),
            F.col("n").cast("string"),
            F.lit("Date Range"),
            F.concat(day("first"), F.lit(" to "), day("last")),
            F.lit("Categories"),
            F.col("categories").cast("string"),
            F.lit("Regions"),
            F.col("regions").cast("string"),
        ).alias("metric", "value")
    )
