"""Row expansion over a run of days."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F, types as T

from daybook.functions import noise
from daybook.operators.project import fill_defaults
from daybook.schema import MONEY, RAW_SALES

# First day, and the ranges of the variation.
FIRST_DAY = dt.date(2024, 1, 1)
QUANTITY_NOISE = (-10, 20)
PRICE_NOISE = (9000, 11000)  # in ten-thousandths
PRICE_UNIT = 10_000
CUSTOMER_OFFSET = (0, 1000)


#: The varied price in whole numbers, high * PART + low hundredths, signs included.
PRICE_PARTS = ("_price_high", "_price_low")
PART = 10**9


def expand_days(
    sales: DataFrame,
    num_days: int = 30,
    first_day: dt.date = FIRST_DAY,
    seed: int = 0,
    price_parts: bool = False,
) -> DataFrame:
    """Every row once per day, with varied quantity, price and customer.

    The rows as given are not kept, so no days give no rows. Each row unrolls a constant list of days
    where it is read, so nothing is shuffled, broadcast or collected, and an
    aggregate above it combines the copies before they leave the task.

    Quantity, price and customer are wider than they came, so the largest values
    vary like any other; a later check reports what does not fit.

    ``price_parts`` adds PRICE_PARTS where the price has two places in 18 digits and the
    quantity is an int: a sum of these is exact, and takes a fraction of a wide decimal's time.
    """
    last_day = first_day + dt.timedelta(days=max(num_days, 1) - 1)
    filled = fill_defaults(sales.select(*[c for c in RAW_SALES.names if c != "sale_date"]))
    kinds = filled.schema
    in_parts = price_parts and kinds["price"].dataType == MONEY and kinds["quantity_sold"].dataType == T.IntegerType()
    if in_parts:
        # Once for each row, below the days.
        filled = filled.withColumn("cents", (F.col("price") * 100).cast("bigint")).withColumns(
            {
                "sign": F.signum("cents").cast("bigint"),
                "cents_high": F.abs(F.call_function("div", F.col("cents"), F.lit(PART))),
                "cents_low": F.abs(F.col("cents") % PART),
            }
        )
    days = filled.withColumn(
        "sale_date",
        F.explode(F.sequence(F.lit(first_day), F.lit(last_day), F.expr("interval 1 day"))),
    )

    if num_days < 1:
        days = days.limit(0)

    def within(draw: str, bounds: tuple[int, int]):
        low, high = bounds
        return F.pmod(F.col(draw), F.lit(high - low + 1)) + F.lit(low)

    drawn = (
        days.withColumn(
            "draw_q",
            noise.mix(noise.row_key(F.col("product_id"), F.col("customer_id"), F.col("sale_date"), seed)),
        )
        .withColumn("draw_p", noise.mix(F.col("draw_q")))
        .withColumn("draw_c", noise.mix(F.col("draw_p")))
    )
    quantity = F.col("quantity_sold").cast("bigint") + within("draw_q", QUANTITY_NOISE)
    ticks = within("draw_p", PRICE_NOISE)
    factor = (ticks.cast("decimal(5,0)") * F.lit("0.0001").cast("decimal(4,4)"))
    parts = []
    if in_parts:
        high = F.col("cents_high") * ticks
        low = (high % PRICE_UNIT) * PART + F.col("cents_low") * ticks + PRICE_UNIT // 2
        whole = {n: F.call_function("div", x, F.lit(PRICE_UNIT).cast("bigint")) for n, x in zip(PRICE_PARTS, (high, low), strict=True)}
        parts = [(F.col("sign") * x).alias(n) for n, x in whole.items()]
    return drawn.select(
        "product_id",
        "product_name",
        "category",
        F.round(F.col("price") * factor, 2).cast("decimal(24,2)").alias("price"),
        F.greatest(F.lit(1).cast("bigint"), quantity).alias("quantity_sold"),
        "sale_date",
        (F.col("customer_id").cast("bigint") + within("draw_c", CUSTOMER_OFFSET)).alias("customer_id"),
        "region",
        *parts,
    )
