"""Exact money arithmetic on decimals."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from daybook.schema import MONEY


def line_revenue(price: Column, quantity: Column) -> Column:
    """Price times quantity, exact: decimal(22,6) by int is decimal(33,6)."""
    return price * quantity


def round_money(amount: Column) -> Column:
    """Half-up to two places, as decimal(18,2)."""
    return F.round(amount, 2).cast(MONEY)


def half_up_mean(total: Column, n: Column, scale: int) -> Column:
    """``total / n`` rounded half-up at ``scale`` places, in a single rounding.

    ``avg`` over decimals rounds at six places already, and rounding that again
    turns x.xx4999999 into the next cent once a group holds millions of rows.
    The whole part and the remainder are both exact, so only the last step rounds.
    """
    n = F.nullif(n, F.lit(0))
    whole = F.call_function("div", total, n)
    rest = F.abs(total % n)
    unit = 10**scale
    ticks = F.call_function("div", rest * F.lit(2 * unit) + n, n * 2)
    signed = F.when(total < 0, -ticks).otherwise(ticks).cast("decimal(20,0)")
    return whole.cast("decimal(20,0)") + signed * F.lit(f"{1 / unit:.{scale}f}").cast(
        f"decimal({scale},{scale})"
    )
