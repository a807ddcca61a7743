"""Repeatable pseudo-random variation from a row's own values.

A retried task must produce the same rows, which an unseeded generator cannot
promise. Multiplication modulo the prime 2^31 - 1 mixes the key well, stays
inside a bigint, and reads the same in any SQL dialect.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

PRIME = 2147483647
MULTIPLIER = 48271


def mix(value: Column) -> Column:
    return F.pmod(value * F.lit(MULTIPLIER) + F.lit(1), F.lit(PRIME))


def row_key(product_id: Column, customer_id: Column, day: Column, seed: int) -> Column:
    days = F.datediff(day, F.lit("1970-01-01").cast("date")).cast("bigint")
    return F.pmod(
        product_id.cast("bigint") * 7919
        + customer_id.cast("bigint") * 104729
        + days * 1299709
        + F.lit(seed),
        F.lit(PRIME),
    )
