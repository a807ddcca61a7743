"""Which target rows can hold a key of the batch, told at the target's scan.

The batch's keys are hashed twice into a bit map, made by aggregation: a row per
32,768 bits. It has a bounded size, so it is broadcast, and the target's rows
are tested where they are read; what passes is a small share of the rows without a key
of the batch, and all with one. An exact comparison has to follow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from daybook.operators.constraints import key_status, normal_key

#: Bits for each key, where about one in seventy other rows passes; and at most.
BITS_PER_KEY, MAX_BITS = 16, 1 << 30
# Fixed value: bits of one row of a bit map.
ROW_BITS = 32_768
_SEEDS = (1, 2)


def _position(seed: int, bits: int) -> Column:
    """From 1 on; null for a key with a null, which equals no other."""
    keys = ["category_key", "region_key", "sale_date"]
    known = F.col(keys[0]).isNotNull() & F.col(keys[1]).isNotNull() & F.col(keys[2]).isNotNull()
    return F.when(known, F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(bits)) + 1)


def filter_bits(n_keys: int) -> int | None:
    """Size of the bit map, a power of two; None where the bound leaves it no use."""
    bits = ROW_BITS
    while bits < min(n_keys * BITS_PER_KEY, MAX_BITS):
        bits *= 2
    return bits if n_keys * BITS_PER_KEY <= 4 * bits else None


def key_filter(batch: DataFrame, bits: int) -> DataFrame:
    """``bucket, bits``: the bit map of the batch's keys, ``bits / 32768`` rows of 4 kB at most."""
    positions = batch.select(*normal_key()).select(F.explode(F.array(*[_position(s, bits) for s in _SEEDS])).alias("at"))
    return (
        positions.where("at is not null")
        .groupBy(F.bitmap_bucket_number("at").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    )


def _is_set(place: Column) -> Column:
    byte = F.substring(F.col("bits"), (F.floor(place / 8) + 1).cast("int"), F.lit(1))
    return F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), F.pmod(place, F.lit(8)).cast("int")) == 1


def possible_rows(target: DataFrame, keys: DataFrame, bits: int) -> DataFrame:
    """Rows of ``target`` that may hold a key of ``keys``, made by ``key_filter`` with as many ``bits``.

    ``keys`` is no larger than ``bits`` say, an eighth of a gigabyte at most, and is broadcast.
    """
    names = ["category_key", "region_key", "sale_date"]
    keyed = target.select(F.struct(*target.columns).alias("row"), *normal_key())
    for seed in _SEEDS:
        at = keyed.select("row", *names, _position(seed, bits).alias("at"))
        met = at.withColumn("bucket", F.bitmap_bucket_number("at")).join(F.broadcast(keys), "bucket")
        keyed = met.where(_is_set(F.bitmap_bit_position("at"))).select("row", *names)
    return keyed.select(*[F.col("row").getField(c).alias(c) for c in target.columns])


def batch_key_status(batch: DataFrame, target: DataFrame, n_keys: int) -> DataFrame:
    """``key_status``, for which only the target's possible rows leave their scan.

    ``n_keys`` is about how many rows the batch has. So many that no filter helps are
    compared with the whole target.
    """
    bits = filter_bits(n_keys)
    if bits is None:
        return key_status(batch, target)
    return key_status(batch, possible_rows(target, key_filter(batch, bits), bits))
