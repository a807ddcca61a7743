import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from daybook.functions import dates, money, noise, text


def one(spark, ddl, value, *columns):
    return spark.createDataFrame([(value,)], ddl).select(*columns).first()


def test_half_up_mean_rounds_ties_up(spark):
    rows = [(Decimal("960.97"),), (Decimal("960.98"),)]
    df = spark.createDataFrame(rows, "p decimal(18,2)")
    mean = money.half_up_mean(F.sum("p"), F.count("p"), 2)
    assert df.agg(mean.alias("m")).first()["m"] == Decimal("960.98")


def test_half_up_mean_rounds_once(spark):
    """2,500,001 into ...: six places first would already lift this to the next cent."""
    n = 2_500_001
    total = Decimal(n // 2) / 100  # mean is just under half a cent
    row = spark.sql(f"SELECT cast({total} AS decimal(28,2)) AS t, cast({n} AS bigint) AS n")
    assert row.select(money.half_up_mean(F.col("t"), F.col("n"), 2)).first()[0] == 0
    assert row.select(F.round(F.round(F.col("t") / F.col("n"), 6), 2)).first()[0] == Decimal("0.01")


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    cents=st.integers(-(10**20), 10**20),
    n=st.integers(1, 10**9),
    scale=st.sampled_from([2, 6]),
)
def test_half_up_mean_is_exact(spark, cents, n, scale):
    df = spark.sql(f"SELECT cast({cents} AS decimal(26,0)) * 0.01BD AS t, cast({n} AS bigint) AS n").select(
        F.col("t").cast("decimal(28,2)").alias("t"), "n"
    )
    if abs(cents) // n >= 10**18:
        return
    twice = 2 * abs(cents) * 10**scale
    ticks = (twice + 100 * n) // (200 * n)
    expected = Decimal(-ticks if cents < 0 else ticks).scaleb(-scale)
    assert df.select(money.half_up_mean(F.col("t"), F.col("n"), scale)).first()[0] == expected


def test_half_up_mean_of_nothing_is_null(spark):
    df = spark.createDataFrame([(None,)], "p decimal(18,2)")
    assert df.agg(money.half_up_mean(F.sum("p"), F.count("p"), 2)).first()[0] is None


def test_round_money(spark):
    cases = {"1.005": "1.01", "960.975": "960.98", "-2.675": "-2.68", "3": "3.00"}
    for given_text, expected in cases.items():
        value = one(spark, "x string", given_text, money.round_money(F.col("x").cast("decimal(20,6)")))[0]
        assert value == Decimal(expected)
        assert value == Decimal(given_text).quantize(Decimal("0.01"), ROUND_HALF_UP)


def test_null_sentinel_keeps_ansi_quiet(spark):
    df = spark.createDataFrame([(None, None, 5)], "a int, b decimal(18,2), c int")
    row = df.select(*[text.null_sentinel(F.col(c)).alias(c) for c in df.columns]).first()
    assert tuple(row) == ("NULL", "NULL", "5")


def test_parse_day(spark):
    good = {"2024-02-29": dt.date(2024, 2, 29)}
    bad = ["2024-13-40", "2024-1-5", "2023-02-29", " 2024-01-05", "2024-01-05T00", "2024-01-05\n", "", None]
    for value in [*good, *bad]:
        assert one(spark, "x string", value, dates.parse_day(F.col("x")))[0] == good.get(value)


def test_parse_instant_and_back(spark):
    moment = "2024-03-31 02:30:05"
    assert one(spark, "x string", moment, dates.parse_instant(F.col("x")))[0] == dt.datetime(2024, 3, 31, 2, 30, 5)
    assert one(spark, "x string", moment, dates.instant_text(dates.parse_instant(F.col("x"))))[0] == moment
    for bad in ("2024-03-31", "2024-03-31 2:30:05", "2024-03-31 02:30:05Z", "2024-03-31 25:00:00", "yesterday"):
        assert one(spark, "x string", bad, dates.parse_instant(F.col("x")))[0] is None


def test_times_do_not_depend_on_the_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        # 02:30 does not exist on this day in this zone.
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        shown = one(spark, "x string", "2024-03-10 02:30:00", dates.instant_text(dates.parse_instant(F.col("x"))))
        assert shown[0] == "2024-03-10 02:30:00"
        assert one(spark, "x int", 1, dates.instant_text(dates.run_time(dt.datetime(2024, 3, 10, 2, 30))))[0] == (
            "2024-03-10 02:30:00"
        )
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_line_inspection(spark):
    c = F.col("x")
    assert one(spark, "x string", "a|b|c", text.separator_count(c, "|"))[0] == 2
    assert one(spark, "x string", "é|ü", text.separator_count(c, "|"))[0] == 1
    assert one(spark, "x string", "a\x00b", text.has_nul(c), text.strip_nul(c), text.looks_binary(c))[:] == (
        True,
        "ab",
        False,
    )
    assert one(spark, "x string", "a\r", text.has_carriage_return(c), text.looks_binary(c))[:] == (True, False)
    assert one(spark, "x string", "a\x07", text.looks_binary(c))[0] is True
    assert one(spark, "x string", "tab\tand é", text.looks_binary(c))[0] is False
    assert one(spark, "x binary", bytearray(b"caf\xe9"), text.looks_binary(c.cast("string")))[0] is True
    assert one(spark, "x string", "Category,REGION,sale_date,n", text.looks_like_header(c))[0] is True
    assert one(spark, "x string", "sale_date,region,category", text.looks_like_header(c))[0] is False


def test_noise_stays_in_range(spark):
    df = spark.range(20000).select(
        noise.mix(noise.row_key(F.col("id"), F.col("id") * 7, F.lit("2024-01-01").cast("date"), 3)).alias("n")
    )
    low, high, distinct = df.agg(F.min("n"), F.max("n"), F.countDistinct("n")).first()
    assert 0 <= low < high < noise.PRIME
    assert distinct > 19900


def test_length_in_utf16_units(spark):
    rows = spark.createDataFrame([("ab",), ("\U0001f600" * 30,), ("",), (None,)], "v string")
    lengths = [r[0] for r in rows.select(text.utf16_length(rows["v"])).collect()]
    assert lengths == [2, 60, 0, None]
