"""Expected values are computed by hand or with Python decimals, not with Spark."""

import datetime as dt
import itertools
import re
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F, types as T

from daybook.operators import aggregate, project
from daybook.operators.expand import expand_days
from daybook.plans.export_job import daily_batch
from daybook.schema import MONEY, RAW_SALES

D = dt.date
SALES = [
    (1, "Lamp", "Home", Decimal("19.99"), 3, D(2024, 5, 1), 11, "Asia"),
    (2, "Desk", "Home", Decimal("150.00"), 1, D(2024, 5, 1), 12, "Asia"),
    (None, "Rug", "Home", Decimal("80.10"), 2, D(2024, 5, 1), 13, "Asia"),
    (4, "Pot", "Garden", None, 5, D(2024, 5, 1), 14, "Europe"),
    (5, "Hose", "Garden", Decimal("960.97"), None, D(2024, 5, 2), 15, "Europe"),
    (6, "Rake", "Garden", Decimal("960.98"), 1, D(2024, 5, 2), 16, "Europe"),
    (7, "Rake", "Garden", Decimal("12.00"), 4, D(2024, 5, 4), 16, "Europe"),
]


@pytest.fixture
def sales(spark):
    return spark.createDataFrame(SALES, RAW_SALES)


def test_daily_sales(sales, run_ts):
    got = {(r.category, r.region, r.sale_date): r for r in aggregate.daily_sales(sales, run_ts).collect()}
    home = got["Home", "Asia", D(2024, 5, 1)]
    assert (home.total_quantity, home.total_revenue) == (6, Decimal("370.17"))
    # The row without a product counts for the sums, not for the product count.
    assert (home.product_count, home.avg_price) == (2, Decimal("83.36"))
    assert home.last_processed == run_ts
    no_price = got["Garden", "Europe", D(2024, 5, 1)]
    assert (no_price.total_quantity, no_price.total_revenue, no_price.avg_price) == (5, None, None)
    tie = got["Garden", "Europe", D(2024, 5, 2)]
    assert (tie.avg_price, tie.total_quantity, tie.total_revenue) == (Decimal("960.98"), 1, Decimal("960.98"))


def test_summary_weighs_days_equally(sales, run_ts):
    rows = aggregate.sales_summary(aggregate.daily_sales(sales, run_ts)).collect()
    garden = next(r for r in rows if r.category == "Garden")
    assert (garden.days_count, garden.total_quantity_all_days) == (3, 10)
    assert garden.total_revenue_all_days == Decimal("1008.98")
    assert garden.overall_avg_price == Decimal("486.490000")
    assert (garden.first_sale_date, garden.last_sale_date) == (D(2024, 5, 1), D(2024, 5, 4))


def test_summary_view(spark, sales, run_ts):
    aggregate.create_summary_view(aggregate.daily_sales(sales, run_ts), "summary_under_test")
    assert spark.table("summary_under_test").count() == 2


def test_metrics(sales, run_ts):
    got = {r.metric: r.value for r in aggregate.pipeline_metrics(aggregate.daily_sales(sales, run_ts)).collect()}
    assert got == {
        "Total Records": "4",
        "Date Range": "2024-05-01 to 2024-05-04",
        "Categories": "2",
        "Regions": "2",
    }


def test_metrics_of_an_empty_table(spark, run_ts):
    empty = aggregate.daily_sales(spark.createDataFrame([], RAW_SALES), run_ts)
    got = {r.metric: r.value for r in aggregate.pipeline_metrics(empty).collect()}
    assert got == {"Total Records": "0", "Date Range": " to ", "Categories": "0", "Regions": "0"}
    assert aggregate.load_verification(empty).first()[:] == (0, None, None)


def test_sums_are_kept(sales, run_ts):
    daily = aggregate.daily_sales(sales, run_ts).agg(F.sum("total_quantity"), F.sum("total_revenue")).first()
    raw = project.with_revenue(sales).agg(F.sum("quantity_sold"), F.sum("revenue")).first()
    assert tuple(daily) == tuple(raw)


@pytest.mark.parametrize("partitions", ["1", "3", "16"])
def test_partitions_do_not_matter(spark, sales, run_ts, partitions):
    expected = sorted(map(str, aggregate.daily_sales(expand_days(sales, 5), run_ts).collect()))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        got = aggregate.daily_sales(expand_days(sales.repartition(7), 5), run_ts).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted(map(str, got)) == expected


def test_expand_matches_plain_python(sales):
    prime = 2147483647

    def mix(x):
        return (x * 48271 + 1) % prime

    expected = defaultdict(int)
    for pid, name, category, price, quantity, _, customer, region in SALES:
        pid, price, quantity = pid or 1, price or Decimal(0), quantity or 1
        for i in range(9):
            day = D(2024, 1, 1) + dt.timedelta(days=i)
            q = mix((pid * 7919 + customer * 104729 + (day - D(1970, 1, 1)).days * 1299709 + 42) % prime)
            p = mix(q)
            c = mix(p)
            new_price = (price * (9000 + p % 2001) / 10000).quantize(Decimal("0.01"), ROUND_HALF_UP)
            expected[
                pid, name, category, new_price, max(1, quantity + q % 31 - 10), day, customer + c % 1001, region
            ] += 1
    got = defaultdict(int)
    for row in expand_days(sales, 9, seed=42).collect():
        got[tuple(row)] += 1
    assert got == expected


def test_expand_fills_gaps_and_respects_bounds(spark):
    gaps = spark.createDataFrame([(None,) * 8], RAW_SALES)
    rows = expand_days(gaps, 30).collect()
    assert len(rows) == 30 and len({r.sale_date for r in rows}) == 30
    for r in rows:
        assert (r.product_id, r.product_name, r.category, r.region) == (1, "Unknown Product", "General", "Unknown")
        assert r.price == 0 and 1 <= r.quantity_sold <= 21 and 1000 <= r.customer_id <= 2000
    assert expand_days(gaps, 0).count() == 0


def test_sums_of_price_parts_are_exact(spark, run_ts):
    """The batch sums no wide decimals, and gives what they would, up to the largest prices and quantities."""
    prices = ["0.00", "0.01", "-0.05", "12.34", "-999.99", "9999999.99", "10000000.01", "-12345678901234.56"]
    prices += ["9999999999999999.99", "-9999999999999999.99", None]
    amounts = [1, 2147483647, -2147483648, 17, None]
    rows = [
        (i, "n", f"c{i % 3}", p and Decimal(p), q, None, 7 * i, "r") for i, (p, q) in enumerate(itertools.product(prices, amounts))
    ]
    layout = T.StructType([T.StructField(f.name, MONEY if f.name == "price" else f.dataType) for f in RAW_SALES])
    sales = spark.createDataFrame(rows, layout)
    plain = aggregate.daily_sales(expand_days(sales, 6), run_ts)
    parts = aggregate.daily_sales(expand_days(sales, 6, price_parts=True), run_ts)
    assert [(f.name, f.dataType) for f in parts.schema] == [(f.name, f.dataType) for f in plain.schema]
    assert sorted(map(str, parts.collect())) == sorted(map(str, plain.collect()))
    plan = daily_batch(sales, run_ts, 6)._jdf.queryExecution().optimizedPlan().toString()
    summed = re.findall(r"sum\(([^()]*#\d+L?)\)", plan)
    assert summed and all(x.endswith("L") for x in summed), plan
    # Prices of another type go the plain way.
    wide = sales.withColumn("price", F.col("price").cast("decimal(22,6)"))
    assert set(expand_days(wide, 2, price_parts=True).columns) == set(sales.columns)


def test_expand_needs_no_shuffle(sales, capsys):
    expand_days(sales, 30).explain()
    plan = capsys.readouterr().out
    assert "Exchange" not in plan and "Join" not in plan


def test_tail_and_preview(sales):
    assert [r.product_id for r in project.tail_by_key(sales, 2, "sale_date", "product_id").collect()] == [7, 6]
    assert project.preview(sales, 3).count() == 3
