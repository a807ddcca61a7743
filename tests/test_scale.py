"""Plans and skew: what has to hold when the tables no longer fit one machine."""

import datetime as dt
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from daybook.operators import aggregate, constraints
from daybook.operators.expand import expand_days
from daybook.plans.load_job import checked_lines
from daybook.sources import lines, star


@contextmanager
def settings(spark, **conf):
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """Star tables in which one part and one order hold a third of the lines."""
    root = tmp_path_factory.mktemp("skewed")
    n = 60000
    hot = F.col("id") % 3 == 0
    spark.range(0, n, 1, 6).select(
        F.when(hot, 7).otherwise(F.col("id") % 2000).alias("l_orderkey"),
        F.when(hot, 5).otherwise(F.col("id") % 500).alias("l_partkey"),
        F.lit(1).alias("l_linenumber"),
        (F.col("id") % 50 + 1).cast("double").alias("l_quantity"),
        F.expr("timestamp_ntz '1998-01-01 00:00:00' + make_dt_interval(cast(id % 40 as int))").alias("l_shipdate"),
    ).write.parquet(f"{root}/lineitem.parquet")
    spark.range(2000).select(
        F.col("id").alias("o_orderkey"), (F.col("id") % 90).alias("o_custkey")
    ).write.parquet(f"{root}/orders.parquet")
    spark.range(90).select(
        F.col("id").alias("c_custkey"), (F.col("id") % 25).cast("int").alias("c_nationkey")
    ).write.parquet(f"{root}/customer.parquet")
    spark.range(25).select(
        F.col("id").cast("int").alias("n_nationkey"), (F.col("id") % 5).cast("int").alias("n_regionkey")
    ).write.parquet(f"{root}/nation.parquet")
    spark.range(5).select(
        F.col("id").cast("int").alias("r_regionkey"), F.concat(F.lit("R"), "id").alias("r_name")
    ).write.parquet(f"{root}/region.parquet")
    spark.range(500).select(
        F.col("id").alias("p_partkey"),
        F.concat(F.lit("part "), "id").alias("p_name"),
        F.concat(F.lit("T"), F.col("id") % 6).alias("p_type"),
        (F.col("id") * 1.5 + 900).cast("double").alias("p_retailprice"),
    ).write.parquet(f"{root}/part.parquet")
    return str(root)


def test_hot_part_and_order_are_split(spark, skewed, run_ts):
    expected = sorted(map(str, aggregate.daily_sales(star.sales_fact(spark, skewed), run_ts).collect()))
    with settings(
        spark,
        **{
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.shuffle.partitions": "8",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        },
    ):
        daily = aggregate.daily_sales(star.sales_fact(spark, skewed), run_ts)
        assert sorted(map(str, daily.collect())) == expected
        plan = plan_of(daily)
    assert plan.count("SortMergeJoin(skew=true)") >= 2
    assert "BroadcastExchange" not in plan and "CartesianProduct" not in plan


def test_daily_reads_only_what_it_needs(spark, skewed, run_ts):
    plan = plan_of(aggregate.daily_sales(star.sales_fact(spark, skewed), run_ts))
    assert "p_name" not in plan and "l_linenumber" not in plan
    assert "PushedFilters: [IsNotNull(l_partkey), IsNotNull(l_orderkey)]" in plan


def test_expansion_adds_nothing_to_the_shuffle(spark, skewed, run_ts):
    """Thirty times the rows, but what moves is bounded by groups per task."""
    sales = star.sales_fact(spark, skewed)
    plan = plan_of(aggregate.daily_sales(expand_days(sales, 30), run_ts))
    assert plan.index("Exchange hashpartitioning(category") < plan.index("partial_sum") < plan.index("explode")


def test_date_filter_reaches_the_scan(spark, skewed, run_ts):
    daily = constraints.conform_daily(aggregate.daily_sales(star.sales_fact(spark, skewed), run_ts))
    recent = constraints.accepted(daily).filter(F.col("sale_date") > dt.date(1998, 1, 20))
    assert "GreaterThanOrEqual(l_shipdate" in plan_of(recent) or "GreaterThan(l_shipdate" in plan_of(recent)


def test_lines_are_parsed_once(spark, tmp_path):
    (tmp_path / "in.txt").write_text("x|y\n")
    rejected = constraints.rejected(checked_lines(lines.read_lines(spark, str(tmp_path / "in.txt")), "|"))
    with settings(spark, **{"spark.sql.debug.maxToStringFields": "1000"}):
        plan = plan_of(rejected)
    assert plan.count("from_csv(") == 1 and plan.count("try_cast(") == 6
    assert "Exchange" not in plan


def test_key_check_has_one_shuffle_and_no_join(spark, skewed, run_ts):
    daily = constraints.accepted(
        constraints.conform_daily(aggregate.daily_sales(star.sales_fact(spark, skewed), run_ts))
    )
    stored = daily.limit(0).unionAll(daily)
    plan = plan_of(constraints.key_conflicts(stored, stored))
    assert plan.count("Exchange hashpartitioning(category_key") == 1
    assert "LeftSemi" not in plan
