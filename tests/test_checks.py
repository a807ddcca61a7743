import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F, types as T

from daybook.operators import constraints as c, quality
from daybook.operators.project import export_record, fill_defaults
from daybook.plans.load_job import checked_lines
from daybook.schema import DAILY, DAILY_TEXT, RAW_SALES
from daybook.sinks.files import unquotable
from daybook.sources import lines

TS = "2024-02-01 06:30:00"
GOOD = ("Home", "Asia", "2024-05-01", "3", "59.97", "1", "19.99", TS)
WIDE = T.StructType(
    [T.StructField(f.name, {"total_quantity": T.LongType(), "product_count": T.LongType()}.get(
        f.name, T.DecimalType(38, 2) if f.name == "total_revenue" else f.dataType)) for f in DAILY]
)


def text_row(**changes):
    return tuple({**dict(zip(DAILY.names, GOOD)), **changes}.values())


CASES = [
    ({}, ""),
    ({"category": None}, "null:category"),
    ({"category": "x" * 50}, ""),
    ({"category": "x" * 51}, "too_long:category"),
    ({"region": "x" * 51}, "too_long:region"),
    ({"region": ""}, "empty:region"),
    ({"category": ""}, ""),
    ({"sale_date": "2024-13-40"}, "unreadable:sale_date"),
    ({"sale_date": "2024-1-5"}, "unreadable:sale_date"),
    ({"sale_date": None}, "null:sale_date"),
    ({"total_quantity": "-1"}, "negative:total_quantity"),
    ({"total_quantity": "0"}, ""),
    ({"total_quantity": "2147483648"}, "unreadable:total_quantity"),
    ({"total_revenue": "-0.01"}, "negative:total_revenue"),
    ({"total_revenue": "1" + "0" * 16}, "unreadable:total_revenue"),
    ({"product_count": "0"}, "not_positive:product_count"),
    ({"avg_price": "-1"}, "negative:avg_price"),
    ({"avg_price": "abc", "last_processed": "soon"}, "unreadable:avg_price,unreadable:last_processed"),
    ({"last_processed": TS + "\r"}, "unreadable:last_processed"),
]


def test_text_rows(spark):
    rows = [(*text_row(**changes), i) for i, (changes, _) in enumerate(CASES)]
    frame = spark.createDataFrame(rows, T.StructType([*DAILY_TEXT.fields, T.StructField("i", T.IntegerType())]))
    got = c.conform_text(frame)
    assert {r.i: r.reasons for r in got.collect()} == {i: reasons for i, (_, reasons) in enumerate(CASES)}
    assert c.accepted(got).schema == DAILY
    assert c.accepted(got).count() + c.rejected(got).count() == len(CASES)


def test_report_counts_each_rule(spark):
    frame = spark.createDataFrame([text_row(**changes) for changes, _ in CASES], DAILY_TEXT)
    report = {r.rule: r.violations for r in c.constraint_report(c.conform_text(frame)).collect()}
    assert len(report) == 14
    assert report["too_long:category"] == report["negative:avg_price"] == 1
    assert report["null:sale_date"] == 3 and report["null:total_quantity"] == 1


def wide(spark, **changes):
    base = ("Home", "Asia", dt.date(2024, 5, 1), 3, Decimal("59.97"), 1, Decimal("19.99"), dt.datetime(2024, 2, 1))
    return spark.createDataFrame([tuple({**dict(zip(DAILY.names, base)), **changes}.values())], WIDE)


@pytest.mark.parametrize(
    "changes, reasons",
    [
        ({}, ""),
        ({"total_quantity": 2**31}, "out_of_range:total_quantity"),
        ({"total_revenue": Decimal(10) ** 16}, "out_of_range:total_revenue"),
        ({"category": "NULL"}, "null_text:category"),
        ({"category": None}, "null:category"),
        ({"region": "two\nlines"}, "line_break:region"),
        ({"total_revenue": None, "avg_price": None}, "null:total_revenue,null:avg_price"),
        ({"product_count": 0}, "not_positive:product_count"),
    ],
)
def test_aggregates_before_export(spark, changes, reasons):
    row = c.conform_daily(wide(spark, **changes)).first()
    assert row.reasons == reasons


def test_separator_check_is_for_readers_without_quotes(spark):
    assert c.conform_daily(wide(spark, category="a|b")).first().reasons == ""
    assert c.conform_daily(wide(spark, category="a|b"), sep="|").first().reasons == "separator:category"
    assert unquotable(wide(spark, region='say "x"')).count() == 1
    assert unquotable(wide(spark)).count() == 0


def test_export_record_has_no_nulls(spark):
    row = export_record(wide(spark, category=None, total_quantity=None, avg_price=None, sale_date=None)).first()
    assert tuple(row) == ("NULL", "Asia", "NULL", "NULL", "59.97", "1", "NULL", "2024-02-01 00:00:00")


def test_fill_defaults(spark):
    row = fill_defaults(spark.createDataFrame([(None,) * 8], RAW_SALES)).first()
    assert tuple(row) == (1, "Unknown Product", "General", Decimal("0.00"), 1, None, 1000, "Unknown")


def keyed(spark, *keys):
    rows = [(cat, reg, day, 1, Decimal(1), 1, Decimal(1), dt.datetime(2024, 2, 1)) for cat, reg, day in keys]
    return spark.createDataFrame(rows, DAILY)


DAY = dt.date(2024, 5, 1)


def test_duplicate_keys_as_the_target_sees_them(spark):
    batch = keyed(spark, ("Home", "Asia", DAY), ("Home", "ASIA ", DAY), ("Home", " Asia", DAY), ("Homé", "Asia", DAY))
    assert [tuple(r) for r in c.duplicate_keys(batch).collect()] == [("home", "asia", DAY, 2)]


def test_conflicts_and_new_keys(spark):
    other = dt.date(2024, 5, 2)
    batch = keyed(spark, ("Home", "Asia", DAY), ("Home", "Asia", other), (None, "Asia", DAY))
    target = keyed(spark, ("HOME ", "asia", DAY), ("Garden", "Asia", other))
    assert [tuple(r) for r in c.key_conflicts(batch, target).collect()] == [("home", "asia", DAY, 1)]
    new = {(r.category, r.sale_date) for r in c.new_keys_only(batch, target).collect()}
    assert new == {("Home", other), (None, DAY)}


def test_one_hot_key(spark):
    """A third of the rows under one key leave each map task as one row."""
    hot = keyed(spark, ("Home", "Asia", DAY)).crossJoin(spark.range(3000)).drop("id")
    rest = keyed(spark, ("Garden", "Asia", DAY)).crossJoin(spark.range(6000)).withColumn(
        "category", F.concat("category", F.col("id"))
    ).drop("id")
    got = c.duplicate_keys(hot.unionByName(rest).repartition(6)).collect()
    assert [tuple(r) for r in got] == [("home", "asia", DAY, 3000)]


def test_profile(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_bytes(b"1|2\x00|3\nfour\r\n5|6|7|8|9\n")
    (tmp_path / "in" / "b c.txt").write_bytes(b"x|\x07|y")
    (tmp_path / "in" / "empty.txt").write_bytes(b"")
    facts = quality.with_line_facts(lines.read_lines(spark, str(tmp_path / "in")), "|")
    got = {
        r.file.rsplit("/", 1)[1]: tuple(r.asDict()[n] for n in ("n_bytes", "n_lines", "min_seps", "max_seps", "nul_lines", "cr_lines", "binary_lines", "is_small", "header_line"))
        for r in quality.file_profile(facts).collect()
    }
    assert got == {
        "a.txt": (23, 3, 0, 4, 1, 1, 0, False, None),
        "b%20c.txt": (5, 1, 2, 2, 0, 0, 1, True, None),
    }
    sizes = {r.n_seps: (r.n_lines, r.is_expected) for r in quality.separator_histogram(facts).collect()}
    assert sizes == {2: (2, False), 0: (1, False), 4: (1, False)}


def test_checked_lines_keep_the_line_of_rejects_only(spark, tmp_path):
    (tmp_path / "in.txt").write_text("|".join(GOOD) + "\n" + "|".join(GOOD[:-1]) + "\n\n" + "|".join(GOOD) + "|x\n")
    got = checked_lines(lines.read_lines(spark, str(tmp_path / "in.txt")), "|").select("line", "reasons").collect()
    by_line = {r.line: r.reasons for r in got}
    assert by_line[None] == ""
    assert by_line["|".join(GOOD[:-1])] == by_line["|".join(GOOD) + "|x"] == "field_count"
    assert by_line[""].startswith("null:category")
    counts = quality.load_reconciliation(checked_lines(lines.read_lines(spark, str(tmp_path / "in.txt")), "|")).first()
    assert tuple(counts) == (4, 1, 3, DAY, DAY, True)
