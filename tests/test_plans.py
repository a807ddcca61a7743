import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from daybook.plans.errors import BatchError
from daybook.plans.export_job import export_batch, export_files
from daybook.plans.load_job import load_batch
from daybook.plans.pipeline import PipelineConfig, run_load, run_pipeline
from daybook.schema import DAILY, RAW_SALES
from daybook.sources import delimited, table

D = dt.date
HEAD = "category,region,sale_date,total_quantity,total_revenue,product_count,avg_price,last_processed"
TS = "2024-02-01 06:30:00"


def line(category="Home", region="Asia", day="2024-05-01", quantity="3"):
    return f"{category},{region},{day},{quantity},59.97,1,19.99,{TS}"


@pytest.fixture
def target(spark, tmp_path):
    name = "target_" + "".join(ch for ch in tmp_path.name if ch.isalnum())
    table.create_target(spark, name, str(tmp_path / "target"))
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


@pytest.fixture
def load(spark, tmp_path, target):
    runs = iter(range(100))

    def run(*files, **options):
        n = next(runs)
        source = tmp_path / f"batch{n}"
        source.mkdir()
        for i, content in enumerate(files):
            (source / f"part-{i}.csv").write_bytes(content if isinstance(content, bytes) else content.encode())
        return load_batch(spark, str(source), target, str(tmp_path / f"stage{n}"), **options)

    return run


def rows(spark, target):
    return sorted((r.category, r.region, str(r.sale_date), r.total_quantity) for r in table.read_target(spark, target).collect())


def test_load_counts_and_contents(spark, target, load):
    result = load(f"{HEAD}\n{line()}\n", f"{line(day='2024-05-03')}\n", "", b"Ho\x00me,Europe,2024-05-02,0,0.00,1,0.00," + TS.encode() + b"\n")
    assert (result.source_rows, result.accepted_rows, result.rejected_rows, result.loaded_rows) == (3, 3, 0, 3)
    assert (result.profile.n_files, result.profile.nul_lines, result.profile.n_lines) == (3, 1, 4)
    assert result.profile.header_lines == 1
    assert (result.first_date, result.last_date, result.rejects_path) == (D(2024, 5, 1), D(2024, 5, 3), None)
    assert rows(spark, target) == [
        ("Home", "Asia", "2024-05-01", 3),
        ("Home", "Asia", "2024-05-03", 3),
        ("Home", "Europe", "2024-05-02", 0),
    ]


def test_insert_only(spark, target, load):
    load(line())
    with pytest.raises(BatchError, match="1 are in"):
        load(line(category="HOME "), line(day="2024-05-02"))
    assert len(rows(spark, target)) == 1
    load(line(day="2024-05-02"))
    assert len(rows(spark, target)) == 2


def test_bad_rows_stop_the_load_or_are_set_aside(spark, target, load):
    content = f"{HEAD}\n{line()}\n{line(quantity='many')}\n{HEAD}\nshort,row\n"
    with pytest.raises(BatchError, match="3 of 4 rows"):
        load(content)
    assert rows(spark, target) == []
    result = load(content, max_errors=3)
    assert (result.source_rows, result.accepted_rows, result.rejected_rows, result.loaded_rows) == (4, 1, 3, 1)
    rejects = {r.raw: r.reasons for r in spark.read.parquet(result.rejects_path).collect()}
    assert set(rejects) == {line(quantity="many"), HEAD, "short,row"}
    assert rejects["short,row"] == "field_count"
    assert rejects[line(quantity="many")] == "unreadable:total_quantity"


@pytest.mark.parametrize(
    "content, message",
    [
        ("", "is empty"),
        (HEAD, "no loadable row"),
        (b"\x7fELF\x02\x01\x01\n", "binary content"),
        (line() + "\n" + line(category="home ") + "\n", "1 keys occur twice"),
    ],
)
def test_refused_batches(spark, target, load, content, message):
    with pytest.raises(BatchError, match=message):
        load(content)
    assert rows(spark, target) == []


def test_missing_target(spark, tmp_path):
    with pytest.raises(BatchError, match="does not exist"):
        load_batch(spark, str(tmp_path), "no_such_table", str(tmp_path / "stage"))


def test_missing_batch(spark, tmp_path, target):
    with pytest.raises(BatchError, match="does not exist"):
        load_batch(spark, str(tmp_path / "nowhere"), target, str(tmp_path / "stage"))


SALES = [
    (1, "Lamp", "Home", Decimal("19.99"), 3, D(2024, 5, 1), 11, "Asia"),
    (2, "Desk, big", "Home", Decimal("150.00"), 1, D(2024, 5, 1), 12, "Asia"),
    (4, "Pot", "Garden | more", Decimal("5.00"), 5, D(2024, 5, 2), 14, "Europe"),
]


def test_export_as_is(spark, tmp_path, run_ts):
    done = export_batch(
        spark, spark.createDataFrame(SALES, RAW_SALES), str(tmp_path / "out"), str(tmp_path / "stage"), run_ts, num_days=None
    )
    assert done.path.endswith("/sales_data_aggregated_20240201_063000.csv") and done.rows == 2
    got = {tuple(r) for r in delimited.read_daily_text(spark, done.path).collect()}
    assert got == {
        ("Home", "Asia", "2024-05-01", "4", "209.97", "2", "85.00", TS),
        ("Garden | more", "Europe", "2024-05-02", "5", "25.00", "1", "5.00", TS),
    }


def test_export_stops_before_writing(spark, tmp_path, run_ts):
    bad = [*SALES, (5, "?", "NULL", Decimal("1.00"), 1, D(2024, 5, 1), 1, "Asia"), (6, "!", "Big", Decimal("1.00"), 2**31 - 1, D(2024, 5, 1), 1, "Asia"), (6, "!", "Big", Decimal("1.00"), 1, D(2024, 5, 1), 1, "Asia")]
    frame = spark.createDataFrame(bad, RAW_SALES)
    with pytest.raises(BatchError, match="2 of 4 rows"):
        export_batch(spark, frame, str(tmp_path / "out"), str(tmp_path / "stage"), run_ts, num_days=None, layout=DAILY)
    assert not (tmp_path / "out").exists()
    done = export_batch(spark, frame, str(tmp_path / "out"), str(tmp_path / "stage"), run_ts, num_days=None, max_errors=2, layout=DAILY)
    assert (done.rows, done.rejected_rows) == (2, 2)
    reasons = {r.category: r.reasons for r in spark.read.parquet(done.rejects_path).collect()}
    assert reasons == {"NULL": "null_text:category", "Big": "out_of_range:total_quantity"}


def test_pipeline_end_to_end(spark, tmp_path, target, run_ts):
    config = PipelineConfig(str(tmp_path / "out"), str(tmp_path / "stage"), target, run_ts, num_days=7)
    sales = spark.createDataFrame(SALES, RAW_SALES)
    with pytest.raises(BatchError, match="no batch below"):
        run_load(spark, config)
    result = run_pipeline(spark, sales, config)
    assert result.exported.rows == result.loaded.loaded_rows == 14
    assert {r.metric: r.value for r in result.metrics.collect()} == {
        "Total Records": "14",
        "Date Range": "2024-01-01 to 2024-01-07",
        "Categories": "2",
        "Regions": "2",
    }
    with pytest.raises(BatchError, match="14 are in"):
        run_pipeline(spark, sales, config)
    assert table.read_target(spark, target).agg(F.count("*")).first()[0] == 14


BIG = (6, "!", "Big", Decimal("1.00"), 2**31 - 1, D(2024, 5, 1), 1, "Asia")


def test_totals_beyond_int_fit_a_wide_target_only(spark, tmp_path, target, run_ts):
    done = export_batch(
        spark, spark.createDataFrame([BIG, BIG], RAW_SALES), str(tmp_path / "out"), str(tmp_path / "stage"), run_ts, None
    )
    load_batch(spark, done.path, target, str(tmp_path / "load"))
    assert [r[3] for r in rows(spark, target)] == [2**32 - 2]
    table.create_target(spark, target, str(tmp_path / "narrow"), layout=DAILY)
    with pytest.raises(BatchError, match="1 of 1 rows"):
        load_batch(spark, done.path, target, str(tmp_path / "load"))


def test_largest_values_expand_without_abort(spark, tmp_path, run_ts):
    top = (7, "!", "Top", Decimal("9999999999999999.99"), 1, D(2024, 5, 1), 2**31 - 1, "Asia")
    frame = spark.createDataFrame([*SALES, BIG, top], RAW_SALES)
    done = export_batch(spark, frame, str(tmp_path / "out"), str(tmp_path / "stage"), run_ts, 7, max_errors=7)
    assert done.rows + done.rejected_rows == 28
    bad = spark.read.parquet(done.rejects_path).collect() if done.rejects_path else []
    assert {r.category for r in bad} <= {"Top"} and all("out_of_range:" in r.reasons for r in bad)


def test_nulls_are_exported_and_refused_by_the_load(spark, tmp_path, target, run_ts):
    gaps = [*SALES, (None, "?", "Gap", None, None, D(2024, 5, 1), None, "Asia")]
    frame = spark.createDataFrame(gaps, RAW_SALES)
    done = export_batch(spark, frame, str(tmp_path / "out"), str(tmp_path / "stage"), run_ts, num_days=None)
    assert (done.rows, done.rejected_rows) == (3, 0)
    with pytest.raises(BatchError, match="1 of 3 rows"):
        load_batch(spark, done.path, target, str(tmp_path / "load"))
    result = load_batch(spark, done.path, target, str(tmp_path / "load"), max_errors=1)
    reasons = spark.read.parquet(result.rejects_path).first().reasons
    assert "null:total_revenue" in reasons and "null:avg_price" in reasons


def raw_file(tmp_path, *lines, header=",".join(RAW_SALES.names)):
    path = tmp_path / "raw.csv"
    path.write_text("\n".join([header, *lines]) + "\n")
    return str(path)


def test_export_from_files_counts_malformed_lines(spark, tmp_path, run_ts):
    good = "1,Lamp,Home,0.004,1000,2024-05-01,11,Asia"
    path = raw_file(tmp_path, good, good.replace("1000", "many"), good.replace("0.004", "0.0000001"), "1,Lamp")
    out, stage = str(tmp_path / "out"), str(tmp_path / "stage")
    with pytest.raises(BatchError, match="3 malformed rows"):
        export_files(spark, path, out, stage, run_ts, None, max_errors=2)
    done = export_files(spark, path, out, stage, run_ts, None, max_errors=3)
    assert (done.rows, done.malformed_rows) == (1, 3)
    assert delimited.read_daily_text(spark, done.path).first().total_revenue == "4.00"
    reasons = sorted(r.reasons for r in spark.read.parquet(done.malformed_path).collect())
    assert reasons == ["field_count", "quantity_sold", "too_fine:price"]


def test_export_from_files_without_faults(spark, tmp_path, run_ts):
    path = raw_file(tmp_path, "1,Lamp,Home,19.99,3,2024-05-01,11,Asia")
    done = export_files(spark, path, str(tmp_path / "out"), str(tmp_path / "stage"), run_ts, None)
    assert (done.rows, done.malformed_rows, done.malformed_path) == (1, 0, None)


def test_swapped_header_is_refused(spark, tmp_path, run_ts):
    names = list(RAW_SALES.names)
    names[0], names[6] = names[6], names[0]
    path = raw_file(tmp_path, "1,Lamp,Home,19.99,3,2024-05-01,11,Asia", header=",".join(names))
    with pytest.raises(Exception, match="header"):
        export_files(spark, path, str(tmp_path / "out"), str(tmp_path / "stage"), run_ts, None)
    assert not (tmp_path / "out").exists()
