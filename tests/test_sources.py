import datetime as dt
import os
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from daybook.schema import CORRUPT, DAILY, DAILY_TEXT, RAW_SALES
from daybook.session import work_dir
from daybook.sinks import files, table as table_sink
from daybook.sources import batches, delimited, lines, sales_csv, table

HEADER = ",".join(RAW_SALES.names)


def write(path, content):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content if isinstance(content, bytes) else content.encode())
    return str(path)


def test_typed_scan_keeps_malformed_rows_apart(spark, tmp_path):
    bad = {
        "x,Lamp,Home,19.99,3,2024-05-01,11,Asia": "product_id",
        "1,Lamp,Home,cheap,3,2024-13-40,11,Asia": "price,sale_date",
        "1,Lamp,Home,19.99,3,2024-1-5,11,Asia": "sale_date",
        "1,Lamp,Home": "field_count",
        "1,Lamp,Home,19.99,3,2024-05-01,11,Asia,extra": "field_count",
    }
    good = ['2,"Desk, ""big""",Home,150.005,1,2024-05-02,12,Asia', "NULL,NULL,NULL,NULL,NULL,NULL,NULL,NULL"]
    path = write(tmp_path / "sales.csv", "\n".join([HEADER, *good, *bad]) + "\n")
    scan = sales_csv.read_sales_csv(spark, path)
    assert {r.raw: r.reasons for r in sales_csv.malformed(scan).collect()} == bad
    kept = sales_csv.well_formed(scan)
    assert kept.schema == RAW_SALES
    assert [tuple(r) for r in kept.orderBy("product_id").collect()] == [
        (None,) * 8,
        (2, 'Desk, "big"', "Home", Decimal("150.005"), 1, dt.date(2024, 5, 2), 12, "Asia"),
    ]
    # The verdict does not hang on the columns that are asked for.
    for column in RAW_SALES.names:
        assert kept.select(column).count() == len(kept.select(column).collect()) == 2


AWKWARD = ["", None, " padded ", "a,b", "p|q", 'say "x"', "back\\", '"', "NULLs", "naïve ☂", "tab\there"]


@pytest.mark.parametrize("sep", [",", "|"])
def test_what_is_written_reads_back(spark, tmp_path, sep):
    rows = [(c, "Asia", "2024-05-01", str(i), "1.00", "1", "1.00", "2024-02-01 06:30:00") for i, c in enumerate(AWKWARD)]
    path = str(tmp_path / "out")
    frame = spark.createDataFrame(rows, DAILY_TEXT)
    if sep == ",":
        files.write_csv(frame, path)
    else:
        files.write_delimited(frame, path)
    back = delimited.read_daily_text(spark, path, sep, header=sep == ",")
    assert sorted(map(str, back.collect())) == sorted(map(str, frame.collect()))
    if sep == "|":
        split = lines.read_lines(spark, path).select(delimited.split_fields(F.col("line"), sep).alias("f"))
        again = split.select(*[F.col(f"f.{n}").alias(n) for n in DAILY_TEXT.names])
        assert sorted(map(str, again.collect())) == sorted(map(str, frame.collect()))


@pytest.mark.parametrize("sep", [",", "|"])
def test_any_text_survives_a_file(spark, tmp_path, sep):
    draw = random.Random(7)
    texts = ["".join(draw.choices("ab,|\"\\\\' \tNULé☂#", k=draw.randint(0, 6))) for _ in range(3000)]
    rows = [
        (a, b, "2024-05-01", str(i), "1.00", "1", "1.00", "2024-02-01 06:30:00")
        for i, (a, b) in enumerate(zip(texts, reversed(texts)))
        if "NULL" not in (a, b)
    ]
    path = str(tmp_path / "out")
    frame = spark.createDataFrame(rows, DAILY_TEXT)
    (files.write_csv if sep == "," else files.write_delimited)(frame, path)
    back = delimited.read_daily_text(spark, path, sep, header=sep == ",")
    assert sorted(map(tuple, back.collect())) == sorted(rows)
    plain = lines.read_header_aware(spark, path, str(tmp_path / "stage"))
    split = plain.select(delimited.split_fields(F.col("line"), sep).alias("f")).select("f.*")
    assert sorted(map(tuple, split.drop(CORRUPT).collect())) == sorted(rows)
    assert split.filter(F.col(CORRUPT).isNotNull()).count() == 0


def test_typed_delimited_scan(spark, tmp_path):
    row = ("Home", "Asia", dt.date(2024, 5, 1), 3, Decimal("59.97"), 1, Decimal("19.99"), dt.datetime(2024, 2, 1, 6, 30))
    files.write_delimited(spark.createDataFrame([row], DAILY), str(tmp_path / "out"))
    assert delimited.read_daily(spark, str(tmp_path / "out")).collect() == [row]


def test_header_is_dropped_only_from_the_first_line(spark, tmp_path):
    head = "Category,region,sale_date"
    write(tmp_path / "in/headed.csv", f"{head}\na,b,1\n{head}\n")
    write(tmp_path / "in/plain.csv", "a,b,2\nc,d,3\n")
    write(tmp_path / "in/late.csv", f"\n{head}\n")
    write(tmp_path / "in/only.csv", head)
    write(tmp_path / "in/empty.csv", "")
    got = lines.read_header_aware(spark, str(tmp_path / "in"), str(tmp_path / "stage"))
    by_file = {}
    for r in got.collect():
        by_file.setdefault(os.path.basename(r.file), []).append(r.line)
    assert {k: sorted(v) for k, v in by_file.items()} == {
        "headed.csv": [head, "a,b,1"],
        "plain.csv": ["a,b,2", "c,d,3"],
        "late.csv": ["", head],
    }


def test_header_of_a_file_in_many_splits(spark, tmp_path):
    """Every later split begins with a line that is not its file's first."""
    head = "category,region,sale_date"
    body = [f"row {i}" if i % 3 else head for i in range(2000)]
    write(tmp_path / "in/big.csv", "\n".join([head, *body]) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        got = lines.read_header_aware(spark, str(tmp_path / "in"), str(tmp_path / "stage")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(r.line for r in got) == sorted(body)


def test_latest_batch(spark, tmp_path):
    assert batches.latest_batch(spark, str(tmp_path / "missing")) is None
    root = tmp_path / "out"
    older = root / "sales_data_aggregated_20240131_063000.csv" / "part-0.csv"
    newer = root / "sales_data_aggregated_20240101_000000.csv" / "part-0.csv"
    single = root / "sales_data_aggregated_20231231_000000.csv"
    for path in (older, newer, single, root / "other_20250101.csv", root / "sales_data_aggregated_x.txt"):
        write(path, "x\n")
    for batch in (older.parent, newer.parent):
        write(batch / "_SUCCESS", "")
    os.utime(older, (1_700_000_000, 1_700_000_000))
    os.utime(newer, (1_700_000_500, 1_700_000_500))
    os.utime(single, (1_600_000_000, 1_600_000_000))
    assert batches.latest_batch(spark, str(root)).endswith(newer.parent.name)
    # Equally new: the greatest path.
    os.utime(older, (1_700_000_500, 1_700_000_500))
    assert batches.latest_batch(spark, str(root)).endswith(older.parent.name)
    os.utime(single, (1_800_000_000, 1_800_000_000))
    assert batches.latest_batch(spark, str(root)).endswith(single.name)
    assert batches.list_batches(spark, str(root)).count() == 3


def test_newest_batch_may_be_empty_but_not_unfinished(spark, tmp_path):
    good = tmp_path / "sales_data_aggregated_20240101_000000.csv"
    write(good, "x\n")
    os.utime(good, (1_700_000_000, 1_700_000_000))
    unfinished = tmp_path / "sales_data_aggregated_20240103_000000.csv" / "part-0.csv"
    write(unfinished, "x\n")
    assert batches.latest_batch(spark, str(tmp_path)).endswith(good.name)
    # The suffix may be that of the parts.
    parts = tmp_path / "sales_data_aggregated_20240102_000000" / "part-0.csv"
    write(parts, "x\n")
    write(parts.parent / "_SUCCESS", "")
    os.utime(parts, (1_700_000_100, 1_700_000_100))
    assert batches.latest_batch(spark, str(tmp_path)).endswith(parts.parent.name)
    empty = tmp_path / "sales_data_aggregated_20240104_000000.csv"
    write(empty, "")
    os.utime(empty, (1_700_000_200, 1_700_000_200))
    assert batches.latest_batch(spark, str(tmp_path)).endswith(empty.name)



def test_batch_name(run_ts):
    assert batches.batch_name(run_ts) == "sales_data_aggregated_20240201_063000.csv"


def test_target_table(spark, tmp_path):
    assert not table.target_exists(spark, "target_under_test")
    table.create_target(spark, "target_under_test", str(tmp_path / "t"))
    assert table.target_exists(spark, "target_under_test")
    row = ("Home", "Asia", dt.date(2024, 5, 1), 3, Decimal("59.97"), 1, Decimal("19.99"), dt.datetime(2024, 2, 1, 6, 30))
    table_sink.append_table(spark.createDataFrame([row], DAILY), "target_under_test")
    assert table.read_target(spark, "target_under_test").collect() == [row]
    table.create_target(spark, "target_under_test", str(tmp_path / "t"))
    assert table.read_target(spark, "target_under_test").count() == 0
    spark.sql("DROP TABLE target_under_test")


def test_layout_prunes(spark, tmp_path):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(200)]
    rows = [
        ("Home", region, day, 1, Decimal("1.00"), 1, Decimal("1.00"), dt.datetime(2024, 2, 1))
        for region in ("Asia", "Europe", "a/b=c")
        for day in days
    ]
    path = str(tmp_path / "t")
    files.write_partitioned(spark.createDataFrame(rows, DAILY), path)
    back = spark.read.schema(DAILY).parquet(path)
    assert sorted(map(str, back.select(*DAILY.names).collect())) == sorted(
        map(str, spark.createDataFrame(rows, DAILY).collect())
    )
    asia = back.filter("region = 'Asia' AND sale_date > '2024-03-01'")
    plan = asia._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(region" in plan and "GreaterThan(sale_date" in plan
    assert asia.count() == sum(d > dt.date(2024, 3, 1) for d in days)


def test_database_options():
    write_options = table_sink.jdbc_write_options("jdbc:x", "t", properties={"user": "u"})
    assert write_options == {"user": "u", "url": "jdbc:x", "dbtable": "t", "batchsize": "10000", "numPartitions": "16"}
    read_options = table.jdbc_read_options("jdbc:x", "t", "2024-01-01", "2024-12-31", 8)
    assert read_options["partitionColumn"] == "sale_date" and read_options["numPartitions"] == "8"


def test_work_dir_is_shared_and_fresh(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = work_dir(spark, "x"), work_dir(spark, "x")
    assert first.startswith(root) and second.startswith(root) and first != second
