"""Places in files, quoted records, contents, key filters, layouts, states, format files, claims."""

import csv
import io
import random
import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from daybook.operators import aggregate, constraints, key_filter, quality
from daybook.plans import load_job, summary
from daybook.plans.claim import Claim, claimed
from daybook.plans.errors import BatchError
from daybook.schema import DAILY, DAILY_TEXT
from daybook.sinks import files
from daybook.sources import format_file, lines, records, sales_csv, table

from test_plans import HEAD, line, load, rows, target  # noqa: F401


@pytest.fixture
def small_splits(spark):
    saved = {}
    for key, value in {"spark.sql.files.maxPartitionBytes": "200", "spark.sql.files.openCostInBytes": "0"}.items():
        saved[key] = spark.conf.get(key)
        spark.conf.set(key, value)
    yield
    for key, value in saved.items():
        spark.conf.set(key, value)


def written(root, contents):
    root.mkdir()
    for number, content in enumerate(contents):
        (root / f"f{number}.csv").write_bytes(content.encode())
    return str(root)


# --- Places -------------------------------------------------------------------


def staged(spark, tmp_path, contents):
    lines.read_lines(spark, written(tmp_path / "in", contents)).write.parquet(str(tmp_path / "stage"))
    return spark.read.parquet(str(tmp_path / "stage"))


def test_numbers_in_files_of_many_splits(spark, tmp_path, small_splits):
    draw = random.Random(1)
    each = [["x" * draw.randrange(60) + str(i) for i in range(n)] for n in (150, 1, 0, 90)]
    # A line longer than several splits, blank lines, and a last line without an end.
    each[0][70] = "long" * 300
    each[3][:3] = ["", "", ""]
    contents = ["".join(x + "\n" for x in each[0]), "only", "", "".join(x + "\n" for x in each[3])]
    each[1] = ["only"]
    stored = staged(spark, tmp_path, contents)
    assert stored.select("file", "block_start").distinct().count() > 10
    place = {f"f{k}.csv": sum(map(len, each[:k])) for k in range(4)}
    got = lines.numbered_in_batch(stored, lines.line_splits(stored)).collect()
    want = [(f"f{k}.csv", i + 1, place[f"f{k}.csv"] + i + 1, x) for k, all_ in enumerate(each) for i, x in enumerate(all_)]
    assert sorted((r.file.rsplit("/", 1)[1], r.line_no, r.batch_line_no, r.line) for r in got) == sorted(want)
    tail = [(r.file.rsplit("/", 1)[1], r.line_no, r.line) for r in lines.tail_by_line(stored, 5).collect()]
    assert sorted(tail) == sorted((f, n, x) for f, n, _, x in want if n > len(each[int(f[1])]) - 5)
    head = [(r.file.rsplit("/", 1)[1], r.line_no, r.line) for r in lines.head_by_line(stored, 5).collect()]
    assert sorted(head) == sorted((f, n, x) for f, n, _, x in want if n <= 5)
    both = [(r.line_no, r.line) for r in lines.tail_by_line(stored, 100, whole_batch=True).collect()]
    assert sorted(both) == sorted((n, x) for *_, n, x in want if n > len(want) - 100)
    assert lines.tail_by_line(stored, 10**6, whole_batch=True).count() == len(want)


def test_many_splits_are_joined_not_broadcast(spark, tmp_path, monkeypatch):
    stored = staged(spark, tmp_path, ["a\nb\n", "c\n"])
    splits = lines.line_splits(stored)
    plan = lines.with_splits(stored, splits)._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan
    monkeypatch.setattr(lines, "MAX_BROADCAST_SPLITS", 1)
    plan = lines.with_splits(stored, splits)._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" not in plan
    assert sorted(r.line_no for r in lines.numbered(stored, splits).collect()) == [1, 1, 2]


def test_rejects_carry_line_numbers(spark, target, load, small_splits):
    content = f"{HEAD}\n" + "".join(line(day=f"2024-05-{k:02d}") + "\n" for k in range(1, 29)) + f"{line(quantity='many')}\n{HEAD}\nshort,row\n"
    result = load(content, max_errors=3)
    found = {r.line_no: r.raw for r in spark.read.parquet(result.rejects_path).collect()}
    assert found == {30: line(quantity="many"), 31: HEAD, 32: "short,row"}


# --- Quoted records -----------------------------------------------------------


def quoted(seed, n):
    draw = random.Random(seed)
    kinds = ["plain", "a,b", 'with "q"', "two\nlines", 'x\n\n"y",\n z', '"\n"', "", " é\n"]
    out, places = io.StringIO(), []
    writer, number = csv.writer(out, lineterminator="\n"), 1
    for i in range(n):
        begin = out.tell()
        writer.writerow([i, draw.choice(kinds)])
        record = out.getvalue()[begin:]
        places.append((number, record.count("\n"), record[:-1]))
        number += record.count("\n")
    return out.getvalue(), places, number


def test_records_over_several_lines_and_splits(spark, tmp_path, small_splits):
    whole, places, _ = quoted(1, 120)
    open_, open_places, number = quoted(2, 100)
    open_places += [(number, 1, '1,"never'), (number + 1, 1, "closed"), (number + 2, 1, "end")]
    path = written(tmp_path / "in", [whole, open_ + '1,"never\nclosed\nend', ""])
    stored = records.stage_quoted(spark, path, str(tmp_path / "stage"))
    assert stored.select("file", "block_start").distinct().count() > 10
    got = records.quoted_records(stored).collect()
    for name, want in (("f0", places), ("f1", open_places)):
        assert sorted((r.line_no, r.n_lines, r.record) for r in got if f"{name}.csv" in r.file) == want
    assert [r.record for r in sorted(got, key=lambda r: r.line_no) if r.problem] == ['1,"never', "closed", "end"]


def test_only_lines_of_records_move(spark, tmp_path):
    """A task reads many splits, in batches of a few lines; to tell which lines are inside a record no line is shuffled."""
    whole, places, _ = quoted(3, 300)
    path = written(tmp_path / "in", [whole, whole])
    sizes = {"spark.sql.files.maxPartitionBytes": "150", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.maxPartitionNum": "3"}
    sizes["spark.sql.execution.arrow.maxRecordsPerBatch"] = "7"
    saved = {k: spark.conf.get(k, None) for k in sizes}
    try:
        for k, v in sizes.items():
            spark.conf.set(k, v)
        stored = records.stage_quoted(spark, path, str(tmp_path / "stage"))
    finally:
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    found = records.quoted_records(stored)
    got = found.collect()
    for name in ("f0", "f1"):
        assert sorted((r.line_no, r.n_lines, r.record) for r in got if f"{name}.csv" in r.file) == places
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "windowspecdefinition" in plan and not re.search(r"windowspecdefinition\([^)]*line_id", plan)


def test_a_long_record_stays_apart(spark, tmp_path):
    path = written(tmp_path / "in", ['a,"1\n2\n3"\nb,"1\n2"\nc\n'])
    stored = records.stage_quoted(spark, path, str(tmp_path / "stage"))
    got = sorted((r.line_no, r.record, r.problem) for r in records.quoted_records(stored, max_lines=2).collect())
    assert got == [(1, 'a,"1', "record_too_long"), (2, "2", "record_too_long"), (3, '3"', "record_too_long"), (4, 'b,"1\n2"', None), (6, "c", None)]


def test_quoted_sales(spark, tmp_path):
    head = "product_id,product_name,category,price,quantity_sold,sale_date,customer_id,region\n"
    good = '1,"two\nlines, ""x""\n",Home,9.99,2,2024-01-05,7,Asia\n'
    bad = '2,"a\nb",Home,9.99,2,2024-13-40,7,Asia\n'
    path = written(tmp_path / "in", [head + good + "\n" + bad + '3,"open\n', head])
    scan = sales_csv.read_quoted_sales(spark, path, str(tmp_path / "stage"))
    assert [r.product_name for r in sales_csv.well_formed(scan).collect()] == ['two\nlines, "x"\n']
    found = {r.raw: r.reasons for r in sales_csv.malformed(scan).collect()}
    assert set(found) == {bad[:-1], '3,"open'} and found[bad[:-1]] == "sale_date"
    with pytest.raises(ValueError, match="header"):
        sales_csv.read_quoted_sales(spark, written(tmp_path / "odd", [good]), str(tmp_path / "stage2"))


# --- Contents -----------------------------------------------------------------


def test_a_fingerprint_sees_every_change_but_order(spark):
    base = [("a", "b", 1), ("a", None, 2), (None, "a", 2), ("", "null", 3), ("=", "", 3)] * 3
    schema = "x string, y string, n int"

    def same(other, names=("x", "y", "n")):
        return quality.content_reconciliation(
            spark.createDataFrame(base, schema).repartition(3), spark.createDataFrame(other, schema), names
        ).first().is_equal

    assert same(base[::-1])
    assert not same(base[:-1]) and not same(base + base[:1]) and not same([*base[1:], base[1]])
    swapped = [("a", "b", 2), ("a", None, 1), *base[2:]]
    assert not same(swapped) and same(swapped, ("x", "y"))
    assert not same([(y, x, n) for x, y, n in base])
    assert not same([("a", "", 2) if r == ("a", None, 2) else r for r in base])
    assert quality.content_reconciliation(spark.createDataFrame([], schema), spark.createDataFrame([], schema), ["x"]).first().is_equal


def test_fingerprints_add_up(spark):
    both = spark.range(100).selectExpr("cast(id as string) as x")
    parts = [quality.content_fingerprint(both.where(f"cast(x as int) % 2 = {k}"), ["x"]).first() for k in (0, 1)]
    whole = quality.content_fingerprint(both, ["x"]).first()
    assert tuple(whole) == tuple(a + b for a, b in zip(*parts, strict=True))


def test_rows_that_swap_a_field_fail_the_load(spark, target, load, monkeypatch):
    kept = load_job.store_ready

    def swapping(ready, path):
        quantity = F.when(F.col("total_quantity") == 3, 4).when(F.col("total_quantity") == 4, 3).otherwise(F.col("total_quantity"))
        return kept(ready.withColumn("total_quantity", quantity.cast("long")), path)

    monkeypatch.setattr(load_job, "store_ready", swapping)
    with pytest.raises(BatchError, match="not the same"):
        load(line(quantity="3"), line(quantity="4", day="2024-05-02"))
    assert rows(spark, target) == []


def test_what_reached_the_target_is_compared(spark, target, load, monkeypatch):
    append = load_job.append_table
    monkeypatch.setattr(load_job, "append_table", lambda ready, *a, **k: append(ready.where("total_quantity < 4"), *a, **k))
    with pytest.raises(BatchError, match="was written, but holds 1 rows for 2"):
        load(line(quantity="3"), line(quantity="4", day="2024-05-02"))


# --- Keys ---------------------------------------------------------------------


def daily_rows(spark, n, shift=0):
    return spark.range(n).selectExpr(
        f"concat('Cat ', id + {shift}) as category",
        "if(id % 3 = 0, 'Asia', 'Europe ') as region",
        "date_add(date'2024-01-01', cast(id % 700 as int)) as sale_date",
        "cast(id as int) as total_quantity",
        "cast(id as decimal(18,2)) as total_revenue",
        "cast(1 as int) as product_count",
        "cast(1 as decimal(18,2)) as avg_price",
        "cast('2024-02-01 06:30:00' as timestamp_ntz) as last_processed",
    )


def test_a_filter_keeps_all_keys_and_few_others(spark):
    batch, others = daily_rows(spark, 3000), daily_rows(spark, 30_000, 10_000)
    bits = key_filter.filter_bits(3000)
    made = key_filter.key_filter(batch, bits)
    spelled = batch.selectExpr("upper(category) || '  ' as category", "lower(region) as region", *DAILY.names[2:])
    assert key_filter.possible_rows(spelled, made, bits).count() == 3000
    assert key_filter.possible_rows(others, made, bits).count() < 30_000 / 40
    nulls = spelled.withColumn("category", F.lit(None).cast("string"))
    assert key_filter.possible_rows(nulls, made, bits).count() == 0
    assert key_filter.possible_rows(others, key_filter.key_filter(batch.limit(0), bits), bits).count() == 0


def test_filtered_conflicts_are_the_same(spark):
    batch, target_ = daily_rows(spark, 500), daily_rows(spark, 900, 300).unionByName(daily_rows(spark, 5).selectExpr("null as category", *DAILY.names[1:]))
    plain = constraints.key_status(batch, target_).collect()
    assert sorted(map(str, key_filter.batch_key_status(batch, target_, 500).collect())) == sorted(map(str, plain))
    assert sorted(map(str, key_filter.batch_key_status(batch, target_, 10**12).collect())) == sorted(map(str, plain))
    assert key_filter.filter_bits(10**12) is None and key_filter.filter_bits(0) == key_filter.ROW_BITS


def test_target_rows_are_tested_before_they_move(spark, tmp_path):
    daily_rows(spark, 100).write.parquet(str(tmp_path / "target"))
    stored = spark.read.parquet(str(tmp_path / "target"))
    bits = key_filter.filter_bits(100)
    plan = key_filter.possible_rows(stored, key_filter.key_filter(daily_rows(spark, 10), bits), bits)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in text
    # The only exchanges of rows are those that sum up the bit map itself.
    assert set(re.findall(r"Exchange hashpartitioning\((\w+)#", text)) <= {"_groupingexpression", "bucket"}


# --- Layout -------------------------------------------------------------------


def test_row_groups_are_skipped_for_each_of_three_columns(spark, tmp_path):
    rows_ = spark.range(200_000).selectExpr(
        "concat('cat', lpad(cast(hash(id) % 40 + 40 as string), 3, '0')) as category",
        "concat('reg', lpad(cast(hash(id, 1) % 30 + 30 as string), 3, '0')) as region",
        "date_add(date'2024-01-01', cast(abs(hash(id, 2)) % 300 as int)) as sale_date",
        "id",
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        files.write_interleaved(rows_, str(tmp_path / "out"), group_bytes=1 << 16)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert spark.read.parquet(str(tmp_path / "out")).agg(F.count("*"), F.sum("id")).first() == (200_000, sum(range(200_000)))
    groups = []
    for part in (tmp_path / "out").glob("*.parquet"):
        meta = pq.ParquetFile(part).metadata
        for g in range(meta.num_row_groups):
            by = {meta.row_group(g).column(c).path_in_schema: meta.row_group(g).column(c).statistics for c in range(3)}
            groups.append({name: (s.min, s.max) for name, s in by.items()})
    assert len(groups) >= 64
    import datetime as dt

    for name, value in (("category", "cat040"), ("region", "reg030"), ("sale_date", dt.date(2024, 5, 1))):
        read = sum(low <= value <= high for low, high in (g[name] for g in groups))
        assert 0 < read <= 0.45 * len(groups), name


def test_interleaved_bits(spark):
    row = spark.sql("select 5 as a, 3 as b, 0 as c").select(files.interleaved([F.col(x) for x in "abc"], bits=3)).first()
    assert row[0] == 0b100_010_110
    one = spark.createDataFrame([(None, None, None, 1)], "category string, region string, sale_date date, n int")
    assert files._with_places(one, ["category", "region", "sale_date"], 8)[0].count() == 1


# --- States -------------------------------------------------------------------


def test_summary_from_states_of_batches(spark, tmp_path):
    rows_ = daily_rows(spark, 400).withColumn("category", F.concat(F.lit("Cat "), F.col("total_quantity") % 7)).withColumn(
        "category", F.when(F.col("total_quantity") % 2 == 0, F.upper("category")).otherwise(F.col("category"))
    )
    root = str(tmp_path / "states")
    for k in [*range(5), 2]:
        summary.store_state(rows_.where(F.col("total_quantity") % 5 == k), root, f"b{k}")
    want = sorted(map(str, aggregate.sales_summary(rows_).collect()))
    assert sorted(map(str, summary.stored_summary(spark, root).collect())) == want
    summary.compact_states(spark, root, str(tmp_path / "one"))
    assert sorted(map(str, summary.stored_summary(spark, str(tmp_path / "one")).collect())) == want
    assert spark.read.parquet(str(tmp_path / "one")).count() < spark.read.parquet(root).count()


def test_a_load_adds_its_state(spark, tmp_path, target, load):
    for day in ("2024-05-01", "2024-05-02"):
        load(line(day=day), summary_root=str(tmp_path / "states"))
    got = summary.stored_summary(spark, str(tmp_path / "states")).first()
    assert (got.days_count, got.total_quantity_all_days) == (2, 6)


def test_sketches_of_batches_unite(spark):
    rows_ = spark.range(60_000).selectExpr("id % 20000 as x", "if(id < 9, null, 'k' || id % 50) as y")
    states = [aggregate.distinct_state(rows_.where(f"x % 3 = {k}"), "x", "y") for k in range(3)]
    got = aggregate.distinct_from_states(states[0].unionByName(states[1]).unionByName(states[2]).unionByName(states[0])).first()
    assert abs(got.x - 20_000) <= aggregate.SKETCH_ERROR * 20_000 and got.y == 50


# --- Format files -------------------------------------------------------------

FORMAT = "14.0\n4\n1 SQLCHAR 0 3 \"\" 2 region \"\"\n2 SQLCHAR 0 0 \"||\" 1 category \"\"\n3 SQLINT 0 0 \"\\t\" 0 skip \"\"\n4 SQLCHAR 0 0 \"\\n\" 3 day SQL_Latin1\n"


def test_scan_by_format_file(spark, tmp_path):
    fields = format_file.parse_format(FORMAT)
    assert [(f.name, f.column, f.length, f.terminator) for f in fields] == [
        ("region", 2, 3, ""), ("category", 1, 0, "||"), ("skip", 0, 0, "\t"), ("day", 3, 0, "\n")
    ]
    path = written(tmp_path / "in", ["As a|b $1||x\t2024\nEurNULL||\t\nno\nUS ||||\\\tx\ty\n"])
    got = format_file.read_by_format(spark, path, fields).collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [("a|b $1", "As", "2024", None), (None, "Eur", "", None), (None, None, None, "no"), ("", "US", "x\ty", None)], key=str
    )


def test_described_layout_reads_what_was_written(spark, tmp_path):
    fields = format_file.parse_format(format_file.describe(DAILY_TEXT))
    assert [f.name for f in fields] == DAILY_TEXT.names and {f.terminator for f in fields[:-1]} == {"|"}


@pytest.mark.parametrize(
    ("change", "message"),
    [
        (("14.0", "x"), "begins with"),
        (("\n4\n", "\n5\n"), "5 fields"),
        (("0 3 \"\"", "0 0 \"\""), "neither"),
        (("SQLINT", "SQLBINARY"), "binary"),
        (("0 skip", "1 skip"), "twice"),
        (("\"\\n\"", "\"|\""), "end with the line"),
        (("\"||\"", "\"\\n\""), "only the last"),
        (("2 SQLCHAR", "7 SQLCHAR"), "field 2"),
    ],
)
def test_wrong_format_files(change, message):
    with pytest.raises(format_file.FormatError, match=message):
        format_file.parse_format(FORMAT.replace(*change, 1))


# --- Recreation and claims ----------------------------------------------------


def test_a_reader_keeps_its_rows_while_the_table_is_made_anew(spark, tmp_path):
    name, root = "again_" + re.sub(r"\W", "", tmp_path.name), str(tmp_path / "versions")
    try:
        table.recreate_target(spark, name, root, daily_rows(spark, 10), DAILY)
        reader = table.read_target(spark, name)
        assert reader.count() == 10
        location = table.recreate_target(spark, name, root, daily_rows(spark, 3), DAILY)
        assert table.read_target(spark, name).count() == 3 and reader.count() == 10
        empty = table.recreate_target(spark, name, root, layout=DAILY)
        assert table.read_target(spark, name).count() == 0 and empty != location
        assert table.drop_versions(spark, root, empty) == 2 and len(list((tmp_path / "versions").iterdir())) == 1
        assert table.read_target(spark, name).count() == 0
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_one_of_two_loads_is_refused(spark, tmp_path, target, load):
    root = f"{table.target_location(spark, target).rstrip('/')}.claims"
    with claimed(spark, root, target):
        with pytest.raises(BatchError, match="another load holds"):
            load(line())
    assert rows(spark, target) == []
    load(line())
    assert len(rows(spark, target)) == 1


def test_a_lost_claim_stops_the_load(spark, target, load, monkeypatch):
    prepare = load_job._prepare

    def meanwhile(*args):
        out = prepare(*args)
        root = f"{table.target_location(spark, target).rstrip('/')}.claims"
        other = Claim(spark, root, target)
        other.system.delete(other.path, False)
        other.take()
        return out

    monkeypatch.setattr(load_job, "_prepare", meanwhile)
    with pytest.raises(BatchError, match="was lost"):
        load(line())
    assert rows(spark, target) == []
