"""Every operator as a query over the star tables, at whole-table size.

Where an operator is about bad data, the fault is written into the rows by a
rule on the day of the month, so that all rows still take part.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from daybook.functions import dates, money, text
from daybook.operators import aggregate, constraints, key_filter, project, quality
from daybook.operators.expand import expand_days as expand_rows
from daybook.plans.export_job import export_batch, export_files
from daybook.plans import summary
from daybook.plans.load_job import source_rows, stage_batch
from daybook.plans.pipeline import PipelineConfig, run_pipeline
from daybook.schema import CORRUPT, DAILY, DAILY_TEXT, MONEY, RAW_SALES
from daybook.session import work_dir
from daybook.sinks import files
from daybook.sinks.table import append_table
from daybook.sources import batches, delimited, format_file, lines, sales_csv, star, table

RUN_TS = dt.datetime(2024, 2, 1, 6, 30, 0)
EARLIER_TS = dt.datetime(2024, 1, 31, 6, 30, 0)
SHORT_RUN = 7
LONG_RUN = 30
CUTOVER = dt.date(2001, 1, 1)


# ---- inputs ---------------------------------------------------------------


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.sales_fact(spark, sf_dir)


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate.daily_sales(sales(spark, sf_dir), RUN_TS)


def target_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily rows in the target's types."""
    return constraints.accepted(constraints.conform_daily(daily(spark, sf_dir)))


def record(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project.export_record(daily(spark, sf_dir))


def with_time_as_text(rows: DataFrame) -> DataFrame:
    return rows.withColumn("last_processed", dates.instant_text(F.col("last_processed")))


def on_day(day: int, value: Column | str | None, otherwise: Column) -> Column:
    value = value if isinstance(value, Column) else F.lit(value)
    return F.when(F.dayofmonth(F.col("day")) == day, value).otherwise(otherwise)


def faulty_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text record with one kind of fault on each of ten days of the month."""
    c = F.col
    rows = record(spark, sf_dir).withColumn("day", c("sale_date").cast("date"))
    return rows.select(
        on_day(9, None, on_day(12, F.repeat(c("category"), 20), c("category"))).alias("category"),
        "region",
        on_day(3, "2024-13-40", on_day(4, "2024-1-5", c("sale_date"))).alias("sale_date"),
        on_day(5, "x12", on_day(6, "99999999999", c("total_quantity"))).alias("total_quantity"),
        on_day(10, F.concat(F.lit("-"), c("total_revenue")), c("total_revenue")).alias("total_revenue"),
        on_day(11, "0", c("product_count")).alias("product_count"),
        on_day(7, "abc", c("avg_price")).alias("avg_price"),
        on_day(8, "yesterday", c("last_processed")).alias("last_processed"),
        "day",
    )


def faulty_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The faulty record as lines, two days of the month with a field too few or too many."""
    fields = [F.coalesce(F.col(n), F.lit(text.NULL_TEXT)) for n in DAILY_TEXT.names]
    return faulty_record(spark, sf_dir).select(faulty_line(fields).alias("line"))


def faulty_line(fields: list[Column]) -> Column:
    whole = F.concat_ws("|", *fields)
    return on_day(13, F.concat_ws("|", *fields[:-1]), on_day(14, F.concat(whole, F.lit("|extra")), whole))


def damaged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with NUL bytes, CR ends, lost separators and control characters."""
    rows = record(spark, sf_dir).withColumn("day", F.col("sale_date").cast("date"))
    whole = F.concat_ws("|", *DAILY_TEXT.names)
    damaged = on_day(
        5,
        F.concat(text.nul_char(), whole, text.nul_char()),
        on_day(
            6,
            F.concat(whole, F.lit("\r")),
            on_day(7, F.concat_ws("|", *DAILY_TEXT.names[:-1]), on_day(8, F.concat(whole, F.chr(F.lit(7))), whole)),
        ),
    )
    return rows.select("region", damaged.alias("line"))


#: Fixed value: the format file of ``scan_by_format_file``.
FORMAT = """14.0
9
1 SQLCHAR 0 0 ";" 2 region ""
2 SQLCHAR 0 12 "" 3 sale_date ""
3 SQLCHAR 0 0 "||" 1 category ""
4 SQLCHAR 0 0 "\\t" 4 total_quantity ""
5 SQLCHAR 0 0 "|" 5 total_revenue ""
6 SQLCHAR 0 0 "," 0 skipped ""
7 SQLCHAR 0 0 ";" 6 product_count ""
8 SQLCHAR 0 0 "|" 7 avg_price ""
9 SQLCHAR 0 0 "\\n" 8 last_processed ""
"""


def stored_lines(spark: SparkSession, rows: DataFrame, name: str) -> str:
    path = work_dir(spark, name)
    rows.write.text(path)
    return path


def staged_lines(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The faulty lines as a batch on its way into the target."""
    path = stored_lines(spark, faulty_lines(spark, sf_dir), name)
    return stage_batch(spark, path, work_dir(spark, f"{name}_stage"), "|")


# ---- sources --------------------------------------------------------------


def faulty_sales_csv(spark: SparkSession, sf_dir: str, name: str, price: Column | None = None) -> str:
    rows = sales(spark, sf_dir).withColumn("day", F.col("sale_date"))
    path = work_dir(spark, name)
    c = F.col
    files.write_csv(
        rows.select(
            on_day(13, F.concat(F.lit("x"), c("product_id")), c("product_id").cast("string")).alias("product_id"),
            "product_name",
            "category",
            c("price") if price is None else price.alias("price"),
            "quantity_sold",
            on_day(14, "2024-13-40", c("sale_date").cast("string")).alias("sale_date"),
            "customer_id",
            "region",
        ),
        path,
    )
    return path


def in_cents(rows: DataFrame) -> DataFrame:
    """The price with two places, for rows that have no more."""
    return rows.withColumn("price", F.col("price").cast(MONEY))


def scan_typed_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = faulty_sales_csv(spark, sf_dir, "scan_typed_csv")
    return in_cents(sales_csv.well_formed(sales_csv.read_sales_csv(spark, path)))


def scan_quoted_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw sales whose product names hold line ends, quotes and separators, on three days of the month."""
    rows = sales(spark, sf_dir).withColumn("day", F.col("sale_date"))
    name = F.col("product_name")
    lines_in_name = on_day(
        5,
        F.concat(name, F.lit('\n"q", x\n\n')),
        on_day(6, F.concat(F.lit('"\n"'), name), on_day(7, F.concat(name, F.lit('"')), name)),
    )
    root = work_dir(spark, "scan_quoted_records")
    files.write_csv(rows.withColumn("product_name", lines_in_name).select(*RAW_SALES.names), f"{root}/files")
    found = sales_csv.read_quoted_sales(spark, f"{root}/files", f"{root}/stage")
    return in_cents(sales_csv.well_formed(found)).select(*RAW_SALES.names)


def ordered_lines(rows: DataFrame, path: str, *by: str) -> None:
    """Lines in files that follow one another, by name, in the order of ``by``."""
    rows.repartitionByRange(*by).sortWithinPartitions(*by).select("line").write.text(path)


def staged_record(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The record's lines in key order, stored with their places."""
    root = work_dir(spark, name)
    rows = record(spark, sf_dir)
    ordered_lines(
        rows.withColumn("line", F.concat_ws("|", *DAILY_TEXT.names)), f"{root}/files", "region", "category", "sale_date"
    )
    lines.read_lines(spark, f"{root}/files").write.parquet(f"{root}/stage")
    return spark.read.parquet(f"{root}/stage")


def numbered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = staged_record(spark, sf_dir, "numbered_lines")
    return lines.numbered_in_batch(stored, lines.line_splits(stored)).select("batch_line_no", "line")


def tail_by_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = staged_record(spark, sf_dir, "tail_by_line")
    return lines.tail_by_line(stored, 25, whole_batch=True).select("line_no", "line")


def scan_by_format_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A data file with its fields in another order, mixed terminators, one of a fixed length and one to skip."""
    root = work_dir(spark, "scan_by_format_file")
    parts = ["region", F.lit(";"), F.rpad("sale_date", 12, " "), "category", F.lit("||"), "total_quantity", F.lit("\t")]
    parts += ["total_revenue", F.lit("|"), F.lit("skipped,"), "product_count", F.lit(";"), "avg_price", F.lit("|"), "last_processed"]
    record(spark, sf_dir).select(F.concat(*parts).alias("line")).write.text(f"{root}/data")
    described = spark.createDataFrame([(FORMAT,)], "value string")
    described.coalesce(1).write.text(f"{root}/format")
    fields = format_file.read_format(spark, f"{root}/format")
    return format_file.read_by_format(spark, f"{root}/data", fields).drop(CORRUPT)


def scan_malformed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = faulty_sales_csv(spark, sf_dir, "scan_malformed_rows")
    return sales_csv.malformed(sales_csv.read_sales_csv(spark, path))


def scan_latest_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = work_dir(spark, "scan_latest_batch")
    older = f"{root}/{batches.batch_name(EARLIER_TS)}"
    files.write_csv(record(spark, sf_dir), older)
    newer = delimited.read_daily_text(spark, older).withColumn(
        "last_processed", dates.instant_text(dates.run_time(RUN_TS + dt.timedelta(days=1)))
    )
    files.write_csv(newer, f"{root}/{batches.batch_name(RUN_TS)}")
    return delimited.read_daily_text(spark, batches.latest_batch(spark, root))


def scan_delimited(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "scan_delimited")
    files.write_delimited(record(spark, sf_dir), path)
    return with_time_as_text(delimited.read_daily(spark, path))


def scan_header_aware(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = work_dir(spark, "scan_header_aware")
    files.write_csv(record(spark, sf_dir), f"{root}/files/headed")
    # The same rows again, without header lines.
    files.write_delimited(
        delimited.read_daily_text(spark, f"{root}/files/headed"), f"{root}/files/plain", sep=","
    )
    found = lines.read_header_aware(spark, f"{root}/files", f"{root}/stage")
    return found.select(F.regexp_extract("file", "/(headed|plain)/", 1).alias("kind"), "line")


# ---- projections ----------------------------------------------------------


def parse_sale_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sales(spark, sf_dir).withColumn("day", F.col("sale_date"))
    as_text = on_day(
        3, "2024-13-40", on_day(4, F.date_format("sale_date", "yyyy-M-d"), F.col("sale_date").cast("string"))
    )
    written = rows.select("l_orderkey", "l_linenumber", as_text.alias("date_text"), as_text.alias("sale_date"))
    return project.with_sale_date(written).withColumn("is_rejected", F.col("sale_date").isNull())


def line_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project.with_revenue(sales(spark, sf_dir)).select(
        "l_orderkey",
        "l_linenumber",
        "product_id",
        "price",
        "quantity_sold",
        F.col("revenue").cast("decimal(29,2)").alias("revenue"),
    )


def conform_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    large = daily(spark, sf_dir).withColumn("total_quantity", F.col("total_quantity") * 30_000_000)
    return constraints.conform_daily(large).select(
        "category",
        "region",
        "sale_date",
        "total_quantity",
        "total_revenue",
        "product_count",
        "avg_price",
        "reasons",
    )


def round_money(spark: SparkSession, sf_dir: str) -> DataFrame:
    exact = (F.col("price") * F.col("quantity_sold")).cast("decimal(18,2)") * F.lit("0.0375").cast("decimal(4,4)")
    return sales(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", "product_id", money.round_money(exact).alias("amount")
    )


def format_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    shipped = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    moment = F.expr("cast(l_shipdate as timestamp_ntz) + make_dt_interval(0, l_linenumber, 0, l_quantity)")
    return shipped.select(
        "l_orderkey",
        "l_linenumber",
        dates.day_text(F.col("l_shipdate").cast("date")).alias("day_text"),
        dates.instant_text(moment).alias("time_text"),
    )


def null_sentinel(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    gaps = daily(spark, sf_dir).withColumns(
        {
            "category": F.nullif(c("category"), F.lit("SMALL")),
            "total_quantity": F.when(c("total_quantity") >= 30, c("total_quantity")),
            "total_revenue": F.when(c("total_revenue") >= 50000, c("total_revenue")),
            "avg_price": F.when(c("avg_price") >= 1000, c("avg_price")),
        }
    )
    return project.export_record(gaps)


def fill_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    gaps = {
        name: F.when(F.col("l_linenumber") != i, F.col(name))
        for i, name in enumerate(project.DEFAULTS, start=1)
    }
    return project.fill_defaults(sales(spark, sf_dir).withColumns(gaps))


def awkward(rows: DataFrame) -> DataFrame:
    """Category texts with the separators and a quote in them."""
    return rows.withColumn("category", F.concat(F.col("category"), F.lit(', a|b "c" \\')))


def redelimit(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = work_dir(spark, "redelimit")
    files.write_csv(awkward(record(spark, sf_dir)), f"{root}/comma")
    files.redelimit(delimited.read_daily_text(spark, f"{root}/comma"), f"{root}/pipe")
    return delimited.read_daily_text(spark, f"{root}/pipe", sep="|", header=False)


def strip_nul(spark: SparkSession, sf_dir: str) -> DataFrame:
    spoiled = sales(spark, sf_dir).select(
        F.concat_ws("|", "product_id", F.concat(text.nul_char(), F.col("product_name"), text.nul_char()), "region")
    )
    path = stored_lines(spark, spoiled, "strip_nul")
    return lines.read_lines(spark, path).select(
        text.strip_nul(F.col("line")).alias("line"), text.has_nul(F.col("line")).alias("had_nul")
    )


# ---- expansion and aggregates ---------------------------------------------


def expand_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return in_cents(expand_rows(sales(spark, sf_dir), SHORT_RUN))


def daily_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_time_as_text(daily(spark, sf_dir))


def sales_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate.sales_summary(daily(spark, sf_dir))


def load_verification(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Asked of a table that the rows were loaded into."""
    name, path = f"daybook_target_{uuid.uuid4().hex}", work_dir(spark, "load_verification")
    table.create_target(spark, name, f"{path}/target", layout=DAILY)
    try:
        append_table(target_rows(spark, sf_dir), name)
        aggregate.load_verification(table.read_target(spark, name)).write.parquet(f"{path}/result")
    finally:
        spark.sql(f"DROP TABLE {name}")
    return spark.read.parquet(f"{path}/result")


def summary_from_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary of seven batches, each of which stored its state; one of them twice."""
    root = work_dir(spark, "summary_from_states")
    rows = daily(spark, sf_dir)
    rows.write.parquet(f"{root}/daily")
    rows = spark.read.schema(rows.schema).parquet(f"{root}/daily")
    for batch in [*range(7), 3]:
        summary.store_state(rows.where(F.year("sale_date") % 7 == batch), f"{root}/states", f"year{batch}")
    return summary.stored_summary(spark, f"{root}/states")


def distinct_from_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct customers and products of seven batches: exact, and whether the united sketches come near enough."""
    root = work_dir(spark, "distinct_from_sketches")
    columns = ("customer_id", "product_id")
    rows = sales(spark, sf_dir).select("sale_date", *columns)
    for batch in range(7):
        aggregate.distinct_state(rows.where(F.year("sale_date") % 7 == batch), *columns).write.parquet(f"{root}/batch={batch}")
    about = aggregate.distinct_from_states(spark.read.parquet(root).select(*columns))
    exact = rows.agg(*[F.count_distinct(c).alias(f"n_{c}") for c in columns])
    near = [
        (F.abs(F.col(c) - F.col(f"n_{c}")) <= aggregate.SKETCH_ERROR * F.col(f"n_{c}")).alias(f"{c}_within_error")
        for c in columns
    ]
    return exact.join(F.broadcast(about)).select(*[f"n_{c}" for c in columns], *near)


def pipeline_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate.pipeline_metrics(daily(spark, sf_dir))


def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project.preview(daily_sales(spark, sf_dir), 10)


def tail_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project.tail_by_key(daily_sales(spark, sf_dir), 25, "sale_date", "category", "region")


# ---- quality --------------------------------------------------------------


def file_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "file_profile")
    damaged_lines(spark, sf_dir).write.partitionBy("region").text(path)
    facts = quality.with_line_facts(lines.read_lines(spark, path), "|")
    return (
        quality.file_profile(facts)
        .withColumn("region", F.url_decode(F.regexp_extract("file", "/region=([^/]*)/", 1)))
        .groupBy("region")
        .agg(
            F.sum("n_bytes").alias("n_bytes"),
            F.sum("n_lines").alias("n_lines"),
            F.min("min_seps").alias("min_seps"),
            F.max("max_seps").alias("max_seps"),
            F.sum("nul_lines").alias("nul_lines"),
            F.sum("cr_lines").alias("cr_lines"),
            F.sum("binary_lines").alias("binary_lines"),
        )
    )


def separator_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = stored_lines(spark, faulty_lines(spark, sf_dir), "separator_histogram")
    return quality.separator_histogram(quality.with_line_facts(lines.read_lines(spark, path), "|"))


def load_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.load_reconciliation(staged_lines(spark, sf_dir, "load_reconciliation"))


def content_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files against the table they were loaded into: as they are, with a field swapped between rows, with a row twice."""
    root = work_dir(spark, "content_reconciliation")
    name = f"daybook_target_{uuid.uuid4().hex}"
    files.write_delimited(record(spark, sf_dir), f"{root}/files")
    table.create_target(spark, name, f"{root}/target", layout=DAILY)
    try:
        append_table(constraints.accepted(stage_batch(spark, f"{root}/files", f"{root}/stage", "|")), name)
    finally:
        spark.sql(f"DROP TABLE {name}")
    before = source_rows(spark, f"{root}/files", "|")
    loaded = spark.read.schema(DAILY).parquet(f"{root}/target").select(*DAILY.names)
    # Two rows of one region swap their quantities.
    ends = loaded.groupBy("region").agg(
        F.min(F.struct("total_quantity", "category", "sale_date")).alias("low"),
        F.max(F.struct("total_quantity", "category", "sale_date")).alias("high"),
    )
    at = [F.col(f"{end}.{key}") == F.col(key) for end in ("low", "high") for key in ("category", "sale_date")]
    other = F.when(at[0] & at[1], F.col("high.total_quantity")).when(at[2] & at[3], F.col("low.total_quantity"))
    swapped = loaded.join(ends, "region").withColumn("total_quantity", F.coalesce(other, "total_quantity"))
    twice = loaded.unionByName(loaded.where("region = 'ASIA'"))
    kinds = {"loaded": loaded, "swapped": swapped.select(*DAILY.names), "twice": twice}
    found = [quality.content_reconciliation(before, rows).select(F.lit(kind).alias("kind"), "*") for kind, rows in kinds.items()]
    return found[0].unionByName(found[1]).unionByName(found[2])


# ---- constraints and load -------------------------------------------------


def typed_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = constraints.conform_text(faulty_record(spark, sf_dir).drop("day"))
    return with_time_as_text(checked)


def reject_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = staged_lines(spark, sf_dir, "reject_rows")
    return constraints.rejected(checked).select(F.col("line").alias("raw"), "reasons")


def reject_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected lines with their number in the batch, whose files are in order of region, day and text."""
    root = work_dir(spark, "reject_lines")
    fields = [F.coalesce(F.col(n), F.lit(text.NULL_TEXT)) for n in DAILY_TEXT.names]
    rows = faulty_record(spark, sf_dir).withColumn("line", faulty_line(fields))
    ordered_lines(rows, f"{root}/files", "region", "day", "line")
    staged = stage_batch(spark, f"{root}/files", f"{root}/stage", "|")
    rejects = lines.numbered_in_batch(constraints.rejected(staged), lines.line_splits(staged))
    return rejects.select("batch_line_no", F.col("line").alias("raw"), "reasons")


def constraint_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return constraints.constraint_report(constraints.conform_text(faulty_record(spark, sf_dir)))


def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = daily(spark, sf_dir).select("category", "region", "sale_date")
    # ASIA's rows a second time, spelled so that only the target sees them as equal.
    spelled = F.array(
        F.col("category"), F.when(F.col("region") == "ASIA", F.concat(F.lower("category"), F.lit("  ")))
    )
    return constraints.duplicate_keys(
        rows.withColumn("category", F.explode(F.array_compact(spelled)))
    )


def earlier(rows: DataFrame) -> DataFrame:
    """A target that holds the years before the cutover, in another spelling."""
    return rows.filter(F.col("sale_date") < F.lit(CUTOVER)).withColumn(
        "category", F.concat(F.lower("category"), F.lit(" "))
    )


def stored_target(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The batch and the earlier target, both from one stored copy of the daily rows."""
    path = work_dir(spark, "stored_target")
    target_rows(spark, sf_dir).write.parquet(path)
    rows = spark.read.schema(DAILY).parquet(path)
    return rows, earlier(rows)


def key_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return constraints.key_conflicts(*stored_target(spark, sf_dir))


def key_conflicts_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same keys, with the target's rows tested at its scan against a bit map of the batch's."""
    rows, target = stored_target(spark, sf_dir)
    status = key_filter.batch_key_status(rows, target, rows.count())
    return status.filter("in_target = 1").drop("in_target")


def new_keys_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_time_as_text(constraints.new_keys_only(*stored_target(spark, sf_dir)))


def mixed_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily rows in which odd days spell category and region as only the target holds for equal."""
    odd = F.dayofmonth("sale_date") % 2 == 1
    rows = daily(spark, sf_dir)
    for name in ("category", "region"):
        rows = rows.withColumn(name, F.when(odd, F.concat(F.lower(name), F.lit(" "))).otherwise(F.col(name)))
    return rows


def sales_summary_mixed_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate.sales_summary(mixed_case(spark, sf_dir))


def pipeline_metrics_mixed_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate.pipeline_metrics(mixed_case(spark, sf_dir))


def preview_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows a preview has, and how many of them are in the whole result."""
    path = work_dir(spark, "preview")
    rows = daily(spark, sf_dir)
    project.preview(rows).write.parquet(path)
    shown = spark.read.parquet(path)
    known = shown.join(rows, shown.columns, "left_semi").agg(F.count("*").alias("n_known"))
    return shown.agg(F.count("*").alias("n_rows")).join(known)


# ---- sinks ----------------------------------------------------------------


def export_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "export_csv")
    files.write_csv(awkward(record(spark, sf_dir)), path)
    return delimited.read_daily_text(spark, path)


def export_delimited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines as they lie in the files."""
    path = work_dir(spark, "export_delimited")
    files.write_delimited(record(spark, sf_dir), path)
    return lines.read_lines(spark, path).select("line")


def bulk_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"daybook_target_{uuid.uuid4().hex}"
    path = work_dir(spark, "bulk_load")
    rows, before = stored_target(spark, sf_dir)
    table.create_target(spark, name, path, layout=DAILY)
    try:
        append_table(before, name)
        append_table(constraints.new_keys_only(rows, table.read_target(spark, name)), name)
    finally:
        spark.sql(f"DROP TABLE {name}")
    return with_time_as_text(spark.read.schema(DAILY).parquet(path).select(*DAILY.names))


def partitioned_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "partitioned_layout")
    files.write_partitioned(target_rows(spark, sf_dir), path)
    return with_time_as_text(spark.read.schema(DAILY).parquet(path).select(*DAILY.names))


def interleaved_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "interleaved_layout")
    files.write_interleaved(target_rows(spark, sf_dir), path)
    return with_time_as_text(spark.read.schema(DAILY).parquet(path))


def recreated_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table after it was made anew, and how many rows a reader sees that had opened it before."""
    name, root = f"daybook_target_{uuid.uuid4().hex}", work_dir(spark, "recreated_target")
    rows, before = stored_target(spark, sf_dir)
    table.recreate_target(spark, name, root, before, DAILY)
    try:
        old = table.read_target(spark, name)
        old.isEmpty()  # it has listed the files it will read
        location = table.recreate_target(spark, name, root, rows, DAILY)
        seen = old.agg(F.count("*").alias("rows_seen_before"))
        now = with_time_as_text(table.read_target(spark, name))
        now.join(F.broadcast(seen)).write.parquet(f"{root}/result")
        table.drop_versions(spark, root, location)
    finally:
        spark.sql(f"DROP TABLE {name}")
    return spark.read.parquet(f"{root}/result")


# ---- jobs -----------------------------------------------------------------


def export_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = work_dir(spark, "export_job")
    rows = sales(spark, sf_dir).select(*RAW_SALES.names)
    done = export_batch(spark, rows, f"{root}/out", f"{root}/stage", RUN_TS, LONG_RUN)
    return delimited.read_daily_text(spark, done.path)


def export_job_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The export as is, from raw files with two malformed days a month; prices hold thirds of a cent."""
    root = work_dir(spark, "export_job_from_files")
    path = faulty_sales_csv(spark, sf_dir, "export_job_from_files_raw", (F.col("price") / 3).cast("decimal(22,6)"))
    done = export_files(spark, path, f"{root}/out", f"{root}/stage", RUN_TS, None, max_errors=2**62)
    rows = delimited.read_daily_text(spark, done.path)
    return rows.withColumn("malformed_rows", F.lit(done.malformed_rows).cast("bigint"))


def full_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = work_dir(spark, "full_run")
    name = f"daybook_target_{uuid.uuid4().hex}"
    table.create_target(spark, name, f"{root}/target")
    config = PipelineConfig(f"{root}/out", f"{root}/stage", name, RUN_TS, LONG_RUN)
    try:
        metrics = run_pipeline(spark, sales(spark, sf_dir).select(*RAW_SALES.names), config).metrics
        metrics.write.parquet(f"{root}/metrics")
    finally:
        spark.sql(f"DROP TABLE {name}")
    return spark.read.parquet(f"{root}/metrics")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        scan_typed_csv,
        scan_malformed_rows,
        scan_quoted_records,
        numbered_lines,
        scan_by_format_file,
        scan_latest_batch,
        scan_delimited,
        scan_header_aware,
        parse_sale_date,
        line_revenue,
        conform_types,
        round_money,
        format_dates,
        null_sentinel,
        fill_defaults,
        redelimit,
        strip_nul,
        expand_days,
        daily_sales,
        sales_summary,
        load_verification,
        pipeline_metrics,
        preview,
        preview_known,
        sales_summary_mixed_case,
        pipeline_metrics_mixed_case,
        tail_by_key,
        tail_by_line,
        summary_from_states,
        distinct_from_sketches,
        file_profile,
        separator_histogram,
        load_reconciliation,
        content_reconciliation,
        typed_load,
        reject_rows,
        reject_lines,
        constraint_report,
        duplicate_keys,
        key_conflicts,
        key_conflicts_filtered,
        new_keys_only,
        export_csv,
        export_delimited,
        bulk_load,
        partitioned_layout,
        interleaved_layout,
        recreated_target,
        export_job,
        export_job_from_files,
        full_run,
    )
}
