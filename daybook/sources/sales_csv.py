"""Typed scan of raw sales files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from daybook.operators.constraints import computed_once
from daybook.schema import CORRUPT, PRICE, RAW_SALES, text_version, with_corrupt
from daybook.sources.csv_options import csv_options
from daybook.sources.lines import head_by_line
from daybook.sources.records import quoted_records, stage_quoted


# Finer than a price may be, so that one with too many places is seen, not rounded.
READ_PRICE = T.DecimalType(38, 18)
TOO_FINE = "too_fine:price"


def read_sales_csv(spark: SparkSession, path: str) -> DataFrame:
    """Raw sales under the fixed schema, plus the raw text of malformed rows.

    A row with a wrong field count or an unreadable number or date keeps its
    line in ``_corrupt_record`` instead of turning into silent nulls. So does a
    price that six places cannot hold; it is null then. A file whose header does not
    name the columns in their order ends the job that reads it.
    """
    read = (
        spark.read.options(**csv_options(header=True))
        .option("mode", "PERMISSIVE")
        .option("enforceSchema", "false")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .schema(with_corrupt(_read_layout()))
        .csv(path)
    )
    return _checked(read)


def _read_layout() -> T.StructType:
    return T.StructType(
        [T.StructField(f.name, READ_PRICE if f.name == "price" else f.dataType) for f in RAW_SALES]
    )


def _checked(read: DataFrame) -> DataFrame:
    price = F.col("price").try_cast(PRICE)
    held = F.coalesce(price == F.col("price"), F.col("price").isNull())
    line = F.to_csv(F.struct(*RAW_SALES.names), csv_options())
    checked = {"price": F.when(held, price), CORRUPT: F.when(held, F.col(CORRUPT)).otherwise(F.coalesce(CORRUPT, line))}
    return read.withColumns(checked).select(*[c for c in read.columns if c not in (*RAW_SALES.names, CORRUPT)], *RAW_SALES.names, CORRUPT)


def read_quoted_sales(spark: SparkSession, path: str, stage_path: str) -> DataFrame:
    """The same from files in which a quoted text may hold line ends, cut into splits like any other.

    ``line_no`` is the file's number of the record's first line. A record that could
    not be put together is malformed. A file whose first line isn't the header ends
    the read with an error. Blank lines between records are no records.
    """
    stored = stage_quoted(spark, path, stage_path)
    # The header holds no quote, so a first line that opens a record isn't one either.
    first_lines = head_by_line(stored.where("block_start = 0"), 1)
    wrong = first_lines.where(F.col("line") != ",".join(RAW_SALES.names)).select("file").first()
    if wrong:
        raise ValueError(f"{wrong['file']} does not begin with the header of raw sales")
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in with_corrupt(_read_layout()))
    options = {**csv_options(), "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    # A record that stayed apart is shown as it is, whatever its fields may look like.
    sound = F.col("problem").isNull()
    parsed = quoted_records(stored).where((F.col("line_no") != 1) & (F.col("record") != "")).select(
        "line_no", "record", sound.alias("sound"), computed_once(F.from_csv(F.when(sound, F.col("record")), ddl, options)).alias("f")
    )
    fields = {n: F.col(f"f.{n}").alias(n) for n in RAW_SALES.names}
    corrupt = F.when(F.col("sound"), F.col(f"f.{CORRUPT}")).otherwise(F.col("record"))
    return _checked(parsed.select("line_no", *fields.values(), corrupt.alias(CORRUPT)))


def is_malformed() -> Column:
    """Whether a row of the scan is malformed.

    The scan reads, and so judges, only the fields a query asks for. Naming all
    of them here makes the verdict the same under every projection.
    """
    marks = [F.when(F.col(CORRUPT).isNotNull(), F.lit("row"))]
    for name in RAW_SALES.names:
        marks.append(F.when(F.col(CORRUPT).isNotNull() & F.col(name).isNull(), F.lit(name)))
    return F.concat_ws(",", *marks) != ""


def well_formed(scan: DataFrame) -> DataFrame:
    return scan.filter(~is_malformed()).drop(CORRUPT)


def malformed(scan: DataFrame) -> DataFrame:
    """The rejected rows: their line, and the fields that could not be read.

    The line is split a second time, as text and on the rejected rows alone, to
    tell an unreadable field from a missing one.
    """
    as_text = with_corrupt(text_version(RAW_SALES))
    ddl = ", ".join(f"{f.name} string" for f in as_text)
    fields = F.from_csv(F.col(CORRUPT), ddl, {**csv_options(), "columnNameOfCorruptRecord": CORRUPT})
    fine = F.col("f.price").try_cast(READ_PRICE).isNotNull()
    unreadable = [
        F.when(
            F.col(f"f.{n}").isNotNull() & F.col(n).isNull(),
            F.when(fine, F.lit(TOO_FINE)).otherwise(F.lit(n)) if n == "price" else F.lit(n),
        )
        for n in RAW_SALES.names
    ]
    reasons = F.when(F.col(f"f.{CORRUPT}").isNotNull(), F.lit("field_count")).otherwise(
        F.concat_ws(",", *unreadable)
    )
    return (
        scan.filter(is_malformed())
        .withColumn("f", fields)
        .select(F.col(CORRUPT).alias("raw"), reasons.alias("reasons"))
    )
