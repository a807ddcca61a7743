"""The target table's rules as columns: a row carries the names of the rules it breaks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F, types as T

from daybook.functions import dates, text
from daybook.schema import CORRUPT, DAILY, DAILY_KEY, DAILY_WIDE, TEXT_LIMIT

TEXT_FIELDS = ("category", "region")
Rules = dict[str, Column]


def null_rules(field: Callable[[str], Column] = F.col) -> Rules:
    return {f"null:{f.name}": field(f.name).isNull() for f in DAILY}


def range_rules(field: Callable[[str], Column] = F.col) -> Rules:
    """Range and length. Unknown for a null, which therefore passes; the null
    rules are there for that."""
    rules = {f"too_long:{n}": text.utf16_length(field(n)) > TEXT_LIMIT for n in TEXT_FIELDS}
    for name in ("total_quantity", "total_revenue", "avg_price"):
        rules[f"negative:{name}"] = field(name) < 0
    rules["not_positive:product_count"] = field("product_count") <= 0
    return rules


def layout_rules(field: Callable[[str], Column] = F.col) -> Rules:
    """The target is stored by region, and a directory cannot be named by an
    empty text: it would read back as null."""
    return {"empty:region": field("region") == ""}


def export_rules(sep: str | None = None) -> Rules:
    """What a file cannot carry: a text equal to the null marker, and a line
    break. With ``sep``, for a reader that knows no quotes, also the separator
    and the quote itself."""
    rules = {}
    for name in TEXT_FIELDS:
        rules[f"null_text:{name}"] = F.col(name) == text.NULL_TEXT
        rules[f"line_break:{name}"] = F.col(name).rlike("[\\r\\n]")
        if sep:
            rules[f"separator:{name}"] = F.contains(F.col(name), F.lit(sep)) | F.contains(
                F.col(name), F.lit('"')
            )
    return rules


def broken(rules: Rules) -> Column:
    """Names of the rules that hold, comma-separated; empty for a sound row.

    A plain text stays inside generated code, and ``reasons = ''`` reaches a
    Parquet scan, neither of which an array would do.
    """
    return F.concat_ws(",", *[F.when(test, F.lit(name)) for name, test in rules.items()])


def computed_once(value: Column) -> Column:
    """``value`` as the only element of an exploded array.

    A filter on an ordinary column is pushed below the projection that computes
    it, and takes a copy of the whole expression along for each mention. It
    cannot be pushed below a generator, so the value is computed once per row.
    """
    return F.explode(F.array(value))


def constraint_report(daily: DataFrame) -> DataFrame:
    """(rule, violations) for every rule, in one pass over the rows."""
    rules = {**null_rules(), **range_rules()}
    counts = daily.agg(*[F.count_if(test).alias(name) for name, test in rules.items()])
    pairs = [part for name in rules for part in (F.lit(name), F.col(f"`{name}`"))]
    return counts.select(F.stack(F.lit(len(rules)), *pairs).alias("rule", "violations"))


def typed_column(name: str) -> Column:
    return F.col(f"typed_{name}")


def conform_daily(daily: DataFrame, sep: str | None = None, layout: T.StructType = DAILY) -> DataFrame:
    """Aggregates narrowed to the target's types, with ``reasons`` for every row
    that does not fit. A number out of range is reported, never wrapped."""
    rules = {**null_rules(), **range_rules(typed_column), **layout_rules(), **export_rules(sep)}
    return _narrowed(daily, layout, rules)


def conform_export(daily: DataFrame, sep: str | None = None, layout: T.StructType = DAILY_WIDE) -> DataFrame:
    """Aggregates in the types of ``layout``, with ``reasons`` only for what a file
    cannot carry. A null or a value outside the target's ranges is the load's business."""
    return _narrowed(daily, layout, export_rules(sep))


def _narrowed(daily: DataFrame, layout: T.StructType, rules: Rules) -> DataFrame:
    narrowed = {}
    for field in layout:
        value = F.col(field.name)
        if field.name in ("total_revenue", "avg_price"):
            value = F.round(value, 2)
        narrowed[f"typed_{field.name}"] = value.try_cast(field.dataType)
    lost = {
        f"out_of_range:{f.name}": F.col(f.name).isNotNull() & typed_column(f.name).isNull() for f in layout
    }
    reasons = broken({**lost, **rules})
    return daily.withColumns(narrowed).select(
        *[typed_column(n).alias(n) for n in DAILY.names], computed_once(reasons).alias("reasons")
    )


def conform_text(record: DataFrame, layout: T.StructType = DAILY) -> DataFrame:
    """Eight text fields to the types of ``layout``, with ``reasons`` for every row
    that cannot be loaded. Other columns pass through."""
    passed = [c for c in record.columns if c not in DAILY.names and c != CORRUPT]
    parsers = {"sale_date": dates.parse_day, "last_processed": dates.parse_instant}
    values = {}
    for field in layout:
        source = F.col(field.name)
        parse = parsers.get(field.name)
        values[f"typed_{field.name}"] = parse(source) if parse else source.try_cast(field.dataType)
    unreadable = {
        f"unreadable:{f.name}": F.col(f.name).isNotNull() & typed_column(f.name).isNull()
        for f in DAILY
        if f.name not in TEXT_FIELDS
    }
    rules = {**unreadable, **null_rules(), **range_rules(typed_column), **layout_rules()}
    if CORRUPT in record.columns:
        # Fields of a line with too few or too many of them mean nothing.
        whole = F.col(CORRUPT).isNull()
        rules = {"field_count": ~whole, **{name: whole & test for name, test in rules.items()}}
    return record.withColumns(values).select(
        *passed,
        *[typed_column(n).alias(n) for n in DAILY.names],
        computed_once(broken(rules)).alias("reasons"),
    )


def accepted(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col("reasons") == "").select(*DAILY.names)


def rejected(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col("reasons") != "")


def normal_key() -> list[Column]:
    """The key as the target compares it."""
    return [
        text.key_text(F.col("category")).alias("category_key"),
        text.key_text(F.col("region")).alias("region_key"),
        F.col("sale_date"),
    ]


def key_status(batch: DataFrame, target: DataFrame | None = None) -> DataFrame:
    """One row per key of the batch: how often it occurs, and whether the target has it.

    Stacking both sides and grouping once replaces a join: each map task reduces
    its rows to one per key, so a key repeated a billion times moves no more
    than any other.
    """
    rows = batch.select(*normal_key(), F.lit(1).alias("in_batch"), F.lit(0).alias("in_target"))
    if target is not None:
        rows = rows.unionAll(
            target.select(*normal_key(), F.lit(0).alias("in_batch"), F.lit(1).alias("in_target"))
        )
    return (
        rows.groupBy("category_key", "region_key", "sale_date")
        .agg(F.sum("in_batch").alias("n_rows"), F.max("in_target").alias("in_target"))
        .filter("n_rows > 0")
    )


def duplicate_keys(batch: DataFrame) -> DataFrame:
    return key_status(batch).filter("n_rows > 1").drop("in_target")


def key_conflicts(batch: DataFrame, target: DataFrame) -> DataFrame:
    """Keys of the batch that the target already holds; loading them would fail."""
    return key_status(batch, target).filter("in_target = 1").drop("in_target")


def new_keys_only(batch: DataFrame, target: DataFrame) -> DataFrame:
    """Rows of the batch whose key the target does not hold.

    A row with a null in its key equals no other, so it stays.
    """
    keyed = batch.withColumns(
        {f"{n}_key": text.key_text(F.col(n)) for n in TEXT_FIELDS}
    )
    known = target.select(*normal_key())
    return keyed.join(known, ["category_key", "region_key", DAILY_KEY[2]], "left_anti").select(
        *batch.columns
    )
