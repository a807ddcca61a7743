"""Fixed layouts: raw sales, daily target table, text record, summary, metrics."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
# A price as it is read: nothing is rounded before the last step of an aggregate.
PRICE = T.DecimalType(22, 6)

# Raw sales file. Every source column is nullable; money is exact from the scan on.
RAW_SALES = T.StructType(
    [
        T.StructField("product_id", T.IntegerType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("price", PRICE),
        T.StructField("quantity_sold", T.IntegerType()),
        T.StructField("sale_date", T.DateType()),
        T.StructField("customer_id", T.IntegerType()),
        T.StructField("region", T.StringType()),
    ]
)

# Daily target table. The load time carries no zone, so it is TIMESTAMP_NTZ and
# no result depends on the session time zone.
DAILY = T.StructType(
    [
        T.StructField("category", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("sale_date", T.DateType()),
        T.StructField("total_quantity", T.IntegerType()),
        T.StructField("total_revenue", MONEY),
        T.StructField("product_count", T.IntegerType()),
        T.StructField("avg_price", MONEY),
        T.StructField("last_processed", T.TimestampNTZType()),
    ]
)

# The same with room for groups of any size: what a file carries, and a target
# unless it declares the narrow integers.
DAILY_WIDE = T.StructType(
    [T.StructField(f.name, T.LongType() if f.dataType == T.IntegerType() else f.dataType) for f in DAILY]
)

# The same eight fields as they travel in a file.
DAILY_TEXT = T.StructType([T.StructField(f.name, T.StringType()) for f in DAILY])

DAILY_KEY = ("category", "region", "sale_date")
TEXT_LIMIT = 50
CORRUPT = "_corrupt_record"


def text_version(schema: T.StructType) -> T.StructType:
    """The same field names, all text."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema])


def with_corrupt(schema: T.StructType) -> T.StructType:
    """``schema`` plus the column in which Spark keeps a malformed line."""
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
