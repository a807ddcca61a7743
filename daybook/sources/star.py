"""Raw sales rows from star-schema tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from daybook.schema import MONEY


def sales_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw sale per order line: its part, buyer, and the buyer's region.

    Customers find their region first, then orders their customer, so the line
    items move twice at most: by order and by part. The part comes last, so that
    its texts, the widest columns, don't move with every line. No join is hinted. Spark broadcasts a side whose
    size it knows to be small, at planning or once the side has been shuffled,
    and splits a skewed partition otherwise.
    """

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    customers = (
        table("customer")
        .select("c_custkey", "c_nationkey")
        .join(table("nation").select("n_nationkey", "n_regionkey"), F.expr("c_nationkey = n_nationkey"))
        .join(table("region").select("r_regionkey", "r_name"), F.expr("n_regionkey = r_regionkey"))
        .select("c_custkey", F.col("r_name").alias("region"))
    )
    orders = (
        table("orders")
        .select("o_orderkey", "o_custkey")
        .join(customers, F.expr("o_custkey = c_custkey"))
        .select("o_orderkey", F.col("o_custkey").cast("int").alias("customer_id"), "region")
    )
    parts = table("part").select(
        "p_partkey",
        F.col("p_partkey").cast("int").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").cast(MONEY).alias("price"),
    )
    lines = table("lineitem").select(
        "l_orderkey",
        "l_partkey",
        F.col("l_quantity").cast("int").alias("quantity_sold"),
        F.col("l_shipdate").cast("date").alias("sale_date"),
        "l_linenumber",
    ).where("l_partkey is not null")
    return (
        lines.join(orders, F.expr("l_orderkey = o_orderkey"))
        .join(parts, F.expr("l_partkey = p_partkey"))
        .select(
            "l_orderkey",
            "l_linenumber",
            "product_id",
            "product_name",
            "category",
            "price",
            "quantity_sold",
            "sale_date",
            "customer_id",
            "region",
        )
    )
