"""The ``sales`` fact view over the star schema, and its total order.

Dimension chains (customer -> nation -> region) are joined before they meet the fact rows.
``nation`` and ``region`` are bounded by the schema (25 and 5 rows), so they are broadcast
explicitly; ``part`` and ``customer`` grow with the data, so the strategy is left to AQE,
which switches to a broadcast only after it has measured the shuffled side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Deterministic total order for every row-sequence operator. The six columns after the date
# are unique per fact row at every test scale.
ORDER_COLS = ["order_date", "l_orderkey", "product_id", "l_suppkey", "l_linenumber", "quantity", "l_extendedprice"]

SALES_COLS = [
    "order_date", "region", "category", "sub_category", "product_id", "product_name",
    "quantity", "sales", "profit", "customer_id", "line_status",
    "l_orderkey", "l_suppkey", "l_linenumber", "l_extendedprice",
]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def sales_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem ⋈ orders ⋈ customer ⋈ nation ⋈ region ⋈ part, all inner."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_linestatus")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_retailprice")

    geo = (nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
           .select("n_nationkey", "r_name"))
    cust = customer.join(F.broadcast(geo), customer.c_nationkey == geo.n_nationkey).select("c_custkey", "r_name")

    # orders meet their customers before the lines, so the lines are not shuffled by customer
    placed = orders.join(cust, F.col("o_custkey") == F.col("c_custkey"))
    fact = (li.join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(part, F.col("l_partkey") == F.col("p_partkey")))
    net = F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))
    return fact.select(
        F.to_date("o_orderdate").alias("order_date"),
        F.col("r_name").alias("region"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("sub_category"),
        F.col("l_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("l_quantity").alias("quantity"),
        net.alias("sales"),
        (net - F.col("l_quantity") * F.col("p_retailprice")).alias("profit"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_linestatus").alias("line_status"),
        "l_orderkey", "l_suppkey", "l_linenumber", "l_extendedprice",
    )
