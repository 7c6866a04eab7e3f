"""The supplied star-schema tables seen through the recommender's raw schema.

Column mapping (fixed, see FIXTURES.md §3):
  orders      o_orderkey → order_id, o_custkey → customer_id,
              o_orderstatus → order_status ('F' = delivered), o_orderdate → order_purchase_timestamp
  items       l_orderkey → order_id, l_linenumber → order_item_id, l_suppkey → seller_id,
              l_partkey → product_id, l_extendedprice → price, l_extendedprice·l_tax → freight_value,
              review 1 + (l_orderkey + l_linenumber) mod 5, none when l_returnflag = 'N'
  customers   c_custkey → customer_id and customer_unique_id
  products    p_partkey → product_id, p_brand → product_category_name
  payments    one per order, o_orderpriority → payment_type
Only the columns a query touches are read; Catalyst prunes the rest at the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

# Status code of a delivered order in the supplied data.
DELIVERED = "F"

# Row order used wherever the reference takes the "first" row of a group.
ITEM_ORDER = ("order_id", "order_item_id", "seller_id", "price")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def line_review(l_orderkey: Column, l_linenumber: Column, l_returnflag: Column) -> Column:
    score = (F.lit(1) + (l_orderkey + l_linenumber) % 5).cast("double")
    return F.when(l_returnflag == F.lit("N"), F.lit(None).cast("double")).otherwise(score)


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Seven raw tables in the reference's shapes, derived lazily from the parquet files."""
    o = table(spark, sf_dir, "orders")
    li = table(spark, sf_dir, "lineitem")
    c = table(spark, sf_dir, "customer")
    p = table(spark, sf_dir, "part")
    orders = o.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        # status codes kept as they are ('F' = delivered): an equality on the raw column
        # reaches the Parquet reader as a pushed filter, a relabelling CASE would not
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("order_purchase_timestamp"),
    )
    items = li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_extendedprice").alias("price"),
        (F.col("l_extendedprice") * F.col("l_tax")).alias("freight_value"),
        # one review per line: the supplied data has no separate review table
        line_review(F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_returnflag")).alias("review_score"),
    )
    customers = c.select(F.col("c_custkey").alias("customer_id"), F.col("c_custkey").alias("customer_unique_id"))
    products = p.select(F.col("p_partkey").alias("product_id"), F.col("p_brand").alias("product_category_name"))
    translation = p.select(
        F.col("p_brand").alias("product_category_name"),
        F.col("p_brand").alias("product_category_name_english"),
    ).distinct()
    payments = o.select(
        F.col("o_orderkey").alias("order_id"),
        F.lit(1).alias("payment_sequential"),
        F.col("o_orderpriority").alias("payment_type"),
    )
    return {
        "orders": orders,
        "items": items,
        "customers": customers,
        "products": products,
        "reviews": None,
        "translation": translation,
        "payments": payments,
    }
