"""Loading tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stowage import TableSpec
from stowage.plans.registry import open_warehouse, query


@query("SELECT * FROM orders")
def table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole table, by spec string."""
    return open_warehouse(spark, sf_dir, "orders").read_table("src.orders")


@query("SELECT * FROM customer")
def table_scan_by_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole table, by its three names."""
    wh = open_warehouse(spark, sf_dir, "customer")
    return wh.read_table(TableSpec(wh.project, "src", "customer"))


@query("""
SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
WHERE l_returnflag = 'R' AND l_quantity >= 30
""")
def table_scan_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filter and column choice on a loaded table; both reach the file scan."""
    df = open_warehouse(spark, sf_dir, "lineitem").read_table("src.lineitem")
    return df.filter((F.col("l_returnflag") == "R") & (F.col("l_quantity") >= 30)).select(
        "l_orderkey", "l_linenumber", "l_extendedprice"
    )


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_totalprice < 0")
def table_scan_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table without rows loads with its schema."""
    wh = open_warehouse(spark, sf_dir, "orders")
    none = wh.read_table("src.orders").filter("o_totalprice < 0")
    wh.write_table(none.select("o_orderkey", "o_orderstatus", "o_totalprice"), "own.refunds")
    return wh.read_table("own.refunds")
