"""Bars and other panel inputs from the driver's tables, and the same as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars: a supplier's nation is the symbol, the ship date the day, each line a trade."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_discount", "l_tax", "l_quantity", "l_shipdate")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    px = F.floor(100 * (1 - F.col("l_discount").cast("double")) * (1 + F.col("l_tax").cast("double")) * 100 + 0.5) / 100
    order = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    trades = lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.concat(F.lit("N"), F.col("s_nationkey")).alias("symbol"), F.to_date("l_shipdate").alias("date"), px.alias("px"), order.alias("o"), F.col("l_quantity").cast("double").alias("q")
    )
    return trades.groupBy("symbol", "date").agg(
        F.min_by("px", "o").alias("open"), F.max("px").alias("max"), F.min("px").alias("min"), F.max_by("px", "o").alias("close"), F.max_by("px", "o").alias("adjclose"), F.sum("q").alias("Trading_Volume")
    )


BARS_SQL = """
trades AS (
  SELECT 'N' || s_nationkey AS symbol, CAST(l_shipdate AS DATE) AS date,
    floor(100 * (1 - l_discount::DOUBLE) * (1 + l_tax::DOUBLE) * 100 + 0.5) / 100 AS px,
    (l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS o, l_quantity::DOUBLE AS q
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
), bars AS MATERIALIZED (
  SELECT symbol, date, arg_min(px, o) AS open, max(px) AS max, min(px) AS min, arg_max(px, o) AS close,
    arg_max(px, o) AS adjclose, sum(q) AS "Trading_Volume"
  FROM trades GROUP BY symbol, date
)"""
