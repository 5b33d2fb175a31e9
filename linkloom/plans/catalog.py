"""Inputs shared by the registered queries: driver tables and derived link tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.urls import is_external

SHOP = "https://www.shop.example"
SHOP_ROOT = "shop.example"
PAGES_ROOT = "example.com"
RUN_TS = "2024-02-01 00:00:00"
OLD_TS = "2024-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shop_url_expr() -> F.Column:
    """Shop-like URLs from ``part``: the key picks one of twelve URL shapes."""
    k = F.col("p_partkey").cast("string")
    n = F.regexp_replace(F.col("p_name"), " ", "-")
    shape = F.col("p_partkey") % 12
    shapes = [
        F.concat(F.lit(SHOP + "/"), n, F.lit("-p-HBV"), k),
        F.concat(F.lit(SHOP + "/"), n, F.lit("-c-"), k),
        F.concat(F.lit(SHOP + "/kampanyalar/"), k),
        F.concat(F.lit(SHOP + "/magaza/"), n),
        F.concat(F.lit(SHOP + "/marka/"), n, F.lit("?k="), k),
        F.lit(SHOP + "/yardim"),
        F.concat(F.lit(SHOP + "/kargo-"), k),
        F.concat(F.lit(SHOP + "/ara?q="), n),
        F.lit(SHOP + "/giris"),
        F.lit(SHOP + "/"),
        F.concat(F.lit("/"), n, F.lit("-p-HBV"), k),
    ]
    expr = F.when(shape == 0, shapes[0])
    for i, s in enumerate(shapes[1:], start=1):
        expr = expr.when(shape == i, s)
    return expr.otherwise(F.lit(None).cast("string"))


def shop_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A link table (id, url, anchor_text, rel, is_external, pred_category) over ``part``."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    url = shop_url_expr()
    return p.select(
        F.col("p_partkey").alias("id"),
        url.alias("url"),
        F.col("p_name").alias("anchor_text"),
        F.when(F.col("p_size") > 40, F.lit("nofollow")).alias("rel"),
        F.coalesce(is_external(url, SHOP_ROOT), F.lit(False)).alias("is_external"),
        F.col("p_size"),
        F.lit(None).cast("string").alias("pred_category"),
    )
