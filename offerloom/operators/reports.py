"""Statistics, deals and small lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerloom.constants import Config
from offerloom.functions.collections import argmin_key


def market_stats(docs: DataFrame) -> DataFrame:
    """Docs, out of stock, distinct barcodes, promoted docs, variant docs and variant names of each market."""
    base = docs.groupBy("market").agg(
        F.count(F.lit(1)).alias("n_docs"), F.count_if(F.coalesce("out_of_stock", F.lit(False))).alias("n_out"), F.count_if(F.size("promoted") > 0).alias("n_promoted"),
        F.count_if(F.size("variants") > 0).alias("n_variants"), F.count_distinct("variant_name").alias("n_variant_names"))
    codes = docs.select("market", F.explode("barcodes").alias("b")).groupBy("market").agg(F.count_distinct("b").alias("n_barcodes"))
    return base.join(codes, "market", "left").withColumn("n_barcodes", F.coalesce("n_barcodes", F.lit(0).cast("long")))


def barcode_classes(docs: DataFrame, a: list[str], b: list[str]) -> DataFrame:
    """``n_a, n_b, n_union, n_both``: barcodes of two market classes."""
    t = docs.select(F.explode("barcodes").alias("c"), "market").groupBy("c").agg(F.bool_or(F.col("market").isin(*a)).alias("a"), F.bool_or(F.col("market").isin(*b)).alias("b"))
    return t.agg(F.count_if("a").alias("n_a"), F.count_if("b").alias("n_b"), F.count_if(F.col("a") | F.col("b")).alias("n_union"), F.count_if(F.col("a") & F.col("b")).alias("n_both"))


def deals(skus: DataFrame, cfg: Config, markets: list[str] | None = None) -> DataFrame:
    """``sku_id, best_market, best_price, third_price``: at least four prices, the least under 0.7 of the third."""
    p = skus.withColumn("ps", F.array_sort(F.map_values("prices"))).withColumn("best_market", argmin_key(F.col("prices"))).where(F.size("ps") >= cfg.deal_prices)
    p = p.where(F.get("ps", F.lit(0)) < cfg.deal_share * F.get("ps", F.lit(2)))
    p = p.where(F.col("best_market").isin(*markets)) if markets else p
    return p.select("sku_id", "best_market", F.get("ps", F.lit(0)).alias("best_price"), F.get("ps", F.lit(2)).alias("third_price"))


def availability(wide: DataFrame, key: str) -> DataFrame:
    """``key, markets``: one-hot columns to sorted lists."""
    long = wide.unpivot(key, [c for c in wide.columns if c != key], "market", "v").where("v = 1")
    return long.groupBy(key).agg(F.array_sort(F.collect_list("market")).alias("markets"))


def category_tree(rows: DataFrame, order: DataFrame | None = None) -> DataFrame:
    """``cat, children``: sub-categories of each category in order; rows have ``cat, subcat``.

    With ``order`` (``cat, place, icon``) also ``place`` and ``icon``; categories it doesn't name have neither.
    """
    tree = rows.distinct().groupBy("cat").agg(F.array_sort(F.collect_list("subcat")).alias("children"))
    return tree if order is None else tree.join(order.dropDuplicates(["cat"]), "cat", "left").select("cat", "children", "place", "icon")


def leaf_categories(tree: DataFrame) -> DataFrame:
    """Categories that are nobody's parent; ``tree`` has ``id, parent``."""
    return tree.join(tree.select(F.col("parent").alias("id")).where("id is not null").distinct(), "id", "left_anti")
