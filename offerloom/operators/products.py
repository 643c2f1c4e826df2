"""SKUs grouped into products, and attributes carried between the levels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerloom.functions.collections import top_per
from offerloom.functions.text import strip_trailing_slash, tokens
from offerloom.operators.graph import components, star_edges


def variant_groups(skus: DataFrame, variants: DataFrame, prefix: str = "") -> DataFrame:
    """``key, sku_id``: SKUs whose links one variant map lists (the last map of a link wins); ``variants`` has ``ord, variants``."""
    at = variants.select("ord", F.explode(F.map_keys("variants")).alias("link")).where("link <> ''")
    at = at.select(F.concat(F.lit(prefix), strip_trailing_slash("link")).alias("link"), "ord").groupBy("link").agg(F.max("ord").alias("key"))
    return skus.select("sku_id", F.explode("links").alias("link")).join(at, "link").select(F.col("key").cast("string").alias("key"), "sku_id").distinct()


def product_link_groups(skus: DataFrame, links: DataFrame, marker: str = "?sku") -> DataFrame:
    """``key, sku_id``: SKUs that have a variant page of one product page."""
    each = skus.select("sku_id", F.explode("links").alias("l")).where(F.contains("l", F.lit(marker)))
    return each.select("sku_id", F.substring_index("l", "?", 1).alias("link")).join(links, "link", "left_semi").select(F.col("link").alias("key"), "sku_id").distinct()


def containment_edges(skus: DataFrame) -> DataFrame:
    """``src, dst``: a SKU and the other that has all its words and whose common words it has; most common words first, then the smallest id."""
    each = skus.select("sku_id", F.explode("clean_names").alias("n"))
    per = each.select("sku_id", F.array_distinct(tokens("n")).alias("ts"))
    n = per.groupBy("sku_id").agg(F.count(F.lit(1)).alias("n"))
    w = per.select("sku_id", F.explode("ts").alias("t")).groupBy("sku_id", "t").agg(F.count(F.lit(1)).alias("k")).join(n, "sku_id")
    g = w.groupBy("sku_id").agg(F.collect_set("t").alias("ts"), F.collect_set(F.when(F.col("k") == F.col("n"), F.col("t"))).alias("common"))
    df = w.groupBy("t").agg(F.count(F.lit(1)).alias("df"))
    rare = w.select("sku_id", "t").join(df, "t").groupBy("sku_id").agg(F.min(F.struct("df", "t"))["t"].alias("t"))
    cand = rare.join(w.select(F.col("sku_id").alias("other"), "t"), "t").where("sku_id <> other").select("sku_id", "other")
    both = cand.join(g.select("sku_id", "ts"), "sku_id").join(g.select(F.col("sku_id").alias("other"), F.col("ts").alias("all"), F.col("common").alias("c")), "other")
    ok = both.where((F.size(F.array_except("ts", "all")) == 0) & (F.size(F.array_except("c", "ts")) == 0))
    return top_per(ok, ["sku_id"], [F.size("c").desc(), F.col("other")]).select(F.col("sku_id").alias("src"), F.col("other").alias("dst"))


def group_skus(skus: DataFrame, variants: DataFrame, links: DataFrame, marker: str = "?sku") -> DataFrame:
    """``sku_id, product_id``: components of variant maps, product pages, and containment among colour-only and size-only SKUs."""
    stars = star_edges(variant_groups(skus, variants), "key", "sku_id").union(star_edges(product_link_groups(skus, links, marker), "key", "sku_id"))
    colored, sized = F.size("colors") > 0, F.col("size").isNotNull() & (F.col("size") != "")
    edges = stars.union(containment_edges(skus.where(colored & ~sized))).union(containment_edges(skus.where(~colored & sized)))
    g = components(edges)
    ids = g.groupBy("component").agg(F.sha2(F.array_join(F.array_sort(F.collect_set("node")), ","), 256).alias("product_id"))
    return g.join(ids, "component").select(F.col("node").alias("sku_id"), "product_id")


def product_rows(skus: DataFrame) -> DataFrame:
    """One row a product (its lists joined) and one a SKU without product; ``uid`` and ``kind`` tell them apart."""
    lists = ["clean_names", "brands", "colors", "barcodes"]
    uid = F.coalesce("product_id", "sku_id").alias("uid")
    rows = skus.select(uid, F.when(F.col("product_id").isNull(), F.lit("sku")).otherwise(F.lit("product")).alias("kind"), "sku_id", *lists)
    return rows.groupBy("uid", "kind").agg(*[F.array_sort(F.flatten(F.collect_list(c))).alias(c) for c in lists], F.array_sort(F.collect_set("sku_id")).alias("sku_ids"))


def attributes_to_skus(skus: DataFrame, products: DataFrame, cols: list[str]) -> DataFrame:
    """Product attributes on each SKU by product id, else by its own."""
    return skus.withColumn("uid", F.coalesce("product_id", "sku_id")).join(products.select("uid", *cols), "uid", "left").drop("uid")


def export_rows(skus: DataFrame, docs: DataFrame) -> DataFrame:
    """``doc_id, sku_id, product_id, brand, category``: product to SKU to docs, without clones."""
    each = skus.select("sku_id", "product_id", "brand", "category", F.explode("doc_ids").alias("doc_id")).where(~F.contains("doc_id", F.lit("clone")))
    return docs.select("doc_id").distinct().join(each, "doc_id").select("doc_id", "sku_id", "product_id", "brand", "category")
