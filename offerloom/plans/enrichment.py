"""Brand, sub-category and sub-brand of products, and back to their SKUs: the steps in order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerloom.functions.text import clean_string
from offerloom.operators import enrich, prep, topics
from offerloom.session import cut


def _each(rows: DataFrame, col: str, to: str) -> DataFrame:
    """``uid, pos, <to>``: the values of a list column, cleaned; empty ones out."""
    return rows.select("uid", F.posexplode(col).alias("pos", to)).withColumn(to, clean_string(to)).where(F.col(to) != "")


def root_of(brands: DataFrame) -> DataFrame:
    """``uid, pos, brand``: brands of several words cut to the more frequent brand they begin with."""
    root = enrich.root_brands(brands.groupBy("brand").agg(F.count(F.lit(1)).alias("n")))
    return brands.join(root, "brand").select("uid", "pos", F.col("root").alias("brand"))


def enriched_products(products: DataFrame, learn: bool = False) -> DataFrame:
    """``uid, brand, subcat, subcat_source, sub_brand`` of products (``uid, clean_names, brands, subcats``).

    Brands are cleaned, cut to their root and chosen by the names; sub-categories are cleaned (merged,
    singular, without gender words and brands) and chosen by the cascade of rules, with ``learn`` also
    by a learner for those that no rule decides; sub-brands come from the words that only one brand of
    a sub-category begins its names with. What can't be told is null.
    """
    names = cut(_each(products, "clean_names", "name"))
    brands = _each(products, "brands", "brand").where((F.length("brand") > 2) & ~prep.is_bad_brand(F.col("brand")))
    brands = cut(root_of(brands))
    votes = products.select("uid", F.posexplode("subcats").alias("pos", "subcat"))
    counts = votes.select(F.col("subcat").alias("s")).withColumn("subcat", prep.singular(clean_string("s"))).groupBy("subcat").agg(F.count(F.lit(1)).alias("n"))
    mapping = prep.clean_subcats(votes, brands, enrich.merged_subcats(counts))
    votes = cut(prep.with_clean(votes, "subcat", mapping).where("subcat is not null"))
    brand = enrich.choose_brand(names, brands)
    subcat = cut(enrich.choose_subcat(names, votes))
    if learn:
        train = names.where("pos = 0").join(subcat, "uid").select("name", "subcat")
        test = names.where("pos = 0").join(subcat, "uid", "left_anti").select("uid", "name")
        subcat = subcat.union(topics.predict_labels(train, test).select("uid", "subcat", F.lit("ml")))
    known = cut(products.select("uid").join(brand, "uid", "left").join(subcat, "uid", "left"))
    rows = names.join(known.where("brand is not null and subcat is not null"), "uid").select("uid", "subcat", "brand", "name")
    sub = enrich.choose_sub_brand(rows, enrich.sub_brand_candidates(enrich.word_group_counts(rows)))
    return known.join(sub, "uid", "left").select("uid", "brand", "subcat", "subcat_source", "sub_brand")


def enriched_skus(skus: DataFrame, products: DataFrame) -> DataFrame:
    """SKUs (``sku_id, product_id``) with the attributes of their product, or of their own where they have none."""
    attributes = enriched_products(products)
    uid = F.coalesce("product_id", "sku_id")
    return skus.drop("brand", "subcat", "sub_brand").withColumn("uid", uid).join(attributes, "uid", "left").drop("uid")


__all__ = ["enriched_products", "enriched_skus", "root_of"]
