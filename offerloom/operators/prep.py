"""Preparation of raw offers: keys, links, clones, filters and cleaned names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerloom import constants as K
from offerloom.functions.barcode import clean_barcodes
from offerloom.functions.collections import drop_empty
from offerloom.functions.names import clean_name_udf
from offerloom.functions.text import category_parts, clean_string, contains_words, singular, strip_tracking, strip_trailing_slash


def keyed_docs(raw: DataFrame) -> DataFrame:
    """Docs with an id and a link; the link loses one trailing slash."""
    return raw.where("doc_id is not null and link is not null").withColumn("link", strip_trailing_slash("link"))


def with_clones(docs: DataFrame) -> DataFrame:
    """A doc of several barcodes becomes one clone a barcode (``<id>+clone<i>``); the others stay. Adds ``is_clone``."""
    many = F.size(F.coalesce("barcodes", F.array().cast("array<string>"))) > 1
    stay = docs.where(~many).withColumn("is_clone", F.lit(False))
    each = docs.where(many).select("*", F.posexplode("barcodes").alias("_i", "_b"))
    clones = each.withColumn("doc_id", F.concat("doc_id", F.lit("+clone"), F.col("_i").cast("string"))).withColumn("barcodes", F.array("_b")).drop("_i", "_b")
    return stay.unionByName(clones.withColumn("is_clone", F.lit(True)))


def clean_docs(raw: DataFrame) -> DataFrame:
    """Keyed docs with cleaned barcodes, cloned."""
    return keyed_docs(raw).withColumn("barcodes", clean_barcodes(F.col("barcodes"))).transform(with_clones)


def product_links(docs: DataFrame, market: str, marker: str = "?sku") -> DataFrame:
    """``link`` of product pages of a market whose links name a variant by ``marker``: the part before ``?`` ends in more than digits."""
    at = docs.where((F.col("market") == market) & F.contains("link", F.lit(marker))).select(F.substring_index(strip_trailing_slash("link"), "?", 1).alias("link"))
    return at.where(~F.element_at(F.split("link", "/"), -1).rlike("^[0-9]*$")).distinct()


def without_product_links(docs: DataFrame, links: DataFrame) -> DataFrame:
    return docs.join(links, "link", "left_anti")


def with_clean_names(docs: DataFrame) -> DataFrame:
    """Adds ``clean_name`` and ``sizes``; codes found in the name join the barcodes."""
    d = docs.withColumn("_c", clean_name_udf(clean_string("name")))
    codes = F.array_union(F.coalesce("barcodes", F.array().cast("array<string>")), F.coalesce("_c.codes", F.array().cast("array<string>")))
    return d.withColumn("barcodes", codes).withColumn("clean_name", F.col("_c.clean_name")).withColumn("sizes", F.coalesce("_c.sizes", F.array().cast("array<struct<digits:double,unit:string>>"))).drop("_c")


def is_bad_brand(c: Column) -> Column:
    bad = (c == "") | c.isin(*K.BAD_BRANDS)
    for p in K.BAD_BRAND_PARTS:
        bad = bad | F.contains(c, F.lit(p))
    return F.coalesce(bad, F.lit(True))


def is_bad_color(c: Column) -> Column:
    bad = (c == "") | c.rlike("^[0-9]+$")
    for p in K.BAD_COLOR_PARTS:
        bad = bad | F.contains(c, F.lit(p))
    return F.coalesce(bad, F.lit(True))


def is_bad_subcat(c: Column) -> Column:
    """Empty, digits, over 40 characters, an offer, or too broad a word; brands go by an anti-join."""
    bad = (c == "") | c.rlike("^[0-9]+$") | (F.length(c) > 40) | c.isin(*K.TOO_BROAD)
    for p in K.BAD_SUBCAT_PARTS:
        bad = bad | F.contains(c, F.lit(p))
    return F.coalesce(bad, F.lit(True))


def promoted_links(docs: DataFrame, markets: tuple[str, ...]) -> DataFrame:
    """``promoted`` cut down to sellers whose name holds an allowed market, their links without tracking; null where none is left."""
    kept = F.map_filter("promoted", lambda k, _: F.exists(F.array(*map(F.lit, markets)), lambda m: F.contains(F.lower(k), m)))
    kept = F.transform_values(kept, lambda _, v: strip_tracking(v))
    return docs.withColumn("promoted", F.when(F.size(kept) > 0, kept))


def variant_pages(docs: DataFrame) -> DataFrame:
    """Docs and, as docs of their own, the pages their variant maps list and no doc has; such a page takes its market and brand from the doc and its colour from the map."""
    pages = docs.where("doc_id is not null").select("*", F.explode("variants").alias("_page", "_color")).withColumn("link", strip_trailing_slash("_page"))
    pages = pages.join(docs.select(strip_trailing_slash("link").alias("link")).distinct(), "link", "left_anti")
    pages = pages.withColumns({"doc_id": F.sha2("link", 256), "color": F.col("_color"), "variants": F.lit(None).cast(docs.schema["variants"].dataType), "sku_id": F.lit(None).cast("string"), "barcodes": F.lit(None).cast("array<string>")})
    return docs.unionByName(pages.select(docs.columns))


def usable_brands(brands: DataFrame) -> DataFrame:
    """``brand``: different brands of three characters or more without a bad part, white space squeezed."""
    return brands.select(F.trim(F.regexp_replace("brand", r"\s+", " ")).alias("brand")).where((F.length("brand") > 2) & ~is_bad_brand(F.col("brand"))).distinct()


def clean_subcats(rows: DataFrame, brands: DataFrame, merged: DataFrame | None = None) -> DataFrame:
    """``original, clean, gender`` of each different ``subcat``: cleaned, singular, merged names replaced, the gender word taken out.

    Bad sub-categories and those that are a brand (``brands``: brand, cleaned) stay out. ``merged`` has ``subcat, merged``.
    """
    c = rows.where("subcat is not null").select(F.col("subcat").alias("original")).distinct().withColumn("clean", singular(clean_string("original")))
    c = c.where(~is_bad_subcat(F.col("clean"))).join(brands.select(F.col("brand").alias("clean")).distinct(), "clean", "left_anti")
    if merged is not None:
        c = c.join(merged.select(F.col("subcat").alias("clean"), "merged"), "clean", "left").withColumn("clean", F.coalesce("merged", "clean"))
    c = c.withColumn("gender", gender_word(F.col("clean")))
    left = F.array_join(F.filter(F.split("clean", " "), lambda t: (t != F.coalesce("gender", F.lit(""))) & (t != "")), " ")
    return c.select("original", F.when(left == "", F.col("clean")).otherwise(left).alias("clean"), "gender")


def with_clean(rows: DataFrame, col: str, mapping: DataFrame) -> DataFrame:
    """``col`` replaced by its ``clean`` form in ``mapping`` (``original, clean``); rows whose value has none lose the value, not the row."""
    return rows.join(mapping.select(F.col("original").alias(col), F.col("clean").alias("_clean")), col, "left").withColumn(col, F.col("_clean")).drop("_clean").select(rows.columns)


def market_subcats(docs: DataFrame, skus: DataFrame) -> DataFrame:
    """``sku_id, market, subcats``: what each market says of the SKUs that have a product; the votes of a market once."""
    v = subcat_votes(docs).select("doc_id", "market", F.explode("votes").alias("v"))
    each = skus.where("product_id is not null").select("sku_id", F.explode("doc_ids").alias("doc_id"))
    return each.join(v, "doc_id").groupBy("sku_id", "market").agg(F.array_sort(F.collect_set("v")).alias("subcats"))


def clean_brand(c: Column | str) -> Column:
    b = clean_string(c)
    return F.when(F.contains(b, F.lit("loreal")) & ~F.contains(b, F.lit("loreal paris")), F.replace(b, F.lit("loreal"), F.lit("loreal paris"))).otherwise(b)


def clean_categories(cats: Column) -> Column:
    """Every part of every category, cleaned and singular; empty ones out."""
    parts = F.flatten(F.transform(cats, lambda c: category_parts(c)))
    return drop_empty(F.transform(parts, lambda p: singular(clean_string(p))))


def subcat_votes(docs: DataFrame, last_of: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, market, votes``: the last category in markets that list from broad to narrow, else the first part of one with a slash, else all."""
    cats = F.filter("categories", lambda c: c.isNotNull() & (c != ""))
    one = F.when(F.col("market").isin(*last_of) if last_of else F.lit(False), F.slice(cats, -1, 1)).otherwise(F.transform(cats, lambda c: F.trim(F.substring_index(c, "/", 1))))
    return docs.where(F.size("categories") > 0).select("doc_id", "market", F.array_distinct(F.flatten(F.transform(one, lambda c: category_parts(c)))).alias("votes"))


def gender_word(c: Column) -> Column:
    """The first gender word of a sub-category, in fixed order."""
    return F.coalesce(*[F.when(contains_words(c, F.lit(g)), F.lit(g)) for g in K.GENDERS])


def check_items(items: DataFrame, most_bad: int) -> int:
    """The number of items that lack a required field; more than ``most_bad`` fail the job."""
    lacking = F.lit(False)
    for c in K.REQUIRED:
        lacking = lacking | F.col(c).isNull() | (F.col(c).cast("string") == "")
    bad = items.agg(F.count_if(lacking)).first()[0]
    if bad > most_bad:
        raise ValueError(f"{bad} items lack a required field; at most {most_bad} may")
    return bad


def check_count(seen: int, in_stock: int, least_share: float = 0.25) -> None:
    """Fewer than a share of the known offers seen means a broken crawl."""
    if seen < in_stock * least_share:
        raise ValueError(f"{seen} items seen of {in_stock} in stock")


def coverage(df: DataFrame, cols: list[str]) -> DataFrame:
    """``field, n_set, n_rows``: how many rows have each field."""
    agg = df.agg(F.count(F.lit(1)).alias("n"), *[F.count(c).alias(c) for c in cols])
    return agg.select(F.inline(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("n_set"), F.col("n").alias("n_rows")) for c in cols])))
