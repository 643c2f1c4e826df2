"""One SKU row from each group of docs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerloom.constants import NO_STOCK, Config
from offerloom.functions.collections import top_per
from offerloom.functions.price import convert_price
from offerloom.functions.text import strip_tracking, tokens
from offerloom.operators.prep import clean_brand


def _rank(column: str, ranks: dict[str, int]):
    if not ranks:
        return F.lit(0)
    return F.coalesce(F.create_map(*[F.lit(x) for kv in ranks.items() for x in kv])[F.col(column)], F.lit(0))


def group_prices(docs: DataFrame, cfg: Config) -> DataFrame:
    """``component, prices, best_price, markets, market_count``: in stock, the last price a market, visible markets.

    Groups without a price, or with one over ``most_spread`` times the least, are dropped.
    """
    d = docs.where(~F.coalesce(F.col("out_of_stock"), F.lit(False)) & (F.coalesce(F.col("price"), F.lit("")) != NO_STOCK))
    if cfg.visible:
        d = d.where(F.col("market").isin(*cfg.visible))
    last = d.where("market is not null").groupBy("component", "market").agg(F.max(F.struct("ord", "price"))["price"].alias("raw")).withColumn("price", convert_price(F.col("raw"))).where("price <> 0")
    g = last.groupBy("component").agg(F.min("price").alias("best_price"), F.max("price").alias("most"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("market", "price")))).alias("prices"))
    g = g.where(F.col("most") <= cfg.most_spread * F.col("best_price"))
    return g.select("component", "prices", "best_price", F.map_keys("prices").alias("markets"), F.size("prices").alias("market_count"))


def group_names(docs: DataFrame, cfg: Config) -> DataFrame:
    """``component, name, src``: by rank of the market, the first market among equals, its last doc; a null picture of the top market stays."""
    last = docs.groupBy("component", "market").agg(F.min("ord").alias("at"), F.max(F.struct("ord", "name"))["name"].alias("name"), F.max(F.struct("ord", "src"))["src"].alias("src"))
    n = last.groupBy("component").agg(
        F.min(F.struct((-_rank("market", cfg.name_rank)).alias("r"), "at", "name"))["name"].alias("name"),
        F.min(F.struct((-_rank("market", cfg.src_rank)).alias("r"), "at", "src"))["src"].alias("src"),
    )
    return n


def modal_size(docs: DataFrame) -> DataFrame:
    """``component, digits, unit, size``: the most frequent size, the first seen among equals."""
    s = docs.select("component", "ord", F.posexplode("sizes").alias("i", "s")).groupBy("component", F.col("s.digits").alias("digits"), F.col("s.unit").alias("unit")).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("ord", "i")).alias("at"))
    top = top_per(s, ["component"], [F.col("n").desc(), F.col("at")])
    shown = F.when(F.col("digits") == F.floor("digits"), F.col("digits").cast("long").cast("string")).otherwise(F.col("digits").cast("string"))
    return top.select("component", "digits", "unit", F.concat_ws(" ", shown, "unit").alias("size"))


def sku_ids(docs: DataFrame) -> DataFrame:
    """``component, sku_id``: the prior id most of its docs had, else its smallest doc id, else a digest of its members.

    An id goes to the group with the smallest doc; each round skips ids already given.
    """
    first = docs.where("not is_clone").groupBy("component").agg(F.min("doc_id").alias("least"))
    prior = docs.where("sku_id <> ''").groupBy("component", "sku_id").agg(F.count(F.lit(1)).alias("n"), F.min("ord").alias("at"))
    top = top_per(prior, ["component"], [F.col("n").desc(), F.col("at")]).join(first, "component", "left")
    won = top_per(top, ["sku_id"], [F.coalesce("least", "component")]).select("component", "sku_id")
    rest = first.join(won, "component", "left_anti")
    second = rest.join(won.select(F.col("sku_id").alias("least")), "least", "left_anti").select("component", F.col("least").alias("sku_id"))
    given = won.union(second)
    members = docs.join(given, "component", "left_anti").groupBy("component").agg(F.sha2(F.array_join(F.array_sort(F.collect_set("doc_id")), ","), 256).alias("sku_id"))
    return given.union(members)


def group_categories(docs: DataFrame) -> DataFrame:
    """``component, categories``: the last categories each market gave, by market."""
    last = docs.where("market is not null and categories is not null").groupBy("component", "market").agg(F.max(F.struct("ord", "categories"))["categories"].alias("c"))
    return last.groupBy("component").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("market", "c")))).alias("categories"))


def group_variant_name(docs: DataFrame) -> DataFrame:
    """``component, variant_name``: the first stated one, else the first name of a variant whose page is a doc of the group.

    A variant's page is a doc's link if it is equal to it or to its part before a later parameter.
    """
    stated = docs.where("variant_name <> ''").groupBy("component").agg(F.min(F.struct("ord", "variant_name"))["variant_name"].alias("v"), F.lit(0).alias("rule"))
    listed = docs.select("component", "ord", F.explode("variants").alias("page", "v")).where("v <> ''").select("component", "ord", "v", strip_tracking("page").alias("page"))
    pages = F.array_distinct(F.array(F.col("link"), F.substring_index("link", "&", 1), F.substring_index("link", "?", 1)))
    held = docs.select("component", F.explode(pages).alias("page")).distinct()
    found = listed.join(held, ["component", "page"]).groupBy("component").agg(F.min(F.struct("ord", "v"))["v"].alias("v"), F.lit(1).alias("rule"))
    return stated.union(found).groupBy("component").agg(F.min(F.struct("rule", "v"))["v"].alias("variant_name"))


def group_words(named: DataFrame, most: int = 3) -> DataFrame:
    """``component, tags, most_common_tokens`` of ``component, ord, name``: words are counted before a group's are brought together."""
    w = named.select("component", "ord", F.posexplode(tokens("name")).alias("i", "w"))
    c = w.groupBy("component", "w").agg((-F.count(F.lit(1))).alias("n"), F.min(F.struct("ord", "i")).alias("at"))
    g = c.groupBy("component").agg(F.array_sort(F.collect_list(F.struct("n", "at", "w"))).alias("ws"))
    word = lambda a: F.array_sort(F.transform(a, lambda x: x["w"]))
    return g.select("component", F.array_join(word(F.col("ws")), " ").alias("tags"), word(F.slice("ws", 1, most)).alias("most_common_tokens"))


def reduce_docs(docs: DataFrame, cfg: Config) -> DataFrame:
    """SKU rows from docs with ``component``: prices, name, picture, size, unit price, sets of values, tags, ids. Lone clones stay out.

    Lists hold different values only, and are as long as the SKU has such values.
    """
    counted = docs.groupBy("component").agg(F.count(F.lit(1)).alias("n"), F.bool_or("is_clone").alias("clone"))
    docs = docs.join(counted.where("n = 1 and clone"), "component", "left_anti")
    brand = clean_brand("brand")
    named = F.when((brand != "") & ~F.contains("clean_name", brand), F.concat_ws(" ", brand, "clean_name")).otherwise(F.col("clean_name"))
    names = docs.select("component", "ord", named.alias("name")).where("name is not null")
    first = names.groupBy("component", "name").agg(F.min("ord").alias("at")).groupBy("component").agg(F.array_sort(F.collect_list(F.struct("at", "name"))).alias("ns"))
    first = first.select("component", F.transform("ns", lambda x: x["name"]).alias("clean_names"))
    lists = docs.groupBy("component").agg(
        F.array_sort(F.collect_set("link")).alias("links"),
        F.array_sort(F.collect_set("doc_id")).alias("doc_ids"),
        F.array_sort(F.collect_set("brand")).alias("brands"),
        F.array_sort(F.array_union(F.collect_set("color"), F.collect_set("variant_name"))).alias("colors"),
    )
    codes = docs.select("component", F.explode("barcodes").alias("b")).groupBy("component").agg(F.array_sort(F.collect_set("b")).alias("barcodes"))
    out = group_prices(docs, cfg).join(group_names(docs, cfg), "component").join(lists, "component").join(sku_ids(docs), "component")
    for part in (codes, first, group_words(names), modal_size(docs), group_categories(docs), group_variant_name(docs)):
        out = out.join(part, "component", "left")
    none = F.array().cast("array<string>")
    out = out.withColumns({"barcodes": F.coalesce("barcodes", none), "clean_names": F.coalesce("clean_names", none), "tags": F.coalesce("tags", F.lit("")), "most_common_tokens": F.coalesce("most_common_tokens", none)})
    return out.withColumn("unit_price", F.round(F.col("best_price") / F.col("digits"), 2))
