"""Brand, sub-category, sub-brand and colour of products by votes over their names.

Flat rows throughout: ``(uid, pos, value)`` for lists, so every choice is a ranked row, not a nested tree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerloom.functions.collections import top_per
from offerloom.functions import names as N
from offerloom.functions.text import contains_words, prefixes, tokens, windows


def frequencies(rows: DataFrame, value: str) -> DataFrame:
    """``value, n`` without nulls."""
    return rows.where(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("n"))


def possible_subcats(rows: DataFrame) -> DataFrame:
    """``brand, subcats``: the sub-categories seen with a brand, sorted; rows have ``brand, subcat``."""
    return rows.where("brand is not null and subcat is not null").groupBy("brand").agg(F.array_sort(F.collect_set("subcat")).alias("subcats"))


def prefix_frequencies(names: DataFrame, end: int = 3) -> DataFrame:
    """``prefix, n`` over the first words of names (the whole repeats where a name is shorter)."""
    return names.select(F.explode(prefixes(tokens("name"), end)).alias("prefix")).groupBy("prefix").agg(F.count(F.lit(1)).alias("n"))


def root_brands(brand_freq: DataFrame) -> DataFrame:
    """``brand, root``: of a brand's prefixes from short to long, the last that is more frequent than all before and the brand."""
    b = brand_freq.select("brand", "n", F.posexplode(prefixes(tokens("brand"))).alias("i", "p"))
    f = b.join(brand_freq.select(F.col("brand").alias("p"), F.col("n").alias("pn")), "p").where("pn > n")
    best = top_per(f, ["brand"], [F.col("pn").desc(), F.col("i")]).select("brand", F.col("p").alias("root"))
    return brand_freq.select("brand").join(best, "brand", "left").select("brand", F.coalesce("root", "brand").alias("root"))


def choose_brand(names: DataFrame, brands: DataFrame, head: int = 4) -> DataFrame:
    """``uid, brand``: the most frequent vendor brand within the first words of a name, else the most frequent; first seen among equals.

    ``names``: uid, pos, name; ``brands``: uid, pos, brand.
    """
    f = brands.groupBy("uid", "brand").agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("at"))
    begin = names.select("uid", F.array_join(F.slice(tokens("name"), 1, head), " ").alias("begin"))
    hit = f.join(begin, "uid").where(F.contains("begin", F.col("brand"))).select("uid", "brand").distinct().withColumn("in_name", F.lit(1))
    ranked = f.join(hit, ["uid", "brand"], "left")
    return top_per(ranked, ["uid"], [F.coalesce("in_name", F.lit(0)).desc(), F.col("n").desc(), F.col("at")]).select("uid", "brand")


def choose_color(names: DataFrame, colors: DataFrame) -> DataFrame:
    """``uid, color``: the first colour that stands in a name, names in the outer order."""
    c = colors.select("uid", F.col("pos").alias("cpos"), "color")
    hit = names.join(c, "uid").where(F.contains("name", F.col("color")))
    return top_per(hit, ["uid"], [F.col("pos"), F.col("cpos")]).select("uid", "color")


def subcat_in_names(names: DataFrame, subcats: DataFrame) -> DataFrame:
    """``uid, subcat``: the most frequent candidate that stands in a name with all its words, or as a substring if it has several."""
    f = subcats.groupBy("uid", "subcat").agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("at")).where("subcat <> ''")
    hit = f.join(names.select("uid", "name"), "uid").where(contains_words(F.col("name"), F.col("subcat")) | (F.contains("subcat", F.lit(" ")) & F.contains("name", F.col("subcat"))))
    return top_per(hit, ["uid"], [F.col("n").desc(), F.col("at")]).select("uid", "subcat")


def subcat_partial(names: DataFrame, subcats: DataFrame) -> DataFrame:
    """``uid, subcat, window``: the most frequent candidate that a name abbreviates, and the words that do."""
    f = subcats.groupBy("uid", "subcat").agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("at"))
    tried = f.join(names, "uid").where(~F.contains("name", F.col("subcat"))).withColumn("window", N.abbreviated(F.col("name"), F.col("subcat")))
    return top_per(tried.where("window is not null"), ["uid"], [F.col("n").desc(), F.col("at"), F.col("pos")]).select("uid", "subcat", "window")


def names_in_full(names: DataFrame, partial: DataFrame) -> DataFrame:
    """``names`` in which the words that abbreviate a product's sub-category (``partial``: uid, subcat, window) are replaced by it, wherever they stand."""
    full = names.join(partial.select("uid", F.col("subcat").alias("_s"), "window"), "uid", "left")
    return full.withColumn("name", F.when(F.col("window").isNotNull(), F.replace("name", F.col("window"), F.col("_s"))).otherwise(F.col("name"))).select(names.columns)


def subcat_majority(subcats: DataFrame) -> DataFrame:
    """``uid, subcat``: the one most frequent; none if another is as frequent."""
    f = subcats.groupBy("uid", "subcat").agg(F.count(F.lit(1)).alias("n"))
    m = f.groupBy("uid").agg(F.max("n").alias("n"))
    return f.join(m, ["uid", "n"]).groupBy("uid").agg(F.min("subcat").alias("subcat"), F.count(F.lit(1)).alias("k")).where("k = 1").select("uid", "subcat")


def subcat_global(names: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``uid, subcat``: the longest run of two words or more of a name that any product has as sub-category."""
    w = names.select("uid", F.explode(windows(tokens("name"), 2)).alias("subcat")).distinct().join(vocabulary.select("subcat").distinct(), "subcat", "left_semi")
    return top_per(w, ["uid"], [F.length("subcat").desc(), F.col("subcat")]).select("uid", "subcat")


def choose_subcat(names: DataFrame, subcats: DataFrame, predicted: DataFrame | None = None) -> DataFrame:
    """``uid, subcat, subcat_source`` by the cascade local_name, partial, majority, global_name, ml."""
    rules = [("local_name", subcat_in_names(names, subcats)), ("partial", subcat_partial(names, subcats).select("uid", "subcat")), ("majority", subcat_majority(subcats)), ("global_name", subcat_global(names, subcats))]
    if predicted is not None:
        rules.append(("ml", predicted.select("uid", "subcat")))
    every = None
    for i, (tag, r) in enumerate(rules):
        r = r.select("uid", "subcat", F.lit(tag).alias("subcat_source"), F.lit(i).alias("rule"))
        every = r if every is None else every.union(r)
    return top_per(every, ["uid"], [F.col("rule")]).select("uid", "subcat", "subcat_source")


def subcat_parents(names: DataFrame, parents: DataFrame) -> DataFrame:
    """``uid, subcat``: the longest parent category (``uid, parent``) that stands in a name with all its words, then the first in order."""
    hit = names.join(parents.where("parent <> ''").select("uid", F.col("parent").alias("subcat")).distinct(), "uid").where(contains_words(F.col("name"), F.col("subcat")))
    return top_per(hit, ["uid"], [F.length("subcat").desc(), F.col("subcat")]).select("uid", "subcat")


def brand_partial(names: DataFrame, brands: DataFrame) -> DataFrame:
    """``uid, brand, window``: brands of a product that its names abbreviate (and don't hold in full), and the words that do."""
    tried = brands.select("uid", "brand").distinct().join(names.select("uid", "name").distinct(), "uid").where(~F.contains("name", F.col("brand")))
    hit = tried.withColumn("window", N.abbreviated(F.col("name"), F.col("brand"))).where("window is not null")
    return hit.groupBy("uid", "brand").agg(F.min("window").alias("window"))


def subcat_tokens(rows: DataFrame, least: int = 5) -> DataFrame:
    """``subcat, token, n``: words that names of at least ``least`` brands of a sub-category have."""
    return token_brand_counts(rows).where(F.col("brands") >= least).select("subcat", "token", F.col("brands").alias("n"))


def shared_tokens(rows: DataFrame, top: int = 10, more_than: int = 3) -> DataFrame:
    """``subcat, token, freq``: of the words that several brands of a sub-category use more than ``more_than`` times the most frequent."""
    t = token_brand_counts(rows).where((F.col("brands") > 1) & (F.col("freq") > more_than))
    return top_per(t, ["subcat"], [F.col("freq").desc(), F.col("token")], top).select("subcat", "token", "freq")


def topic_input(rows: DataFrame, least_brands: int = 2, least_freq: int = 4, least_names: int = 2) -> DataFrame:
    """``subcat, name``: names cut down to the words that several brands of their sub-category use often; empty names and sub-categories with too few names stay out."""
    kept = token_brand_counts(rows).where((F.col("brands") >= least_brands) & (F.col("freq") >= least_freq)).select("subcat", "token")
    each = rows.where("name is not null").select("subcat", "uid", "name").distinct().select("subcat", "uid", "name", F.posexplode(tokens("name")).alias("i", "token")).join(kept, ["subcat", "token"])
    names = each.groupBy("subcat", "uid", "name").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "token"))), lambda x: x["token"]), " ").alias("short"))
    enough = names.groupBy("subcat").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_names).select("subcat")
    return names.join(enough, "subcat", "left_semi").select("subcat", F.col("short").alias("name"))


def known_strings(brands: DataFrame, subcats: DataFrame) -> DataFrame:
    """``known``: all brands and sub-categories."""
    return brands.select(F.col("brand").alias("known")).union(subcats.select("subcat")).where("known <> ''").distinct()


def without_known(rows: DataFrame, text: str, known: DataFrame) -> DataFrame:
    """Rows whose ``text`` lost every run of words that is a known string: the runs are joined, not put into one pattern, so the list may be long."""
    w = rows.select(text).where(F.col(text).isNotNull()).distinct().withColumn("ws", tokens(text))
    runs = w.select(text, "ws", F.explode(F.flatten(F.transform(F.sequence(F.lit(1), F.size("ws")), lambda i: F.transform(F.sequence(i, F.size("ws")), lambda j: F.struct(i.alias("i"), j.alias("j"), F.array_join(F.slice("ws", i, j - i + 1), " ").alias("known")))))).alias("r")).where("size(ws) > 0")
    gone = runs.select(text, "ws", "r.*").join(known, "known", "left_semi").groupBy(text, "ws").agg(F.array_distinct(F.flatten(F.collect_list(F.sequence("i", "j")))).alias("at"))
    short = gone.select(text, F.array_join(F.transform(F.filter(F.transform("ws", lambda t, i: F.struct(t.alias("t"), (i + 1).alias("i"))), lambda x: ~F.array_contains("at", x["i"])), lambda x: x["t"]), " ").alias("_short"))
    return rows.join(short, text, "left").withColumn(text, F.coalesce("_short", text)).drop("_short").select(rows.columns)


def merge_by_prefix(counts: DataFrame) -> DataFrame:
    """``subcat, merged``: names of over seven characters that begin another at most three longer; the most frequent of those."""
    a = counts.select("subcat", F.left("subcat", F.lit(8)).alias("b")).where(F.length("subcat") > 7)
    o = counts.select(F.col("subcat").alias("other"), "n", F.left("subcat", F.lit(8)).alias("b"))
    hit = a.join(o, "b").where(F.col("other").startswith(F.col("subcat")) & (F.length("other") - F.length("subcat")).between(1, 3))
    return top_per(hit, ["subcat"], [F.col("n").desc(), F.col("other")]).select("subcat", F.col("other").alias("merged"))


def merge_by_subset(counts: DataFrame) -> DataFrame:
    """``subcat, merged``: names of several words go to the most frequent name of several words that is a subset of them; equal word sets go to the more frequent, then smaller."""
    m = counts.withColumn("ts", F.array_distinct(tokens("subcat"))).where(F.contains("subcat", F.lit(" ")))
    big = m.select("subcat", "n", F.col("ts").alias("bt"), F.explode("ts").alias("t"))
    small = m.select(F.col("subcat").alias("o"), F.col("n").alias("on"), F.col("ts").alias("ot"), F.explode("ts").alias("t"))
    hit = big.join(small, "t").where("subcat <> o").groupBy("subcat", "n", "o", "on", F.size("ot").alias("k"), F.size("bt").alias("bk")).agg(F.count(F.lit(1)).alias("c")).where("c = k")
    hit = hit.where((F.col("k") < F.col("bk")) | (F.col("on") > F.col("n")) | ((F.col("on") == F.col("n")) & (F.col("o") < F.col("subcat"))))
    return top_per(hit, ["subcat"], [F.col("on").desc(), F.col("o")]).select("subcat", F.col("o").alias("merged"))


def merged_subcats(counts: DataFrame) -> DataFrame:
    """Both merges; a subset merge goes before a prefix merge."""
    s = merge_by_subset(counts)
    return s.union(merge_by_prefix(counts).join(s, "subcat", "left_anti"))


def filtered_names(products: DataFrame) -> DataFrame:
    """Adds ``filtered_names``: clean names without brands, sub-categories and colours."""
    return products.withColumn("filtered_names", N.filtered_names(F.col("clean_names"), F.col("brands"), F.col("subcats"), F.col("colors")))


def word_group_counts(rows: DataFrame, end: int = 4) -> DataFrame:
    """``subcat, brand, uid, wg, count``: word groups at the beginning of a product's filtered names.

    Rows: subcat, brand, uid, name (one a name). Groups of n > 1 words weigh 1.25 to the n; a group needs
    half as much as there are names.
    """
    named = rows.select("subcat", "brand", "uid", "name").withColumn("nid", F.monotonically_increasing_id())
    total = rows.groupBy("subcat", "brand", "uid").agg(F.count(F.lit(1)).alias("names"))
    wg = named.select("subcat", "brand", "uid", "nid", F.explode(prefixes(tokens("name"), end)).alias("w"))
    wg = wg.withColumn("wg", F.trim(F.replace("w", F.col("brand"), F.lit("")))).where("wg <> ''")
    c = wg.groupBy("subcat", "brand", "uid", "nid", "wg").agg(F.count(F.lit(1)).alias("c"))
    k = F.size(tokens("wg"))
    weighed = c.withColumn("c", F.when(k > 1, F.round(F.col("c") * F.pow(F.lit(1.25), k), 2)).otherwise(F.col("c").cast("double")))
    out = weighed.groupBy("subcat", "brand", "uid", "wg").agg(F.round(F.sum("c"), 2).alias("count"))
    return out.join(total, ["subcat", "brand", "uid"]).where(F.col("count") >= F.col("names") / 2).drop("names")


def sub_brand_candidates(counts: DataFrame, min_products: int = 1) -> DataFrame:
    """``subcat, brand, wg, count``: groups of three characters or more that one brand of the sub-category has, without shorter ones that a longer, more frequent one contains."""
    per = counts.groupBy("subcat", "brand", "wg").agg(F.sum("count").cast("int").alias("count"), F.count(F.lit(1)).alias("products"))
    brands = per.groupBy("subcat", "wg").agg(F.count_distinct("brand").alias("brands"))
    one = per.join(brands, ["subcat", "wg"]).where((F.col("brands") < 2) & (F.length("wg") >= 3) & (F.col("products") >= min_products)).select("subcat", "brand", "wg", "count")
    parts = one.select("subcat", "brand", F.col("wg").alias("long"), F.col("count").alias("lc"), F.explode(windows(tokens("wg"))).alias("wg"))
    worse = one.join(parts, ["subcat", "brand", "wg"]).where("count < lc and wg <> long").select("subcat", "brand", "wg").distinct()
    return one.join(worse, ["subcat", "brand", "wg"], "left_anti")


def choose_sub_brand(names: DataFrame, candidates: DataFrame) -> DataFrame:
    """``uid, sub_brand``: the most frequent candidate of its sub-category and brand that stands in a name with all words; ``names`` has uid, subcat, brand, name."""
    hit = names.join(candidates, ["subcat", "brand"]).where(contains_words(F.col("name"), F.col("wg")))
    return top_per(hit, ["uid"], [F.col("count").desc(), F.col("wg")]).select("uid", F.col("wg").alias("sub_brand"))


def token_brand_counts(rows: DataFrame) -> DataFrame:
    """``subcat, token, brands, freq``: in how many brands and names of a sub-category a word occurs."""
    t = rows.select("subcat", "brand", F.explode(F.array_distinct(tokens("name"))).alias("token"))
    return t.groupBy("subcat", "token").agg(F.count_distinct("brand").alias("brands"), F.count(F.lit(1)).alias("freq"))
