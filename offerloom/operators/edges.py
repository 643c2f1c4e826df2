"""Links between docs in stages: shared barcode, equal name, token containment, promoted link.

Each stage sees which docs the stages before it connected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerloom.functions.collections import top_per
from offerloom.functions.text import sorted_words, strip_tracking, tokens
from offerloom.operators.graph import components, star_edges
from offerloom.session import cut


def _sized(a: Column, b: Column) -> Column:
    """Sizes agree: one side has none, or they share one."""
    return (F.size(a) == 0) | (F.size(b) == 0) | F.coalesce(F.arrays_overlap(a, b), F.lit(False))


def barcode_edges(docs: DataFrame) -> DataFrame:
    """Docs of one barcode, as stars."""
    return star_edges(docs.select("doc_id", F.explode("barcodes").alias("code")), "code", "doc_id")


def barcode_connected(docs: DataFrame) -> DataFrame:
    """Every doc with a barcode counts as connected, even alone."""
    return docs.where(F.size("barcodes") > 0).select("doc_id").distinct()


def exact_name_edges(docs: DataFrame, connected: DataFrame) -> DataFrame:
    """Docs with the same words whose sizes agree; words that occur with several barcodes are skipped.

    Docs of one size form a star; a doc without a size links to the first of every size (it bridges
    them), so all pairs that agree are linked with an edge a doc and size.
    """
    named = docs.where("clean_name <> ''").select("doc_id", sorted_words("clean_name").alias("key"), "sizes", "barcodes")
    several = named.select("key", F.explode("barcodes").alias("b")).groupBy("key").agg(F.count_distinct("b").alias("n")).where("n > 1")
    free = named.join(several, "key", "left_anti").join(connected, "doc_id", "left_anti")
    by_size = free.select("key", "doc_id", F.explode_outer("sizes").alias("size"))
    stars = star_edges(by_size.where("size is not null").withColumn("k", F.concat_ws("|", "key", F.col("size.digits").cast("string"), F.col("size.unit"))), "k", "doc_id")
    hubs = by_size.groupBy("key", "size").agg(F.min("doc_id").alias("src"))
    bare = by_size.where("size is null").select("key", F.col("doc_id").alias("dst"))
    bridges = bare.join(hubs, "key").where("src <> dst").select("src", "dst")
    return stars.union(bridges).distinct()


def group_tokens(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """``component, all_tokens, common_tokens, sizes, first``: union and intersection of the words of a group's names."""
    m = docs.where("not is_clone and clean_name <> ''").join(groups.withColumnRenamed("node", "doc_id"), "doc_id")
    n = m.groupBy("component").agg(F.count_distinct("doc_id").alias("n"), F.min("doc_id").alias("first"), F.array_distinct(F.flatten(F.collect_list("sizes"))).alias("sizes"))
    t = m.select("component", "doc_id", F.explode(F.array_distinct(tokens("clean_name"))).alias("t")).groupBy("component", "t").agg(F.count_distinct("doc_id").alias("k"))
    t = t.join(n.select("component", "n"), "component").groupBy("component").agg(F.collect_set("t").alias("all_tokens"), F.collect_set(F.when(F.col("k") == F.col("n"), F.col("t"))).alias("common_tokens"))
    return n.drop("n").join(t, "component")


def containment_matches(singles: DataFrame, groups: DataFrame) -> DataFrame:
    """``doc_id, component, first``: the group with all words of a doc whose common words the doc has, sizes agreeing.

    A doc meets groups by its rarest word only; of several groups the one with most common words wins,
    then the smallest.
    """
    words = groups.select("component", F.explode("all_tokens").alias("t"))
    df = words.groupBy("t").agg(F.count(F.lit(1)).alias("df"))
    s = singles.where("clean_name <> ''").select("doc_id", F.array_distinct(tokens("clean_name")).alias("ts"), F.col("sizes").alias("ds"))
    rare = s.select("doc_id", F.explode("ts").alias("t")).join(df, "t", "left").groupBy("doc_id").agg(F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "t")).alias("r")).where("r.df > 0").select("doc_id", F.col("r.t").alias("t"))
    cand = rare.join(words, "t").select("doc_id", "component").join(s, "doc_id").join(groups, "component")
    ok = (F.size(F.array_except("ts", "all_tokens")) == 0) & (F.size(F.array_except("common_tokens", "ts")) == 0) & ((F.size("ds") == 0) | F.coalesce(F.arrays_overlap("ds", "sizes"), F.lit(False)))
    return top_per(cand.where(ok), ["doc_id"], [F.size("common_tokens").desc(), F.col("component")]).select("doc_id", "component", "first")


def promoted_edges(docs: DataFrame, connected: DataFrame, link_key: tuple[str, str] | None = None) -> DataFrame:
    """Referrer and target of promoted links: the target has no barcode, one referrer, and isn't connected yet.

    ``link_key``, a pattern and what to put for it, reduces the links of shops that know a page by a part of its address.
    """
    page = lambda c: F.regexp_replace(c, *link_key) if link_key else c
    docs = docs.withColumn("link", page(F.col("link")))
    by_link = docs.groupBy("link").agg(F.max(F.struct("ord", "doc_id", "barcodes"))["doc_id"].alias("dst"), F.max_by("barcodes", "ord").alias("tb"))
    refs = docs.where(F.size("promoted") > 0).select(F.col("doc_id").alias("src"), F.explode("promoted").alias("seller", "link")).withColumn("link", page(strip_tracking("link"))).select("src", "link").distinct()
    hit = refs.join(by_link, "link").where((F.coalesce(F.size("tb"), F.lit(0)) < 1) & (F.col("src") != F.col("dst"))).select("src", "dst").distinct()
    once = hit.groupBy("dst").agg(F.count(F.lit(1)).alias("n"), F.min("src").alias("src")).where("n = 1")
    return once.join(connected.withColumnRenamed("doc_id", "dst"), "dst", "left_anti").select("src", "dst")


def staged_edges(docs: DataFrame, link_key: tuple[str, str] | None = None) -> DataFrame:
    """``src, dst, stage`` of all stages in order, each seeing the docs connected before it."""
    docs = cut(docs.select("doc_id", "link", "ord", "clean_name", "sizes", "barcodes", "promoted", "is_clone"))
    one = cut(barcode_edges(docs))
    known = barcode_connected(docs)
    two = cut(exact_name_edges(docs, known))
    ends = lambda e: e.select(F.col("src").alias("doc_id")).union(e.select(F.col("dst").alias("doc_id")))
    known = cut(known.union(ends(two)).distinct())
    groups = components(one.union(two))
    info = cut(group_tokens(docs, groups))
    singles = docs.where("not is_clone").join(known, "doc_id", "left_anti")
    three = cut(containment_matches(singles, info).select(F.col("first").alias("src"), F.col("doc_id").alias("dst")))
    known = known.union(ends(three)).distinct()
    four = promoted_edges(docs, known, link_key)
    tag = lambda e, s: e.select("src", "dst", F.lit(s).alias("stage"))
    return tag(one, "barcode").union(tag(two, "exact_name")).union(tag(three, "set_match")).union(tag(four, "promoted"))
