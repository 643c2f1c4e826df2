"""Connected components by random contraction, and groups of offers linked by shared keys.

Method: every vertex hooks to the vertex of its closed neighbourhood that comes first in a fresh hash
order, edges are relabelled, deduplicated and loops dropped, until no edge is left; each round's
mapping is kept and the mappings are then expanded from the last to the first. A round leaves at most
a constant fraction of the vertices in expectation, so the rounds grow with the logarithm of the
vertices and the tables of all rounds together stay proportional to the first.

Scale: no group is ever gathered; a hub with a third of all edges is a single key of a partially
aggregated ``min`` and of joins that adaptive execution splits. State between rounds lies in the
shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerloom.functions.barcode import gtin
from offerloom.session import cut, release

MAX_ROUNDS = 60


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", out: str = "group_id") -> DataFrame:
    """``node, <out>`` for every node of an edge; ``out`` is the smallest node of its component.

    Repeated edges, loops and either direction are the same; edges with a null end are ignored (a
    loop alone makes a component of one). An empty table gives an empty table. Extra columns are
    left out. Node ids are compared as strings.
    """
    a, b = F.col(src).cast("string"), F.col(dst).cast("string")
    pairs = edges.where(F.col(src).isNotNull() & F.col(dst).isNotNull()).select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).distinct()
    pairs = cut(pairs)
    nodes = pairs.select(F.col("u").alias("node")).union(pairs.select(F.col("v").alias("node"))).distinct()
    live = pairs.where("u <> v")  # the first round reads the pairs, later ones their own tables
    maps: list[DataFrame] = []
    for r in range(MAX_ROUNDS):
        if live.isEmpty():
            break
        h = lambda c, r=r: F.xxhash64(F.lit(r), F.col(c), F.lit("order"))
        both = live.select("u", "v").union(live.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = both.groupBy("u").agg(F.min(F.struct(h("v").alias("h"), F.col("v").alias("n"))).alias("m"))
        own = F.struct(h("u").alias("h"), F.col("u").alias("n"))
        step = cut(near.select("u", F.least(F.col("m"), own)["n"].alias("to")))
        maps.append(step)
        left = live.join(step, "u").select(F.col("to").alias("x"), F.col("v").alias("u"))
        both_ends = left.join(step, "u").select("x", F.col("to").alias("y"))
        before, live = live, cut(both_ends.where("x <> y").select(F.least("x", "y").alias("u"), F.greatest("x", "y").alias("v")).distinct())
        if r:
            release(before)
    else:
        raise RuntimeError(f"edges are left after {MAX_ROUNDS} rounds")
    if not maps:
        return nodes.select("node", F.col("node").alias(out))
    label = maps[-1].select(F.col("u").alias("node"), F.col("to").alias("root"))
    for step in reversed(maps[:-1]):
        later = label.select(F.col("node").alias("to"), F.col("root"))
        label = step.join(later, "to", "left").select(F.col("u").alias("node"), F.coalesce("root", "to").alias("root"))
    label = cut(label)
    for step in maps:
        release(step)
    least = label.groupBy("root").agg(F.min("node").alias("least"))
    named = label.join(least, "root").select("node", "least")
    return nodes.join(named, "node", "left").select("node", F.coalesce("least", "node").alias(out))


def doc_key_links(raw_docs: DataFrame, skus: DataFrame) -> DataFrame:
    """``doc_id, key``: the valid barcodes of a doc and the SKUs it belongs to, each as a tagged key.

    A barcode counts by its digits without leading zeros, with 8 to 14 left and the right check
    digit. ``<id>+clone<n>`` means its doc. Blank ids, and ids without a row in raw_docs, are ignored.
    """
    docs = raw_docs.select(F.trim("doc_id").alias("doc_id"), "sku_id", "barcodes").where("doc_id <> ''")
    codes = docs.select("doc_id", F.explode("barcodes").alias("b")).select("doc_id", gtin(F.col("b")).alias("g")).where("g is not null")
    own = docs.where("trim(sku_id) <> ''").select("doc_id", F.concat(F.lit("s:"), F.trim("sku_id")).alias("key"))
    listed = skus.where("trim(sku_id) <> ''").select(F.explode("doc_ids").alias("d"), F.concat(F.lit("s:"), F.trim("sku_id")).alias("key"))
    listed = listed.select(F.trim(F.regexp_replace("d", r"\+clone[0-9]*$", "")).alias("doc_id"), "key").distinct()
    listed = listed.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    return codes.select("doc_id", F.concat(F.lit("b:"), "g").alias("key")).union(own).union(listed.select("doc_id", "key")).distinct()


def offer_groups(raw_docs: DataFrame, skus: DataFrame) -> DataFrame:
    """``doc_id, group_id`` for each doc in a group of two or more; ``group_id`` is its smallest doc_id.

    Each key becomes a star around its smallest doc, so a key with n docs gives n - 1 edges. Null or
    empty arrays, null ids, repeated rows and empty tables just give no link.
    """
    links = doc_key_links(raw_docs, skus)
    hubs = links.groupBy("key").agg(F.min("doc_id").alias("hub"))
    edges = links.join(hubs, "key").where("doc_id <> hub").select(F.col("hub").alias("src"), F.col("doc_id").alias("dst"))
    return connected_components(edges).select(F.col("node").alias("doc_id"), "group_id")
