"""How well names alone bring docs back to their group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerloom.functions.collections import top_per
from offerloom.operators.edges import containment_matches, exact_name_edges, group_tokens
from offerloom.operators.graph import components
from offerloom.session import cut


def held_out(docs: DataFrame, groups: DataFrame, least: int = 3, large: int = 5) -> DataFrame:
    """``component, doc_id``: one doc of each group of ``least`` docs or more (clones don't count), two of groups of ``large`` or more, in hash order."""
    m = groups.select("component", F.col("node").alias("doc_id")).join(docs.where("not is_clone").select("doc_id"), "doc_id", "left_semi")
    n = m.groupBy("component").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    two = top_per(m.join(n, "component"), ["component"], [F.xxhash64("doc_id"), F.col("doc_id")], 2)
    first = two.groupBy("component").agg(F.min(F.struct(F.xxhash64("doc_id"), "doc_id"))["doc_id"].alias("_first"))
    return two.join(first, "component").where((F.col("n") >= large) | (F.col("doc_id") == F.col("_first"))).select("component", "doc_id")


def evaluate_matching(docs: DataFrame, edges: DataFrame) -> DataFrame:
    """``doc_id, outcome``: held-out docs are cut off from their group and matched again by name.

    Outcome: ok (back with all of the rest of its group), wrong (matched, but not with all of them) or
    failed (not matched). ``docs`` as for the matching stages; ``edges``: src, dst.
    """
    groups = cut(components(edges))
    test = cut(held_out(docs, groups))
    gone = test.select("doc_id")
    left = edges.join(gone.select(F.col("doc_id").alias("src")), "src", "left_anti").join(gone.select(F.col("doc_id").alias("dst")), "dst", "left_anti").select("src", "dst")
    # what is left of a group stays one although its edges may have led over a held-out doc
    rest = groups.join(gone.withColumnRenamed("doc_id", "node"), "node", "left_anti")
    hub = rest.groupBy("component").agg(F.min("node").alias("src"))
    left = left.union(rest.join(hub, "component").where("node <> src").select("src", F.col("node").alias("dst")))
    known = rest.select(F.col("node").alias("doc_id"))
    named = cut(exact_name_edges(docs.join(gone, "doc_id", "left_semi").withColumn("barcodes", F.array().cast("array<string>")).unionByName(docs.join(gone, "doc_id", "left_anti")), known))
    now = components(left.union(named))
    singles = docs.where("not is_clone").join(gone, "doc_id", "left_semi").join(named.select(F.col("src").alias("doc_id")).union(named.select("dst")), "doc_id", "left_anti")
    sets = containment_matches(singles, cut(group_tokens(docs, now))).select(F.col("first").alias("src"), F.col("doc_id").alias("dst"))
    after = cut(components(left.union(named).union(sets)))
    expected = test.join(rest.select("component", "node"), "component")
    at = after.select(F.col("node").alias("doc_id"), F.col("component").alias("mine"))
    theirs = after.select("node", F.col("component").alias("theirs"))
    seen = expected.join(at, "doc_id", "left").join(theirs, "node", "left").groupBy("doc_id").agg(F.bool_and(F.coalesce(F.col("mine") == F.col("theirs"), F.lit(False))).alias("all"), F.max("mine").alias("mine"))
    return seen.select("doc_id", F.when(F.col("all"), "ok").when(F.col("mine").isNotNull(), "wrong").otherwise("failed").alias("outcome"))
