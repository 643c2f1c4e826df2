"""Held-out passages inside a corpus.

Method: a positional inverted index. Its terms are pairs of neighbouring words, its postings (term,
document, position). For every run of words that would count, the rarest term of the run in the
corpus gives the candidates: a posting of it fixes at which offset the passage would lie. The lists of
the other terms, adjusted by their offset, are then intersected with the candidates, and runs of
matches long enough are the exact phrases. Proximity matches take the hits of a chain of neighbouring
offsets together, so that words put in or left out don't break them.

Scale: only terms of the passages are posted, by an equality join on the passages' terms, whose number
depends on the held-out set and not on the corpus. Candidates come from the rarest terms, so their
number follows the leaks; every step is a join or a partially combined aggregation on (document,
passage, offset) and no list of postings is ever gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from offerloom.functions.text import words
from offerloom.session import cut


def _terms(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, pos, term``: pairs of neighbouring words with the place of the first, from 0."""
    w = df.where(f"{id_col} is not null and {text_col} is not null").select(F.col(id_col).alias("id"), words(text_col).alias("w")).where("size(w) > 1")
    pairs = F.transform(F.sequence(F.lit(1), F.size("w") - 1), lambda i: F.concat_ws(" ", F.element_at("w", i), F.element_at("w", i + 1)))
    return w.select("id", F.posexplode(pairs).alias("pos", "term"))


def build_index(documents: DataFrame, item_terms: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, pos, term`` of the corpus for the terms that some passage has, written once."""
    known = item_terms.select("term").distinct()
    return cut(_terms(documents, id_col, text_col).join(known, "term", "left_semi").select(F.col("id").alias("doc_id"), "pos", "term"))


def anchors(item_terms: DataFrame, index: DataFrame, run: int) -> DataFrame:
    """``item_id, ipos, term``: of each run of ``run`` neighbouring terms of a passage the one rarest in the corpus."""
    df = index.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    at = item_terms.join(df, "term", "left").select("item_id", "ipos", "term", F.coalesce("df", F.lit(0)).alias("df"))
    w = W.partitionBy("item_id").orderBy("ipos").rowsBetween(0, run - 1)
    best = at.withColumn("n", F.count(F.lit(1)).over(w)).withColumn("a", F.min(F.struct("df", "ipos", "term")).over(w)).where(F.col("n") == run)
    return best.where("a.df > 0").select("item_id", F.col("a.ipos").alias("ipos"), F.col("a.term").alias("term")).distinct()


def offsets(documents: DataFrame, eval_items: DataFrame, least: int) -> DataFrame:
    """``doc_id, item_id, off, ipos``: the matched terms of every candidate offset (document place minus passage place)."""
    item_terms = cut(_terms(eval_items, "item_id", "text").select(F.col("id").alias("item_id"), F.col("pos").alias("ipos"), "term"))
    index = build_index(documents, item_terms)
    picked = anchors(item_terms, index, least - 1)
    cand = index.join(picked, "term").select("doc_id", "item_id", (F.col("pos") - F.col("ipos")).alias("off")).distinct()
    wanted = cand.join(item_terms, "item_id").select("doc_id", "item_id", "off", "ipos", "term", (F.col("off") + F.col("ipos")).alias("pos"))
    return wanted.join(index.distinct(), ["doc_id", "pos", "term"]).select("doc_id", "item_id", "off", "ipos")


def exact_phrases(documents: DataFrame, eval_items: DataFrame, least: int = 10) -> DataFrame:
    """``doc_id, item_id, words``: documents that hold at least ``least`` consecutive words of a passage, and the most they hold.

    Words are compared without regard to case, accents, punctuation, spacing and invisible characters.
    Null ids and texts match nothing; repeated rows of a document count once; passages shorter than
    ``least`` words can't match. An empty side gives an empty result.
    """
    hits = offsets(documents, eval_items, least).distinct()
    w = W.partitionBy("doc_id", "item_id", "off").orderBy("ipos")
    runs = hits.withColumn("run", F.col("ipos") - F.row_number().over(w)).groupBy("doc_id", "item_id", "off", "run").agg((F.count(F.lit(1)) + 1).alias("words"))
    return runs.where(F.col("words") >= least).groupBy("doc_id", "item_id").agg(F.max("words").cast("long").alias("words"))


def near_phrases(documents: DataFrame, eval_items: DataFrame, least: int = 10, share: float = 0.5, slack: int = 2) -> DataFrame:
    """``doc_id, item_id, share``: passages of which at least ``share`` lies in a document with up to ``slack`` words put in or left out between the parts.

    Candidates need only half as long a run as exact phrases. Offsets of a document and passage that lie
    within ``slack`` of the next one form a chain, so many small changes may add up; the hits of a chain
    count together.
    """
    total = _terms(eval_items, "item_id", "text").groupBy(F.col("id").alias("item_id")).agg(F.count(F.lit(1)).alias("n"))
    hits = cut(offsets(documents, eval_items, max(2, least // 2)).distinct())
    by_off = W.partitionBy("doc_id", "item_id").orderBy("off")
    apart = F.coalesce(F.col("off") - F.lag("off").over(by_off) > slack, F.lit(True)).cast("int")
    chains = hits.select("doc_id", "item_id", "off").distinct().withColumn("apart", apart).select("doc_id", "item_id", "off", F.sum("apart").over(by_off).alias("chain"))
    both = hits.join(chains, ["doc_id", "item_id", "off"]).select("doc_id", "item_id", "chain", "ipos").distinct()
    held = both.groupBy("doc_id", "item_id", "chain").agg(F.count(F.lit(1)).alias("k")).groupBy("doc_id", "item_id").agg(F.max("k").alias("k"))
    return held.join(total, "item_id").select("doc_id", "item_id", F.round(F.col("k") / F.col("n"), 4).alias("share")).where(F.col("share") >= share)
