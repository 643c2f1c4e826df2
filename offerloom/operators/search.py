"""Serving queries over the SKU table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerloom.functions.text import clean_string, tokens


def keyword_search(skus: DataFrame, query: str, markets: list[str] | None = None, limit: int = 24, offset: int = 0) -> DataFrame:
    """``sku_id, name, score``: SKUs that have every word of the query in name or ``tags`` (where there is such a column), up to 0, 1 or 2 edits by its length.

    A word that fits counts double in the name and once in the tags.
    """
    q = skus.sparkSession.range(1).select(F.explode(F.array_distinct(tokens(clean_string(F.lit(query))))).alias("q"))
    k = F.when(F.length("q") < 3, 0).when(F.length("q") <= 5, 1).otherwise(2)
    s = skus if markets is None else skus.where(F.arrays_overlap("markets", F.array(*map(F.lit, markets))))
    field = lambda c, weight: s.select("sku_id", "name", F.explode(F.array_distinct(tokens(clean_string(c)))).alias("w"), F.lit(weight).alias("weight"))
    words = field("name", 2).union(field("tags", 1)) if "tags" in s.columns else field("name", 2)
    vocabulary = words.select("w").distinct().join(F.broadcast(q)).where(F.levenshtein("w", "q") <= k)
    hit = words.join(vocabulary, "w").groupBy("sku_id", "name", "q").agg(F.sum("weight").alias("c"))
    n = q.agg(F.count(F.lit(1)).alias("n"))
    full = hit.groupBy("sku_id", "name").agg(F.count(F.lit(1)).alias("k"), F.sum("c").alias("score")).join(F.broadcast(n)).where("k = n")
    return full.orderBy(F.desc("score"), "sku_id").offset(offset).limit(limit).select("sku_id", "name", "score")


def names_by_links(docs: DataFrame, links: DataFrame) -> DataFrame:
    """``link, name`` of the docs that have one of the links."""
    return docs.select("link", "name").join(links.select("link").distinct(), "link", "left_semi")


def link_queue(docs: DataFrame) -> DataFrame:
    """``link``: pages to fetch, the known ones and those that variant maps list."""
    return docs.select("link").union(docs.select(F.explode(F.map_keys("variants")))).where("link <> ''").distinct()


def by_ids(skus: DataFrame, ids: DataFrame, cols: list[str]) -> DataFrame:
    return skus.join(ids.select("sku_id").distinct(), "sku_id", "left_semi").select("sku_id", *cols)


def by_barcodes(skus: DataFrame, codes: list[str]) -> DataFrame:
    return skus.where(F.arrays_overlap("barcodes", F.array(*map(F.lit, codes))))


def inverted_index(rows: DataFrame, key: str, text: str, skip: tuple[str, ...] = ()) -> DataFrame:
    """``token, key``: words of two characters or more that aren't skipped, one row each."""
    t = rows.select(F.col(key), F.explode(F.array_distinct(tokens(text))).alias("token")).where(F.length("token") > 1)
    return t.where(~F.col("token").isin(*skip)) if skip else t


def _pieces(df: DataFrame, at: str, length: str, edits: str, number: str) -> DataFrame:
    """``number``, ``o``, ``m``: place and length of each of ``edits`` + 1 pieces of the ``length`` characters from ``at``."""
    cut_at = lambda i: f"(({i}) * {length}) div ({edits} + 1)"
    t = df.withColumn(number, F.explode(F.expr(f"sequence(0, {edits})")))
    return t.withColumn("o", F.expr(f"cast({at} + {cut_at(number)} as int)")).withColumn("m", F.expr(f"cast({cut_at(number + ' + 1')} - {cut_at(number)} as int)"))


def _places(df: DataFrame, begin: str, length: str, at: str, over: str, edits: str, number: str, place: str) -> DataFrame:
    """``place``: where piece ``number`` (``m`` long, at ``o`` of a part that begins at ``at`` and is ``over`` characters long) may lie in the ``length`` characters from ``begin``.

    Of ``edits`` + 1 pieces one is unchanged with at most as many edits before it as pieces, and no
    more behind it than are left: it is shifted by at most that from either end.
    """
    o, shift = f"(o - ({at}))", f"({length} - ({over}))"
    low = f"greatest(0, {o} - {number}, {o} + {shift} - ({edits} - {number}))"
    high = f"least({length} - m, {o} + {number}, {o} + {shift} + ({edits} - {number}))"
    t = df.withColumn("_low", F.expr(low)).withColumn("_high", F.expr(high)).where("_low <= _high")
    return t.withColumn(place, F.explode(F.expr(f"sequence({begin} + _low, {begin} + _high)"))).drop("_low", "_high")


def similar_pairs(names: DataFrame, least: float = 0.8, hot: int = 100) -> DataFrame:
    """``a, b, ratio`` (a before b): all pairs of different names whose edit similarity, one less the edits over the longer length, is high enough.

    Pigeonhole join: with k edits allowed the longer name is cut into k + 1 segments, of which the
    shorter one must hold one unchanged near its place, so names need no word in common. No segment
    is dropped. Those that more than ``hot`` names of a length have in the same place must also share
    one of the pieces of the rest (the part beside the segment with the longer pieces), which can be
    cut the same way because the edits left for it are known.
    """
    if not 0 < least <= 1:
        raise ValueError("least must be above 0 and at most 1")
    n = names.select("name").distinct().where("name <> ''").withColumn("n", F.length("name"))
    share = 1 - least + 0.0001  # more than the rounding of the ratio lets through
    lengths = n.select(F.col("n").alias("len")).distinct().withColumn("k", F.floor(F.col("len") * share).cast("int")).where("k > 0")
    key = ["len", "i", "seg"]
    c = _pieces(n.withColumnRenamed("name", "c").withColumnRenamed("n", "len").join(F.broadcast(lengths), "len"), "0", "len", "k", "i")
    c = c.withColumn("seg", F.expr("substring(c, o + 1, m)"))
    p = _pieces(n.withColumnRenamed("name", "p").join(F.broadcast(lengths), F.expr("len >= n and len - n <= k")), "0", "len", "k", "i")
    p = _places(p, "0", "n", "0", "len", "k", "i", "at").withColumn("seg", F.expr("substring(p, at + 1, m)"))
    often = c.groupBy(key).agg(F.count(F.lit(1)).alias("f")).where(F.col("f") > hot).select(key)
    cold = p.join(often, key, "left_anti").select("p", "n", *key).join(c.select("c", "k", *key), key)

    right = "(len - o - m) * (i + 1) >= o * (k - i + 1)"
    part = {"begin": f"if({right}, o + m, 0)", "over": f"if({right}, len - o - m, o)", "e": f"if({right}, k - i, i)"}
    c2 = _pieces(c.join(often, key, "left_semi").withColumns({x: F.expr(y) for x, y in part.items()}), "begin", "over", "e", "j").withColumn("seg2", F.expr("substring(c, o + 1, m)"))
    own = {"start": f"if({right}, at + m, 0)", "size": f"if({right}, n - at - m, at)"}
    p2 = p.join(often, key, "left_semi").withColumns({x: F.expr(y) for x, y in (part | own).items()})
    p2 = _places(_pieces(p2, "begin", "over", "e", "j"), "start", "size", "begin", "over", "e", "j", "at2").withColumn("seg2", F.expr("substring(p, at2 + 1, m)"))
    key2 = [*key, "j", "seg2"]
    split = p2.select("p", "n", *key2).join(c2.select("c", "k", *key2), key2)

    pair = cold.select("c", "p", "n", "len", "k").unionByName(split.select("c", "p", "n", "len", "k")).where("n < len or c < p")
    pair = pair.withColumn("e", F.expr("levenshtein(c, p, k)")).where("e >= 0").select(F.least("c", "p").alias("a"), F.greatest("c", "p").alias("b"), "e", "len").distinct()
    return pair.select("a", "b", F.round(1 - F.col("e") / F.col("len"), 4).alias("ratio")).where(F.col("ratio") >= least)
