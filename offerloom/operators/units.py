"""Quantities in common units, with conversions estimated between the sources that state them.

A source is a unit spelling. The list of spellings says which words are units; their factors come from
the data. Records of one entity (a doc and the SKU records that list it, or the two
statements inside a SKU record) that state their quantity in two spellings give a sample of the scale
between them. Per pair of spellings a robust scale (median of the log ratio), its support and the share
of samples near it, and an offset (median of the residuals) are estimated; a concentrated scale without
an offset is snapped to the nearest known conversion, and factors are propagated from the common units
through the graph of snapped pairs, strongest support first. A factor so found holds even against the
declared one; only spellings that no pair reaches keep their declared conversion. Words that no list
declares become units only through the graph.

Scale: pairs come from the listing edges (linear in them, no pairs within a group); the graph is
aggregated by spelling pair before anything leaves the executors, so the driver sees at most
``MOST_PAIRS`` rows, whatever the data, and fails loudly beyond.
"""

from __future__ import annotations

import math
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerloom.functions.size import UNITS, UNLISTED, measured, number, strip_no_quantity
from offerloom.functions.text import plain
from offerloom.session import cut

BASES = ("gr", "ml", "adet", "tablet", "yikama")
#: Samples a pair needs, the share of them near its scale, and how near is near (in log).
LEAST_SUPPORT, LEAST_SHARE, NEAR = 5, 0.6, 0.05
#: The same for words no list declares as units.
NEW_SUPPORT, NEW_SHARE = 30, 0.9
MOST_PAIRS = 20_000
OUNCE, POUND, FLUID_OUNCE = Decimal("28.349523125"), Decimal("453.59237"), Decimal("29.5735295625")
KNOWN = sorted({Decimal(1), *(Decimal(10) ** k for k in range(-3, 4)), OUNCE, POUND, FLUID_OUNCE, Decimal(12)})


def _unit_text(c: Column) -> Column:
    u = F.rtrim(F.regexp_replace(plain(c), r"^fl ?\.? ?oz\.?$", "fl oz"))
    return F.regexp_replace(u, r"\.$", "")


def _good(m: Column) -> Column:
    return F.when(m["num"].isNotNull() & m["pack"].isNotNull(), m)


def doc_measures(raw_docs: DataFrame) -> DataFrame:
    """``ord, doc_id, m, num, word``: the stated quantity, or else a number and the word after it."""
    t = raw_docs.where("name is not null").select("ord", "doc_id", strip_no_quantity(plain("name")).alias("t"))
    # written before it is used: filters on m would each repeat all its regular expressions
    m = cut(t.select("ord", "doc_id", "t", measured(F.col("t"), True).alias("m")))
    m = m.withColumn("m", _good(F.col("m")))
    other = F.col("m").isNull() & F.col("t").rlike(UNLISTED)
    return m.select("ord", "doc_id", "m", F.when(other, number(F.regexp_extract("t", UNLISTED, 1))).alias("num"), F.when(other, F.regexp_extract("t", UNLISTED, 2)).alias("word"))


def sku_measures(skus: DataFrame) -> DataFrame:
    """``ord, doc_ids, m1, m2``: what ``size`` states, and ``digits`` with ``unit`` where both are given."""
    t = skus.select("ord", "doc_ids", strip_no_quantity(plain("size")).alias("t"), "digits", _unit_text(F.col("unit")).alias("u"))
    given = F.col("digits").isNotNull() & ~F.isnan("digits") & (F.col("u") != "")
    two = F.when(given, F.struct(F.col("digits").cast("decimal(20,6)").alias("num"), F.lit(1).alias("pack"), F.col("u").alias("spelling")))
    m = cut(t.select("ord", "doc_ids", measured(F.col("t"), True).alias("m1"), two.alias("m2")))
    return m.withColumn("m1", _good(F.col("m1")))


def samples(docs: DataFrame, skus: DataFrame) -> DataFrame:
    """``u, x, v, y``: quantities x in spelling u and y in spelling v of one entity, u before v."""
    amount = lambda m: (m["num"] * m["pack"]).cast("double")
    own = skus.where("m1 is not null and m2 is not null").select(F.col("m1.spelling").alias("a"), amount(F.col("m1")).alias("p"), F.col("m2.spelling").alias("b"), amount(F.col("m2")).alias("q"))
    listed = skus.select(F.explode(F.array_distinct("doc_ids")).alias("d"), F.coalesce("m1", "m2").alias("m")).where("m is not null")
    listed = listed.select(F.regexp_replace("d", r"\+clone[0-9]*$", "").alias("doc_id"), "m")
    stated = docs.select("doc_id", F.coalesce(F.col("m.spelling"), F.concat(F.lit("?"), "word")).alias("a"), F.coalesce(amount(F.col("m")), F.col("num").cast("double")).alias("p")).where("a is not null")
    across = stated.join(listed, "doc_id").select("a", "p", F.col("m.spelling").alias("b"), amount(F.col("m")).alias("q"))
    s = own.union(across).where("p > 0 and q > 0 and a <> b")
    swap = F.col("a") > F.col("b")
    return s.select(F.least("a", "b").alias("u"), F.when(swap, F.col("q")).otherwise(F.col("p")).alias("x"), F.greatest("a", "b").alias("v"), F.when(swap, F.col("p")).otherwise(F.col("q")).alias("y"))


def pair_scales(s: DataFrame) -> DataFrame:
    """``u, v, support, scale, share, offset, typical``: y is about scale · x + offset, and its median is typical."""
    lr = F.log(F.col("y") / F.col("x"))
    med = s.groupBy("u", "v").agg(F.count(F.lit(1)).alias("support"), F.percentile_approx(lr, 0.5, 2000).alias("ls")).where(F.col("support") >= LEAST_SUPPORT)
    near = s.join(med, ["u", "v"]).withColumn("r", lr - F.col("ls"))
    return near.groupBy("u", "v", "support", "ls").agg(
        F.avg((F.abs("r") <= NEAR).cast("double")).alias("share"),
        F.percentile_approx(F.when(F.abs("r") <= NEAR, F.col("y") - F.exp("ls") * F.col("x")), 0.5, 2000).alias("offset"),
        F.percentile_approx("y", 0.5, 2000).alias("typical"),
    ).select("u", "v", "support", F.exp("ls").alias("scale"), "share", "offset", "typical")


def snap(scale: float, near: float = NEAR) -> Decimal | None:
    """The known conversion, or the quotient of two, within ``near`` of an estimated scale."""
    best = None
    for a in KNOWN:
        for b in KNOWN:
            gap = abs(math.log(scale) - math.log(a / b))
            if gap <= near and (best is None or (round(gap, 3), a != 1 and b != 1) < best[0]):
                best = ((round(gap, 3), a != 1 and b != 1), a / b)
    return best[1] if best else None


def unit_graph(docs: DataFrame, skus: DataFrame) -> list[dict]:
    """The factor of every unit spelling: ``spelling, base, factor, support, origin``.

    ``origin`` is anchor, estimated (reached through the graph), corrected (reached with another factor
    or common unit than the declared one, which then doesn't count) or declared (not reached). A pair
    with an offset is no pure scale and stays out of the graph.
    """
    rows = pair_scales(samples(docs, skus)).limit(MOST_PAIRS + 1).collect()
    if len(rows) > MOST_PAIRS:
        raise ValueError(f"more than {MOST_PAIRS} pairs of unit spellings")
    near: dict[str, list] = {}
    for r in rows:
        new = r.u[0] == "?" or r.v[0] == "?"
        firm = r.share >= (NEW_SHARE if new else LEAST_SHARE) and r.support >= (NEW_SUPPORT if new else LEAST_SUPPORT)
        k = snap(r.scale) if firm and abs(r.offset or 0.0) <= NEAR * r.typical else None
        if k:  # one u is k v
            near.setdefault(r.v, []).append((r.u, k, r.support))
            near.setdefault(r.u, []).append((r.v, 1 / k, r.support))
    found = {b: (b, Decimal(1), None) for b in BASES}
    while True:
        grown = max(((n, w2, w, k) for w in found for w2, k, n in near.get(w, []) if w2 not in found), key=lambda e: (e[0], e[1]), default=None)
        if grown is None:
            break
        n, w2, w, k = grown
        base, f, _ = found[w]
        # one w2 is k w
        found[w2] = (base, snap(float(f * k), 1e-6) or f * k, n)
    out = []
    for u, (base, f) in UNITS.items():
        b, g, n = found.get(u, (None, None, None))
        if b is None:
            out.append({"spelling": u, "base": base, "factor": Decimal(f), "support": None, "origin": "declared"})
        else:
            agrees = b == base and abs(float(g) / float(f) - 1) < 1e-3
            out.append({"spelling": u, "base": b, "factor": g, "support": n, "origin": "anchor" if u in BASES else "estimated" if agrees else "corrected"})
    for u, (b, g, n) in found.items():
        if u[0] == "?" and u[1:] not in UNITS:
            out.append({"spelling": u[1:], "base": b, "factor": g, "support": n, "origin": "estimated"})
    return out


def _graph_df(like: DataFrame, graph: list[dict]) -> DataFrame:
    rows = [(g["spelling"], g["base"], g["factor"].quantize(Decimal("1e-10")), g["support"], g["origin"]) for g in graph]
    return like.sparkSession.createDataFrame(rows, "spelling string, base_unit string, factor decimal(14,10), support long, origin string")


def conversions(raw_docs: DataFrame, skus: DataFrame) -> DataFrame:
    """The unit graph as a table."""
    return _graph_df(raw_docs, unit_graph(doc_measures(raw_docs), sku_measures(skus)))


def common_quantities(raw_docs: DataFrame, skus: DataFrame) -> DataFrame:
    """``rec_table, ord, base_unit, milli``: every stated quantity in thousandths of its common unit.

    A doc states it in its name; a SKU record in ``size`` or, failing that, in ``digits`` and ``unit``
    together. Products are multiplied out and rounded half up. Null and empty texts, and numbers
    without a unit, state none; repeated rows each keep theirs; empty tables give none.
    """
    d, k = doc_measures(raw_docs), sku_measures(skus)
    graph = _graph_df(raw_docs, unit_graph(d, k))
    word = F.when(F.col("word").isNotNull(), F.struct(F.col("num").alias("num"), F.lit(1).alias("pack"), F.col("word").alias("spelling")))
    rows = d.select(F.lit("raw_docs").alias("rec_table"), "ord", F.coalesce("m", word).alias("m")).union(k.select(F.lit("skus"), "ord", F.coalesce("m1", "m2")))
    rows = rows.where("m is not null").select("rec_table", "ord", F.col("m.num").try_cast("decimal(14,4)").alias("num"), F.col("m.pack").cast("decimal(10,0)").try_cast("decimal(6,0)").alias("pack"), F.col("m.spelling").alias("spelling"))
    milli = (F.round(F.col("num") * F.col("pack") * F.col("factor"), 3) * 1000).cast("long")
    return rows.join(F.broadcast(graph), "spelling").select("rec_table", "ord", "base_unit", milli.alias("milli")).where("milli is not null")
