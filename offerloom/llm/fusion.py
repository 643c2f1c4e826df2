"""The best record of each duplicate group: usable values, declared trust, and Bayesian fusion.

Method: every usable value is a claim of its source (the market). Source accuracies are estimated by
voting, and a pair of sources is judged dependent from the values they share, false ones weighing
most; the vote of a copier counts less where it claims what its original claims; accuracies and votes
are estimated anew for a fixed number of rounds, and the value with the greatest posterior wins.

Where sources have a declared trust, the trust is a prior that outweighs any number of votes
(``surviving_records``; the README says what that leaves to the votes).

Scale: claims are first reduced to one per (entity, field, source), so the claims about one field are
at most as many as the sources, however many rows an entity has; ``MOST_SOURCES`` is checked. They are
grouped once; every round is then one pass without a join, whose sums by source pair are partially
aggregated.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerloom.functions.collections import let
from offerloom.functions.text import plain
from offerloom.session import cut

FIELDS = ("name", "src", "brand", "category")

# --- fixed values, as ``plain`` leaves them: texts that stand in for a missing value ---------------
STAND_INS = {
    "name": ("isimsiz urun", "urun adi", "urun adi yok", "test", "xxx"),
    "src": ("about:blank",),
    "brand": ("?", "#yok", ".", "belirtilmemis", "bilinmiyor", "markasiz", "markasiz urun", "no brand"),
    "category": ("kategori yok", "tanimsiz", "diger", "genel", "other"),
}
ANY_STAND_IN = ("-", "--", "null", "none", "n/a", "na", "yok", "nan", "bos", "unknown")
PICTURE_STAND_IN = r"(?i)(resim-?yok|no-?image|placeholder|default)[^/]*$"
# ---------------------------------------------------------------------------------------------------
#: Sources, at most (the driver holds a few numbers for each pair), the least dependence that counts, the rank of unknown sources.
MOST_SOURCES, LEAST_DEPENDENCE, UNKNOWN = 500, 0.01, -(2**31)
CUT_OFF = r"(…|\.\.)[\s\p{Z}]*$"


def usable(field: str, c: Column | str) -> Column:
    """Whether a value says something: false for null, blank, a stand-in, and names cut off at the end."""
    c = F.col(c) if isinstance(c, str) else c
    p = plain(c)
    ok = (p != "") & ~p.isin(*ANY_STAND_IN, *STAND_INS.get(field, ()))
    if field == "src":
        ok = ok & c.rlike(r"(?i)^\s*https?://") & ~c.rlike(PICTURE_STAND_IN)
    if field == "name":
        ok = ok & ~c.rlike(CUT_OFF)
    return F.coalesce(ok, F.lit(False))


def claims(records: DataFrame, entity: str = "sku_id", source: str = "market", fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """``entity, source, ts, ord, field, value``: the usable values, one row each; null entities stay out."""
    each = F.inline(F.array(*[F.struct(F.lit(f).alias("field"), F.when(usable(f, f), F.col(f)).alias("value")) for f in fields]))
    rows = records.where(F.col(entity).isNotNull()).select(F.col(entity).alias("entity"), F.col(source).alias("source"), "ts", "ord", each)
    return rows.where("value is not null")


def latest_claims(records: DataFrame, entity: str, source: str, fields: tuple[str, ...], trust: DataFrame | None = None) -> DataFrame:
    """``entity, field, cs``: the claims about one field of one entity, one a source (its latest), in order of source.

    A claim is ``source, v, value, ts, ord, trust``; ``v`` is the plain form, in which values are
    compared, ``ts`` in microseconds. The array is as long as there are sources at most. With
    ``trust`` (``source, field, trust``) unknown sources and null ones rank below all; without it
    null sources claim nothing.
    """
    c = claims(records, entity, source, fields).withColumn("v", plain("value")).withColumn("ts", F.coalesce(F.unix_micros(F.col("ts").cast("timestamp")), F.lit(-(2**63)).cast("long")))
    c = c.where("source is not null") if trust is None else c.withColumn("source", F.coalesce("source", F.lit("")))
    c = c.groupBy("entity", "field", "source").agg(F.max(F.struct("ts", "ord", "v", "value")).alias("m"))
    if trust is None:
        c = c.withColumn("trust", F.lit(0))
    else:
        c = c.join(trust, ["source", "field"], "left").withColumn("trust", F.coalesce("trust", F.lit(UNKNOWN)))
    claim = F.struct("source", "m.v", "m.value", "m.ts", "m.ord", "trust")
    return c.groupBy("entity", "field").agg(F.array_sort(F.collect_list(claim)).alias("cs"))


class Sources:
    """What is known of the sources: accuracies, and dependences of pairs (the copier first)."""

    def __init__(self, start: float, n_false: int, copy_rate: float, prior: float):
        self.start, self.n_false, self.copy_rate, self.prior = start, n_false, copy_rate, prior
        self.accuracy: dict[str, float] = {}
        self.copies: dict[tuple[str, str], float] = {}

    def learn(self, rows: list) -> None:
        """From ``s1, s2, n, p, kt, kf, kd``: sums over the values of a source (s2 null) or of a pair of sources."""
        self.accuracy = {r.s1: min(max(r.p / r.n, 0.05), 0.95) for r in rows if r.s2 is None}
        self.copies = {}
        c = self.copy_rate
        for r in rows:
            if r.s2 is None or not c:
                continue
            a, b = self.accuracy[r.s1], self.accuracy[r.s2]
            true, false = a * b, (1 - a) * (1 - b) / self.n_false
            copied = min(a, b)  # what the copied source has right
            gain = r.kt * math.log((c * copied + (1 - c) * true) / true) + r.kf * math.log((c * (1 - copied) + (1 - c) * false) / false) + r.kd * math.log(1 - c)
            odds = math.log(self.prior / (1 - self.prior)) + gain
            d = 1 / (1 + math.exp(-min(max(odds, -50.0), 50.0)))
            if d >= LEAST_DEPENDENCE:
                # the less accurate of a dependent pair is taken for the copier
                self.copies[(r.s1, r.s2) if (a, r.s2) < (b, r.s1) else (r.s2, r.s1)] = d

    def vote(self, source: Column) -> Column:
        log = {s: math.log(self.n_false * a / (1 - a)) for s, a in self.accuracy.items()}
        first = math.log(self.n_false * self.start / (1 - self.start))
        return F.coalesce(_lookup(log, source), F.lit(first))

    def kept(self, source: Column, others: Column) -> Column:
        """The share of a vote that isn't copied from one of the others, who claim the same."""
        gone = {f"{a}\t{b}": 1 - self.copy_rate * d for (a, b), d in self.copies.items()}
        if not gone:
            return F.lit(1.0)
        return F.aggregate(others, F.lit(1.0), lambda acc, y: acc * F.coalesce(_lookup(gone, F.concat_ws("\t", source, y)), F.lit(1.0)))


def _lookup(values: dict[str, float], key: Column) -> Column:
    if not values:
        return F.lit(None).cast("double")
    return F.create_map(*[F.lit(x) for kv in sorted(values.items()) for x in kv])[key]


def posteriors(cs: Column, known: Sources, prior: Callable[[Column], Column] | None = None) -> Column:
    """``v, votes, vote, p, best``: each value claimed in ``cs``, its vote and posterior, and its claim of greatest prior, later, last arrived.

    The vote is the sum of the log odds of its sources, copied ones discounted, plus the prior of its
    best claim. Posteriors are taken relative to the greatest vote, so no number of votes overflows;
    the values nobody claims share what is left of ``n_false + 1``.
    """

    def one(v: Column) -> Column:
        mine = F.filter(cs, lambda c: c["v"] == v)
        names = F.transform(mine, lambda c: c["source"])
        vote = F.aggregate(names, F.lit(0.0), lambda acc, s: acc + known.vote(s) * known.kept(s, names))
        best = F.array_max(F.transform(mine, lambda c: F.struct((prior(c) if prior else F.lit(0.0)).alias("prior"), c["ts"].alias("ts"), c["ord"].alias("ord"), c["value"].alias("value"))))
        return F.struct(v.alias("v"), F.size(mine).alias("votes"), (vote + best["prior"]).alias("vote"), best.alias("best"))

    def normal(vs: Column) -> Column:
        top = F.greatest(F.array_max(F.transform(vs, lambda x: x["vote"])), F.lit(0.0))
        rest = F.greatest(F.lit(0.0), F.lit(float(known.n_false + 1)) - F.size(vs)) * F.exp(-top)
        return let(F.struct(top.alias("top"), rest.alias("rest")), lambda t: let(
            F.aggregate(vs, t["rest"], lambda acc, x: acc + F.exp(x["vote"] - t["top"])),
            lambda z: F.transform(vs, lambda x: F.struct(x["v"].alias("v"), x["votes"].alias("votes"), x["vote"].alias("vote"), (F.exp(x["vote"] - t["top"]) / z).alias("p"), x["best"].alias("best")))))

    return let(F.transform(F.array_distinct(F.transform(cs, lambda c: c["v"])), one), normal)


def _evidence(groups: DataFrame, known: Sources) -> list:
    """Per source and per pair of sources with a common entity and field, the sums that ``Sources.learn`` needs."""
    said = F.transform("cs", lambda c: F.struct(c["source"].alias("source"), c["v"].alias("v"), F.get(F.filter("post", lambda x: x["v"] == c["v"]), F.lit(0))["p"].alias("p")))
    zero = F.lit(0.0)
    each = lambda c: F.struct(c["source"].alias("s1"), F.lit(None).cast("string").alias("s2"), F.lit(1.0).alias("n"), c["p"].alias("p"), zero.alias("kt"), zero.alias("kf"), zero.alias("kd"))

    def pair(c: Column, d: Column) -> Column:
        same = c["v"] == d["v"]
        parts = (F.when(same, c["p"]).otherwise(0.0).alias("kt"), F.when(same, 1 - c["p"]).otherwise(0.0).alias("kf"), F.when(same, 0.0).otherwise(1.0).alias("kd"))
        return F.struct(c["source"].alias("s1"), d["source"].alias("s2"), zero.alias("n"), zero.alias("p"), *parts)

    pairs = F.flatten(F.transform("said", lambda c: F.transform(F.filter("said", lambda d: d["source"] > c["source"]), lambda d: pair(c, d))))
    rows = groups.select("cs", posteriors(F.col("cs"), known).alias("post")).select(said.alias("said")).select(F.inline(F.concat(F.transform("said", each), pairs)))
    sums = rows.groupBy("s1", "s2").agg(*[F.sum(c).alias(c) for c in ("n", "p", "kt", "kf", "kd")])
    most = MOST_SOURCES * (MOST_SOURCES + 1) // 2
    got = sums.limit(most + 1).collect()
    if len(got) > most:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    return got


def estimate(groups: DataFrame, rounds: int, n_false: int, start_accuracy: float, copy_rate: float, prior_dependence: float) -> Sources:
    """Accuracies and dependences after some rounds of voting and judging; a round is one pass and one aggregate by source pair."""
    known = Sources(start_accuracy, n_false, copy_rate, prior_dependence)
    for _ in range(rounds):
        known.learn(_evidence(groups, known))
    return known


def surviving_records(skus: DataFrame, market_trust: DataFrame, rounds: int = 2, n_false: int = 20, start_accuracy: float = 0.8, copy_rate: float = 0.8, prior_dependence: float = 0.1) -> DataFrame:
    """``sku_id, field, ord``: for each sku_id of two or more rows, the row each usable field comes from.

    It is the row behind the value of greatest posterior. The declared rank of the market is the prior
    (``src_rank`` for src, else ``name_rank``; an unknown market ranks below all), recency (``ts``, null
    is earliest, then ``ord``) a second, lesser one; a step of either outweighs the votes of all
    sources, so estimated accuracies only shift posteriors between claims of one rank and time. A field
    without a usable value gives no row; an empty table gives none.
    """
    many = skus.where("sku_id is not null").groupBy("sku_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("sku_id")
    rank = market_trust.where("market is not null").groupBy(F.col("market").alias("source")).agg(F.max("name_rank").alias("name_rank"), F.max("src_rank").alias("src_rank"))
    trust = rank.select("source", F.inline(F.array(*[F.struct(F.lit(f).alias("field"), F.col("src_rank" if f == "src" else "name_rank").alias("trust")) for f in FIELDS])))
    groups = cut(latest_claims(skus.select("sku_id", "market", "ts", "ord", *FIELDS), "sku_id", "market", FIELDS, trust).join(many.withColumnRenamed("sku_id", "entity"), "entity", "left_semi"))
    known = estimate(groups, rounds, n_false, start_accuracy, copy_rate, prior_dependence)
    step = (F.size("cs") + 1) * math.log(n_false * 19)  # no vote exceeds it: accuracies are held under 0.95

    def prior(c: Column) -> Column:
        below = F.size(F.filter("cs", lambda d: d["trust"] < c["trust"]))
        before = F.size(F.filter("cs", lambda d: F.struct(d["ts"], d["ord"]) < F.struct(c["ts"], c["ord"])))
        return step * (below * (F.size("cs") + 1) + before)

    best = groups.select("entity", "field", F.array_max(F.transform(posteriors(F.col("cs"), known, prior), lambda x: F.struct(x["vote"].alias("vote"), x["best"]["ord"].alias("ord"))))["ord"].alias("ord"))
    return best.select(F.col("entity").alias("sku_id"), "field", "ord")


def fuse(
    records: DataFrame, entity: str = "sku_id", source: str = "market", fields: tuple[str, ...] = FIELDS,
    rounds: int = 3, n_false: int = 20, start_accuracy: float = 0.8, copy_rate: float = 0.8, prior_dependence: float = 0.1,
) -> DataFrame:
    """``entity, field, value, posterior, votes``: the value of greatest posterior by copy-aware fusion.

    Values are compared in their ``plain`` form; ``value`` is the latest spelling of the winner. A
    source claims one value an entity and field, its latest. Of equal votes the value that comes first
    in order wins. Null sources, entities and values make no claim.
    """
    groups = cut(latest_claims(records, entity, source, fields))
    known = estimate(groups, rounds, n_false, start_accuracy, copy_rate, prior_dependence)
    ranked = F.transform(posteriors(F.col("cs"), known), lambda x: F.struct((-F.round(x["vote"], 9)).alias("nv"), x["v"].alias("v"), x["p"].alias("p"), x["votes"].alias("votes"), x["best"]["value"].alias("value")))
    best = groups.select("entity", "field", F.array_min(ranked).alias("b"))
    return best.select(F.col("entity").alias(entity), "field", F.col("b.value").alias("value"), F.round("b.p", 6).alias("posterior"), F.col("b.votes").alias("votes"))
