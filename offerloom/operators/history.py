"""Versions of entities whose attributes change, from sightings, by Merkle comparison.

Each calendar day closes a snapshot of all links. A snapshot is a tree over hash buckets of links: a
leaf is the digest of a link's state, a node the exclusive-or of the digests below it. A link's digest
depends on its state alone, so a link that wasn't seen, or was seen unchanged, has the same digest in
both of two neighbouring snapshots; a day on which it passed through other states has a digest of
these. Links not seen on a day add the same to both trees and are left out of both.

Neighbouring snapshots are compared from the root down: one digest pair a day; under the days that
differ one pair for each branch; under the branches that differ one pair for each leaf bucket of some
``LINKS_A_BUCKET`` links. Only sightings under differing leaf buckets are read and diffed row by row,
which finds and appends the new versions; the digests decide nothing else.

Scale: sightings are grouped by (link, day), so a link with a third of all rows spreads over its days;
only the one row a link has a day meets by link. Every level's digests are partially aggregated.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from offerloom.functions.text import strip_trailing_slash
from offerloom.session import cut

#: Links that a leaf bucket holds on average.
LINKS_A_BUCKET = 16
OUT_OF_STOCK = -1
DAY = 86_400_000_000
# Fixed value: the text that stands for a price when an offer is out of stock.
NO_STOCK_TEXT = r"(?i)stokta\s+yok"


def price_units(c: Column | str) -> Column:
    """A price text in ten-thousandths, null if it isn't a number.

    Currency marks and spaces go. Of several dots and commas the last is decimal; one alone is decimal
    too, but for a dot before exactly three digits.
    """
    s = F.regexp_replace(F.lower(F.col(c) if isinstance(c, str) else c), r"tl|try|[₺\s\p{Z}]", "")
    s = F.regexp_replace(s, r"[.,](?=[0-9]*[.,])", "")  # only the last mark stays
    s = F.translate(F.regexp_replace(s, r"^([0-9]{1,3})\.([0-9]{3})$", "$1$2"), ",", ".")
    return (F.regexp_extract(s, r"^[0-9]+(\.[0-9]+)?$", 0).try_cast("decimal(20,4)") * 10000).cast("long")


def mixed_time(c: Column) -> Column:
    """A time in one of the notations in use, UTC; day before month where dots separate them."""
    s = F.regexp_replace(F.regexp_replace(F.trim(c), "T", " "), "Z$", "")
    dotted = F.regexp_replace(s, r"^([0-9]{1,2})\.([0-9]{1,2})\.([0-9]{4})", "$3-$2-$1")
    slashed = F.regexp_replace(dotted, r"^([0-9]{4})/([0-9]{1,2})/([0-9]{1,2})", "$1-$2-$3")
    return slashed.try_cast("timestamp_ntz")


def micros(df: DataFrame, name: str) -> Column:
    """Microseconds since 1970 of a timestamp; one without a zone is UTC, whatever the session's zone."""
    if dict(df.dtypes)[name] == "timestamp_ntz":
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(name))
    return F.unix_micros(name)


def state(price: Column, out_of_stock: Column) -> Column:
    """Out of stock whatever the price, else the price above zero in ten-thousandths, else null."""
    out = F.coalesce(out_of_stock, F.lit(False)) | F.coalesce(price.rlike(NO_STOCK_TEXT), F.lit(False))
    return F.when(out, F.lit(OUT_OF_STOCK).cast("long")).otherwise(F.nullif(price_units(price), F.lit(0).cast("long")))


def sightings(items: DataFrame, raw_docs: DataFrame) -> DataFrame:
    """``link, at, ord, state`` (``at`` in microseconds) of all usable sightings; null links, times and states stay out."""
    seen = items.select(strip_trailing_slash("link").alias("link"), micros(items, "ts").alias("at"), "ord", state(F.col("price"), F.col("out_of_stock")).alias("state"))
    past = raw_docs.select(strip_trailing_slash("link").alias("link"), "ord", F.explode("historical_prices").alias("price", "time"))
    past = past.withColumn("time", mixed_time(F.col("time")))
    past = past.select("link", micros(past, "time").alias("at"), "ord", state(F.col("price"), F.lit(False)).alias("state"))
    return seen.unionByName(past).where("link is not null and at is not null and state is not null")


def one_per_time(rows: DataFrame) -> DataFrame:
    """At one link and time the greatest ``ord`` counts, then the greatest state."""
    best = rows.groupBy("link", "at").agg(F.max(F.struct("ord", "state")).alias("m"))
    return best.select("link", "at", F.floor(F.col("at") / DAY).cast("int").alias("day"), F.col("m.state").alias("state"))


def leaf_bits(rows: DataFrame) -> int:
    """Bits of a leaf bucket's number, even so that a branch has half of them: buckets grow in number with the links, not in size."""
    links = rows.agg(F.approx_count_distinct("link")).first()[0]
    return 2 * max(1, math.ceil(math.log2(max(links, 1) / LINKS_A_BUCKET + 1) / 2))


def snapshot_leaves(rows: DataFrame, bits: int) -> DataFrame:
    """``link, day, bucket, carried, old, new``: the digests of a seen link in the snapshots before and after the day, and the state it came with (null: none)."""
    day = rows.groupBy("link", "day").agg(F.min("state").alias("lo"), F.max("state").alias("hi"), F.max(F.struct("at", "state"))["state"].alias("last"))
    still = F.xxhash64("link", "last")
    new = F.when(F.col("lo") == F.col("hi"), still).otherwise(F.xxhash64("link", "lo", "hi", "last"))
    by_link = W.partitionBy("link").orderBy("day")
    old = F.coalesce(F.lag("still").over(by_link), F.lit(0).cast("long"))
    bucket = F.pmod(F.xxhash64("link", F.lit("bucket")), F.lit(1 << bits)).cast("int")
    day = day.select("link", "day", "last", still.alias("still"), new.alias("new"))
    return day.select("link", "day", bucket.alias("bucket"), F.lag("last").over(by_link).alias("carried"), old.alias("old"), "new")


def differing_buckets(leaves: DataFrame, bits: int) -> DataFrame:
    """``day, bucket`` of the leaf buckets whose digests differ from the day before, found from the root down."""
    branch = F.shiftright("bucket", bits // 2).alias("branch")
    differs = F.bit_xor("old") != F.bit_xor("new")
    days = leaves.groupBy("day").agg(differs.alias("d")).where("d").select("day")
    under = leaves.join(days, "day", "left_semi")
    branches = under.groupBy("day", branch).agg(differs.alias("d")).where("d").select("day", "branch")
    under = leaves.withColumn("branch", branch).join(branches, ["day", "branch"], "left_semi")
    return under.groupBy("day", "bucket").agg(differs.alias("d")).where("d").select("day", "bucket")


def rows_to_diff(rows: DataFrame) -> DataFrame:
    """``link, day, at, state, carried``: the sightings under differing leaf buckets, with the state their link came with."""
    bits = leaf_bits(rows)
    leaves = cut(snapshot_leaves(rows, bits))
    changed = leaves.join(differing_buckets(leaves, bits), ["day", "bucket"], "left_semi").select("link", "day", "carried")
    return rows.join(changed, ["link", "day"])


def versions(items: DataFrame, raw_docs: DataFrame) -> DataFrame:
    """``link, at, state, day``: each version of each link with the microsecond it began.

    A version begins with the first sighting and with each whose state differs from the one before.
    Links lose one trailing slash; sightings without stock sign and positive price are ignored; a null
    flag is in stock; repeated rows count once; empty tables give an empty history.
    """
    near = rows_to_diff(cut(one_per_time(sightings(items, raw_docs))))
    before = F.coalesce(F.lag("state").over(W.partitionBy("link", "day").orderBy("at")), F.col("carried"))
    return near.withColumn("before", before).where("before is null or before <> state").select("link", "at", "state", "day")


def history(items: DataFrame, raw_docs: DataFrame) -> DataFrame:
    """``link, valid_from, valid_to, in_stock, price``: the full history; ``valid_to`` (null: still valid) is when the next version begins."""
    v = cut(versions(items, raw_docs))
    first = v.groupBy("link", "day").agg(F.min("at").alias("first_at"))
    nxt = first.select("link", "day", F.lead("first_at").over(W.partitionBy("link").orderBy("day")).alias("next_day_at"))
    end = F.coalesce(F.lead("at").over(W.partitionBy("link", "day").orderBy("at")), F.col("next_day_at"))
    out = v.join(nxt, ["link", "day"]).withColumn("end", end)
    return out.select(
        "link", F.floor(F.col("at") / 1_000_000).alias("valid_from"), F.floor(F.col("end") / 1_000_000).alias("valid_to"),
        (F.col("state") != OUT_OF_STOCK).alias("in_stock"), F.when(F.col("state") != OUT_OF_STOCK, F.col("state") / 10000.0).alias("price"),
    )
