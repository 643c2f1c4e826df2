"""Keeping tables current: upserts, diffs, replacement, deletion, out-of-stock marks and price updates.

Each takes and gives tables; ``publish`` writes one and swaps it in.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import islice

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from offerloom.functions.collections import overlay


def upsert(existing: DataFrame, updates: DataFrame, key: str, add_to_set: tuple[str, ...] = (), overlay_maps: tuple[str, ...] = ()) -> DataFrame:
    """New values over old where they aren't null; arrays in ``add_to_set`` grow, maps in ``overlay_maps`` merge; new keys are added. Rows of updates without a key are left out."""
    n = updates.where(F.col(key).isNotNull()).select(F.col(key), *[F.col(c).alias(f"_n_{c}") for c in updates.columns if c != key])
    j = existing.join(n, key, "full_outer")
    out = [F.col(key)]
    for c in existing.columns:
        if c == key:
            continue
        if f"_n_{c}" not in n.columns:
            out.append(F.col(c))
        elif c in add_to_set:
            out.append(F.coalesce(F.array_union(c, f"_n_{c}"), c, f"_n_{c}").alias(c))
        elif c in overlay_maps:
            out.append(F.when(F.col(c).isNotNull() | F.col(f"_n_{c}").isNotNull(), overlay(F.col(c), F.col(f"_n_{c}"))).alias(c))
        else:
            out.append(F.coalesce(f"_n_{c}", c).alias(c))
    return j.select(*out)


def replace_by_key(existing: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    return existing.join(rows.select(key), key, "left_anti").unionByName(rows)


def delete_by_key(existing: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return existing.join(keys.select(key), key, "left_anti")


def diff(old: DataFrame, new: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """``key, op``: insert, update or delete, by a digest of the compared columns; equal rows give none."""
    digest = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in cols])
    a, b = old.select(key, digest.alias("_a")), new.select(key, digest.alias("_b"))
    op = F.when(F.col("_a").isNull(), "insert").when(F.col("_b").isNull(), "delete").when(F.col("_a") != F.col("_b"), "update")
    return a.join(b, key, "full_outer").select(key, op.alias("op")).where("op is not null")


def apply_diff(old: DataFrame, new: DataFrame, key: str, ops: DataFrame) -> DataFrame:
    """The three kinds of change at once."""
    kept = old.join(ops, key, "left_anti")
    return kept.unionByName(new.join(ops.where("op <> 'delete'").select(key), key, "left_semi"))


def sku_ids_to_docs(docs: DataFrame, skus: DataFrame) -> DataFrame:
    """Each doc gets the id of the SKU that lists it (the smallest, if several)."""
    at = skus.select("sku_id", F.explode("doc_ids").alias("doc_id")).groupBy("doc_id").agg(F.min("sku_id").alias("_s"))
    return docs.join(at, "doc_id", "left").withColumn("sku_id", F.coalesce("_s", "sku_id")).drop("_s")


def mark_out_of_stock(docs: DataFrame, seen: DataFrame, market: str, least_share: float = 0.25) -> DataFrame:
    """Links of a market that a complete crawl didn't see go out of stock; a crawl that saw under a share of them fails."""
    known = docs.where(F.col("market") == market).select("link").distinct()
    n, k = known.count(), known.join(seen.select("link").distinct(), "link", "left_semi").count()
    if k < n * least_share:
        raise ValueError(f"{k} of {n} known links were seen")
    hit = seen.select("link").distinct().withColumn("_seen", F.lit(True))
    gone = (F.col("market") == market) & F.col("_seen").isNull()
    return docs.join(hit, "link", "left").withColumn("out_of_stock", F.when(gone, F.lit(True)).otherwise(F.col("out_of_stock"))).drop("_seen")


def price_updates(skus: DataFrame, prices: DataFrame) -> DataFrame:
    """``sku_id, prices``: current prices with new ones (``sku_id, market, price``, the last by ``ord``) over them."""
    last = prices.groupBy("sku_id", "market").agg(F.max(F.struct("ord", "price"))["price"].alias("price"))
    new = last.groupBy("sku_id").agg(F.map_from_entries(F.collect_list(F.struct("market", "price"))).alias("_n"))
    merged = F.map_concat(F.map_filter("prices", lambda k, _: ~F.array_contains(F.map_keys("_n"), k)), F.col("_n"))
    return skus.join(new, "sku_id").select("sku_id", F.coalesce(merged, "_n").alias("prices"))


def price_log(items: DataFrame) -> DataFrame:
    """``link, price, last_seen``: when each price of a link was last seen."""
    return items.where("price is not null and link is not null").groupBy("link", "price").agg(F.date_format(F.max("ts"), "MM/dd/yyyy, HH:mm:ss").alias("last_seen"))


def publish(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Write a whole table; the commit is all or nothing."""
    w = df.write.mode("overwrite")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)


def append(df: DataFrame, path: str) -> None:
    """New rows beside those that are there."""
    df.write.mode("append").parquet(path)


def create_table(spark: SparkSession, path: str, schema: StructType) -> bool:
    """An empty table with a schema, unless there is one; whether it was made."""
    try:
        spark.read.parquet(path)
        return False
    except AnalysisException:
        spark.createDataFrame([], schema).write.parquet(path)
        return True


def write_key_values(df: DataFrame, key: str, put: Callable[[list[tuple[str, str]]], None], batch: int = 300) -> None:
    """Rows as JSON documents by key to a store outside, ``batch`` a call, from every executor at once.

    ``put`` gets (key, document) pairs and must bear being called again with the same ones, because a
    task that is lost runs again. Rows without a key are left out.
    """
    rest = [c for c in df.columns if c != key]
    rows = df.where(F.col(key).isNotNull()).select(F.col(key).cast("string"), F.to_json(F.struct(*rest)))

    def send(part: Iterator) -> None:
        while some := [tuple(r) for r in islice(part, batch)]:
            put(some)

    rows.foreachPartition(send)


def without_numeric_ids(df: DataFrame, key: str) -> DataFrame:
    """Rows whose key isn't digits only; null keys stay."""
    return df.where(~F.coalesce(F.col(key).rlike("^[0-9]+$"), F.lit(False)))


def export_csv(df: DataFrame, path: str, cols: list[str], by: str = "sku_id") -> None:
    """Known columns in order, nulls as empty, sorted by SKU, in one file per task."""
    keep = [c for c in cols if c in df.columns]
    rows = df.orderBy(by) if by in df.columns else df
    rows.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in keep]).write.mode("overwrite").option("header", True).csv(path)
