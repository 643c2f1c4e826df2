"""Queries that run through the streams, in several batches and over a restart, and their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerloom.functions.text import strip_trailing_slash
from offerloom.session import ensure_checkpoint_dir
from offerloom.sources.tables import table
from offerloom.streaming import pipeline as P


def _root(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"


def _arrivals(rows: DataFrame, root: str) -> list[Callable[[], None]]:
    """Two loads of files for a stream's folder, in order of arrival: together all rows."""
    half = rows.agg(F.percentile_approx("ord", 0.5)).first()[0]
    late = F.coalesce(F.col("ord") > half, F.lit(True))
    return [lambda part=part: rows.where(part).repartition(2).write.mode("append").parquet(f"{root}/in") for part in (~late, late)]


def _drained(rows: DataFrame, store: Callable[[str], P.StampedStore], drain: Callable[[DataFrame, P.StampedStore, str], object]) -> P.StampedStore:
    """Each load is drained file by file by a new query and a new store object, as after a restart."""
    spark, root = rows.sparkSession, _root(rows.sparkSession)
    for load in _arrivals(rows, root):
        load()
        kept = store(f"{root}/store")
        drain(P.item_stream(spark, f"{root}/in", rows.schema), kept, f"{root}/offsets").awaitTermination()
    return kept


def offers(spark: SparkSession, folder: str) -> DataFrame:
    """The final offers after all items ran through the stream."""
    items = table(spark, folder, "items")
    store = _drained(items, lambda at: P.StampedStore(spark, at, grow=("barcodes",)), P.run_upserts)
    return store.read().select("link", "price", "market", F.array_join("barcodes", ",").alias("codes"))


def sku_links(raw_docs: DataFrame, skus: DataFrame) -> DataFrame:
    """``link, sku_id`` of the docs that SKUs list."""
    listed = skus.where("sku_id is not null").select("sku_id", F.explode("doc_ids").alias("d")).select("sku_id", F.regexp_replace("d", r"\+clone[0-9]*$", "").alias("doc_id"))
    return listed.join(raw_docs.select("doc_id", strip_trailing_slash("link").alias("link")), "doc_id").where("link is not null").select("link", "sku_id").distinct()


def prices(spark: SparkSession, folder: str) -> DataFrame:
    """The current price of each SKU and market after all items ran through the stream."""
    items, links = table(spark, folder, "items"), sku_links(table(spark, folder, "raw_docs"), table(spark, folder, "skus"))
    store = _drained(items, lambda at: P.StampedStore(spark, at, keys=("sku_id", "market")), lambda s, kept, c: P.run(s, c, kept, lambda b: P.batch_prices(b, links)))
    return store.read().select("sku_id", "market", "price")


def search_hits(spark: SparkSession, folder: str) -> DataFrame:
    """Barcodes that search hits gave, the last ones a link; the codes of raw_docs stand for the hits' texts, which hold none in these tables."""
    rows = table(spark, folder, "raw_docs").select("link", F.col("barcodes").alias("google_info"), "ord", F.col("ord").alias("ts"))
    store = _drained(rows, lambda at: P.StampedStore(spark, at), lambda s, kept, c: P.run(s, c, kept, P.search_batch))
    return store.read().select("link", F.array_join(F.array_sort("barcodes"), ",").alias("codes"))


def windows(spark: SparkSession, folder: str) -> DataFrame:
    """Items a market and day of event time; counts are kept by the stream's own state."""
    root = _root(spark)
    items = table(spark, folder, "items").select("market", F.col("ts").cast("timestamp").alias("ts"), "ord")
    for load in _arrivals(items, root):
        load()
    counted = P.windowed_counts(P.item_stream(spark, f"{root}/in", items.schema))

    def keep(batch: DataFrame, epoch: int) -> None:
        batch.select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "market", "n").write.mode("overwrite").parquet(f"{root}/out")

    counted.writeStream.outputMode("complete").foreachBatch(keep).option("checkpointLocation", f"{root}/offsets").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{root}/out")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"stream_upserts": offers, "stream_prices": prices, "stream_search": search_hits, "stream_windows": windows}


ORACLES = {
    "stream_upserts": r"""
        with i as (select regexp_replace(link, '/$', '') as link, nullif(price, '') as price, nullif(market, '') as market, barcodes, struct_pack(ts := ts, ord := ord) as seen from items where link is not null),
        b as (select link, trim(unnest(string_split(b, ','))) as t from (select link, unnest(barcodes) as b from i)),
        k as (select link, string_agg(distinct case when length(t) in (8, 13) then t else right(t, 13) end, ',' order by case when length(t) in (8, 13) then t else right(t, 13) end) as codes
              from b where regexp_matches(t, '^([0-9]{8}|[0-9]{13}|0[1-9][0-9]{12})$') group by 1),
        l as (select link, arg_max(price, seen) filter (price is not null) as price, arg_max(market, seen) filter (market is not null) as market from i group by 1)
        select l.link, price, market, coalesce(codes, '') as codes from l left join k using (link)""",
    "stream_prices": r"""
        with s as (select distinct regexp_replace(r.link, '/$', '') as link, l.sku_id from (select sku_id, regexp_replace(unnest(doc_ids), '\+clone[0-9]*$', '') as doc_id from skus where sku_id is not null) l join raw_docs r using (doc_id) where r.link is not null),
        p as (select regexp_replace(link, '/$', '') as link, market, regexp_replace(lower(price), 'tl|₺|try|[ ]', '', 'g') as t, ts, ord from items where link is not null and market is not null and ts is not null and not coalesce(out_of_stock, false) and price <> 'Stokta Yok'),
        n as (select *, round(try_cast(case when regexp_matches(t, '^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)$') then t end as double), 2) as price from p)
        select sku_id, market, arg_max(price, struct_pack(ts := ts, ord := ord)) as price from n join s using (link) where price > 0 group by 1, 2""",
    "stream_search": r"""
        with g as (select ord, regexp_replace(link, '/$', '') as link, unnest(barcodes) as g from raw_docs where link is not null),
        c as (select ord, link, string_agg(distinct ltrim(g, '0'), ',' order by ltrim(g, '0')) as codes from g where length(g) in (13, 14) and g[1] = '0' and regexp_matches(ltrim(g, '0'), '^[0-9]+$') group by 1, 2)
        select link, arg_max(codes, ord) as codes from c group by 1""",
    "stream_windows": "select strftime(ts, '%Y-%m-%d') as day, market, count(*) as n from items where ts is not null group by 1, 2",
}
