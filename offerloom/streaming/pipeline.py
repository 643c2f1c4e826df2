"""The crawl as a stream: cleaned micro-batches that upsert offers, update prices and replace search hits.

State is a ``StampedStore``: every field carries the time of the row it came from, so late batches never
overwrite newer values and the order of batches doesn't matter. A batch writes only its own segment;
reading merges the segments by key, and every ``COMPACT_AFTER`` segments they are merged for good. Which
segments count is told by numbered pointer files in the store's folder, each written whole and then
renamed, so a failed batch leaves the last state, a restarted driver goes on from it, and a batch that is
run again is skipped.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from offerloom.constants import NO_STOCK
from offerloom.functions.barcode import clean_barcodes, info_barcodes
from offerloom.functions.collections import clean_item
from offerloom.functions.price import convert_price
from offerloom.functions.text import strip_trailing_slash
from offerloom.operators.sync import price_log
from offerloom.session import _hadoop_path

#: Segments of a store before they are merged.
COMPACT_AFTER = 8


def item_stream(spark: SparkSession, path: str, schema: StructType, files_per_batch: int = 1) -> DataFrame:
    """Items from a folder that grows, or from one file of a folder."""
    r = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    p, fs = _hadoop_path(spark, path)
    if fs.getFileStatus(p).isFile():
        folder, _, name = path.rpartition("/")
        return r.option("pathGlobFilter", name).parquet(folder)
    return r.parquet(path)


def clean_batch(batch: DataFrame) -> DataFrame:
    """Empty values to null, one slash off the end of links, barcodes cleaned; rows without a link stay out."""
    b = clean_item(batch.where("link is not null"))
    return b.withColumn("link", strip_trailing_slash("link")).withColumn("barcodes", clean_barcodes(F.col("barcodes")))


def search_batch(batch: DataFrame) -> DataFrame:
    """``link, barcodes``, with the row's time: search hits, whose ``google_info`` replaces the barcodes; rows without usable ones stay out."""
    codes = info_barcodes(F.col("google_info"))
    return batch.where("link is not null").select(strip_trailing_slash("link").alias("link"), codes.alias("barcodes"), "ts", "ord").where(F.size("barcodes") > 0)


def batch_prices(batch: DataFrame, sku_links: DataFrame, active: tuple[str, ...] | None = None) -> DataFrame:
    """``sku_id, market, price``, with the row's time: the new prices of SKUs whose offers (``sku_links``: link, sku_id) a batch has seen.

    Only markets in ``active`` update at once, if given. Offers out of stock or without a price update nothing.
    """
    b = batch.where("link is not null and market is not null and ts is not null").where(~F.coalesce("out_of_stock", F.lit(False)) & (F.coalesce("price", F.lit("")) != NO_STOCK))
    b = b if active is None else b.where(F.col("market").isin(*active))
    b = b.select(strip_trailing_slash("link").alias("link"), "market", convert_price(F.col("price")).alias("price"), "ts", "ord").where("price > 0")
    return b.join(sku_links.select("link", "sku_id").distinct(), "link").select("sku_id", "market", "price", "ts", "ord")


class StampedStore:
    """Rows by key whose fields each hold the last value that isn't null, by ``ts`` and then ``ord``; fields in ``grow`` are sets that only grow."""

    def __init__(self, spark: SparkSession, root: str, keys: tuple[str, ...] = ("link",), grow: tuple[str, ...] = ()):
        self.spark, self.root, self.keys, self.grow = spark, root.rstrip("/"), keys, grow

    def _fs(self, path: str):
        return _hadoop_path(self.spark, path)

    def pointer(self) -> dict:
        """``n``, the live ``segments``, and the last epoch of each stream."""
        at, fs = self._fs(f"{self.root}/pointer")
        names = sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []
        whole = [x for x in names if x.endswith(".json")]
        if not whole:
            return {"n": 0, "segments": [], "epochs": {}}
        stream = fs.open(self._fs(f"{self.root}/pointer/{whole[-1]}")[0])
        try:
            return json.loads(bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)))
        finally:
            stream.close()

    def _point(self, state: dict) -> None:
        tmp, fs = self._fs(f"{self.root}/pointer/{uuid.uuid4().hex}.tmp")
        out = fs.create(tmp, True)
        out.write(json.dumps(state).encode())
        out.close()
        if not fs.rename(tmp, self._fs(f"{self.root}/pointer/{state['n']:012d}.json")[0]):
            raise RuntimeError(f"another writer changed {self.root}")

    def _merged(self, stamped: DataFrame) -> DataFrame:
        def agg(c: str) -> Column:
            return F.array_sort(F.array_distinct(F.flatten(F.collect_set(c)))) if c in self.grow else F.max(c)

        return stamped.groupBy(*self.keys).agg(*[agg(c).alias(c) for c in stamped.columns if c not in self.keys])

    def _segments(self, names: list[str]) -> DataFrame | None:
        return self._merged(self.spark.read.parquet(*[f"{self.root}/{x}" for x in names])) if names else None

    def read(self) -> DataFrame | None:
        """The current rows, null before the first batch."""
        d = self._segments(self.pointer()["segments"])
        return None if d is None else d.select(*self.keys, *[F.col(c) if c in self.grow else F.col(f"{c}.v").alias(c) for c in d.columns if c not in self.keys])

    def apply(self, rows: DataFrame, epoch: int, stream: str = "") -> bool:
        """Take in rows with ``ts`` and ``ord``; false if this epoch of the stream was taken in before."""
        state = self.pointer()
        if state["epochs"].get(stream, -1) >= epoch:
            return False
        stamp = lambda c: F.when(F.col(c).isNotNull(), F.struct("ts", "ord", F.col(c).alias("v")))
        fields = [c for c in rows.columns if c not in self.keys and c not in ("ts", "ord")]
        has_keys = " and ".join(f"{k} is not null" for k in self.keys)
        stamped = rows.where(has_keys).select(*self.keys, F.struct("ts", "ord", F.col("ts").alias("v")).alias("ts"), *[F.col(c) if c in self.grow else stamp(c).alias(c) for c in fields])
        name = f"segment-{uuid.uuid4().hex}"
        self._merged(stamped).write.parquet(f"{self.root}/{name}")
        live, old = [*state["segments"], name], []
        if len(live) > COMPACT_AFTER:
            whole = f"segment-{uuid.uuid4().hex}"
            self._segments(live).write.parquet(f"{self.root}/{whole}")
            live, old = [whole], live
        self._point({"n": state["n"] + 1, "segments": live, "epochs": {**state["epochs"], stream: epoch}})
        for x in old:
            p, fs = self._fs(f"{self.root}/{x}")
            fs.delete(p, True)
        return True


def run(stream: DataFrame, checkpoint: str, store: StampedStore, prepare: Callable[[DataFrame], DataFrame], then: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
    """Drain a stream into a store batch by batch; ``then`` gets each batch after it is stored."""

    def each(batch: DataFrame, epoch: int) -> None:
        store.apply(prepare(batch), epoch, checkpoint)
        if then:
            then(batch, epoch)

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def run_upserts(stream: DataFrame, store: StampedStore, checkpoint: str, prices: StampedStore | None = None, sku_links: DataFrame | None = None, active: tuple[str, ...] | None = None) -> StreamingQuery:
    """Offers into ``store`` and, with ``prices`` and ``sku_links``, their prices on to the SKUs at once."""

    def propagate(batch: DataFrame, epoch: int) -> None:
        prices.apply(batch_prices(batch, sku_links, active), epoch, checkpoint)

    return run(stream, checkpoint, store, clean_batch, propagate if prices is not None else None)


def sku_prices(prices: StampedStore) -> DataFrame:
    """``sku_id, prices``: the current price of each market."""
    d = prices.read()
    return d.groupBy("sku_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("market", "price")))).alias("prices"))


def recent(stream: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Repeats within the delay are dropped by link and time."""
    return stream.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["link", "ts"])


def windowed_counts(stream: DataFrame, width: str = "1 day", delay: str = "1 hour") -> DataFrame:
    """Items a market and window of event time."""
    return stream.withWatermark("ts", delay).groupBy(F.window("ts", width), "market").agg(F.count(F.lit(1)).alias("n"))


__all__ = ["StampedStore", "batch_prices", "clean_batch", "item_stream", "price_log", "recent", "run", "run_upserts", "search_batch", "sku_prices", "windowed_counts"]
