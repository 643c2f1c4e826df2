import pytest
from pyspark.sql import functions as F

from offerloom.session import cut, release, scratch
from offerloom.streaming import pipeline as P

ROW = "link string, price string, market string, out_of_stock boolean, barcodes array<string>, ts long, ord long, clash string"


def rows(spark, *data):
    return spark.createDataFrame([(a, b, "m", None, c, t, o, None) for a, b, c, t, o in data], ROW)


def test_late_batches_and_restarts(spark, tmp_path):
    store = lambda: P.StampedStore(spark, str(tmp_path), grow=("barcodes",))
    assert store().read() is None
    assert store().apply(P.clean_batch(rows(spark, ("a/", "5", ["12345678"], 10, 1), ("b", "7", None, 10, 2), (None, "1", None, 10, 3))), 0, "s")
    assert not store().apply(P.clean_batch(rows(spark, ("a", "999", None, 99, 9))), 0, "s")  # the same epoch again
    assert store().apply(P.clean_batch(rows(spark, ("a", "4", ["87654321"], 5, 4), ("b", "", None, 20, 5), ("c", None, None, 1, 6))), 1, "s")  # an older row, and a newer one without a price
    got = {r.link: (r.price, sorted(r.barcodes or [])) for r in store().read().collect()}
    assert got == {"a": ("5", ["12345678", "87654321"]), "b": ("7", []), "c": (None, [])}
    assert store().apply(P.clean_batch(rows(spark, ("a", "6", None, 11, 0))), 0, "other stream")
    assert {r.link: r.price for r in store().read().collect()}["a"] == "6"


def test_segments_are_merged_and_old_ones_deleted(spark, tmp_path):
    store = P.StampedStore(spark, str(tmp_path))
    for e in range(P.COMPACT_AFTER + 2):
        store.apply(rows(spark, (f"l{e % 3}", str(e), None, e, e)), e)
    assert len(store.pointer()["segments"]) == 2 and len([x for x in tmp_path.iterdir() if x.name.startswith("segment")]) == 2
    n = P.COMPACT_AFTER + 2
    assert {r.link: int(r.price) for r in store.read().collect()} == {f"l{i}": max(e for e in range(n) if e % 3 == i) for i in range(3)}


def test_a_failed_batch_leaves_the_last_state(spark, tmp_path):
    store = P.StampedStore(spark, str(tmp_path))
    store.apply(rows(spark, ("a", "1", None, 1, 1)), 0)
    with pytest.raises(Exception, match="planned"):
        store.apply(rows(spark, ("a", "2", None, 2, 2)).withColumn("price", F.raise_error(F.lit("planned")).cast("string")), 1)
    assert [r.price for r in store.read().collect()] == ["1"]


def test_stream_over_a_restart(spark, tmp_path):
    links = spark.createDataFrame([("a", "s1"), ("b", "s1")], "link string, sku_id string")

    def drain():
        offers, prices = P.StampedStore(spark, f"{tmp_path}/offers", grow=("barcodes",)), P.StampedStore(spark, f"{tmp_path}/prices", keys=("sku_id", "market"))
        stream = P.item_stream(spark, f"{tmp_path}/in", rows(spark).schema)
        P.run_upserts(stream, offers, f"{tmp_path}/offsets", prices, links).awaitTermination()
        return {r.link: r.price for r in offers.read().collect()}, {r.sku_id: r.prices for r in P.sku_prices(prices).collect()}

    rows(spark, ("a", "5", None, 10, 1), ("x", "1", None, 1, 2)).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    assert drain() == ({"a": "5", "x": "1"}, {"s1": {"m": 5.0}})
    rows(spark, ("b", "3", None, 12, 3), ("a", "9", None, 2, 4)).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    assert drain() == ({"a": "5", "b": "3", "x": "1"}, {"s1": {"m": 3.0}})


def test_inactive_markets_update_no_prices(spark):
    links = spark.createDataFrame([("a", "s1")], "link string, sku_id string")
    b = rows(spark, ("a", "5", None, 10, 1))
    assert P.batch_prices(b, links, active=("other",)).count() == 0 and P.batch_prices(b, links).count() == 1


def test_scratch_deletes_what_was_cut(spark):
    with scratch():
        t = cut(spark.range(3))
        assert t.count() == 3
    with pytest.raises(Exception, match="(?i)not.exist|no such|FileNotFound"):
        t.count()
    kept = cut(spark.range(2))
    assert kept.count() == 2
    release(kept)
