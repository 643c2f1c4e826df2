"""Nulls in any column, empty and very long texts, ties, repeated rows, empty tables and extra columns with clashing names."""

import pytest
from pyspark.sql import functions as F

pytest.importorskip("offerloom.llm")
from offerloom.llm import bpe, canonical, components, disguise, fusion, leaks, listings, pii  # noqa: E402

CLASH = ("d", "p", "m", "n", "word", "words", "family", "variant", "codes", "rest", "kind", "value", "entity", "field", "source", "v", "cs", "u", "dst", "src_", "node", "group_id", "text_", "pos", "term", "off", "x", "link")


def clashing(df):
    return df.withColumns({c: F.lit("clash") for c in CLASH if c not in df.columns})


def raw_docs(spark, rows):
    return clashing(spark.createDataFrame(rows, "doc_id string, name string, brand string, barcodes array<string>, sku_id string, ord long"))


def skus(spark, rows):
    return clashing(spark.createDataFrame(rows, "sku_id string, doc_ids array<string>, name string, src string, brand string, category string, color string, market string, ts timestamp, ord long"))


LONG = "Marka Satir Serin Limon Şampuan 500 ml " + "uzun" * 20_000
DOCS = [
    ("a", "Marka Satir Serin Limon Şampuan 500 ml", "Marka", ["2000000001302", None, ""], "s", 1), ("a", "Marka Satir Serin Limon Şampuan 500 ml", "Marka", None, "s", 9),
    ("b", "MARKA SATİR SERİN LİMON SHAMPOO 0,5 LT", None, [], None, 2), ("c", LONG, "Marka", None, "", 3), ("d", "", "", [""], " ", 4), ("e", None, None, None, None, 5), (None, "x", "y", ["2000000001302"], "s", 6), ("f", "   ", "​", None, None, 7), ("g", "500 ml", None, None, None, None),
]
T = "2020-01-01 00:00:00"


def test_listings(spark):
    d = raw_docs(spark, DOCS)
    assert {tuple(r) for r in listings.same_product_pairs(d).collect()} == {("a", "b")}
    assert listings.product_groups(d.where("doc_id is null")).count() == 0 and listings.same_product_pairs(d.limit(0)).count() == 0


def test_groups(spark):
    d, k = raw_docs(spark, DOCS), skus(spark, [("s", ["b+clone1", None, "", "gone", "b"], *[None] * 8), (None, ["a"], *[None] * 8), ("t", None, *[None] * 8)])
    assert {tuple(r) for r in components.offer_groups(d, k).collect()} == {("a", "a"), ("b", "a")}
    assert components.offer_groups(d.limit(0), k).count() == 0 and components.offer_groups(d, k.limit(0)).count() == 0


def test_canonical(spark):
    d = raw_docs(spark, DOCS)
    k = skus(spark, [("s", None, None, None, None, "Bal ", "Mavi", None, None, 1), (None, None, None, None, None, None, "", None, None, 2), ("s", None, None, None, None, "b" * 50_000, "mavii", None, None, 3)])
    ref = clashing(spark.createDataFrame([(1, "brand", "Marka", [None, ""]), (2, "category", "Bal", None), (3, "color", "Mavi", []), (4, "color", "Mavi", []), (None, "color", "Mor", None), (5, None, "x", None), (6, "brand", None, None)], "ref_id long, kind string, canonical string, aliases array<string>"))
    got = {tuple(r) for r in canonical.mapped_rows(spark, d, k, ref).collect()}
    assert got == {("brand", 6, -1), ("category", 1, 2), ("category", 3, -1), ("color", 3, 3), ("brand", 7, -1)} or got == {("brand", 6, -1), ("category", 1, 2), ("category", 3, -1), ("color", 3, 3)}
    assert {r.ref_id for r in canonical.mapped_rows(spark, d, k, ref.limit(0)).collect()} == {-1}
    assert canonical.mapped_rows(spark, d.limit(0), k.limit(0), ref).count() == 0


def test_fusion(spark):
    row = lambda s, name, market, o, ts=T: (s, None, name, "https://i/1.jpg", "B" * 100_000, "Bal", None, market, ts, o)
    rows = [row("s", "Ad", "m", 1), row("s", "Ad", "m", 1), row("s", "Ad2", None, 2), row("t", "Ad", "m", 3, None), row("t", "Od", "k", 4, None), row(None, "Ad", "m", 5), row("u", None, None, 6, None), row("u", "", "m", None)]
    k = clashing(spark.createDataFrame(rows, "sku_id string, doc_ids array<string>, name string, src string, brand string, category string, color string, market string, ts string, ord long").withColumn("ts", F.col("ts").cast("timestamp")))
    trust = clashing(spark.createDataFrame([("m", 1, 1), ("m", 1, 1), ("k", 1, None)], "market string, name_rank int, src_rank int"))
    got = {(r.sku_id, r.field): r.ord for r in fusion.surviving_records(k, trust).collect()}
    assert got[("s", "name")] == 1 and got[("t", "name")] == 4 and got[("t", "src")] == 3 and ("u", "name") not in got  # a tie in rank and time goes to the later arrival
    assert fusion.surviving_records(k, trust.limit(0)).where("sku_id = 's' and field = 'name'").first().ord == 2
    assert fusion.fuse(k).where("sku_id = 's'").count() == 4 and fusion.fuse(k.limit(0)).count() == 0


def test_disguise(spark):
    d = raw_docs(spark, [*DOCS, ("z", "ｘ" * 50_000, None, None, None, 8)])
    assert {(r.ord, r.field) for r in disguise.detect(d).collect()} == {(7, "brand"), (8, "name")}
    assert {r.ord: len(r.clean) for r in disguise.consistent(d).collect()} == {7: 0, 8: 50_000} and disguise.consistent(d.limit(0)).count() == 0


def documents(spark, texts):
    return clashing(spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(None, "x")], "doc_id long, text string"))


def test_documents(spark):
    passage = " ".join(f"kelime{i}" for i in range(12))
    long = " ".join(["dolgu"] * 30_000) + " " + passage + " beni 0532 555 00 11 numarasından arayın"
    d = documents(spark, [None, "", " ", long, long, "a" * 60_000])
    e = clashing(spark.createDataFrame([(1, passage), (1, passage), (2, None), (None, passage), (3, "")], "item_id long, text string"))
    assert sorted((r.doc_id, r.item_id) for r in leaks.exact_phrases(d, e).collect()) == [(3, 1), (4, 1)]
    assert {(r.doc_id, r.item_id) for r in leaks.near_phrases(d, e).collect()} == {(3, 1), (4, 1)}
    assert leaks.exact_phrases(d.limit(0), e).count() == 0
    ids = {r.doc_id: len(r.ids) for r in bpe.encode_documents(d).collect()}
    assert ids[0] == ids[1] == 0 and ids[3] == ids[4] > 30_000 and len(ids) == 7
    train = [f"Kargo geldi. beni 0532 555 00 {i} numarasından arayın" for i in range(10, 60)]
    found = pii.find_items(documents(spark, [None, "", " ", long, long, "a" * 60_000, *train])).collect()
    assert {(r.doc_id, r.kind, r.start_at) for r in found if r.doc_id in range(6)} == {(i, "phone", long.index("0532")) for i in (3, 4)}
    assert pii.masked(d.limit(0)).count() == 0
