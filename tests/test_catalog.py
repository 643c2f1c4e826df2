"""Operators of the catalogue: groups, evaluation, enrichment, connectors and sinks, with nulls, ties and empty tables."""

import json

import pytest
from pyspark.sql import functions as F

from offerloom.constants import Config
from offerloom.functions import collections as C
from offerloom.operators import enrich, evaluation, graph, prep, reduce, search, sync
from offerloom.plans import enrichment
from offerloom.sources import connectors as cn

DOC = "doc_id string, ord long, clean_name string, sizes array<struct<digits:double,unit:string>>, barcodes array<string>, is_clone boolean"


def test_fully_connected(spark):
    g = spark.createDataFrame([("a", "a"), ("b", "a"), ("c", "c"), ("d", "c")], "node string, component string")
    known = spark.createDataFrame([("a",), ("b",), ("b",), ("c",), (None,)], "node string")
    assert [r.component for r in graph.fully_connected(g, known).collect()] == ["a"]
    assert graph.fully_connected(g.limit(0), known).count() == 0


def test_held_out_docs_come_back_by_name(spark):
    rows = [(f"a{i}", i, "serin limon bal", [], [], False) for i in range(3)] + [(f"b{i}", 10 + i, n, [], [], False) for i, n in enumerate(("kara uzum pekmez", "kara uzum", "kara uzum pekmez kavanoz", "x"))]
    docs = spark.createDataFrame(rows, DOC)
    edges = spark.createDataFrame([("a0", "a1"), ("a0", "a2"), ("b0", "b1"), ("b0", "b2"), ("b0", "b3")], "src string, dst string")
    got = {r.doc_id: r.outcome for r in evaluation.evaluate_matching(docs, edges).collect()}
    assert len(got) == 2 and all(v in ("ok", "wrong", "failed") for v in got.values())
    assert [v for k, v in got.items() if k.startswith("a")] == ["failed"] or [v for k, v in got.items() if k.startswith("a")] == ["ok"]
    assert len(evaluation.held_out(docs, graph.components(edges)).collect()) == 2
    five = spark.createDataFrame([("a0", f"a{i}") for i in range(1, 6)], "src string, dst string")
    docs5 = spark.createDataFrame([(f"a{i}", i, "n", [], [], i == 5) for i in range(6)], DOC)
    assert len(evaluation.held_out(docs5, graph.components(five)).collect()) == 2  # five docs without the clone: two are held out
    assert evaluation.evaluate_matching(docs.limit(0), edges.limit(0)).count() == 0


def test_group_parts(spark):
    d = spark.createDataFrame([("g", 1, "m", ["a"], None, "l?v=1", {"l?v=1": "Mavi", "l?v=2": ""}), ("g", 2, "m", ["b", "c"], "", "x", None), ("g", 3, None, None, None, None, None), ("h", 4, "m", None, "Kırmızı", "y", {"l?v=1": "Mavi"})], "component string, ord long, market string, categories array<string>, variant_name string, link string, variants map<string,string>")
    assert [tuple(r) for r in reduce.group_categories(d).collect()] == [("g", {"m": ["b", "c"]})]
    assert {tuple(r) for r in reduce.group_variant_name(d).collect()} == {("g", "Mavi"), ("h", "Kırmızı")}
    names = spark.createDataFrame([("g", 1, "b a b"), ("g", 2, "a c"), ("g", 3, None), ("h", 1, "")], "component string, ord long, name string")
    assert [(r.component, r.tags, r.most_common_tokens) for r in reduce.group_words(names, 2).collect()] == [("g", "a b c", ["a", "b"])]


def test_subcats_are_cleaned_and_applied(spark):
    rows = spark.createDataFrame([("Kadın Çantaları",), ("İndirim",), ("12",), (None,), ("Marka",), ("sabunlar",)], "subcat string")
    merged = spark.createDataFrame([("sabun", "kati sabun")], "subcat string, merged string")
    m = prep.clean_subcats(rows, spark.createDataFrame([("marka",)], "brand string"), merged)
    assert {tuple(r) for r in m.collect()} == {("Kadın Çantaları", "canta", "kadin"), ("sabunlar", "kati sabun", None)}
    out = prep.with_clean(rows.withColumn("x", F.lit(1)), "subcat", m)
    assert sorted(str(r.subcat) for r in out.collect()) == ["None"] * 4 + ["canta", "kati sabun"] and out.columns == ["subcat", "x"]


def test_enrichment_chain(spark):
    rows = [(f"u{i}", [f"fener sabun {w} {i}", None], ["Fener", "Fener", "x1"], ["Sabunlar", None, "İndirim"]) for i, w in enumerate(("limon", "limon", "nane"))]
    rows += [("n", None, None, None), ("e", [], [], [])]
    p = spark.createDataFrame(rows, "uid string, clean_names array<string>, brands array<string>, subcats array<string>")
    got = {r.uid: (r.brand, r.subcat, r.subcat_source) for r in enrichment.enriched_products(p).collect()}
    assert got["u0"] == ("fener", "sabun", "local_name") and got["n"] == got["e"] == (None, None, None)
    skus = spark.createDataFrame([("s", "u0", "old"), ("u1", None, "old"), ("z", None, "old")], "sku_id string, product_id string, brand string")
    assert {r.sku_id: r.brand for r in enrichment.enriched_skus(skus, p).collect()} == {"s": "fener", "u1": "fener", "z": None}
    assert enrichment.enriched_products(p.limit(0)).count() == 0


def test_known_phrases_leave_by_words(spark):
    rows = spark.createDataFrame([(1, "kara uzum pekmez"), (2, "uzum kara"), (3, None), (4, "")], "id int, name string")
    known = spark.createDataFrame([("kara uzum",), ("pek",)], "known string")
    assert {r.id: r.name for r in enrich.without_known(rows, "name", known).collect()} == {1: "pekmez", 2: "uzum kara", 3: None, 4: ""}


def test_topic_words(spark):
    rows = spark.createDataFrame([("s", b, f"{b}{i}", "limon nane") for b in "ab" for i in range(2)] + [("s", "a", "q", "tek"), ("t", "a", "r", None)], "subcat string, brand string, uid string, name string")
    assert {(r.token, r.freq) for r in enrich.shared_tokens(rows).collect()} == {("limon", 4), ("nane", 4)}
    assert enrich.subcat_tokens(rows).count() == 0 and {r.token for r in enrich.subcat_tokens(rows, 2).collect()} == {"limon", "nane"}
    assert sorted(tuple(r) for r in enrich.topic_input(rows).collect()) == [("s", "limon nane")] * 4


def test_partial_brands_and_parents(spark):
    names = spark.createDataFrame([("u", 0, "buyuk f sabun kutusu")], "uid string, pos int, name string")
    brands = spark.createDataFrame([("u", "fener sabun"), ("u", "kutusu")], "uid string, brand string")
    assert [tuple(r) for r in enrich.brand_partial(names, brands).collect()] == [("u", "fener sabun", "f sabun")]
    parents = spark.createDataFrame([("u", "sabun"), ("u", "sabun kutusu"), ("u", "yok"), ("u", "")], "uid string, parent string")
    assert [tuple(r) for r in enrich.subcat_parents(names, parents).collect()] == [("u", "sabun kutusu")]


def test_maps(spark):
    df = spark.sql("select map('a', '1', 'n', null) as x, map('a', '2', 'b', '3') as y, cast(null as map<string,string>) as z")
    assert df.select(C.merged_maps(F.col("z"), F.col("x"), F.col("y")).alias("m")).first().m == {"a": "1", "b": "3"}
    m = spark.sql("select map('k', array('b', 'a', null)) as m union all select map('k', array('a'), 'l', array()) union all select null")
    assert [tuple(r) for r in C.nested_sets(m, "m").collect()] == [("k", ["a", "b"])]


def test_search_pages(spark):
    src = cn.register("a101", r"<li>.*?</li>", {"link": r'href="([^"]+)"', "name": "<b>(.*?)</b>", "price": "<i>(.*?)</i>"})
    one, two = '<li><a href="/x"><b>X</b><i>1,50</i></a></li>', '<li><a href="/x"></a></li><li><a href="/y"></a></li>'
    pages = spark.createDataFrame([("p", one, "111"), ("q", two, "222"), ("r", None, "333")], "url string, body string, code string")
    assert [(r.link, r.price, r.barcodes) for r in cn.read_search(pages, src).collect()] == [("/x", 1.5, ["111"])]
    assert sorted(r.link for r in cn.read_offers(pages, src).collect()) == ["/x", "/x", "/y"]  # a list page may have several
    assert "a101" in cn.sources(search=True) and "a101" not in cn.sources(search=False)


def test_json_in_pages_and_pages_in_json(spark):
    eve = cn.register("eve", "", {"link": "$.u", "name": "$.n", "price": "$.p"}, outer=r"var items = (\[.*?\]);", kind="json_in_text")
    body = 'x var items = [{"u": "/a", "n": "A", "p": "2,5"}, {"n": "no link"}]; y'
    assert [(r.link, r.name, r.price) for r in cn.read_offers(spark.createDataFrame([("u", body), ("v", "none"), ("w", None)], "url string, body string"), eve).collect()] == [("/a", "A", 2.5)]
    civil = cn.register("civil", "<p>.*?</p>", {"link": 'href="(.*?)"', "name": "<b>(.*?)</b>"}, outer="$.html", kind="html_in_json")
    page = json.dumps({"html": '<p><a href="/c"><b> C </b></a></p>'})
    assert [(r.link, r.name) for r in cn.read_offers(spark.createDataFrame([("u", page), ("v", "{}")], "url string, body string"), civil).collect()] == [("/c", "C")]


def test_maps_of_a_page(spark):
    src = cn.register("google", "<div.*</div>", {"link": 'id="(.*?)"'}, maps={"promoted": ("<s>(.*?)</s>", "<l>(.*?)</l>"), "variants": ("<v>(.*?)</v>", "<w>(.*?)</w>")})
    body = '<div id="/g"><s>m</s><l>/1</l><s>k</s><l>/2</l><s>m</s><l>/3</l></div>'
    (r,) = cn.read_offers(spark.createDataFrame([("u", body)], "url string, body string"), src).collect()
    assert r.promoted == {"m": "/3", "k": "/2"} and r.variants == {}


def test_sinks(spark, tmp_path):
    schema = spark.range(1).schema
    assert sync.create_table(spark, f"{tmp_path}/t", schema) and not sync.create_table(spark, f"{tmp_path}/t", schema)
    sync.append(spark.range(2), f"{tmp_path}/t")
    sync.append(spark.range(2), f"{tmp_path}/t")
    assert spark.read.parquet(f"{tmp_path}/t").count() == 4
    at = str(tmp_path)

    def put(some):
        import os
        import uuid

        assert len(some) <= 3
        with open(os.path.join(at, f"{uuid.uuid4().hex}.kv"), "w") as f:
            json.dump(some, f)

    df = spark.range(10).select(F.when(F.col("id") < 9, F.concat(F.lit("k"), "id")).alias("k"), F.col("id").alias("v")).coalesce(1)
    sync.write_key_values(df, "k", put, batch=3)
    got = [tuple(x) for p in tmp_path.glob("*.kv") for x in json.loads(p.read_text())]
    assert sorted(got) == [(f"k{i}", json.dumps({"v": i}, separators=(",", ":"))) for i in range(9)]
    ids = spark.createDataFrame([("12",), ("a1",), (None,), ("",)], "k string")
    assert sorted(str(r.k) for r in sync.without_numeric_ids(ids, "k").collect()) == ["", "None", "a1"]
    skus = spark.createDataFrame([("b", None), ("a", "x")], "sku_id string, name string")
    sync.export_csv(skus, f"{tmp_path}/csv", ["name", "none"])
    assert [r.name for r in spark.read.option("header", True).csv(f"{tmp_path}/csv").collect()] == ["x", None]


def test_tags_are_searched(spark):
    k = spark.createDataFrame([("a", "Limon Sabun", "limon sabun eski"), ("b", "Sabun", "limonlu sabun limom"), ("c", None, None)], "sku_id string, name string, tags string")
    assert [(r.sku_id, r.score) for r in search.keyword_search(k, "limon sabun").collect()] == [("a", 6), ("b", 4)]
    assert [(r.sku_id, r.score) for r in search.keyword_search(k.drop("tags"), "limon sabun").collect()] == [("a", 4)]
    d = spark.createDataFrame([("l", {"v": "x"}), (None, None), ("v", {})], "link string, variants map<string,string>")
    assert sorted(r.link for r in search.link_queue(d).collect()) == ["l", "v"]


def test_variant_pages_make_product_pages(spark):
    cfg = Config(product_market="m", variant_marker="?v=")
    rows = [("d", 1, "https://m/urun-p-1", "m", {"https://m/urun-p-1?v=0": "Mavi", "https://m/urun-p-1?v=1": "Bej"}, None, None, None), ("e", 2, "https://m/9", "m", {"https://m/9?v=0": "Mor"}, None, None, None), ("f", 3, None, "m", None, None, None, None)]
    d = spark.createDataFrame(rows, "doc_id string, ord long, link string, market string, variants map<string,string>, color string, sku_id string, barcodes array<string>")
    pages = prep.variant_pages(d)
    assert pages.count() == 6 and {r.color for r in pages.collect()} == {None, "Mavi", "Bej", "Mor"}
    links = prep.product_links(pages, cfg.product_market, cfg.variant_marker)
    assert [r.link for r in links.collect()] == ["https://m/urun-p-1"]
    assert prep.without_product_links(pages, links).count() == 5  # docs without a link stay


@pytest.mark.parametrize("n,fails", [(0, False), (2, True)])
def test_items_are_checked(spark, n, fails):
    items = spark.createDataFrame([("l", "n", "p", "m", "s"), *[("l", None, "p", "m", "")] * n], "link string, name string, price string, market string, src string")
    if fails:
        with pytest.raises(ValueError):
            prep.check_items(items, 1)
    assert prep.check_items(items, 5) == n
