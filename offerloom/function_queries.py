"""Queries of functions, files, connectors and smaller steps, each beside its SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerloom.catalog_queries import CFG, ROWS, WS, _low, _rows
from offerloom.functions import collections as C
from offerloom.functions import text as T
from offerloom.functions.barcode import url_barcode
from offerloom.functions.names import clean_name_udf, first_size_udf
from offerloom.functions.price import locale_price
from offerloom.functions.sql import register
from offerloom.operators import edges, enrich, prep, products, reduce, reports, search, sync, topics
from offerloom.plans import rebuild
from offerloom.session import ensure_checkpoint_dir
from offerloom.sources import connectors as cn
from offerloom.sources import files
from offerloom.sources.tables import table


def _q(make: Callable[..., DataFrame], *tables: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: make(*(table(spark, sf_dir, t) for t in tables))


def _place(df: DataFrame) -> str:
    return f"{ensure_checkpoint_dir(df.sparkSession)}/files-{uuid.uuid4().hex}"


def _json(p: DataFrame) -> DataFrame:
    at = _place(p)
    files.save_json(p.select("p_partkey", "p_name", "p_size"), at)
    return p.sparkSession.read.schema("p_partkey long, p_name string, p_size int").json(at)


def _csv(p: DataFrame) -> DataFrame:
    at = f"{_place(p)}.csv"
    p.select("p_partkey", F.concat("p_name", F.lit(' "a", b')).alias("p_name")).write.option("header", True).option("escape", '"').csv(at)
    return p.sparkSession.read.option("header", True).option("escape", '"').schema("p_partkey long, p_name string").csv(at)


def _sheet(p: DataFrame) -> DataFrame:
    at = f"{_place(p)}.csv"
    p.select("p_partkey", "p_type").write.option("header", True).csv(at)
    return files.read_sheet(p.sparkSession, at, "p_partkey long, p_type string")


def _backup(k: DataFrame) -> DataFrame:
    at = _place(k)
    files.backup(k, at)
    return k.sparkSession.read.parquet(at).select("ord", "sku_id", F.size("prices").alias("n_prices"))


def _export(k: DataFrame) -> DataFrame:
    at = _place(k)
    sync.export_csv(k.where("sku_id is not null").select("sku_id", "ord", "market"), at, ["sku_id", "market", "ord", "absent"])
    return k.sparkSession.read.option("header", True).schema("sku_id string, market string, ord long").csv(at).select("sku_id", F.coalesce("market", F.lit("")).alias("market"), "ord")


def _in_sql(spark: SparkSession, folder: str) -> DataFrame:
    register(spark)
    return spark.sql("select ord, offer_strip_trailing_slash(link) as link, offer_convert_price(price) as price, coalesce(offer_contains_words(lower(name), 'sabun'), false) as soap from {i}", i=table(spark, folder, "items"))


#: A shop of each kind of page, for pages rendered from the tables.
SHOPS = {
    "html": cn.Source("html", "html", "<li>.*?</li>", fields={"link": 'href="(.*?)"', "name": "<b>(.*?)</b>", "price": "<i>(.*?)</i>", "src": 'src="(.*?)"'}, price="S", base="https://s", barcode_from="src"),
    "json": cn.Source("json", "json", "$.items", fields={"link": "$.u", "name": "$.n", "price": "$.p"}, price="N"),
    "json_ld": cn.Source("json_ld", "json_ld", fields={"link": "$.url", "name": "$.name", "price": "$.offers.price"}, price="N"),
    "json_in_text": cn.Source("text", "json_in_text", outer=r"var items = (\[.*?\]);", fields={"link": "$.u", "name": "$.n", "price": "$.p"}, price="N"),
    "html_in_json": cn.Source("inner", "html_in_json", "<p>.*?</p>", outer="$.html", fields={"link": "href='(.*?)'", "name": "<b>(.*?)</b>", "price": "<i>(.*?)</i>"}, price="T"),
    "search": cn.Source("search", "html", "<li>.*?</li>", fields={"link": 'href="(.*?)"', "name": "<b>(.*?)</b>"}, unique_hit=True),
}


def _rendered(p: DataFrame, kind: str) -> DataFrame:
    """A page for each size, with the parts of that size."""
    link, name = F.concat(F.lit("/"), F.col("p_partkey").cast("string")), F.col("p_name")
    price = F.col("p_retailprice").cast("decimal(12,2)").cast("string")
    if kind == "html":
        item = F.concat(F.lit('<li><a href="'), link, F.lit('"><b> '), name, F.lit('</b><i>'), F.translate(price, ".", ","), F.lit(' TL</i><img src="/img/2000000'), F.lpad(F.col("p_partkey").cast("string"), 6, "0"), F.lit('_1.jpg"></a></li>\n'))
    elif kind == "html_in_json":
        item = F.concat(F.lit("<p><a href='"), link, F.lit("'><b>"), name, F.lit("</b><i>"), F.translate(price, ".", ","), F.lit("</i></p>"))
    elif kind == "json_ld":
        item = F.concat(F.lit('<script type="application/ld+json">'), F.to_json(F.struct(link.alias("url"), name.alias("name"), F.struct(price.alias("price")).alias("offers"))), F.lit("</script>"))
    else:
        item = F.to_json(F.struct(link.alias("u"), name.alias("n"), price.alias("p")))
    items = p.groupBy("p_size").agg(F.array_join(F.array_sort(F.collect_list(item)), "," if kind in ("json", "json_in_text") else "").alias("x"))
    body = {
        "html": F.concat(F.lit("<ul>"), "x", F.lit("</ul>")), "json": F.concat(F.lit('{"items": ['), "x", F.lit("]}")), "json_ld": F.col("x"),
        "json_in_text": F.concat(F.lit("<script>var items = ["), "x", F.lit("];</script>")), "html_in_json": F.to_json(F.struct(F.col("x").alias("html"))),
    }[kind]
    return items.select(F.col("p_size").cast("string").alias("url"), body.alias("body"))


def _pages(kind: str, src: str) -> Callable[[SparkSession, str], DataFrame]:
    return _q(lambda p: cn.read_offers(_rendered(p, kind), SHOPS[src]).select("link", "name", "price", F.array_join("barcodes", ",").alias("codes")), "part")


def _searched(p: DataFrame) -> DataFrame:
    pages = p.groupBy("p_name", "p_type", "p_size").agg(F.array_join(F.collect_list(F.concat(F.lit('<li><a href="/'), F.col("p_partkey").cast("string"), F.lit('"><b>'), "p_name", F.lit("</b></a></li>"))), "").alias("body"))
    pages = pages.select(F.concat_ws("|", "p_name", "p_type", F.col("p_size").cast("string")).alias("url"), "body", F.col("p_size").cast("string").alias("code"))
    return cn.read_search(pages, SHOPS["search"]).select("link", "name", F.array_join("barcodes", ",").alias("codes"))


def _sold(p: DataFrame):
    """Names of parts as shops would write them: a size in one of several notations, a code, stop words and a single letter."""
    n = F.col("p_size").cast("string")
    size = F.when(F.col("p_size") < 10, F.concat(n, F.lit(" KG"))).when(F.col("p_size") < 20, F.concat(F.lit("2 x "), n, F.lit(" Lt."))).when(F.col("p_size") < 30, F.lit("0,75 litre")).when(F.col("p_size") < 40, F.concat(n, F.lit("'lü"))).otherwise(F.concat(F.lit("3 kg "), n, F.lit(" Yıkama")))
    return F.concat_ws(" ", "p_name", F.lit("ve"), size, F.lit("12345678 x Set"))


def _named_docs(p: DataFrame) -> DataFrame:
    """Parts as docs of the matching stages: name, a size for some, a barcode for a few."""
    size = F.when(F.col("p_size") > 25, F.array(F.struct(F.col("p_size").cast("double").alias("digits"), F.lit("gr").alias("unit")))).otherwise(F.array().cast("array<struct<digits:double,unit:string>>"))
    return p.select(
        F.col("p_partkey").cast("string").alias("doc_id"), F.col("p_partkey").alias("ord"), F.concat_ws(" ", F.lower("p_type"), "p_name", F.lower("p_brand")).alias("clean_name"), size.alias("sizes"),
        F.when(F.col("p_size") == 1, F.array(F.lit("1"))).otherwise(F.array().cast("array<string>")).alias("barcodes"), F.lit(False).alias("is_clone"), F.lit(None).cast("map<string,string>").alias("promoted"), F.lit(None).cast("string").alias("link"))


def _exact(p: DataFrame) -> DataFrame:
    """Which docs exact names link, as ends of edges."""
    d = _named_docs(p)
    e = edges.exact_name_edges(d, edges.barcode_connected(d))
    return e.select(F.col("src").alias("doc_id")).union(e.select("dst")).distinct()


def _promoted(r: DataFrame) -> DataFrame:
    """Docs whose links are promoted by the doc of the same SKU that comes before them."""
    d = r.where("doc_id is not null and link is not null and sku_id is not null").select("doc_id", "ord", F.concat("link", F.lit("?utm_source=x")).alias("page"), "link", "sku_id")
    d = d.join(d.groupBy("doc_id").agg(F.max("ord").alias("ord")), ["doc_id", "ord"], "left_semi")
    first = d.groupBy("sku_id").agg(F.min("doc_id").alias("by"))
    refs = d.join(first, "sku_id").where("doc_id <> by").groupBy("by").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("doc_id", "page")))).alias("promoted"))
    docs = d.join(refs.withColumnRenamed("by", "doc_id"), "doc_id", "left").select("doc_id", "ord", T.strip_trailing_slash("link").alias("link"), F.array().cast("array<string>").alias("barcodes"), "promoted")
    return edges.promoted_edges(docs, docs.limit(0).select("doc_id"))


def _sub_brand_rows(k: DataFrame) -> DataFrame:
    return _rows(k).select("subcat", "brand", "uid", "name").distinct()


WG = f"""{ROWS}, d as (select distinct subcat, brand, uid, name, row_number() over () as nid from (select distinct * from rows)), tot as (select subcat, brand, uid, count(*) as names from d group by 1, 2, 3),
  pr as (select subcat, brand, uid, nid, trim(replace(unnest(case when len({WS('name')}) > 0 then list_transform(range(1, 5), lambda i: array_to_string({WS('name')}[1:i], ' ')) else [] end), brand, '')) as wg from d),
  c as (select subcat, brand, uid, nid, wg, count(*) as c from pr where wg <> '' group by all), w as (select *, case when len({WS('wg')}) > 1 then round(c * power(1.25, len({WS('wg')})), 2) else cast(c as double) end as s from c),
  g as (select subcat, brand, uid, wg, round(sum(s), 2) as count from w group by 1, 2, 3, 4), wgc as (select g.* from g join tot using (subcat, brand, uid) where count >= names / 2)"""
SB = f"""{WG}, per as (select subcat, brand, wg, cast(trunc(sum(count)) as int) as count, count(*) as products from wgc group by 1, 2, 3), br as (select subcat, wg, count(distinct brand) as brands from per group by 1, 2),
  one as (select subcat, brand, wg, count from per join br using (subcat, wg) where brands < 2 and length(wg) >= 3 and products >= 1),
  runs as (select subcat, brand, wg as long, count as lc, unnest(flatten(list_transform(range(1, len({WS('wg')}) + 1), lambda i: list_transform(range(i, len({WS('wg')}) + 1), lambda j: array_to_string({WS('wg')}[i:j], ' '))))) as wg from one),
  worse as (select distinct one.subcat, one.brand, one.wg from one join runs using (subcat, brand, wg) where one.count < lc and one.wg <> long), sb as (select * from one anti join worse using (subcat, brand, wg))"""
PAGE_SQL = "select '{base}/' || p_partkey as link, p_name as name, round(p_retailprice, 2) as price, {codes} as codes from part"
COUNTS = "cnt as (select lower(p_name) || ' ' || lower(p_type) as s, count(*) as n from part group by 1)"


def _part_counts(p: DataFrame) -> DataFrame:
    return p.groupBy(F.concat_ws(" ", F.lower("p_name"), F.lower("p_type")).alias("subcat")).agg(F.count(F.lit(1)).alias("n"))


def _stems(p: DataFrame) -> DataFrame:
    """Names with and without their last letters, with counts."""
    n = F.concat_ws("", F.lower("p_type"), F.regexp_replace("p_name", " ", ""))
    return p.groupBy(F.when(F.col("p_size") < 20, n).when(F.col("p_size") < 35, F.concat(n, F.lit("ler"))).otherwise(F.concat(n, F.lit("s"))).alias("subcat")).agg(F.count(F.lit(1)).alias("n"))


def _named(k: DataFrame) -> DataFrame:
    return k.where("name is not null and sku_id is not null").select(F.col("sku_id").alias("uid"), F.col("ord").alias("pos"), _low("name").alias("name"))


def _voted(k: DataFrame) -> DataFrame:
    return k.where("trim(category) <> '' and sku_id is not null").select(F.col("sku_id").alias("uid"), F.col("ord").alias("pos"), _low("category").alias("subcat"))


VOTES = "f as (select sku_id as uid, lower(replace(category, 'İ', 'i')) as subcat, count(*) as n, min(ord) as first from skus where trim(category) <> '' and sku_id is not null group by 1, 2)"
NAMED = f"nm as (select sku_id as uid, ord as pos, lower(replace(name, 'İ', 'i')) as name, {WS("lower(replace(name, 'İ', 'i'))")} as ws from skus where name is not null and sku_id is not null)"
_PAIRS = "list_zip(ws[i:i + len(s) - 1], s)"
_SHARED = "list_intersect(ws[i:i + len(s) - 1], s)"
PARTIAL = f"""{VOTES}, {NAMED}, cand as (select f.*, pos, ws, {WS('subcat')} as s from f join nm using (uid) where not contains(name, subcat)),
  found as (select *, list_filter(range(1, greatest(len(ws) - len(s) + 2, 1)), lambda i: (len({_SHARED}) > 1 or (len({_SHARED}) = 1 and length({_SHARED}[1]) > 3))
    and len(list_filter({_PAIRS}, lambda p: not (starts_with(p[1], p[2]) or starts_with(p[2], p[1])))) = 0 and len(list_filter({_PAIRS}, lambda p: p[1] <> p[2] and length(p[1]) = 1)) < 2) as hits from cand where len(s) > 1),
  partial as (select uid, subcat, array_to_string(ws[hits[1]:hits[1] + len(s) - 1], ' ') as win, row_number() over (partition by uid order by n desc, first, pos) as rn from found where len(hits) > 0)"""
CASCADE = f"""with {PARTIAL},
  lr as (select f.*, row_number() over (partition by uid order by n desc, first) as rn from f join nm using (uid) where subcat <> '' and contains(name, subcat) and (contains(subcat, ' ') or len(list_filter({WS('subcat')}, lambda t: not list_contains(ws, t))) = 0)),
  mj as (select uid, min(subcat) as subcat from (select *, max(n) over (partition by uid) as x from f) where n = x group by uid having count(*) = 1),
  gw as (select distinct uid, unnest(flatten(list_transform(range(1, len(ws)), lambda i: list_transform(range(i + 1, len(ws) + 1), lambda j: array_to_string(ws[i:j], ' '))))) as subcat from nm),
  gl as (select uid, subcat, row_number() over (partition by uid order by length(subcat) desc, subcat) as rn from gw where subcat in (select subcat from f)),
  every as (select uid, subcat, 'local_name' as src, 0 as r from lr where rn = 1 union all select uid, subcat, 'partial', 1 from partial where rn = 1 union all select uid, subcat, 'majority', 2 from mj union all select uid, subcat, 'global_name', 3 from gl where rn = 1),
  top as (select *, row_number() over (partition by uid order by r) as rn from every) select uid, subcat, src as subcat_source from top where rn = 1"""
FUNCTIONS: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    # text
    "text_stopwords": (_q(lambda p: p.select("p_partkey", F.array_join(T.drop_stopwords(T.tokens(F.concat_ws(" ", "p_name", F.lit("ve kg tuz ile tuz")))), " ").alias("t")), "part"), "select p_partkey, p_name || ' tuz tuz' as t from part"),
    "text_single_letters": (_q(lambda p: p.select("p_partkey", F.explode(T.tokens(F.concat_ws(" ", "p_name", F.lit("a 7 ş")))).alias("t")).select("p_partkey", "t", T.is_single_letter(F.col("t")).alias("is")), "part"), "select p_partkey, t, length(t) = 1 and t <> '7' as is from (select p_partkey, unnest(string_split(p_name, ' ') || ['a', '7', 'ş']) as t from part)"),
    "text_codes": (_q(lambda r: r.select("ord", F.explode("barcodes").alias("t")).where("t is not null").select("ord", T.is_barcode_token(F.col("t")).alias("is")), "raw_docs"), "select ord, regexp_matches(t, '^([0-9]{8}|[0-9]{10}|[0-9]{11}|[0-9]{13})$') as is from (select ord, unnest(barcodes) as t from raw_docs) where t is not null"),
    "text_mixed": (_q(lambda p: p.select("p_partkey", T.is_mixed_token(F.regexp_replace("p_brand", "#", "")).alias("is")), "part"), "select p_partkey, length(p_brand) > 6 as is from part"),
    "text_removed": (_q(lambda p: p.select("p_partkey", T.remove_substrings("p_name", F.array(F.lit("red"), F.lit("i"), F.lit(""))).alias("t")), "part"), "select p_partkey, trim(regexp_replace(replace(replace(p_name, 'red', ''), 'i', ''), ' +', ' ', 'g')) as t from part"),
    "text_squeezed": (_q(lambda p: p.select("p_partkey", T.squeeze(F.concat(F.lit(" \t"), F.regexp_replace("p_name", " ", " \n "))).alias("t")), "part"), "select p_partkey, p_name as t from part"),
    "text_folded": (_q(lambda p: p.select("p_partkey", T.accent_fold(F.concat("p_name", F.lit("Çığöşü ﬁ½Ａ"))).alias("t")), "part"), "select p_partkey, p_name || 'Cıgosu fi12A' as t from part"),
    "array_longest_first": (_q(lambda p: p.select("p_partkey", F.array_join(C.longest_first(F.split("p_name", " ")), ",").alias("t")), "part"), "select p_partkey, case when length(string_split(p_name, ' ')[2]) > length(string_split(p_name, ' ')[1]) then string_split(p_name, ' ')[2] || ',' || string_split(p_name, ' ')[1] else replace(p_name, ' ', ',') end as t from part"),
    "array_deduped": (_q(lambda p: p.select("p_partkey", F.array_join(C.dedup_denull(F.array("p_type", F.lit(None), "p_name", "p_type")), ",").alias("t")), "part"), "select p_partkey, p_type || ',' || p_name as t from part"),
    "array_not_empty": (_q(lambda p: p.select("p_partkey", F.size(C.drop_empty(F.array("p_type", F.lit(None), F.lit(""), F.lit(" ")))).cast("long").alias("n")), "part"), "select p_partkey, 2 as n from part"),
    "map_overlaid": (_q(lambda r: r.select("ord", C.sorted_entries(C.overlay(F.col("promoted"), F.create_map(F.lit("paketci"), F.lit("-")))).alias("m")), "raw_docs"), "select ord, array_to_string(list_sort(list_transform(list_filter(coalesce(map_entries(promoted), []), lambda e: e.key <> 'paketci'), lambda e: e.key || '=' || e.value) || ['paketci=-']), ',') as m from raw_docs"),
    "lists_zipped": (_q(lambda p: p.select("p_partkey", F.split("p_name", " ").alias("a"), F.array("p_size", F.lit(0)).alias("b")).select("p_partkey", cn.zipped("a", "b")).select("p_partkey", "a", "b"), "part"), "select p_partkey, string_split(p_name, ' ')[i] as a, [p_size, 0][i] as b from part, (select unnest([1, 2]) as i)"),
    "price_locale_s": (_q(lambda p: p.select("p_partkey", locale_price(F.concat(F.translate(F.col("p_retailprice").cast("decimal(12,2)").cast("string"), ".", ","), F.lit(" TL")), "S").alias("p")), "part"), "select p_partkey, round(p_retailprice, 2) as p from part"),
    "price_locale_d": (_q(lambda p: p.select("p_partkey", locale_price(F.concat(F.col("p_retailprice").cast("int").cast("string"), F.lit(",25.x")), "D").alias("p")), "part"), "select p_partkey, trunc(p_retailprice) + 0.25 as p from part"),
    "url_codes": (_q(lambda p: p.select("p_partkey", url_barcode(F.concat(F.lit("/i/8690"), F.lpad(F.col("p_partkey").cast("string"), 9, "0"), F.lit("_2.jpg"))).alias("c")), "part"), "select p_partkey, '8690' || lpad(p_partkey::varchar, 9, '0') as c from part"),
    "rows_sliced": (_q(lambda o: o.orderBy("o_orderkey").offset(100).limit(50).select("o_orderkey"), "orders"), "select o_orderkey from orders order by o_orderkey limit 50 offset 100"),
    "sizes_made": (
        _q(lambda p: p.select("p_partkey", first_size_udf(T.clean_string(_sold(p))).alias("s")).select("p_partkey", "s.digits", "s.unit"), "part"),
        "select p_partkey, cast(case when p_size < 10 then p_size * 1000 when p_size < 20 then 2 * p_size * 1000 when p_size < 30 then 750 when p_size < 40 then p_size else p_size end as double) as digits, case when p_size < 10 then 'gr' when p_size < 30 then 'ml' when p_size < 40 then 'adet' else 'yıkama' end as unit from part",
    ),
    "names_made": (
        _q(lambda p: p.select("p_partkey", clean_name_udf(T.clean_string(_sold(p))).alias("c")).select("p_partkey", "c.clean_name", F.size("c.sizes").cast("long").alias("n_sizes"), F.array_join("c.codes", ",").alias("codes")), "part"),
        "select p_partkey, p_name || ' set' as clean_name, case when p_size >= 40 then 2 else 1 end as n_sizes, '12345678' as codes from part",
    ),
    "sql_functions": (
        lambda s, d: _in_sql(s, d),
        r"""select ord, regexp_replace(link, '/$', '') as link, round(try_cast(case when regexp_matches(p, '^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)$') then p end as double), 2) as price, coalesce(contains(lower(name), 'sabun') and list_contains(list_filter(regexp_split_to_array(trim(lower(name)), '\s+'), lambda t: t <> ''), 'sabun'), false) as soap
            from (select *, regexp_replace(lower(price), 'tl|₺|try|[ ]', '', 'g') as p from items)""",
    ),
    "category_order": (
        _q(lambda p: reports.category_tree(p.select(F.col("p_type").alias("cat"), F.col("p_brand").alias("subcat")), p.where("p_size < 3").groupBy(F.col("p_type").alias("cat")).agg(F.min("p_partkey").alias("place"), F.max("p_name").alias("icon"))).select("cat", C.sorted_text(F.col("children")).alias("children"), "place", "icon"), "part"),
        "select p_type as cat, string_agg(distinct p_brand, ',' order by p_brand) as children, min(p_partkey) filter (p_size < 3) as place, max(p_name) filter (p_size < 3) as icon from part group by 1",
    ),
    "promoted_allowed": (
        _q(lambda r: prep.promoted_links(r, ("paket", "kavsak")).where("promoted is not null").select("ord", C.sorted_entries(F.col("promoted")).alias("p")), "raw_docs"),
        "select ord, string_agg(e.key || '=' || regexp_replace(regexp_replace(e.value, '[?&](gclid|utm).*$', ''), '/$', ''), ',' order by e.key || '=' || e.value) as p from (select ord, unnest(map_entries(promoted)) as e from raw_docs) where contains(e.key, 'paket') or contains(e.key, 'kavsak') group by 1",
    ),
    "names_in_full": (
        _q(lambda k: enrich.names_in_full(_named(k), enrich.subcat_partial(_named(k), _voted(k))), "skus"),
        f"with {PARTIAL} select nm.uid, pos, case when win is not null then replace(name, win, p.subcat) else name end as name from nm left join (select * from partial where rn = 1) p using (uid)",
    ),
    # files and pages
    "files_json": (_q(_json, "part"), "select p_partkey, p_name, p_size from part"),
    "files_csv": (_q(_csv, "part"), "select p_partkey, p_name || ' \"a\", b' as p_name from part"),
    "files_sheet": (_q(_sheet, "part"), "select p_partkey, p_type from part"),
    "files_backup": (_q(_backup, "skus"), "select ord, sku_id, coalesce(cardinality(prices), -1) as n_prices from skus".replace("coalesce(cardinality(prices), -1)", "cardinality(prices)")),
    "csv_export": (_q(_export, "skus"), "select sku_id, coalesce(market, '') as market, ord from skus where sku_id is not null"),
    "pages_html": (_pages("html", "html"), PAGE_SQL.format(base="https://s", codes="'2000000' || lpad(p_partkey::varchar, 6, '0')")),
    "pages_json": (_pages("json", "json"), PAGE_SQL.format(base="", codes="''")),
    "pages_json_ld": (_pages("json_ld", "json_ld"), PAGE_SQL.format(base="", codes="''")),
    "pages_json_in_text": (_pages("json_in_text", "json_in_text"), PAGE_SQL.format(base="", codes="''")),
    "pages_html_in_json": (_pages("html_in_json", "html_in_json"), PAGE_SQL.format(base="", codes="''")),
    "pages_searched": (_q(_searched, "part"), "select '/' || min(p_partkey) as link, p_name as name, p_size::varchar as codes from part group by p_name, p_type, p_size having count(*) = 1"),
    "page_fields": (_q(lambda p: cn.page_fields(p.select(F.col("p_partkey").cast("string").alias("url"), F.concat(F.lit("<title>"), "p_name", F.lit("</title>\n<h1>"), "p_type", F.lit("</h1><a href=1><a class=x href=2>")).alias("body"))), "part"), "select p_partkey::varchar as url, p_name as title, p_type as h1, 2 as n_links from part"),
    # matching and products
    "edges_exact_name": (
        _q(_exact, "part"),
        """with d as (select p_partkey::varchar as id, array_to_string(list_sort(string_split(lower(p_type) || ' ' || p_name || ' ' || lower(p_brand), ' ')), ' ') as k, case when p_size > 25 then p_size end as s from part where p_size <> 1)
           select distinct a.id as doc_id from d a join d b on a.k = b.k and a.id <> b.id and (a.s = b.s or a.s is null or b.s is null)""",
    ),
    "edges_promoted": (
        _q(_promoted, "raw_docs"),
        r"""with d as (select doc_id, max(ord) as ord, arg_max(regexp_replace(link, '/$', ''), ord) as link, arg_max(sku_id, ord) as sku_id from (select * from raw_docs where doc_id is not null and link is not null and sku_id is not null) group by 1),
            f as (select sku_id, min(doc_id) as src from d group by 1), r as (select distinct src, d.link from d join f using (sku_id) where doc_id <> src), t as (select link, max(struct_pack(o := ord, d := doc_id)).d as dst from d group by 1),
            h as (select distinct src, dst from r join t using (link) where src <> dst) select any_value(src) as src, dst from h group by dst having count(*) = 1""",
    ),
    "docs_without_product_pages": (
        _q(lambda r: prep.without_product_links(prep.variant_pages(rebuild.last_rows(r)), prep.product_links(prep.variant_pages(rebuild.last_rows(r)), CFG.product_market, CFG.variant_marker)).groupBy("market").agg(F.count(F.lit(1)).alias("n")), "raw_docs"),
        """with r as (select doc_id, arg_max(struct_pack(l := link, v := variants, m := market), ord) as r from raw_docs where doc_id is not null group by 1),
           p as (select regexp_replace(e.key, '/$', '') as link, m from (select unnest(map_entries(r.v)) as e, r.m as m from r) where regexp_replace(e.key, '/$', '') not in (select regexp_replace(r.l, '/$', '') from r where r.l is not null) union all select r.l, r.m from r),
           g as (select distinct split_part(regexp_replace(link, '/$', ''), '?', 1) as link from p where m = 'sahilmar' and contains(link, '?v=') and not regexp_matches(string_split(split_part(link, '?', 1), '/')[-1], '^[0-9]*$'))
           select m as market, count(*) as n from p where link is null or link not in (select link from g) group by 1""",
    ),
    "product_containment": (
        _q(lambda k: products.containment_edges(k.where("sku_id is not null and name is not null").groupBy("sku_id").agg(F.collect_set(_low("name")).alias("clean_names"))), "skus"),
        f"""with n as (select distinct sku_id, lower(replace(name, 'İ', 'i')) as name from skus where sku_id is not null and name is not null), m as (select sku_id, count(*) as m from n group by 1),
            t as (select sku_id, t, count(*) as c from (select sku_id, unnest(list_distinct({WS('name')})) as t from n) group by 1, 2), g as (select sku_id, list(t) as ts, coalesce(list(t) filter (c = m), []) as common from t join m using (sku_id) group by 1),
            h as (select a.sku_id as src, b.sku_id as dst, row_number() over (partition by a.sku_id order by len(b.common) desc, b.sku_id) as rn from g a join g b on a.sku_id <> b.sku_id and list_has_all(b.ts, a.ts) and list_has_all(a.ts, b.common)) select src, dst from h where rn = 1""",
    ),
    "sku_id_choice": (
        _q(lambda r: reduce.sku_ids(r.where("doc_id is not null and market is not null").select(F.col("market").alias("component"), "doc_id", "sku_id", "ord", F.lit(False).alias("is_clone"))), "raw_docs"),
        """with d as (select market as c, doc_id, sku_id, ord from raw_docs where doc_id is not null and market is not null), f as (select c, min(doc_id) as least from d group by 1), p as (select c, sku_id, count(*) as n, min(ord) as first from d where sku_id <> '' group by 1, 2),
           t as (select *, row_number() over (partition by c order by n desc, first) as rn from p), w as (select t.c, t.sku_id, row_number() over (partition by t.sku_id order by f.least) as r from t join f using (c) where rn = 1), won as (select c, sku_id from w where r = 1)
           select c as component, sku_id from won union all select c, least from f where c not in (select c from won) and least not in (select sku_id from won)""",
    ),
    # enrichment
    "subcat_partial": (_q(lambda k: enrich.subcat_partial(_named(k), _voted(k)), "skus"), f"with {PARTIAL} select uid, subcat, win as window from partial where rn = 1".replace("as window", 'as "window"')),
    "values_cleaned": (
        _q(lambda k: prep.with_clean(k.select("ord", "category"), "category", k.where("category is not null").select(F.col("category").alias("original"), F.concat(F.lit("> "), "category").alias("clean")).distinct().where(F.length("original") > 5)), "skus"),
        "select ord, case when length(category) > 5 then '> ' || category end as category from skus",
    ),
    "merge_prefix_counts": (
        _q(lambda p: enrich.merge_by_prefix(_stems(p)), "part"),
        """with c as (select case when p_size < 20 then x when p_size < 35 then x || 'ler' else x || 's' end as s, count(*) as n from (select *, lower(p_type) || replace(p_name, ' ', '') as x from part) group by 1),
           h as (select a.s, b.s as o, row_number() over (partition by a.s order by b.n desc, b.s) as rn from c a join c b on starts_with(b.s, a.s) and length(b.s) - length(a.s) between 1 and 3 where length(a.s) > 7) select s as subcat, o as merged from h where rn = 1""",
    ),
    "merge_subset_counts": (
        _q(lambda p: enrich.merge_by_subset(_part_counts(p).union(p.groupBy(F.lower("p_name").alias("subcat")).agg(F.count(F.lit(1)).alias("n")))), "part"),
        f"""with {COUNTS}, m as (select s, n from cnt union all select lower(p_name), count(*) from part group by 1), t as (select s, n, list_distinct(string_split(s, ' ')) as ts from m),
           h as (select a.s, b.s as o, row_number() over (partition by a.s order by b.n desc, b.s) as rn from t a join t b on a.s <> b.s and list_has_all(a.ts, b.ts) where len(b.ts) < len(a.ts) or b.n > a.n or (b.n = a.n and b.s < a.s)) select s as subcat, o as merged from h where rn = 1""",
    ),
    "word_groups": (_q(lambda k: enrich.word_group_counts(_sub_brand_rows(k)), "skus"), f"with {WG} select subcat, brand, uid, wg, count from wgc"),
    "sub_brand_groups": (_q(lambda k: enrich.sub_brand_candidates(enrich.word_group_counts(_sub_brand_rows(k))), "skus"), f"with {SB} select subcat, brand, wg, count from sb"),
    "sub_brand_choice": (
        _q(lambda k: enrich.choose_sub_brand(_sub_brand_rows(k), enrich.sub_brand_candidates(enrich.word_group_counts(_sub_brand_rows(k)))), "skus"),
        f"with {SB}, hit as (select d.uid, sb.wg, row_number() over (partition by d.uid order by sb.count desc, sb.wg) as rn from d join sb using (subcat, brand) where contains(d.name, sb.wg) and len(list_filter({WS('sb.wg')}, lambda t: not list_contains({WS('d.name')}, t))) = 0) select uid, wg as sub_brand from hit where rn = 1",
    ),
    "subcat_topics": (_q(lambda k: topics.subcat_topics(enrich.topic_input(_rows(k)).withColumn("uid", F.monotonically_increasing_id())), "skus"), None),
    "nmf_topics": (_q(topics.nmf_topics, "documents"), None),
    "lsi_topics": (_q(topics.lsi_topics, "documents"), None),
    "search_paged": (
        _q(lambda p: search.keyword_search(p.select(F.col("p_partkey").alias("sku_id"), F.col("p_name").alias("name"), F.array("p_type").alias("markets")), "widgett red", ["SMALL", "ECONOMY"], limit=5, offset=2), "part"),
        """with w as (select p_partkey as sku_id, p_name as name, unnest(list_distinct(string_split(p_name, ' '))) as w from part where p_type in ('SMALL', 'ECONOMY')), q as (select unnest(['widgett', 'red']) as q),
           h as (select sku_id, name, q, 2 * count(*) as c from w join q on levenshtein(w, q) <= case when length(q) < 3 then 0 when length(q) <= 5 then 1 else 2 end group by 1, 2, 3)
           select sku_id, name, sum(c) as score from h group by 1, 2 having count(*) = 2 order by score desc, sku_id limit 5 offset 2""",
    ),
}


PLAIN_COUNTS = r"m as (select s, count(*) as n from (select trim(regexp_replace(strip_accents(replace(lower(replace(category, 'İ', 'i')), 'ı', 'i')), '\s+', ' ', 'g')) as s from skus where category is not null) where s <> '' group by 1)"
#: SQL of queries that stand in ``queries``.
MORE_SQL = {
    "subcat_cascade": CASCADE,
    "sub_brands": f"with {SB} select subcat, brand, wg, count from sb".replace(ROWS, "rows as (select p_type as subcat, p_brand as brand, p_partkey::varchar as uid, p_name as name from part)"),
    "subcat_merge_prefix": f"with {PLAIN_COUNTS}, h as (select a.s, b.s as o, row_number() over (partition by a.s order by b.n desc, b.s) as rn from m a join m b on starts_with(b.s, a.s) and length(b.s) - length(a.s) between 1 and 3 where length(a.s) > 7) select s as subcat, o as merged from h where rn = 1",
    "subcat_merge_subset": f"""with {PLAIN_COUNTS}, t as (select s, n, list_distinct(string_split(s, ' ')) as ts from m where contains(s, ' ')),
        h as (select a.s, b.s as o, row_number() over (partition by a.s order by b.n desc, b.s) as rn from t a join t b on a.s <> b.s and list_has_all(a.ts, b.ts) where len(b.ts) < len(a.ts) or b.n > a.n or (b.n = a.n and b.s < a.s)) select s as subcat, o as merged from h where rn = 1""",
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, (f, _) in FUNCTIONS.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for k, (_, s) in FUNCTIONS.items() if s} | MORE_SQL
