"""Queries of the core and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerloom import catalog_queries, function_queries, stream_queries
from offerloom.constants import Config
from offerloom.functions import collections as C
from offerloom.functions import text as T
from offerloom.functions.barcode import clean_barcodes, gtin, search_barcode
from offerloom.functions.names import first_size_udf
from offerloom.functions.price import convert_price, locale_price
from offerloom.operators import edges, enrich, graph, history, prep, products, reports, search, sync, topics, units
from offerloom.plans import rebuild
from offerloom.sources.tables import table

Q = dict[str, Callable[[SparkSession, str], DataFrame]]


def _q(make: Callable[..., DataFrame], *tables: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: make(*(table(spark, sf_dir, t) for t in tables))


def problem_queries() -> Q:
    return {
        "p3_found": _q(units.common_quantities, "raw_docs", "skus"),
        "p3_units": _q(units.conversions, "raw_docs", "skus"),
        "p5_found": _q(lambda i, r: history.versions(i, r).select("link", F.floor(F.col("at") / 1_000_000).cast("long").alias("valid_from")), "items", "raw_docs"),
        "p5_history": _q(history.history, "items", "raw_docs"),
    }


P5_FOUND = r"""
with s as (
  select regexp_replace(link, '/$', '') as link, epoch_us(ts) as tm, ord, price, coalesce(out_of_stock, false) as oos from items
  union all
  select regexp_replace(link, '/$', ''), epoch_us(cast(regexp_replace(regexp_replace(regexp_replace(regexp_replace(e.value, 'T', ' '), 'Z$', ''), '^(\d+)\.(\d+)\.(\d{4})', '\3-\2-\1'), '^(\d{4})/(\d+)/(\d+)', '\1-\2-\3') as timestamp)), ord, e.key, false
  from (select link, ord, unnest(map_entries(historical_prices)) as e from raw_docs)),
st as (select link, tm, ord, case when oos or regexp_matches(price, '(?i)stokta\s+yok') then -1
         else try_cast(replace(regexp_replace(lower(price), 'tl|try|[₺\s]', '', 'g'), ',', '.') as decimal(18,4)) end as state from s where link is not null and tm is not null),
one as (select link, tm, arg_max(state, ord) as state from st where state = -1 or state > 0 group by link, tm),
v as (select *, lag(state) over (partition by link order by tm) as before from one)
select link, cast(floor(tm / 1000000) as bigint) as valid_from from v where before is null or before <> state
"""


CFG = catalog_queries.CFG


def _subcat_counts(d: DataFrame) -> DataFrame:
    c = d.select(T.plain("category").alias("subcat")).where("subcat <> ''")
    return c.groupBy("subcat").agg(F.count(F.lit(1)).alias("n"))


def _low(c: str):
    """Lower case in which dotted capital I is one letter."""
    return F.lower(F.translate(c, "İ", "i"))


def _names(d: DataFrame) -> DataFrame:
    """``uid, pos, name`` of SKU records."""
    return d.where("name is not null and sku_id is not null").select(F.col("sku_id").alias("uid"), F.col("ord").alias("pos"), _low("name").alias("name"))


def _votes(d: DataFrame, col: str, to: str) -> DataFrame:
    return d.where(f"trim({col}) <> '' and sku_id is not null").select(F.col("sku_id").alias("uid"), F.col("ord").alias("pos"), _low(col).alias(to))


def _snapshots(i: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The last item of each link in the first and in the second half of the time."""
    half = F.lit("2020-04-01").cast("timestamp_ntz")
    last = lambda d: d.where("link is not null").groupBy("link").agg(F.max(F.struct("ts", "ord", "price", "market")).alias("r")).select("link", F.col("r.price").alias("price"), F.col("r.market").alias("market"))
    return last(i.where(F.col("ts") < half)), last(i.where(F.col("ts") >= half))


def reference_queries() -> Q:
    txt = C.sorted_text
    return {
        # text, arrays, numbers
        "text_clean": _q(lambda p: p.select("p_partkey", T.clean_string("p_name").alias("clean")), "part"),
        "text_singular": _q(lambda p: p.select("p_partkey", T.singular(F.lower("p_type")).alias("one")), "part"),
        "text_windows": _q(lambda p: p.select("p_partkey", F.explode(T.windows(T.tokens("p_name"))).alias("w")), "part"),
        "text_prefixes": _q(lambda p: p.select("p_partkey", F.explode(T.prefixes(T.tokens("p_name"), 4)).alias("w")), "part"),
        "text_sorted_words": _q(lambda p: p.select("p_partkey", T.sorted_words("p_name").alias("key")), "part"),
        "text_contains_words": _q(lambda r: r.where(T.contains_words(F.lower("name"), F.lit("sabun"))).select("ord"), "raw_docs"),
        "category_parts": _q(lambda r: r.select("ord", F.explode("categories").alias("c")).select("ord", F.explode(T.category_parts("c")).alias("part")), "raw_docs"),
        "clean_links": _q(lambda r: r.select("ord", T.strip_trailing_slash("link").alias("link")), "raw_docs"),
        "tracking_links": _q(lambda r: r.select("ord", F.explode("promoted").alias("seller", "l")).select("ord", "seller", T.strip_tracking("l").alias("link")), "raw_docs"),
        "barcode_clean": _q(lambda r: r.where("barcodes is not null").select("ord", txt(clean_barcodes(F.col("barcodes"))).alias("codes")), "raw_docs"),
        "barcode_gtin": _q(lambda r: r.select("ord", F.explode("barcodes").alias("b")).select("ord", gtin(F.col("b")).alias("g")).where("g is not null"), "raw_docs"),
        "barcode_queue": _q(lambda r: r.select(F.explode("barcodes").alias("b")).distinct().select(search_barcode(F.col("b")).alias("code")).where("code is not null").distinct(), "raw_docs"),
        "price_convert": _q(lambda i: i.select("ord", convert_price(F.col("price")).alias("p")), "items"),
        "price_locale_t": _q(lambda i: i.select("ord", locale_price(F.col("price"), "T").alias("p")), "items"),
        "size_first": _q(lambda r: r.where("name is not null").select("ord", first_size_udf(T.clean_string("name")).alias("s")).select("ord", "s.digits", "s.unit").where("digits is not null"), "raw_docs"),
        "names_cleaned": _q(lambda r: prep.with_clean_names(r.select("ord", "name", "barcodes")).select("ord", "clean_name", F.size("sizes").alias("n_sizes")), "raw_docs"),
        "array_top2": _q(lambda o: o.groupBy("o_custkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", "o_orderpriority"))), lambda s: s["o_orderpriority"]).alias("a")).select("o_custkey", F.array_join(C.most_common(F.col("a"), 2), ",").alias("top2")), "orders"),
        "array_majority": _q(lambda o: o.groupBy("o_custkey").agg(F.collect_list("o_orderpriority").alias("a")).select("o_custkey", C.majority(F.col("a")).alias("m")), "orders"),
        # preparation
        "docs_keyed": _q(lambda r: prep.keyed_docs(r).select("doc_id", "ord", "link"), "raw_docs"),
        "docs_cloned": _q(lambda r: prep.with_clones(r.select("doc_id", "ord", "barcodes")).select("doc_id", "ord", "is_clone", txt(F.col("barcodes")).alias("codes")), "raw_docs"),
        "docs_coverage": _q(lambda r: prep.coverage(r, ["name", "brand", "color", "sku_id"]), "raw_docs"),
        "brands_bad": _q(lambda r: r.where("brand is not null").select("ord", prep.is_bad_brand(F.lower("brand")).alias("bad")), "raw_docs"),
        "subcats_bad": _q(lambda k: k.where("category is not null").select("ord", prep.is_bad_subcat(F.lower("category")).alias("bad")), "skus"),
        "in_stock": _q(lambda r: r.where(~F.col("out_of_stock").eqNullSafe(True)).groupBy("market").agg(F.count(F.lit(1)).alias("n")), "raw_docs"),
        "no_barcodes": _q(lambda r: r.where("barcodes is null").select("ord"), "raw_docs"),
        # graph and SKUs
        "barcode_components": _q(lambda r: graph.components(edges.barcode_edges(r.select("doc_id", clean_barcodes(F.col("barcodes")).alias("barcodes")))).select(F.col("node").alias("doc_id"), "component"), "raw_docs"),
        "sku_edges": _q(lambda r: edges.staged_edges(rebuild.prepared(r, CFG), CFG.link_key).groupBy("stage").agg(F.count(F.lit(1)).alias("n")), "raw_docs"),
        "sku_rows": _q(lambda r: rebuild.skus(r, CFG).select("sku_id", "name", "best_price", "market_count", "size", "unit_price", "tags"), "raw_docs"),
        "sku_products": _q(lambda r: rebuild.with_products(rebuild.skus(r, CFG), r, CFG).select("sku_id", "product_id"), "raw_docs"),
        "product_rows": _q(lambda k: products.product_rows(k.where("sku_id is not null").select("sku_id", "product_id", F.array_compact(F.array("name")).alias("clean_names"), F.array_compact(F.array("brand")).alias("brands"), F.array_compact(F.array("color")).alias("colors"), F.coalesce("barcodes", F.array().cast("array<string>")).alias("barcodes"))).select("uid", "kind", F.size("clean_names").cast("long").alias("n_names"), F.size("sku_ids").cast("long").alias("n_skus")), "skus"),
        "export_rows": _q(lambda k, r: products.export_rows(k, r).select("doc_id", "sku_id", "category").distinct(), "skus", "raw_docs"),
        # enrichment
        "brand_freq": _q(lambda r: enrich.frequencies(r.select(_low("brand").alias("b")), "b"), "raw_docs"),
        "prefix_freq": _q(lambda p: enrich.prefix_frequencies(p.select(F.col("p_name").alias("name"))), "part"),
        "root_brands": _q(lambda p: enrich.root_brands(enrich.prefix_frequencies(p.select(F.col("p_name").alias("name"))).withColumnRenamed("prefix", "brand")), "part"),
        "possible_subcats": _q(lambda p: enrich.possible_subcats(p.select(F.col("p_brand").alias("brand"), F.col("p_type").alias("subcat"))).select("brand", txt(F.col("subcats")).alias("subcats")), "part"),
        "brand_choice": _q(lambda k: enrich.choose_brand(_names(k), _votes(k, "brand", "brand")), "skus"),
        "color_choice": _q(lambda k: enrich.choose_color(_names(k), _votes(k, "color", "color")), "skus"),
        "subcat_local": _q(lambda k: enrich.subcat_in_names(_names(k), _votes(k, "category", "subcat")), "skus"),
        "subcat_majority": _q(lambda k: enrich.subcat_majority(_votes(k, "category", "subcat")), "skus"),
        "subcat_global": _q(lambda k: enrich.subcat_global(_names(k), _votes(k, "category", "subcat")), "skus"),
        "subcat_cascade": _q(lambda k: enrich.choose_subcat(_names(k), _votes(k, "category", "subcat")), "skus"),
        "subcat_merge_prefix": _q(lambda k: enrich.merge_by_prefix(_subcat_counts(k)), "skus"),
        "subcat_merge_subset": _q(lambda k: enrich.merge_by_subset(_subcat_counts(k)), "skus"),
        "sub_brands": _q(lambda p: enrich.sub_brand_candidates(enrich.word_group_counts(p.select(F.col("p_type").alias("subcat"), F.col("p_brand").alias("brand"), F.col("p_partkey").cast("string").alias("uid"), F.col("p_name").alias("name")))), "part"),
        "token_brands": _q(lambda p: enrich.token_brand_counts(p.select(F.col("p_type").alias("subcat"), F.col("p_brand").alias("brand"), F.col("p_name").alias("name"))), "part"),
        # sync
        "upsert": _q(lambda i: sync.upsert(*_snapshots(i), "link"), "items"),
        "diff": _q(lambda i: sync.diff(*_snapshots(i), "link", ["price", "market"]), "items"),
        "price_log": _q(lambda i: sync.price_log(i), "items"),
        "out_of_stock_marks": _q(lambda r, i: sync.mark_out_of_stock(r.select("ord", "link", "market", "out_of_stock"), i.select("link"), "kavsak"), "raw_docs", "items"),
        # serving and reports
        "search_keyword": _q(lambda k: search.keyword_search(k, "sivi sabun"), "skus"),
        "search_barcode": _q(lambda k: search.by_barcodes(k, ["2000000015828", "2000000004969"]).select("ord"), "skus"),
        "inverted_index": _q(lambda p: search.inverted_index(p, "p_partkey", "p_name"), "part"),
        "similar_names": _q(lambda k: search.similar_pairs(k.select(F.lower("brand").alias("name")), 0.8), "skus"),
        "market_stats": _q(reports.market_stats, "raw_docs"),
        "barcode_classes": _q(lambda r: reports.barcode_classes(r, ["kavsak", "pirilti", "bakkalim"], ["evrenmar", "goncashop"]), "raw_docs"),
        "deals": _q(lambda k: reports.deals(k.select(F.concat("sku_id", F.lit("/"), F.col("ord").cast("string")).alias("sku_id"), "prices"), Config(deal_share=0.95, deal_prices=3)), "skus"),
        "category_tree": _q(lambda p: reports.category_tree(p.select(F.col("p_brand").alias("cat"), F.col("p_type").alias("subcat"))).select("cat", txt(F.col("children")).alias("children")), "part"),
        "leaf_categories": _q(lambda n, r: reports.leaf_categories(n.select((F.col("n_nationkey") + 100).alias("id"), F.col("n_regionkey").alias("parent")).union(r.select("r_regionkey", F.lit(None).cast("int")))).select("id"), "nation", "region"),
        "availability": _q(lambda r: reports.availability(r.groupBy("brand").pivot("market", ["kavsak", "pirilti", "evrenmar"]).agg(F.lit(1)).where("brand is not null"), "brand").select("brand", txt(F.col("markets")).alias("markets")), "raw_docs"),
        # learners
        "predict_subcats": _q(lambda k: topics.predict_labels(k.select(F.lower("name").alias("name"), F.lower("category").alias("subcat")).where("trim(subcat) <> ''"), k.where("category is null").select(F.col("ord").cast("string").alias("uid"), F.lower("name").alias("name"))), "skus"),
        "tfidf_top": _q(lambda d: topics.top_tfidf(d, "source", "text"), "documents"),
        "lda_topics": _q(topics.lda_topics, "documents"),
    }


_W = "string_split(p_name, ' ')"
_TOP = "row_number() over (partition by uid order by"
ORACLES = {
    "text_clean": "select p_partkey, trim(regexp_replace(regexp_replace(replace(lower(p_name), '-', ' '), '[^a-z0-9,. ]', '', 'g'), ' +', ' ', 'g')) as clean from part",
    "text_singular": "select p_partkey, left(lower(p_type), greatest(length(p_type) - 4, 0)) || replace(replace(replace(replace(right(lower(p_type), 4), 'leri', ''), 'lari', ''), 'ler', ''), 'lar', '') as one from part",
    "text_windows": f"select p_partkey, unnest(flatten(list_transform(range(1, len({_W}) + 1), lambda i: list_transform(range(i, len({_W}) + 1), lambda j: array_to_string({_W}[i:j], ' '))))) as w from part",
    "text_prefixes": f"select p_partkey, unnest(list_transform(range(1, 5), lambda i: array_to_string({_W}[1:i], ' '))) as w from part",
    "text_sorted_words": f"select p_partkey, array_to_string(list_sort({_W}), ' ') as key from part",
    "text_contains_words": r"select ord from raw_docs where list_contains(list_filter(regexp_split_to_array(lower(name), '\s+'), lambda t: t <> ''), 'sabun')",
    "category_parts": "select ord, trim(unnest(regexp_split_to_array(c, '/|,|&| ve | and '))) as part from (select ord, unnest(categories) as c from raw_docs)",
    "clean_links": "select ord, regexp_replace(link, '/$', '') as link from raw_docs",
    "tracking_links": "select ord, e.key as seller, regexp_replace(regexp_replace(e.value, '[?&](gclid|utm).*$', ''), '/$', '') as link from (select ord, unnest(map_entries(promoted)) as e from raw_docs)",
    "barcode_clean": r"""with b as (select ord, unnest(barcodes) as b from raw_docs), t as (select ord, trim(unnest(string_split(b, ','))) as t from b),
        k as (select distinct ord, case when length(t) in (8, 13) then t else right(t, 13) end as c from t where regexp_matches(t, '^([0-9]{8}|[0-9]{13}|0[1-9][0-9]{12})$'))
        select r.ord, coalesce(string_agg(c, ',' order by c), '') as codes from raw_docs r left join k using (ord) where barcodes is not null group by r.ord""",
    "barcode_gtin": r"""with d as (select ord, ltrim(regexp_replace(b, '[^0-9]', '', 'g'), '0') as g from (select ord, unnest(barcodes) as b from raw_docs)), p as (select *, lpad(g, 14, '0') as p from d where length(g) between 8 and 14)
        select ord, g from p where (10 - list_sum(list_transform(range(1, 14), lambda i: cast(substr(p, i, 1) as int) * (case when i % 2 = 1 then 3 else 1 end))) % 10) % 10 = cast(substr(p, 14, 1) as int)""",
    "barcode_queue": "select distinct case when left(b, 1) <> '0' then b when b = '' then b when length(b) = 14 and left(b, 2) <> '00' then right(b, 13) end as code from (select unnest(barcodes) as b from raw_docs) where not (left(b, 1) = '0' and not (length(b) = 14 and left(b, 2) <> '00'))",
    "price_convert": "select ord, round(try_cast(case when regexp_matches(s, '^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)$') then s end as double), 2) as p from (select ord, regexp_replace(lower(price), 'tl|₺|try|[ ]', '', 'g') as s from items)",
    "price_locale_t": "select ord, round(try_cast(case when regexp_matches(s, '^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)$') then s end as double), 2) as p from (select ord, regexp_replace(lower(replace(replace(price, '.', ''), ',', '.')), 'tl|₺|try|[ ]', '', 'g') as s from items)",
    "array_top2": "with c as (select o_custkey, o_orderpriority as p, count(*) as n, min(o_orderkey) as f from orders group by all), r as (select *, row_number() over (partition by o_custkey order by n desc, f) as rn from c) select o_custkey, string_agg(p, ',' order by rn) as top2 from r where rn <= 2 group by 1",
    "array_majority": "with c as (select o_custkey, o_orderpriority as p, count(*) as n from orders group by all), m as (select *, max(n) over (partition by o_custkey) as x from c), k as (select o_custkey, min(p) as p, count(*) as k from m where n = x group by 1) select o_custkey, case when k = 1 then p end as m from k",
    "docs_keyed": "select doc_id, ord, regexp_replace(link, '/$', '') as link from raw_docs where doc_id is not null and link is not null",
    "docs_cloned": "select doc_id, ord, false as is_clone, array_to_string(list_sort(barcodes), ',') as codes from raw_docs where coalesce(len(barcodes), 0) <= 1 union all select doc_id || '+clone' || (i - 1), ord, true, barcodes[i] from (select doc_id, ord, barcodes, unnest(range(1, len(barcodes) + 1)) as i from raw_docs where len(barcodes) > 1)",
    "docs_coverage": "select 'name' as field, count(name) as n_set, count(*) as n_rows from raw_docs union all select 'brand', count(brand), count(*) from raw_docs union all select 'color', count(color), count(*) from raw_docs union all select 'sku_id', count(sku_id), count(*) from raw_docs",
    "brands_bad": "select ord, b = '' or b in ('dr', 'my') or contains(b, 'brn ') or contains(b, 'markasiz') or contains(b, 'erkek') or contains(b, 'kadin') or contains(b, ' adet') as bad from (select ord, lower(brand) as b from raw_docs where brand is not null)",
    "subcats_bad": "select ord, c = '' or regexp_matches(c, '^[0-9]+$') or length(c) > 40 or contains(c, 'indirim') or contains(c, '%') or contains(c, 'kampanya') or c in ('kozmetik', 'supermarket', 'gida', 'el', 'erkek', 'bakim', 'icecek', 'sivi', 'kati', 'bebek', 'kedi', 'kopek', 'bakim urun', 'temizleyici') as bad from (select ord, lower(category) as c from skus where category is not null)",
    "in_stock": "select market, count(*) as n from raw_docs where out_of_stock is distinct from true group by market",
    "no_barcodes": "select ord from raw_docs where barcodes is null",
    "barcode_components": r"""with recursive b as (select doc_id, unnest(barcodes) as b from raw_docs), t as (select doc_id, trim(unnest(string_split(b, ','))) as t from b),
        k as (select distinct doc_id, case when length(t) in (8, 13) then t else right(t, 13) end as c from t where regexp_matches(t, '^([0-9]{8}|[0-9]{13}|0[1-9][0-9]{12})$')),
        h as (select doc_id as u, min(doc_id) over (partition by c) as v from k), e as (select u, v from h where u <> v union select v, u from h where u <> v),
        reach(doc_id, r) as (select u, u from e union select reach.doc_id, e.v from reach join e on reach.r = e.u) select doc_id, min(r) as component from reach group by doc_id""",
    "subcat_local": r"""with f as (select sku_id as uid, lower(category) as subcat, count(*) as n, min(ord) as first from skus where trim(category) <> '' and sku_id is not null group by 1, 2),
        n as (select sku_id as uid, lower(name) as name, list_filter(regexp_split_to_array(trim(lower(name)), '\s+'), lambda t: t <> '') as ws from skus where name is not null and sku_id is not null),
        h as (select f.*, row_number() over (partition by uid order by n desc, first) as rn from f join n using (uid) where contains(name, subcat) and (contains(subcat, ' ') or len(list_filter(list_filter(regexp_split_to_array(trim(subcat), '\s+'), lambda t: t <> ''), lambda t: not list_contains(ws, t))) = 0))
        select uid, subcat from h where rn = 1""",
    "product_rows": "select coalesce(product_id, sku_id) as uid, case when product_id is null then 'sku' else 'product' end as kind, count(name) as n_names, count(distinct sku_id) as n_skus from skus where sku_id is not null group by 1, 2",
    "export_rows": "select distinct d as doc_id, sku_id, category from (select unnest(doc_ids) as d, sku_id, category from skus) where not contains(d, 'clone') and d in (select doc_id from raw_docs)",
    "brand_freq": "select lower(brand) as b, count(*) as n from raw_docs where brand is not null group by 1",
    "prefix_freq": f"select prefix, count(*) as n from (select unnest(list_transform(range(1, 4), lambda i: array_to_string({_W}[1:i], ' '))) as prefix from part) group by 1",
    "root_brands": f"""with f as (select prefix as brand, count(*) as n from (select unnest(list_transform(range(1, 4), lambda i: array_to_string({_W}[1:i], ' '))) as prefix from part) group by 1),
        p as (select brand, n, unnest(range(1, len(string_split(brand, ' ')) + 1)) as i from f), j as (select p.brand, i, g.brand as root, g.n as gn from p join f g on g.brand = array_to_string(string_split(p.brand, ' ')[1:i], ' ') where g.n > p.n),
        b as (select *, row_number() over (partition by brand order by gn desc, i) as rn from j) select f.brand, coalesce(root, f.brand) as root from f left join b on b.brand = f.brand and rn = 1""",
    "possible_subcats": "select p_brand as brand, string_agg(distinct p_type, ',' order by p_type) as subcats from part group by 1",
    "brand_choice": f"""with v as (select sku_id as uid, lower(brand) as brand, count(*) as n, min(ord) as first from skus where trim(brand) <> '' and sku_id is not null group by 1, 2),
        b as (select sku_id as uid, array_to_string(list_filter(regexp_split_to_array(trim(lower(name)), '\\s+'), lambda t: t <> '')[1:4], ' ') as b from skus where name is not null and sku_id is not null),
        h as (select distinct uid, brand, 1 as hit from v join b using (uid) where contains(b, brand)),
        r as (select v.*, {_TOP} coalesce(hit, 0) desc, n desc, first) as rn from v left join h using (uid, brand)) select uid, brand from r where rn = 1""",
    "color_choice": f"with c as (select sku_id as uid, ord as cpos, lower(color) as color from skus where trim(color) <> '' and sku_id is not null), n as (select sku_id as uid, ord as pos, lower(name) as name from skus where name is not null and sku_id is not null), r as (select uid, color, {_TOP} pos, cpos) as rn from n join c using (uid) where contains(name, color)) select uid, color from r where rn = 1",
    "subcat_majority": "with f as (select sku_id as uid, lower(category) as subcat, count(*) as n from skus where trim(category) <> '' and sku_id is not null group by 1, 2), m as (select *, max(n) over (partition by uid) as x from f) select uid, min(subcat) as subcat from m where n = x group by uid having count(*) = 1",
    "token_brands": f"select p_type as subcat, t as token, count(distinct p_brand) as brands, count(*) as freq from (select distinct p_partkey, p_type, p_brand, unnest({_W}) as t from part) group by 1, 2",
    "upsert": "with l as (select link, ts, ord, price, market from items where link is not null), a as (select link, arg_max(struct_pack(price := price, market := market), struct_pack(ts := ts, ord := ord)) as r from l where ts < '2020-04-01' group by 1), b as (select link, arg_max(struct_pack(price := price, market := market), struct_pack(ts := ts, ord := ord)) as r from l where ts >= '2020-04-01' group by 1) select link, coalesce(b.r.price, a.r.price) as price, coalesce(b.r.market, a.r.market) as market from a full join b using (link)",
    "diff": "with l as (select link, ts, ord, price, market from items where link is not null), a as (select link, arg_max(struct_pack(price := price, market := market), struct_pack(ts := ts, ord := ord)) as r from l where ts < '2020-04-01' group by 1), b as (select link, arg_max(struct_pack(price := price, market := market), struct_pack(ts := ts, ord := ord)) as r from l where ts >= '2020-04-01' group by 1) select link, case when a.link is null then 'insert' when b.link is null then 'delete' else 'update' end as op from (select link, r from a) a full join (select link, r from b) b using (link) where a.link is null or b.link is null or a.r.price is distinct from b.r.price or a.r.market is distinct from b.r.market".replace("a.link is null", "a.r is null").replace("b.link is null", "b.r is null"),
    "price_log": "select link, price, strftime(max(ts), '%m/%d/%Y, %H:%M:%S') as last_seen from items where price is not null and link is not null group by 1, 2",
    "out_of_stock_marks": "select ord, link, market, case when market = 'kavsak' and link not in (select link from items where link is not null) then true else out_of_stock end as out_of_stock from raw_docs",
    "search_barcode": "select ord from skus where list_has_any(barcodes, ['2000000015828', '2000000004969'])",
    "inverted_index": f"select distinct p_partkey, unnest(list_filter({_W}, lambda t: length(t) > 1)) as token from part",
    "market_stats": "select r.market, count(*) as n_docs, count(*) filter (out_of_stock) as n_out, count(*) filter (cardinality(promoted) > 0) as n_promoted, count(*) filter (cardinality(variants) > 0) as n_variants, count(distinct variant_name) as n_variant_names, any_value(coalesce(n_barcodes, 0)) as n_barcodes from raw_docs r left join (select market, count(distinct b) as n_barcodes from (select market, unnest(barcodes) as b from raw_docs) group by 1) using (market) group by 1",
    "barcode_classes": "with t as (select c, bool_or(market in ('kavsak', 'pirilti', 'bakkalim')) as a, bool_or(market in ('evrenmar', 'goncashop')) as b from (select unnest(barcodes) as c, market from raw_docs) where c is not null group by 1) select count(*) filter (a) as n_a, count(*) filter (b) as n_b, count(*) filter (a or b) as n_union, count(*) filter (a and b) as n_both from t",
    "deals": "with p as (select sku_id || '/' || ord as sku_id, list_sort(map_values(prices)) as ps, list_sort(list_transform(map_entries(prices), lambda e: struct_pack(v := e.value, k := e.key)))[1].k as best_market from skus where sku_id is not null) select sku_id, best_market, ps[1] as best_price, ps[3] as third_price from p where len(ps) >= 3 and ps[1] < 0.95 * ps[3]",
    "category_tree": "select p_brand as cat, string_agg(distinct p_type, ',' order by p_type) as children from part group by 1",
    "leaf_categories": "select n_nationkey + 100 as id from nation union all select r_regionkey from region where r_regionkey not in (select n_regionkey from nation)",
    "availability": "select brand, string_agg(distinct market, ',' order by market) as markets from raw_docs where brand is not null and market in ('kavsak', 'pirilti', 'evrenmar') group by 1",
}


def queries() -> Q:
    return problem_queries() | reference_queries() | stream_queries.queries() | catalog_queries.queries() | function_queries.queries()


def oracle_sql() -> dict[str, str]:
    return {"p5_found": P5_FOUND} | ORACLES | stream_queries.ORACLES | catalog_queries.oracle_sql() | function_queries.oracle_sql()
