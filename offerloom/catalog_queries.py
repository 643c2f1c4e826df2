"""More queries of the operators, each beside its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerloom.constants import Config
from offerloom.functions import collections as C
from offerloom.functions import names as N
from offerloom.functions import text as T
from offerloom.functions.barcode import longest_digits
from offerloom.operators import edges, enrich, evaluation, graph, prep, products, reduce, search, sync
from offerloom.plans import enrichment, rebuild
from offerloom.sources.tables import table

#: These shops know a page by its number, whatever words stand before it.
LINK_KEY = (r"^(https?://[^/]+)/[^/]*(-p-[0-9]+)$", "$1$2")
CFG = Config(name_rank={"kavsak": 8, "pirilti": 7, "bakkalim": 6}, src_rank={"mavisepet": 7, "bakkalim": 6, "renklidepo": 3}, product_market="sahilmar", variant_marker="?v=", link_key=LINK_KEY)


def _q(make: Callable[..., DataFrame], *tables: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: make(*(table(spark, sf_dir, t) for t in tables))


def _low(c: str):
    """Lower case in which dotted capital I is one letter."""
    return F.lower(F.translate(c, "İ", "i"))


def _rows(k: DataFrame) -> DataFrame:
    """``subcat, brand, uid, name`` of SKU records that have all."""
    return k.where("category is not null and brand is not null and name is not null and sku_id is not null").select(_low("category").alias("subcat"), _low("brand").alias("brand"), F.col("sku_id").alias("uid"), _low("name").alias("name"))


ROWS = "rows as (select lower(replace(category, 'İ', 'i')) as subcat, lower(replace(brand, 'İ', 'i')) as brand, sku_id as uid, lower(replace(name, 'İ', 'i')) as name from skus where category is not null and brand is not null and name is not null and sku_id is not null)"
WS = lambda c: f"list_filter(regexp_split_to_array(trim({c}), '\\s+'), lambda t: t <> '')"
TB = f"{ROWS}, tb as (select subcat, token, count(distinct brand) as brands, count(*) as freq from (select subcat, brand, unnest(list_distinct({WS('name')})) as token from rows) group by 1, 2)"


def _as_groups(d: DataFrame) -> DataFrame:
    """Docs of one ``sku_id`` as a group."""
    return d.where("sku_id <> ''").withColumn("component", F.col("sku_id"))


def _entries(c: str):
    return C.sorted_entries(F.col(c))


def _halves(i: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The last item of each link in the first and in the second half of the time."""
    half = F.lit("2020-04-01").cast("timestamp_ntz")
    last = lambda d: d.where("link is not null").groupBy("link").agg(F.max(F.struct("ts", "ord", "price"))["price"].alias("price"))
    return last(i.where(F.col("ts") < half)), last(i.where(F.col("ts") >= half))


HALVES = "l as (select link, price, ts, ord from items where link is not null), a as (select link, arg_max(struct_pack(p := price), struct_pack(ts := ts, ord := ord)).p as price from l where ts < '2020-04-01' group by 1), b as (select link, arg_max(struct_pack(p := price), struct_pack(ts := ts, ord := ord)).p as price from l where ts >= '2020-04-01' group by 1)"


def _pages(r: DataFrame) -> DataFrame:
    return prep.product_links(prep.variant_pages(rebuild.last_rows(r)), CFG.product_market, CFG.variant_marker)


def _variant_skus(r: DataFrame) -> DataFrame:
    """Colours as SKUs whose links are the variant pages of that colour."""
    each = r.select(F.explode("variants").alias("page", "color"))
    return each.groupBy(F.col("color").alias("sku_id")).agg(F.collect_set("page").alias("links"))


def _evaluated(r: DataFrame) -> DataFrame:
    docs = rebuild.prepared(r, CFG)
    return evaluation.evaluate_matching(docs, edges.staged_edges(docs, CFG.link_key))


def _enriched(k: DataFrame) -> DataFrame:
    lists = k.where("sku_id is not null").groupBy(F.col("sku_id").alias("uid")).agg(*[F.collect_list(c).alias(to) for c, to in (("name", "clean_names"), ("brand", "brands"), ("category", "subcats"))])
    return enrichment.enriched_products(lists)


def _replaced(i: DataFrame) -> DataFrame:
    return sync.replace_by_key(*_halves(i), "link")


def _deleted(i: DataFrame) -> DataFrame:
    a, b = _halves(i)
    return sync.delete_by_key(a, b, "link")


def _changed(i: DataFrame) -> DataFrame:
    a, b = _halves(i)
    return sync.apply_diff(a, b, "link", sync.diff(a, b, "link", ["price"]))


def _price_updates(k: DataFrame) -> DataFrame:
    one = k.where("sku_id is not null").groupBy("sku_id").agg(F.max_by("prices", "ord").alias("prices"))
    new = k.where("sku_id is not null and market is not null and best_price is not null").select("sku_id", "market", F.col("best_price").alias("price"), "ord")
    return sync.price_updates(one, new).select("sku_id", _entries("prices").alias("prices"))


def _sized(k: DataFrame) -> DataFrame:
    has = F.col("digits").isNotNull() & ~F.isnan("digits") & F.col("unit").isNotNull()
    return k.where("sku_id is not null").select(F.col("sku_id").alias("component"), "ord", F.when(has, F.array(F.struct("digits", "unit"))).otherwise(F.array().cast("array<struct<digits:double,unit:string>>")).alias("sizes"))


def _known_pairs(p: DataFrame) -> DataFrame:
    """Names of parts sold under a common type, as known phrases."""
    return enrich.known_strings(p.where("p_type = 'ECONOMY'").select(F.col("p_name").alias("brand")), p.select(F.lower("p_type").alias("subcat")))


CATALOG: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    # synchronising
    "rows_replaced": (_q(_replaced, "items"), f"with {HALVES} select link, price from b union all select link, price from a where link not in (select link from b)"),
    "rows_deleted": (_q(_deleted, "items"), f"with {HALVES} select link, price from a where link not in (select link from b)"),
    "rows_changed": (_q(_changed, "items"), f"with {HALVES} select link, price from b"),
    "docs_sku_ids": (
        _q(lambda r, k: sync.sku_ids_to_docs(r.select("doc_id", "ord", "sku_id"), k).select("ord", "doc_id", "sku_id"), "raw_docs", "skus"),
        "with l as (select doc_id, min(sku_id) as s from (select sku_id, unnest(doc_ids) as doc_id from skus) group by 1) select ord, doc_id, coalesce(s, sku_id) as sku_id from raw_docs left join l using (doc_id)",
    ),
    "price_updates": (
        _q(_price_updates, "skus"),
        """with o as (select sku_id, arg_max(prices, ord) filter (prices is not null) as prices from skus where sku_id is not null group by 1),
           n as (select sku_id, market as k, arg_max(best_price, ord) as v from skus where sku_id is not null and market is not null and best_price is not null group by 1, 2),
           e as (select sku_id, e.key as k, e.value as v from (select sku_id, unnest(map_entries(prices)) as e from o where sku_id in (select sku_id from n)) union all select * from n),
           m as (select sku_id, k, v from e anti join n on e.sku_id = n.sku_id and e.k = n.k union all select * from n)
           select sku_id, string_agg(distinct k || '=' || v, ',' order by k || '=' || v) as prices from m group by 1""",
    ),
    "items_lacking": (
        lambda s, d: s.createDataFrame([(prep.check_items(table(s, d, "items"), 10**12),)], "n long"),
        "select count(*) as n from items where coalesce(link, '') = '' or coalesce(name, '') = '' or coalesce(price, '') = '' or coalesce(market, '') = '' or coalesce(src, '') = ''",
    ),
    "worded_ids": (_q(lambda r: sync.without_numeric_ids(r.select("ord", F.element_at(F.split("link", "-"), -1).alias("id")), "id"), "raw_docs"), "select ord, string_split(link, '-')[-1] as id from raw_docs where not coalesce(regexp_matches(string_split(link, '-')[-1], '^[0-9]+$'), false)"),
    # preparation
    "brands_clean": (_q(lambda p: p.select("p_partkey", prep.clean_brand(F.concat("p_brand", F.lit("-L'Oréal"))).alias("b")), "part"), "select p_partkey, replace(lower(p_brand), '#', '') || ' loreal paris' as b from part"),
    "brands_usable": (_q(lambda p: prep.usable_brands(p.select(F.lower("p_name").alias("brand"))), "part"), "select distinct lower(p_name) as brand from part where length(p_name) > 2"),
    "subcat_votes": (
        _q(lambda r: prep.subcat_votes(r.select("doc_id", "market", "categories", "ord"), ("kavsak",)).select("doc_id", "market", C.sorted_text(F.col("votes")).alias("votes")), "raw_docs"),
        r"""with c as (select ord, doc_id, market, list_filter(categories, lambda c: c is not null and c <> '') as cs from raw_docs where len(categories) > 0),
            o as (select ord, doc_id, market, unnest(case when market = 'kavsak' then cs[-1:] else list_transform(cs, lambda c: trim(string_split(c, '/')[1])) end) as c from c),
            p as (select distinct ord, trim(unnest(regexp_split_to_array(c, '/|,|&| ve | and '))) as p from o)
            select doc_id, market, coalesce((select string_agg(p, ',' order by p) from p where p.ord = c.ord), '') as votes from c""",
    ),
    "gender_words": (
        _q(lambda p: p.select("p_partkey", prep.gender_word(F.concat_ws(" ", "p_name", F.when(F.col("p_size") < 10, "women men").when(F.col("p_size") < 20, "bayan").when(F.col("p_size") < 30, "unisex cocuk"))).alias("g")).where("g is not null"), "part"),
        "select p_partkey, case when p_size < 10 then 'men' when p_size < 20 then 'bayan' else 'cocuk' end as g from part where p_size < 30",
    ),
    "subcats_clean": (
        _q(lambda p: prep.clean_subcats(p.select(F.concat_ws(" ", F.lit("Kadın"), "p_name", F.lit("Krem Kremleri")).alias("subcat")), p.select(F.lit("x").alias("brand"))), "part"),
        "select distinct 'Kadın ' || p_name || ' Krem Kremleri' as original, p_name || ' krem krem' as clean, 'kadin' as gender from part where length(p_name) + 20 < 41",
    ),
    "product_pages": (
        _q(_pages, "raw_docs"),
        """with r as (select doc_id, arg_max(struct_pack(l := link, v := variants, m := market), ord) as r from raw_docs where doc_id is not null group by 1),
           p as (select regexp_replace(e.key, '/$', '') as link, m from (select unnest(map_entries(r.v)) as e, r.m as m from r) where regexp_replace(e.key, '/$', '') not in (select regexp_replace(r.l, '/$', '') from r where r.l is not null)
                 union all select r.l, r.m from r)
           select distinct split_part(regexp_replace(link, '/$', ''), '?', 1) as link from p where m = 'sahilmar' and contains(link, '?v=') and not regexp_matches(string_split(split_part(regexp_replace(link, '/$', ''), '?', 1), '/')[-1], '^[0-9]*$')""",
    ),
    "market_subcats": (
        _q(lambda r, k: prep.market_subcats(r, k).select("sku_id", "market", C.sorted_text(F.col("subcats")).alias("subcats")), "raw_docs", "skus"),
        r"""with v as (select distinct doc_id, market, trim(unnest(regexp_split_to_array(c, '/|,|&| ve | and '))) as v from (select doc_id, market, trim(string_split(unnest(list_filter(categories, lambda c: c is not null and c <> '')), '/')[1]) as c from raw_docs)),
            k as (select sku_id, unnest(doc_ids) as doc_id from skus where product_id is not null)
            select sku_id, market, string_agg(distinct v, ',' order by v) as subcats from k join v using (doc_id) group by 1, 2""",
    ),
    "longest_digits": (
        _q(lambda r: r.select("ord", longest_digits(F.col("link")).alias("d")).where("d is not null"), "raw_docs"),
        "select ord, ds[list_position(list_transform(ds, lambda x: length(x)), list_max(list_transform(ds, lambda x: length(x))))] as d from (select ord, regexp_extract_all(link, '[0-9]+') as ds from raw_docs) where len(ds) > 0",
    ),
    "maps_merged": (
        _q(lambda r: r.select("ord", C.sorted_entries(C.merged_maps(F.col("promoted"), F.col("variants"), F.create_map(F.lit("paketci"), F.lit("-")))).alias("m")), "raw_docs"),
        "with e as (select ord, e.key as k, e.value as v, 0 as r from (select ord, unnest(map_entries(promoted)) as e from raw_docs) union all select ord, e.key, e.value, 1 from (select ord, unnest(map_entries(variants)) as e from raw_docs) union all select ord, 'paketci', '-', 2 from raw_docs), f as (select ord, k, arg_min(v, r) as v from e group by 1, 2) select ord, string_agg(k || '=' || v, ',' order by k || '=' || v) as m from f where v is not null group by 1",
    ),
    "nested_sets": (
        _q(lambda r: C.nested_sets(r.where("market is not null and categories is not null").select(F.create_map("market", "categories").alias("m")), "m").select("key", C.sorted_text(F.col("members")).alias("members")), "raw_docs"),
        "select market as key, string_agg(distinct c, ',' order by c) as members from (select market, unnest(categories) as c from raw_docs where market is not null) where c is not null group by 1",
    ),
    # groups and SKUs
    "connected_groups": (None, None),
    "matching_evaluation": (_q(_evaluated, "raw_docs"), None),
    "variant_groups": (
        _q(lambda r: products.variant_groups(_variant_skus(r), r.select("ord", "variants")), "raw_docs"),
        "with p as (select ord, e.key as page, e.value as color from (select ord, unnest(map_entries(variants)) as e from raw_docs)), k as (select regexp_replace(page, '/$', '') as link, max(ord) as key from p where page <> '' group by 1) select distinct cast(key as varchar) as key, color as sku_id from p join k on p.page = k.link where color is not null union select distinct cast(key as varchar), color from p join k on p.page = k.link where color is null",
    ),
    "product_link_groups": (
        _q(lambda r: products.product_link_groups(_variant_skus(r), _pages(r), CFG.variant_marker), "raw_docs"),
        """with r as (select doc_id, arg_max(struct_pack(l := link, v := variants, m := market), ord) as r from raw_docs where doc_id is not null group by 1),
           g as (select distinct split_part(regexp_replace(e.key, '/$', ''), '?', 1) as link from (select unnest(map_entries(r.v)) as e, r.m as m from r) where m = 'sahilmar' and contains(e.key, '?v=') and not regexp_matches(string_split(split_part(e.key, '?', 1), '/')[-1], '^[0-9]*$')),
           p as (select e.key as page, e.value as color from (select unnest(map_entries(variants)) as e from raw_docs) where contains(e.key, '?v='))
           select distinct split_part(page, '?', 1) as key, color as sku_id from p where split_part(page, '?', 1) in (select link from g)""",
    ),
    "sku_categories": (
        _q(lambda r: reduce.group_categories(_as_groups(r)).select("component", C.sorted_text(F.transform(F.map_entries("categories"), lambda e: F.concat_ws("=", e["key"], F.array_join(e["value"], "+")))).alias("c")), "raw_docs"),
        "with l as (select sku_id, market, arg_max(categories, ord) as c from raw_docs where sku_id <> '' and market is not null and categories is not null group by 1, 2) select sku_id as component, string_agg(market || '=' || array_to_string(c, '+'), ',' order by market || '=' || array_to_string(c, '+')) as c from l group by 1",
    ),
    "sku_variant_names": (
        _q(lambda r: reduce.group_variant_name(_as_groups(r)), "raw_docs"),
        """with s as (select sku_id, arg_min(variant_name, struct_pack(o := ord, v := variant_name)) as v from raw_docs where sku_id <> '' and variant_name <> '' group by 1),
           p as (select sku_id, ord, regexp_replace(regexp_replace(e.key, '[?&](gclid|utm).*$', ''), '/$', '') as page, e.value as v from (select sku_id, ord, unnest(map_entries(variants)) as e from raw_docs where sku_id <> '') where e.value <> ''),
           d as (select sku_id, link as page from raw_docs union select sku_id, split_part(link, '&', 1) from raw_docs union select sku_id, split_part(link, '?', 1) from raw_docs),
           f as (select p.sku_id, arg_min(v, struct_pack(o := ord, v := v)) as v from p join d using (sku_id, page) group by 1)
           select coalesce(s.sku_id, f.sku_id) as component, coalesce(s.v, f.v) as variant_name from s full join f using (sku_id)""",
    ),
    "sku_prices": (
        _q(lambda k: reduce.group_prices(k.where("sku_id is not null").select(F.col("sku_id").alias("component"), "market", "ord", "out_of_stock", F.col("best_price").cast("string").alias("price")), CFG).select("component", "best_price", "market_count", _entries("prices").alias("prices")), "skus"),
        """with l as (select sku_id, market, arg_max(struct_pack(p := best_price), ord).p as p from skus where sku_id is not null and market is not null and not coalesce(out_of_stock, false) group by 1, 2), n as (select sku_id, market, round(p, 2) as p from l where p <> 0)
           select sku_id as component, min(p) as best_price, count(*) as market_count, string_agg(market || '=' || p, ',' order by market || '=' || p) as prices from n group by 1 having max(p) <= 3.0 * min(p)""",
    ),
    "sku_names": (
        _q(lambda r: reduce.group_names(_as_groups(r).where("market is not null"), CFG), "raw_docs"),
        """with l as (select sku_id, market, min(ord) as f, arg_max(struct_pack(n := name, s := src), ord) as r from raw_docs where sku_id <> '' and market is not null group by 1, 2),
           k as (select *, case market when 'kavsak' then 8 when 'pirilti' then 7 when 'bakkalim' then 6 else 0 end as nr, case market when 'mavisepet' then 7 when 'bakkalim' then 6 when 'renklidepo' then 3 else 0 end as sr from l)
           select sku_id as component, arg_min(r, struct_pack(r := -nr, f := f)).n as name, arg_min(r, struct_pack(r := -sr, f := f)).s as src from k group by 1""",
    ),
    "sku_sizes": (
        _q(lambda k: reduce.modal_size(_sized(k)).select("component", "digits", "unit"), "skus"),
        "with s as (select sku_id, digits, unit, count(*) as n, min(ord) as f from skus where sku_id is not null and digits is not null and not isnan(digits) and unit is not null group by 1, 2, 3), r as (select *, row_number() over (partition by sku_id order by n desc, f) as rn from s) select sku_id as component, digits, unit from r where rn = 1",
    ),
    "sku_words": (
        _q(lambda k: reduce.group_words(k.where("sku_id is not null and name is not null").select(F.col("sku_id").alias("component"), "ord", _low("name").alias("name"))).select("component", "tags", F.array_join("most_common_tokens", ",").alias("top")), "skus"),
        f"""with w as (select sku_id, ord, unnest(ws) as w, generate_subscripts(ws, 1) as i from (select sku_id, ord, {WS("lower(replace(name, 'İ', 'i'))")} as ws from skus where sku_id is not null and name is not null)),
            c as (select sku_id, w, count(*) as n, min(struct_pack(o := ord, i := i)) as f from w group by 1, 2), r as (select *, row_number() over (partition by sku_id order by n desc, f) as rn from c)
            select sku_id as component, string_agg(w, ' ' order by w) as tags, string_agg(w, ',' order by w) filter (rn <= 3) as top from r group by 1""",
    ),
    "attributes_to_skus": (
        _q(lambda k: products.attributes_to_skus(k.where("sku_id is not null").select("sku_id", "product_id", "ord"), k.where("product_id is not null").groupBy(F.col("product_id").alias("uid")).agg(F.max("brand").alias("brand")), ["brand"]).select("ord", "sku_id", "brand"), "skus"),
        "with p as (select product_id as uid, max(brand) as brand from skus where product_id is not null group by 1) select ord, sku_id, p.brand from skus left join p on p.uid = coalesce(product_id, sku_id) where sku_id is not null",
    ),
    # enrichment
    "enriched_products": (_q(_enriched, "skus"), None),
    "brand_partial": (
        _q(lambda k: enrich.brand_partial(_rows(k).select("uid", "name"), _rows(k).select("uid", "brand")), "skus"),
        f"""with {ROWS}, n as (select distinct uid, name, {WS('name')} as ws from rows), b as (select distinct uid, brand, {WS('brand')} as s from rows), c as (select * from n join b using (uid) where not contains(name, brand) and len(s) > 1),
            w as (select uid, brand, s, unnest(list_transform(range(1, greatest(len(ws) - len(s) + 2, 1)), lambda i: ws[i:i + len(s) - 1])) as w, unnest(range(1, greatest(len(ws) - len(s) + 2, 1))) as i, name from c),
            h as (select uid, brand, name, arg_min(array_to_string(w, ' '), i) as win from w where (len(list_intersect(w, s)) > 1 or (len(list_intersect(w, s)) = 1 and length(list_intersect(w, s)[1]) > 3))
              and len(list_filter(list_zip(w, s), lambda p: not (starts_with(p[1], p[2]) or starts_with(p[2], p[1])))) = 0 and len(list_filter(list_zip(w, s), lambda p: p[1] <> p[2] and length(p[1]) = 1)) < 2 group by 1, 2, 3)
            select uid, brand, min(win) as "window" from h group by 1, 2""",
    ),
    "subcat_parents": (
        _q(lambda k: enrich.subcat_parents(_rows(k).select("uid", F.lit(0).alias("pos"), "name"), _rows(k).select("uid", F.col("subcat").alias("parent"))), "skus"),
        f"with {ROWS}, h as (select distinct a.uid, b.subcat from rows a join rows b using (uid) where b.subcat <> '' and contains(a.name, b.subcat) and len(list_filter({WS('b.subcat')}, lambda t: not list_contains({WS('a.name')}, t))) = 0), r as (select *, row_number() over (partition by uid order by length(subcat) desc, subcat) as rn from h) select uid, subcat from r where rn = 1",
    ),
    "subcat_tokens": (_q(lambda k: enrich.subcat_tokens(_rows(k)), "skus"), f"with {TB} select subcat, token, brands as n from tb where brands >= 5"),
    "shared_tokens": (_q(lambda k: enrich.shared_tokens(_rows(k)), "skus"), f"with {TB}, r as (select *, row_number() over (partition by subcat order by freq desc, token) as rn from tb where brands > 1 and freq > 3) select subcat, token, freq from r where rn <= 10"),
    "topic_input": (
        _q(lambda k: enrich.topic_input(_rows(k)), "skus"),
        f"""with {TB}, k as (select subcat, token from tb where brands >= 2 and freq >= 4), d as (select distinct subcat, uid, name from rows), t as (select subcat, uid, name, unnest({WS('name')}) as token, generate_subscripts({WS('name')}, 1) as i from d),
            s as (select subcat, uid, name, string_agg(token, ' ' order by i) as short from t join k using (subcat, token) group by 1, 2, 3), n as (select subcat from s group by 1 having count(*) >= 2) select subcat, short as name from s where subcat in (select subcat from n)""",
    ),
    "known_strings": (_q(_known_pairs, "part"), "select p_name as known from part where p_type = 'ECONOMY' union select lower(p_type) from part"),
    "known_removed": (
        _q(lambda p: enrich.without_known(p.select("p_partkey", F.concat_ws(" ", "p_name", F.lower("p_type"), F.lit("set")).alias("name")), "name", _known_pairs(p)), "part"),
        "select p_partkey, case when p_name in (select p_name from part where p_type = 'ECONOMY') then 'set' else p_name || ' set' end as name from part",
    ),
    "names_filtered": (
        _q(lambda p: p.select("p_partkey", F.array_join(N.filtered_names(F.array(F.concat_ws(" ", "p_name", F.lit("mavi 12345678 for erkek kutu"))), F.array(F.element_at(F.split("p_name", " "), -1)), F.array().cast("array<string>"), F.array(F.lit("blue"))), "|").alias("n")), "part"),
        "select p_partkey, array_to_string(list_filter(string_split(p_name, ' ')[1:-2] || ['kutu'], lambda t: t not in (string_split(p_name, ' ')[-1], 'blue', 'mavi')), ' ') as n from part",
    ),
    "categories_clean": (
        _q(lambda p: p.select("p_partkey", F.array_join(prep.clean_categories(F.array(F.concat("p_name", F.lit(" Kremleri/Çay, Süt & Un")))), "|").alias("c")), "part"),
        "select p_partkey, p_name || ' krem|cay|sut|un' as c from part",
    ),
    # lookups
    "link_queue": (_q(search.link_queue, "raw_docs"), "select link from raw_docs where link <> '' union select unnest(map_keys(variants)) from raw_docs"),
    "names_by_links": (_q(lambda r, i: search.names_by_links(r, i), "raw_docs", "items"), "select link, name from raw_docs where link in (select link from items)"),
    "docs_of_markets": (lambda s, d: table(s, d, "raw_docs", ("ord", "link"), ("kavsak", "pirilti")), "select ord, link from raw_docs where market in ('kavsak', 'pirilti')"),
    "skus_by_ids": (_q(lambda k, r: search.by_ids(k, r, ["ord", "name"]), "skus", "raw_docs"), "select sku_id, ord, name from skus where sku_id in (select sku_id from raw_docs)"),
}


def _connected(r: DataFrame) -> DataFrame:
    from offerloom.functions.barcode import clean_barcodes

    g = graph.components(edges.barcode_edges(r.select("doc_id", clean_barcodes(F.col("barcodes")).alias("barcodes"))))
    return graph.fully_connected(g, r.where("sku_id <> ''").select(F.col("doc_id").alias("node")))


CONNECTED_SQL = r"""with recursive b as (select doc_id, unnest(barcodes) as b from raw_docs), t as (select doc_id, trim(unnest(string_split(b, ','))) as t from b),
    k as (select distinct doc_id, case when length(t) in (8, 13) then t else right(t, 13) end as c from t where regexp_matches(t, '^([0-9]{8}|[0-9]{13}|0[1-9][0-9]{12})$')),
    h as (select doc_id as u, min(doc_id) over (partition by c) as v from k), e as (select u, v from h where u <> v union select v, u from h where u <> v),
    reach(doc_id, r) as (select u, u from e union select reach.doc_id, e.v from reach join e on reach.r = e.u), g as (select doc_id, min(r) as component from reach group by doc_id)
    select component from g group by 1 having bool_and(doc_id in (select doc_id from raw_docs where sku_id <> ''))"""
CATALOG["connected_groups"] = (_q(_connected, "raw_docs"), CONNECTED_SQL)

#: SQL of queries that stand in ``queries``.
MORE_SQL = {
    "p5_history": r"""with s as (
        select regexp_replace(link, '/$', '') as link, epoch_us(ts) as tm, ord, price, coalesce(out_of_stock, false) as oos from items
        union all
        select regexp_replace(link, '/$', ''), epoch_us(cast(regexp_replace(regexp_replace(regexp_replace(regexp_replace(e.value, 'T', ' '), 'Z$', ''), '^(\d+)\.(\d+)\.(\d{4})', '\3-\2-\1'), '^(\d{4})/(\d+)/(\d+)', '\1-\2-\3') as timestamp)), ord, e.key, false
        from (select link, ord, unnest(map_entries(historical_prices)) as e from raw_docs)),
      st as (select link, tm, ord, case when oos or regexp_matches(price, '(?i)stokta\s+yok') then -1
             else try_cast(replace(regexp_replace(lower(price), 'tl|try|[₺\s]', '', 'g'), ',', '.') as decimal(18,4)) end as state from s where link is not null and tm is not null),
      one as (select link, tm, arg_max(state, ord) as state from st where state = -1 or state > 0 group by link, tm),
      v as (select *, lag(state) over (partition by link order by tm) as before from one), b as (select link, tm, state from v where before is null or before <> state)
      select link, cast(floor(tm / 1000000) as bigint) as valid_from, cast(floor(lead(tm) over (partition by link order by tm) / 1000000) as bigint) as valid_to, state <> -1 as in_stock, case when state <> -1 then cast(state as double) end as price from b""",
    "subcat_global": f"""with v as (select distinct lower(replace(category, 'İ', 'i')) as subcat from skus where trim(category) <> '' and sku_id is not null),
        n as (select sku_id as uid, {WS("lower(replace(name, 'İ', 'i'))")} as ws from skus where name is not null and sku_id is not null),
        w as (select distinct uid, unnest(flatten(list_transform(range(1, len(ws)), lambda i: list_transform(range(i + 1, len(ws) + 1), lambda j: array_to_string(ws[i:j], ' '))))) as subcat from n),
        r as (select uid, subcat, row_number() over (partition by uid order by length(subcat) desc, subcat) as rn from w join v using (subcat)) select uid, subcat from r where rn = 1""",
    "search_keyword": r"""with c as (select sku_id, name, regexp_replace(strip_accents(replace(regexp_replace(replace(replace(lower(replace(name, 'İ', 'i')), 'ı', 'i'), ',', '.'), '[-&/]', ' ', 'g'), '*', ' * ')), '[^a-z0-9,. ]', '', 'g') as c from skus where name is not null),
        t as (select distinct sku_id, name, ord, case when regexp_matches(replace(x, '.', ''), '^[0-9]+$') then x else replace(x, '.', ' ') end as x from (select sku_id, name, row_number() over () as ord, unnest(list_filter(regexp_split_to_array(c, '\s+'), lambda t: t <> '')) as x from c)),
        w as (select sku_id, name, unnest(list_filter(string_split(x, ' '), lambda t: t <> '')) as w, ord from t), q as (select unnest(['sivi', 'sabun']) as q),
        d as (select distinct sku_id, name, ord, w from w), h as (select sku_id, name, q, 2 * count(*) as c from d join q on levenshtein(w, q) <= 1 group by 1, 2, 3)
        select sku_id, name, sum(c) as score from h group by 1, 2 having count(*) = 2 order by score desc, sku_id limit 24""",
    "tfidf_top": f"""with t as (select source, unnest({WS('lower(text)')}) as token from documents where source is not null and text is not null), f as (select source, token, count(*) as tf from t group by 1, 2), d as (select token, count(*) as df from f group by 1), n as (select count(distinct source) as n from f),
        s as (select source, token, round(tf * ln((n + 1) / (df + 1)), 6) as score from f join d using (token), n), r as (select *, row_number() over (partition by source order by score desc, token) as rn from s) select source, token, score from r where rn = 1""",
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, (f, _) in CATALOG.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for k, (_, s) in CATALOG.items() if s} | MORE_SQL
