"""Queries of this subpackage and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerloom.llm import bpe, canonical, components, disguise, fusion, leaks, listings, pii
from offerloom.sources.tables import table


def _q(make: Callable[..., DataFrame], *tables: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: make(*(table(spark, sf_dir, t) for t in tables))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "p1_found": _q(components.offer_groups, "raw_docs", "skus"),
        "p2_found": _q(listings.same_product_pairs, "raw_docs"),
        "p2_groups": _q(listings.product_groups, "raw_docs"),
        "p4_found": lambda s, d: canonical.mapped_rows(s, table(s, d, "raw_docs"), table(s, d, "skus"), table(s, d, "ref_values")),
        "p6_found": _q(fusion.surviving_records, "skus", "market_trust"),
        "p6_fused": _q(fusion.fuse, "skus"),
        "p7_found": _q(lambda r: disguise.detect(r).select("ord", "field"), "raw_docs"),
        "p7_clean": _q(disguise.consistent, "raw_docs"),
        "p8_ids": _q(bpe.encode_documents, "documents"),
        "p9_found": _q(lambda d, e: leaks.exact_phrases(d, e).select("doc_id", "item_id"), "documents", "eval_items"),
        "p9_near": _q(leaks.near_phrases, "documents", "eval_items"),
        "p10_found": _q(pii.find_items, "documents"),
        "p10_masked": _q(pii.masked, "documents"),
        "p1_sizes": _q(lambda r, k: components.offer_groups(r, k).groupBy("group_id").agg(F.count(F.lit(1)).alias("n_docs")), "raw_docs", "skus"),
    }


P1_LINKS = r"""
  digits as (select doc_id, ltrim(regexp_replace(b, '[^0-9]', '', 'g'), '0') as d from (select doc_id, unnest(barcodes) as b from raw_docs)),
  padded as (select doc_id, d, lpad(d, 14, '0') as p from digits where length(d) between 8 and 14),
  codes as (select distinct doc_id, 'b:' || d as key from padded
            where (10 - list_sum(list_transform(range(1, 14), lambda i: cast(substr(p, i, 1) as int) * (case when i % 2 = 1 then 3 else 1 end))) % 10) % 10 = cast(substr(p, 14, 1) as int)),
  owned as (select distinct doc_id, 's:' || trim(sku_id) as key from raw_docs where trim(sku_id) <> ''
            union select distinct regexp_replace(x, '\+clone[0-9]*$', ''), 's:' || trim(sku_id) from (select sku_id, unnest(doc_ids) as x from skus) where regexp_replace(x, '\+clone[0-9]*$', '') in (select doc_id from raw_docs)),
  links as (select * from codes union select * from owned),
  edges as (select a.doc_id as u, min(b.doc_id) as v from links a join links b using (key) group by a.doc_id, key)
"""

P7_TEXTS = "select ord, 'name' as field, name as x from raw_docs where name is not null union all select ord, 'brand', brand from raw_docs where brand is not null"
#: Written from Unicode's blocks, apart from the operator's own patterns.
P7_CASE = r"""(regexp_matches(x, '[ªº²³¹¼½¾ĳŀŉſ]|[\x{2070}-\x{209C}]|[\x{2100}-\x{214F}]|[\x{2150}-\x{217F}]|[\x{2460}-\x{24EA}]|[\x{3200}-\x{33FF}]|[\x{FB00}-\x{FB06}]|[\x{FF01}-\x{FFEE}]|[\x{1D400}-\x{1D7FF}]|[\x{1F100}-\x{1F16C}]')
          or regexp_matches(x, '[\p{M}\p{Cf}]') or regexp_matches(x, '[\x{9}-\x{D}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]')
          or len(list_filter(regexp_extract_all(x, '[\p{L}\p{N}_]+'), lambda w: regexp_matches(w, '\p{Latin}') and regexp_matches(w, '[\p{Cyrillic}\p{Greek}]'))) > 0)"""


def oracle_sql() -> dict[str, str]:
    return {
        "p1_found": f"""with recursive {P1_LINKS},
          sides as (select u, v from edges where u <> v union select v, u from edges where u <> v),
          reach(doc_id, r) as (select u, u from sides union select reach.doc_id, sides.v from reach join sides on reach.r = sides.u)
          select doc_id, min(r) as group_id from reach group by doc_id""",
        "p6_found": r"""
          with c as (
            select sku_id, 'name' as field, name as v, ord, ts, market from skus union all select sku_id, 'src', src, ord, ts, market from skus
            union all select sku_id, 'brand', brand, ord, ts, market from skus union all select sku_id, 'category', category, ord, ts, market from skus),
          u as (select *, lower(strip_accents(replace(trim(v), 'ı', 'i'))) as p from c where v is not null and trim(v) <> ''),
          ok as (select * from u where p not in ('-', '--', 'null', 'none', 'n/a', 'na', 'yok', 'nan', 'bos', 'unknown') and case field
              when 'name' then p not in ('isimsiz urun', 'urun adi', 'urun adi yok', 'test', 'xxx') and not regexp_matches(v, '(…|\.\.)\s*$')
              when 'brand' then p not in ('?', '#yok', '.', 'belirtilmemis', 'bilinmiyor', 'markasiz', 'markasiz urun', 'no brand')
              when 'category' then p not in ('kategori yok', 'tanimsiz', 'diger', 'genel', 'other')
              else regexp_matches(lower(v), '^\s*https?://') and not regexp_matches(lower(v), '(resim-?yok|no-?image|placeholder|default)[^/]*$') end)
          select sku_id, field, ord from (
            select ok.*, row_number() over (partition by sku_id, field order by coalesce(case when field = 'src' then src_rank else name_rank end, -2147483648) desc, ts desc nulls last, ord desc) as rn
            from ok left join market_trust using (market) where sku_id in (select sku_id from skus group by sku_id having count(*) > 1)) where rn = 1""",
        "p7_found": f"""select ord, field from ({P7_TEXTS}) where {P7_CASE}""",
        "p7_clean": f"""
          with f as (select ord, field, x from ({P7_TEXTS}) where {P7_CASE}),
          bare as (select ord, field, regexp_replace(regexp_replace(x, '[\\x{{9}}-\\x{{D}}\\x{{85}}\\x{{A0}}\\x{{2000}}-\\x{{200A}}\\x{{202F}}\\x{{205F}}\\x{{3000}}]', ' ', 'g'), '\\p{{Cf}}', '', 'g') as x from f),
          c as (select ord, field, unnest(string_split(x, '')) as c, generate_subscripts(string_split(x, ''), 1) as i from bare),
          n as (select *, unicode(c) as u from c),
          plain as (select ord, field, i, case
              when c in ('ﬀ', 'ﬁ', 'ﬂ', 'ﬃ', 'ﬄ', 'ﬆ') then ['ff', 'fi', 'fl', 'ffi', 'ffl', 'st'][list_position(['ﬀ', 'ﬁ', 'ﬂ', 'ﬃ', 'ﬄ', 'ﬆ'], c)]
              when u between 65281 and 65374 then chr(u - 65248)
              when u between 119808 and 120483 and (u - 119808) % 52 < 26 then chr(65 + (u - 119808) % 52)
              when u between 119808 and 120483 then chr(97 + (u - 119808) % 52 - 26)
              when u between 120782 and 120831 then chr(48 + (u - 120782) % 10)
              when c = '™' then 'TM' when c = '№' then 'No' when c in ('²', '³') then chr(u - 128) when c = '¹' then '1' else c end as t from n),
          j as (select ord, field, regexp_replace(nfc_normalize(string_agg(t, '' order by i)), '\\p{{M}}', '', 'g') as x from plain group by 1, 2)
          select ord, field, array_to_string(list_transform(string_split(x, ' '), lambda w: case when regexp_matches(w, '\\p{{Latin}}') and regexp_matches(w, '[\\p{{Cyrillic}}\\p{{Greek}}]') then translate(w, 'АВЕКМНОРСТУХІЅЈаеорсухіѕјһԁвкмнтΑΒΕΖΗΙΚΜΝΟΡΤΥΧαεικνορτυχγηωσ', 'ABEKMHOPCTYXISJaeopcyxisjhdbkmhtABEZHIKMNOPTYXaeikvoptuxynwo') else w end), ' ') as clean from j""",
        "p1_sizes": f"""with recursive {P1_LINKS},
          sides as (select u, v from edges where u <> v union select v, u from edges where u <> v),
          reach(doc_id, r) as (select u, u from sides union select reach.doc_id, sides.v from reach join sides on reach.r = sides.u),
          g as (select doc_id, min(r) as group_id from reach group by doc_id)
          select group_id, count(*) as n_docs from g group by 1""",
        "p9_found": r"""
          with docs as (select doc_id, list_filter(regexp_split_to_array(lower(strip_accents(regexp_replace(replace(lower(text), 'ı', 'i'), '[\p{Cf}\p{M}]', '', 'g'))), '[^\p{L}\p{N}]+'), lambda t: t <> '') as w from documents where text is not null),
          items as (select item_id, list_filter(regexp_split_to_array(lower(strip_accents(regexp_replace(replace(lower(text), 'ı', 'i'), '[\p{Cf}\p{M}]', '', 'g'))), '[^\p{L}\p{N}]+'), lambda t: t <> '') as w from eval_items where text is not null),
          dg as (select doc_id, unnest(list_transform(range(1, len(w) - 8), lambda i: array_to_string(w[i:i + 9], ' '))) as g from docs where len(w) >= 10),
          ig as (select item_id, unnest(list_transform(range(1, len(w) - 8), lambda i: array_to_string(w[i:i + 9], ' '))) as g from items where len(w) >= 10)
          select distinct doc_id, item_id from dg join ig using (g)""",
    }
