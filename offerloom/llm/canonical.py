"""Free-entered values mapped to a canonical list, in SQL only.

Method: partition-based pigeonhole join. With k edits allowed, a reference form is cut into k + 1
segments, of which every value within k edits must hold one unchanged, moved by no more than the
edits allow. Two neighbouring characters swapped count as one edit and may spoil two segments, but
only where they stand on either side of a cut: such pairs of the value are swapped back and probed
too, with one edit less. Values and forms meet by equality on (kind, form length, segment number,
segment text), are verified with the built-in ``levenshtein``, and the values that meet none are
reported through an anti-join. Joins whose sides grow with the data are sort-merge joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from offerloom.functions.text import LOOK_ALIKES, ascii_fold_map
from offerloom.session import cut

#: Edits allowed by the length of the form: none under 4 characters, one under 7, two from 7 on.
EDITS = "case when {n} < 4 then 0 when {n} < 7 then 1 else 2 end"
MOST = 2

# --- fixed values: what sellers put around a value ------------------------------------------------
BRAND_BEFORE = r"^marka ?: ?"
BRAND_AFTER = r" ?(®|™| official| kozmetik| turkiye| gida| ltd[.]? ?sti[.]?| a[.] ?s[.]?)$"
CATEGORY_AFTER = r" (cesitleri|modelleri|urunleri)$"
PLURAL_AFTER = r"(ler|lar)$"
COLOR_BEFORE = r"^[0-9]+ "
COLOR_AFTER = r"( renkli| renk| ?[(][^)]*[)])$"
# --------------------------------------------------------------------------------------------------


def _lit(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def plain_sql(x: str) -> str:
    """The SQL text, for ``spark.sql`` with arguments (its braces are doubled), of ``functions.text.plain`` over the expression ``x``."""
    one, many = ascii_fold_map()
    x = f"regexp_replace({x}, '[\\\\p{{Cf}}\\\\p{{Mn}}\\\\p{{Me}}]', '')"
    x = f"regexp_replace({x}, '(?<![\\\\p{{L}}\\\\p{{N}}])[\\\\p{{IsCyrillic}}\\\\p{{IsGreek}}]+(?![\\\\p{{L}}\\\\p{{N}}])', ' ')"
    x = f"translate({x}, {_lit(''.join(LOOK_ALIKES))}, {_lit(''.join(LOOK_ALIKES.values()))})"
    for ch, to in many.items():
        if 0xFB00 <= ord(ch) <= 0xFB06:
            x = f"replace({x}, '{ch}', '{to}')"
    low = {k: v.lower() for k, v in one.items()} | {"ı": "i"}
    x = f"translate(regexp_replace(lower({x}), '\\\\p{{Mn}}', ''), {_lit(''.join(low))}, {_lit(''.join(low.values()))})"
    x = f"trim(regexp_replace({x}, '[\\\\p{{Z}}\\\\s]+', ' '))"
    return x.replace("{", "{{").replace("}", "}}")


def reference_forms(spark: SparkSession, ref_values: DataFrame) -> DataFrame:
    """``kind, ref_id, form, len, most``: the ways an entry may be written, letters and digits only.

    The canonical text, its aliases, both together, two words swapped, and the first word as an
    initial (there only one edit counts). Null kinds, ids and texts give no form.
    """
    return spark.sql(
        f"""
        with r as (
          select kind, ref_id, {plain_sql('canonical')} as c, transform(coalesce(aliases, array()), a -> {plain_sql('a')}) as al
          from {{t}} where kind is not null and ref_id is not null and canonical is not null
        ), w as (select *, split(c, ' ') as p from r),
        f as (
          select kind, ref_id, c as form, {MOST} as most from w
          union all select kind, ref_id, explode(al), {MOST} from w
          union all select kind, ref_id, explode(transform(al, a -> concat(c, a))), {MOST} from w
          union all select kind, ref_id, concat(p[1], p[0]), {MOST} from w where size(p) = 2 and kind = 'brand'
          union all select kind, ref_id, concat(left(p[0], 1), p[1]), 1 from w where size(p) = 2 and kind = 'brand'
        )
        select kind, ref_id, form, length(form) as len, max(most) as most
        from (select kind, ref_id, regexp_replace(form, '[^a-z0-9]', '') as form, most from f)
        where form <> '' group by kind, ref_id, form
        """,
        t=ref_values,
    )


def value_variants(spark: SparkSession, values: DataFrame) -> DataFrame:
    """``kind, value, s``: a value as typed and without what stands around it, letters and digits only."""
    squeezed = lambda x: f"regexp_replace({x}, '[^a-z0-9]', '')"
    last = "trim(element_at(split(p, '[>»/]'), -1))"
    return spark.sql(
        f"""
        with v as (select kind, value, {plain_sql('value')} as p from {{t}}),
        s as (
          select kind, value, array(
              {squeezed('p')},
              {squeezed(f"regexp_replace(regexp_replace(regexp_replace(p, {_lit(BRAND_BEFORE)}, ''), {_lit(BRAND_AFTER)}, ''), {_lit(BRAND_AFTER)}, '')")}) as ss
          from v where kind = 'brand'
          union all
          select kind, value, array(
              {squeezed('p')}, {squeezed(last)}, {squeezed(f"regexp_replace({last}, {_lit(CATEGORY_AFTER)}, '')")},
              {squeezed(f"regexp_replace({last}, {_lit(PLURAL_AFTER)}, '')")}) as ss
          from v where kind = 'category'
          union all
          select kind, value, array(
              {squeezed('p')}, {squeezed(f"regexp_replace(p, {_lit(COLOR_BEFORE)}, '')")}, {squeezed(f"regexp_replace(p, {_lit(COLOR_AFTER)}, '')")}) as ss
          from v where kind = 'color'
          union all
          select kind, value, array({squeezed('p')}) as ss from v where kind not in ('brand', 'category', 'color')
        )
        select distinct kind, value, s from s lateral view explode(ss) x as s where s <> ''
        """,
        t=values,
    )


def pigeonhole_join(spark: SparkSession, variants: DataFrame, forms: DataFrame) -> DataFrame:
    """``kind, value, ref_id, edits`` of every pair within the allowed edits (the least, if several).

    Edits are insertions, deletions, replacements and swaps of two neighbours. ``levenshtein`` counts
    a swap as two, so pairs it puts further apart are tried again with each neighbouring pair of the
    value swapped back.
    """
    edits = EDITS.format(n="len")
    anagram = "length(s) = len and array_sort(split(s, '')) = array_sort(split(form, ''))"
    swapped = "concat(left(s, i - 1), substring(s, i + 1, 1), substring(s, i, 1), substring(s, i + 2))"
    begins = "({i} * len div (k + 1))"
    # a segment moves by d characters if d more were put in than taken out before it; n - len - d behind it
    moves = "sequence(0 - (r - (n - len)) div 2, (r + (n - len)) div 2)"
    tasks = spark.conf.get("spark.sql.shuffle.partitions")
    return spark.sql(
        f"""
        with f as (select kind, ref_id, form, len, least({edits}, most) as most, {edits} as k from {{forms}}),
        fs as (
          select kind, ref_id, form, len, most, i, substring(form, {begins.format(i="i")} + 1, {begins.format(i="(i + 1)")} - {begins.format(i="i")}) as seg
          from f lateral view explode(sequence(0, least(k, len - 1))) x as i
        ),
        s as (select distinct kind, s, length(s) as n from {{variants}}),
        sl as (
          select * from (select kind, s, n, len, {edits} as k from s lateral view explode(sequence(greatest(1, n - {MOST}), n + {MOST})) x as len)
          where abs(n - len) <= k
        ),
        probes as (
          select kind, s, s as t, n, len, k, k as r from sl
          union all
          select kind, s, concat(left(s, at - 1), substring(s, at + 1, 1), substring(s, at, 1), substring(s, at + 2)), n, len, k, r
          from (
            select *, {begins.format(i="b")} + d as at
            from (select *, k - 1 as r from sl where k > 0 and abs(n - len) < k) lateral view explode(sequence(1, k)) x as b lateral view explode({moves}) y as d
          ) where at between 1 and n - 1 and substring(s, at, 1) <> substring(s, at + 1, 1)
        ),
        si as (
          select kind, s, t, n, len, r, i, {begins.format(i="i")} as at, {begins.format(i="(i + 1)")} - {begins.format(i="i")} as m
          from probes lateral view explode(sequence(0, least(k, len - 1))) x as i
        ),
        ss as (
          select distinct kind, s, len, i, substring(t, at + d + 1, m) as seg
          from si lateral view explode({moves}) x as d where at + d >= 0 and at + d + m <= n
        ),
        c as (select distinct ss.kind, ss.s, fs.ref_id, fs.form, fs.len, fs.most from ss join fs on ss.kind = fs.kind and ss.len = fs.len and ss.i = fs.i and ss.seg = fs.seg),
        d as (select /*+ REPARTITION({tasks}, s, form) */ *, levenshtein(s, form, 2 * {MOST}) as e from c),
        g as (
          select kind, s, ref_id, case
              when e between 0 and 1 then e
              when e = 2 and {anagram} and exists(sequence(1, length(s) - 1), i -> {swapped} = form) then 1
              when e = 2 then 2
              when e > 2 and most = 2 and exists(sequence(1, length(s) - 1), i -> levenshtein({swapped}, form) <= 1 or (levenshtein({swapped}, form) = 2 and {anagram})) then 2
            end as edits, most
          from d where e >= 0
        ),
        ok as (select kind, s, ref_id, min(edits) as edits from g where edits <= most group by kind, s, ref_id)
        select /*+ MERGE(ok) */ v.kind, v.value, ok.ref_id, min(ok.edits) as edits
        from {{variants}} v join ok on v.kind = ok.kind and v.s = ok.s group by v.kind, v.value, ok.ref_id
        """,
        forms=forms,
        variants=variants,
    )


def map_values(spark: SparkSession, values: DataFrame, ref_values: DataFrame) -> DataFrame:
    """``kind, value, ref_id, edits`` for each distinct value: the closest entry, -1 and null if none.

    ``values`` has ``kind, value``. Null and blank values are left out. Of entries equally close the
    one with the smallest ref_id is taken. An empty list maps all to -1.
    """
    values = spark.sql("select distinct kind, value from {t} where kind is not null and regexp_replace(value, '[\\\\p{{Z}}\\\\s]+', '') <> ''", t=values)
    values = cut(values)
    hits = pigeonhole_join(spark, cut(value_variants(spark, values)), cut(reference_forms(spark, ref_values)))
    best = cut(spark.sql("select kind, value, min(struct(edits, ref_id)) as b from {h} group by kind, value", h=hits))
    return spark.sql(
        """
        select kind, value, b.ref_id as ref_id, b.edits as edits from {b}
        union all
        select /*+ MERGE(b) */ v.kind, v.value, cast(-1 as bigint) as ref_id, cast(null as int) as edits
        from {v} v left anti join {b} b on v.kind = b.kind and v.value = b.value
        """,
        b=best,
        v=values,
    )


def typed_values(spark: SparkSession, raw_docs: DataFrame, skus: DataFrame) -> DataFrame:
    """``kind, ord, value``: brands of raw_docs, categories and colours of skus."""
    return spark.sql(
        """
        select 'brand' as kind, ord, brand as value from {d} where brand is not null
        union all select 'category', ord, category from {s} where category is not null
        union all select 'color', ord, color from {s} where color is not null
        """,
        d=raw_docs.select("ord", "brand"),
        s=skus.select("ord", "category", "color"),
    )


def mapped_rows(spark: SparkSession, raw_docs: DataFrame, skus: DataFrame, ref_values: DataFrame) -> DataFrame:
    """``kind, ord, ref_id`` of each row whose value isn't null, blank or exactly a canonical of its kind."""
    rows = spark.sql(
        "select v.kind, v.ord, v.value from {v} v left anti join {r} r on v.kind = r.kind and v.value = r.canonical",
        v=typed_values(spark, raw_docs, skus),
        r=ref_values.select("kind", "canonical"),
    )
    mapped = map_values(spark, rows, ref_values)
    return spark.sql("select /*+ MERGE(m) */ r.kind, r.ord, m.ref_id from {r} r join {m} m on r.kind = m.kind and r.value = m.value", r=rows, m=mapped)
