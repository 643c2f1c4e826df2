"""The functions that queries in SQL need most, under names of their own in a session.

They are SQL functions, so the optimiser puts their bodies into the plan and they stay in the JVM.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from offerloom.functions.text import PLURALS

_TAIL = "right(x, 4)"
for _p in PLURALS:
    _TAIL = f"replace({_TAIL}, '{_p}', '')"

#: Name, arguments, result and body; the body says the same as the Column function of that name.
DEFINITIONS = {
    "strip_trailing_slash": ("x string", "string", "regexp_replace(x, '/$', '')"),
    "strip_tracking": ("x string", "string", "regexp_replace(regexp_replace(x, '[?&](gclid|utm).*$', ''), '/$', '')"),
    "singular": ("x string", "string", f"concat(case when length(x) > 4 then left(x, length(x) - 4) else '' end, {_TAIL})"),
    "sorted_words": ("x string", "string", "array_join(array_sort(filter(split(trim(x), '\\\\s+'), t -> t <> '')), ' ')"),
    "category_parts": ("x string", "array<string>", "transform(split(x, '/|,|&| ve | and '), p -> trim(p))"),
    "convert_price": (
        "x string", "double",
        "round(try_cast(regexp_extract(regexp_replace(regexp_replace(lower(x), 'tl|₺|try|[ ]', ''), '^([^.]*)\\\\.([^.]*)\\\\.([^.]*)$', '$1.$2'), '^[+-]?([0-9]+\\\\.?[0-9]*|\\\\.[0-9]+)(e[+-]?[0-9]+)?$', 0) as double), 2)",
    ),
    "search_barcode": ("x string", "string", "case when not startswith(x, '0') then x when length(x) = 14 and not startswith(x, '00') then right(x, 13) end"),
    "gtin": (
        "x string", "string",
        "transform(array(ltrim('0', regexp_replace(x, '[^0-9]', ''))), d -> case when length(d) between 8 and 14 and (10 - aggregate(sequence(1, 13), 0, (a, i) -> a + cast(substring(lpad(d, 14, '0'), i, 1) as int) * (case when i % 2 = 1 then 3 else 1 end)) % 10) % 10 = cast(right(d, 1) as int) then d end)[0]",
    ),
    "contains_words": ("hay string, needle string", "boolean", "contains(hay, needle) and size(array_except(filter(split(trim(needle), '\\\\s+'), t -> t <> ''), filter(split(trim(hay), '\\\\s+'), t -> t <> ''))) = 0"),
}


def register(spark: SparkSession, prefix: str = "offer_") -> list[str]:
    """Make the functions known to the session's SQL as ``offer_<name>``; the names."""
    for name, (args, result, body) in DEFINITIONS.items():
        spark.sql(f"create or replace temporary function {prefix}{name}({args}) returns {result} return {body}")
    return [prefix + n for n in DEFINITIONS]
