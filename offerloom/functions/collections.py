"""Array and map functions as Column expressions, and choices among rows with a total order."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` names it.

    The optimiser copies a column into every expression and pushed filter that uses it; a lambda's
    variable can't be copied.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def dedup_denull(a: Column) -> Column:
    """Without nulls and repeats, first places kept."""
    return F.array_distinct(F.array_compact(a))


def drop_empty(a: Column) -> Column:
    """Without nulls and empty strings."""
    return F.filter(a, lambda x: x.isNotNull() & (x != ""))


def longest_first(a: Column) -> Column:
    """By length descending; equal lengths stay in order."""
    keyed = F.transform(a, lambda x, i: F.struct((-F.length(x)).alias("n"), i.alias("i"), x.alias("x")))
    return F.transform(F.array_sort(keyed), lambda s: s["x"])


def most_common(a: Column, n: int) -> Column:
    """The n most frequent elements, first seen first among equals; nulls don't count."""
    d = F.array_distinct(F.array_compact(a))
    keyed = F.transform(d, lambda x, i: F.struct((-F.size(F.filter(a, lambda y: y == x))).alias("n"), i.alias("i"), x.alias("x")))
    return F.transform(F.slice(F.array_sort(keyed), 1, n), lambda s: s["x"])


def majority(a: Column) -> Column:
    """The one most frequent element, null if another is as frequent."""
    d = F.array_distinct(F.array_compact(a))
    keyed = F.array_sort(F.transform(d, lambda x, i: F.struct((-F.size(F.filter(a, lambda y: y == x))).alias("n"), i.alias("i"), x.alias("x"))))
    tie = (F.size(keyed) > 1) & (F.get(keyed, F.lit(0))["n"] == F.get(keyed, F.lit(1))["n"])
    return F.when(~tie, F.get(keyed, F.lit(0))["x"])


def argmin_key(m: Column) -> Column:
    """The key of the least value, the first key among equals."""
    return F.array_min(F.transform(F.map_entries(m), lambda e: F.struct(e["value"].alias("v"), e["key"].alias("k"))))["k"]


def overlay(old: Column, new: Column) -> Column:
    """``old`` with the entries of ``new`` over it; a null map counts as empty."""
    o, n = F.coalesce(old, F.create_map().cast("map<string,string>")), F.coalesce(new, F.create_map().cast("map<string,string>"))
    return F.map_concat(F.map_filter(o, lambda k, _: ~F.coalesce(F.array_contains(F.map_keys(n), k), F.lit(False))), n)


def merged_maps(*maps: Column) -> Column:
    """One map of several: the first that has a key gives its value; null maps count as empty, keys without a value go."""
    out = maps[-1]
    for m in reversed(maps[:-1]):
        out = overlay(out, m)
    return F.map_filter(out, lambda _, v: v.isNotNull())


def nested_sets(rows: DataFrame, col: str) -> DataFrame:
    """``key, members``: for each key of a map of arrays the different members it has in any row."""
    each = rows.select(F.explode(col).alias("key", "m")).select("key", F.explode("m").alias("m")).where("m is not null")
    return each.groupBy("key").agg(F.array_sort(F.collect_set("m")).alias("members"))


def sorted_entries(m: Column) -> Column:
    """``k=v`` entries in order, joined: a form that any engine can compare."""
    return F.array_join(F.array_sort(F.transform(F.map_entries(m), lambda e: F.concat(e["key"].cast("string"), F.lit("="), e["value"].cast("string")))), ",")


def sorted_text(a: Column) -> Column:
    return F.array_join(F.array_sort(a), ",")


def clean_item(df: DataFrame) -> DataFrame:
    """Empty strings, empty arrays and maps, and zeros become null; false stays."""
    out = []
    for name, kind in df.dtypes:
        c = F.col(name)
        if kind == "string":
            c = F.nullif(c, F.lit(""))
        elif kind.startswith(("array", "map")):
            c = F.when(F.size(c) > 0, c)
        elif kind in ("double", "float", "int", "bigint") or kind.startswith("decimal"):
            c = F.when(c != 0, c)
        out.append(c.alias(name))
    return df.select(*out)


def top_per(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The first n rows of each key in the given order."""
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")
