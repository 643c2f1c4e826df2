"""Barcodes as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def barcode_tokens(arr: Column) -> Column:
    """Array entries cut at commas, trimmed; empty ones stay out."""
    parts = F.flatten(F.transform(arr, lambda b: F.transform(F.split(F.coalesce(b, F.lit("")), ","), lambda t: F.trim(t))))
    return F.filter(parts, lambda t: t != "")


def clean_barcodes(arr: Column) -> Column:
    """8 or 13 digits as they are; 14 digits with one leading zero without it; the rest out; distinct."""
    digits = F.filter(barcode_tokens(arr), lambda t: t.rlike("^[0-9]+$"))
    kept = F.transform(digits, lambda t: F.when(F.length(t).isin(8, 13), t).when(t.rlike("^0[1-9][0-9]{12}$"), F.right(t, F.lit(13))))
    return F.array_distinct(F.array_compact(kept))


def info_barcodes(arr: Column) -> Column:
    """Of 13 or 14 characters starting with 0: all leading zeros off, digits only, distinct."""
    some = F.filter(arr, lambda t: F.length(t).isin(13, 14) & t.startswith("0"))
    bare = F.transform(some, lambda t: F.ltrim(t, F.lit("0")))
    return F.array_distinct(F.filter(bare, lambda t: t.rlike("^[0-9]+$")))


def search_barcode(c: Column) -> Column:
    """Codes worth searching for: 8 long with leading 0 out; 14 long '0x' to its last 13; other leading zeros out."""
    return (
        F.when(~c.startswith("0"), c)
        .when((F.length(c) == 14) & ~c.startswith("00"), F.right(c, F.lit(13)))
    )


def url_barcode(c: Column) -> Column:
    """A run of 13 digits, else of 14, in an image address."""
    a, b = F.regexp_extract(c, "[0-9]{13}", 0), F.regexp_extract(c, "[0-9]{14}", 0)
    return F.when(a != "", a).when(b != "", b)


def longest_digits(c: Column) -> Column:
    """The longest run of digits, the first of equals; null if there is none."""
    runs = F.regexp_extract_all(c, F.lit("([0-9]+)"), F.lit(1))
    best = F.array_max(F.transform(runs, lambda r, i: F.struct(F.length(r).alias("n"), (-i).alias("i"), r.alias("r"))))
    return best["r"]


def gtin(c: Column) -> Column:
    """The digits without leading zeros where 8 to 14 remain and the last is the right check digit, else null."""
    d = F.ltrim(F.regexp_replace(c, "[^0-9]", ""), F.lit("0"))
    p = F.lpad(d, 14, "0")
    total = sum((F.substring(p, i, 1).cast("int") * (3 if i % 2 else 1) for i in range(1, 14)), F.lit(0))
    ok = F.length(d).between(8, 14) & ((F.lit(10) - total % 10) % 10 == F.substring(p, 14, 1).cast("int"))
    return F.when(ok, d)
