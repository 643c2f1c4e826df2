"""Prices in text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: How a source writes thousands and decimals: T dot groups and comma is decimal, D text before the
#: first dot with comma decimal, S comma decimal, N a number.
RULES = ("T", "D", "S", "N")


def convert_price(c: Column) -> Column:
    """A price as a double rounded to cents; unparseable or empty gives null. Of three dot parts the first two count."""
    s = F.regexp_replace(F.lower(c.cast("string")), "tl|₺|try|[ ]", "")
    s = F.regexp_replace(s, r"^([^.]*)\.([^.]*)\.([^.]*)$", "$1.$2")
    num = F.regexp_extract(s, r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?$", 0)
    return F.round(num.try_cast("double"), 2)


def locale_price(c: Column, rule: str) -> Column:
    """A shop's price text as a double by its rule."""
    if rule == "T":
        s = F.translate(c, ",.", ".")
    elif rule == "D":
        s = F.translate(F.substring_index(c, ".", 1), ",", ".")
    elif rule == "S":
        s = F.translate(c, ",", ".")
    elif rule == "N":
        s = c
    else:
        raise ValueError(f"price rule {rule!r}")
    return convert_price(s)
