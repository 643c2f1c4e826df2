"""Quantities inside text: number, pack count and unit spelling, natively in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from offerloom.functions.collections import let
from offerloom.functions.text import plain

# --- fixed values: unit spellings (as ``plain`` leaves them), their common unit and factor ---------
UNITS = {
    "gr": ("gr", "1"), "g": ("gr", "1"), "gram": ("gr", "1"), "grm": ("gr", "1"), "mg": ("gr", "0.001"),
    "kg": ("gr", "1000"), "kilo": ("gr", "1000"), "kilogram": ("gr", "1000"),
    "oz": ("gr", "28.349523125"), "ounce": ("gr", "28.349523125"), "lb": ("gr", "453.59237"), "lbs": ("gr", "453.59237"),
    "ml": ("ml", "1"), "mililitre": ("ml", "1"), "cc": ("ml", "1"), "cl": ("ml", "10"),
    "l": ("ml", "1000"), "lt": ("ml", "1000"), "litre": ("ml", "1000"), "fl oz": ("ml", "29.5735295625"),
    "adet": ("adet", "1"), "tane": ("adet", "1"), "li": ("adet", "1"), "lu": ("adet", "1"), "duzine": ("adet", "12"),
    "tablet": ("tablet", "1"), "kapsul": ("tablet", "1"), "yikama": ("yikama", "1"),
}
#: Amounts written in words.
WORD_AMOUNTS = {"ceyrek": "0.25", "yarim": "0.5", "bir": "1", "bir bucuk": "1.5", "iki": "2", "iki bucuk": "2.5", "uc": "3", "dort": "4", "bes": "5", "on": "10"}
#: Numbers that are no quantities: shades, percentages, factors and offers.
NO_QUANTITY = (
    r"(?<![a-z])(?:no|ton|numara|renk)\b ?[:.]? ?[0-9]+(?![0-9])",
    r"% ?[0-9]+(?:[.,][0-9]+)?|[0-9]+(?:[.,][0-9]+)? ?%(?! ?[0-9])",
    r"(?<![a-z])(?:spf|ph|formul|faktor) ?[0-9]+(?:[.,][0-9]+)?\+?",
    r"(?<![0-9])[0-9]+ ?saat(?![a-z])",
    r"(?<![0-9])[0-9]+ ?al ?[0-9]+ ?ode(?![a-z])",
    r"(?<![0-9])[0-9]+ ?['’`]?(?:si|su|i|u)? ?1 ?arada(?![a-z])",
)
# -----------------------------------------------------------------------------------------------------

NUM = r"[0-9]{1,3}(?:\.[0-9]{3})+(?:,[0-9]+)?(?![0-9])|[0-9]+(?:[.,][0-9]+)?"
_LONG_FIRST = sorted((u for u in UNITS if u not in ("fl oz", "duzine", "yikama")), key=lambda u: (-len(u), u))
UNIT = r"fl ?\.? ?oz|" + "|".join(_LONG_FIRST)
_END = r"(?![a-z0-9])"
WASH = r"(?<![0-9.,a-z])([0-9]+) ?yikama" + _END
PACK_FIRST = rf"(?<![0-9.,a-z])([0-9]+) ?[x*×] ?({NUM}) ?['’`]?({UNIT}){_END}"
PACK_LAST = rf"(?<![0-9.,a-z])({NUM}) ?['’`]?({UNIT})\.? ?[x*×] ?([0-9]+)(?![0-9.,]*[0-9a-z])"
SINGLE = rf"(?<![0-9.,a-z])({NUM}) ?['’`]?({UNIT}){_END}"
MEASURE = rf"(?<![0-9.,a-z])({NUM}) ?['’`]?({'|'.join(['fl ?[.]? ?oz', *(u for u in _LONG_FIRST if UNITS[u][0] in ('gr', 'ml'))])}){_END}"
IN_WORDS = rf"(?<![a-z])({'|'.join(sorted(WORD_AMOUNTS, key=len, reverse=True))}) (kilogram|kilo|kg|litre|lt|duzine){_END}"
#: A number before any other word: a candidate for a unit spelling that is not listed.
UNLISTED = rf"(?<![0-9.,a-z])({NUM}) ?([a-z]{{1,12}})\.?{_END}"

#: Everything that may be read as a quantity, one pass over the text.
_HITS = rf"(?<![0-9.,a-z])(?=[0-9])(?:{'|'.join((PACK_FIRST, PACK_LAST, SINGLE))})|{IN_WORDS}"

MEASURED = "struct<num:decimal(20,6),pack:int,spelling:string>"


def number(c: Column) -> Column:
    """A dot before exactly three digits groups thousands; otherwise dot and comma are decimal."""
    grouped = c.rlike(r"^[0-9]{1,3}(\.[0-9]{3})+(,[0-9]+)?$")
    s = F.when(grouped, F.translate(c, ",.", ".")).otherwise(F.translate(c, ",", "."))
    return s.try_cast("decimal(20,6)")


def spelling(c: Column) -> Column:
    """One form per unit spelling: fluid ounces without their dots."""
    return F.when(c.rlike("^fl"), F.lit("fl oz")).otherwise(c)


def strip_no_quantity(t: Column) -> Column:
    for pat in NO_QUANTITY:
        t = F.regexp_replace(t, pat, " ")
    return t


def measured(c: Column | str, is_plain: bool = False) -> Column:
    """The stated quantity of a text as ``struct(num, pack, spelling)``, or null.

    ``is_plain``: ``c`` is a column that already went through ``plain`` and ``strip_no_quantity`` in an
    earlier projection; many expressions use it, so it shouldn't be computed in each.

    A count of washes comes first, then products of two numbers in either order, then a weight or a
    volume, then any other unit, then amounts in words.
    """
    text = (F.col(c) if isinstance(c, str) else c) if is_plain else strip_no_quantity(plain(c))
    return let(text, lambda t: F.when(t.rlike(WASH), _made(number(F.regexp_extract(t, WASH, 1)), F.lit(1), F.lit("yikama"))).otherwise(
        let(F.array_join(F.regexp_extract_all(t, F.lit(_HITS), F.lit(0)), "\n"), _read)))


def _made(num: Column, pack: Column, unit: Column) -> Column:
    return F.struct(num.alias("num"), pack.cast("int").alias("pack"), unit.alias("spelling"))


def _read(t: Column) -> Column:
    """The quantity among the hits ``t``, one a line."""
    g = lambda pat, i: F.regexp_extract(t, pat, i)
    one = F.lit(1)
    words = F.create_map(*[F.lit(x) for kv in WORD_AMOUNTS.items() for x in kv])
    return (
        F.when(t == "", F.lit(None).cast(MEASURED))
        .when(t.rlike(PACK_FIRST), _made(number(g(PACK_FIRST, 2)), g(PACK_FIRST, 1).try_cast("int"), spelling(g(PACK_FIRST, 3))))
        .when(t.rlike(PACK_LAST), _made(number(g(PACK_LAST, 1)), g(PACK_LAST, 3).try_cast("int"), spelling(g(PACK_LAST, 2))))
        .when(t.rlike(MEASURE), _made(number(g(MEASURE, 1)), one, spelling(g(MEASURE, 2))))
        .when(t.rlike(SINGLE), _made(number(g(SINGLE, 1)), one, spelling(g(SINGLE, 2))))
        .when(t.rlike(IN_WORDS), _made(words[g(IN_WORDS, 1)].cast("decimal(20,6)"), one, g(IN_WORDS, 2)))
    )
