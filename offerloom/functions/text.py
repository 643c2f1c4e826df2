"""String functions as Column expressions; every one runs inside the JVM.

Null in gives null out unless stated otherwise.
"""

from __future__ import annotations

import functools
import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values ------------------------------------------------------------------------------
#: Words left out of cleaned names.
STOPWORDS = ("ml", "gr", "kg", "adet", "ve", "and", "ile", "for", "icin")
#: Endings that make a Turkish plural.
PLURALS = ("leri", "lari", "ler", "lar")
#: Cyrillic and Greek capitals and small letters that look like a Latin one, and that one.
LOOK_ALIKES = {
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X", "І": "I", "Ѕ": "S", "Ј": "J", "Ү": "Y", "Ԁ": "D", "Ԛ": "Q", "Ԝ": "W",
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x", "і": "i", "ѕ": "s", "ј": "j", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ѵ": "v",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "α": "a", "β": "b", "γ": "y", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "σ": "o", "τ": "t", "υ": "u", "χ": "x", "ω": "w", "ϲ": "c", "ϳ": "j",
}
# -----------------------------------------------------------------------------------------------


def _as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


@functools.cache
def ascii_fold_map(limit: int = 0x20000) -> tuple[dict[str, str], dict[str, str]]:
    """Code points whose compatibility decomposition is one ASCII character, and several: by rule."""
    one, many = {}, {}
    for cp in range(0x80, limit):
        ch = chr(cp)
        to = "".join(x for x in unicodedata.normalize("NFKD", ch) if ord(x) < 128)
        if len(to) == 1:
            one[ch] = to
        elif len(to) > 1:
            many[ch] = to
    return one, many


@functools.cache
def _small_fold_map() -> tuple[str, str]:
    one, _ = ascii_fold_map()
    low = {k: v.lower() for k, v in one.items()}
    return "".join(low), "".join(low.values())


def accent_fold(c: Column | str) -> Column:
    """Characters whose decomposition is ASCII become it, whether one character or several; others stay."""
    one, many = ascii_fold_map()
    c = F.translate(_as_col(c), "".join(one), "".join(one.values()))
    # two literals instead of one for each entry: the optimiser makes them one map, the driver has less to build
    several = F.map_from_arrays(F.split(F.lit("\n".join(many)), "\n"), F.split(F.lit("\n".join(many.values())), "\n"))
    spelt_out = lambda x: F.array_join(F.transform(F.split(x, ""), lambda ch: F.coalesce(several[ch], ch)), "")
    # few texts still have a foreign character, so only they are taken apart
    return F.get(F.transform(F.array(c), lambda x: F.when(x.rlike(r"[^\x00-\x7Fı]"), spelt_out(x)).otherwise(x)), F.lit(0))


def squeeze(c: Column | str) -> Column:
    """White space runs to one blank, ends trimmed."""
    return F.trim(F.regexp_replace(_as_col(c), r"\s+", " "))


def non_word_to_space(c: Column | str) -> Column:
    """Everything but letters, digits and ``_`` becomes a blank; ends trimmed."""
    return F.trim(F.regexp_replace(_as_col(c), r"(?U)[^\w]", " "))


def replace_chars(c: Column | str) -> Column:
    """Lower case, dotless i to i; ``&``, ``-`` and ``/`` to blanks, comma to dot, star set apart."""
    c = F.replace(F.lower(_as_col(c)), F.lit("ı"), F.lit("i"))
    return F.replace(F.translate(c, "&-/,", "   ."), F.lit("*"), F.lit(" * "))


def dots_in_numbers_only(c: Column | str) -> Column:
    """A dot stays in tokens that are digits without their dots, elsewhere it becomes a blank."""
    toks = F.filter(F.split(_as_col(c), r"\s+"), lambda t: t != "")
    kept = F.transform(toks, lambda t: F.when(F.replace(t, F.lit("."), F.lit("")).rlike("^[0-9]+$"), t).otherwise(F.replace(t, F.lit("."), F.lit(" "))))
    return F.array_join(kept, " ")


def clean_string(c: Column | str) -> Column:
    """Lower-case ASCII with digits, blanks, commas and number dots only; null and '' give ''."""
    c = accent_fold(replace_chars(_as_col(c)))
    c = F.regexp_replace(c, "[^a-zA-Z0-9,. ]", "")
    return F.coalesce(squeeze(dots_in_numbers_only(c)), F.lit(""))


def singular(c: Column | str) -> Column:
    """Plural endings leave the last four characters, wherever in them they stand."""
    c = _as_col(c)
    tail = F.right(c, F.lit(4))
    for p in PLURALS:
        tail = F.replace(tail, F.lit(p), F.lit(""))
    return F.concat(F.when(F.length(c) > 4, F.left(c, F.length(c) - 4)).otherwise(""), tail)


def tokens(c: Column | str) -> Column:
    """Words at white space, without empty ones."""
    return F.filter(F.split(F.trim(_as_col(c)), r"\s+"), lambda t: t != "")


def drop_stopwords(arr: Column, words: tuple[str, ...] = STOPWORDS) -> Column:
    """Repeated words stay repeated."""
    return F.filter(arr, lambda t: ~t.isin(*words))


def is_single_letter(t: Column) -> Column:
    return (F.length(t) == 1) & ~t.rlike("[0-9]")


def is_barcode_token(t: Column) -> Column:
    return t.rlike("^([0-9]{8}|[0-9]{10}|[0-9]{11}|[0-9]{13})$")


def is_mixed_token(t: Column) -> Column:
    """Letters and digits mixed in a token of more than five characters."""
    return (F.length(t) > 5) & t.rlike("[0-9]") & t.rlike("[a-zA-Z]")


def remove_substrings(c: Column | str, subs: Column) -> Column:
    """Each literal of the array ``subs`` is taken out, blanks squeezed."""
    return squeeze(F.aggregate(subs, _as_col(c), lambda acc, s: F.when(s == "", acc).otherwise(F.replace(acc, s, F.lit("")))))


def windows(arr: Column, least: int = 1) -> Column:
    """All runs of at least ``least`` consecutive words, by start and then by length."""
    n = F.size(arr)
    starts = F.when(n >= least, F.sequence(F.lit(1), n - least + 1)).otherwise(F.array().cast("array<int>"))
    return F.flatten(F.transform(starts, lambda i: F.transform(F.sequence(F.lit(least), n - i + 1), lambda k: F.array_join(F.slice(arr, i, k), " "))))


def prefixes(arr: Column, end: int | None = None, clamp: bool = False) -> Column:
    """Prefixes of 1..end words (all without ``end``); beyond the last word the whole repeats unless ``clamp``."""
    n = F.size(arr) if end is None else F.lit(end) if not clamp else F.least(F.lit(end), F.size(arr))
    return F.when(F.size(arr) > 0, F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(arr, 1, i), " "))).otherwise(F.array().cast("array<string>"))


def contains_words(hay: Column, needle: Column) -> Column:
    """``needle`` is a substring of ``hay`` and all its words are words of it."""
    return F.contains(hay, needle) & (F.size(F.array_except(tokens(needle), tokens(hay))) == 0)


def category_parts(c: Column | str) -> Column:
    """Cut at slash, comma, ampersand and the words for 'and'; parts trimmed."""
    return F.transform(F.split(_as_col(c), "/|,|&| ve | and "), lambda p: F.trim(p))


def sorted_words(c: Column | str) -> Column:
    """The words in order: equal for texts with the same words in another order."""
    return F.array_join(F.array_sort(tokens(c)), " ")


def strip_trailing_slash(c: Column | str) -> Column:
    """One slash at the end goes."""
    return F.regexp_replace(_as_col(c), "/$", "")


def strip_tracking(c: Column | str) -> Column:
    """Advertising parameters and all after them go, then one slash at the end."""
    return strip_trailing_slash(F.regexp_replace(_as_col(c), r"[?&](gclid|utm).*$", ""))


def plain(c: Column | str) -> Column:
    """One comparable form for dirty text: lower-case, unaccented, without disguise.

    Words wholly in Cyrillic or Greek go (they are slogans here), look-alike letters elsewhere become
    Latin, compatibility forms and accents fold to ASCII, invisible characters and combining marks go,
    all kinds of space become one blank. Other characters stay. Null gives null.
    """
    c = _as_col(c)
    c = F.regexp_replace(c, r"[\p{Cf}\p{Mn}\p{Me}]", "")
    c = F.regexp_replace(c, r"(?<![\p{L}\p{N}])[\p{IsCyrillic}\p{IsGreek}]+(?![\p{L}\p{N}])", " ")
    c = F.translate(c, "".join(LOOK_ALIKES), "".join(LOOK_ALIKES.values()))
    _, many = ascii_fold_map()
    for ch, to in many.items():
        if 0xFB00 <= ord(ch) <= 0xFB06:
            c = F.replace(c, F.lit(ch), F.lit(to))
    src, dst = _small_fold_map()
    c = F.regexp_replace(F.lower(c), r"\p{Mn}", "")
    c = F.translate(c, src + "ı", dst + "i")
    return F.trim(F.regexp_replace(c, r"[\p{Z}\s]+", " "))


def words(c: Column | str) -> Column:
    """Words for text comparison: no case, accents, punctuation or invisible characters."""
    c = F.regexp_replace(F.lower(_as_col(c)), r"[\p{Cf}\p{M}]", "")
    src, dst = _small_fold_map()
    c = F.translate(c, src + "ı", dst + "i")
    return F.filter(F.split(c, r"[^\p{L}\p{N}]+"), lambda t: t != "")


def py_plain(s: str) -> str:
    """``plain`` for one Python string (tests and driver-side constants)."""
    s = "".join(x for x in s if unicodedata.category(x) not in ("Cf", "Mn", "Me"))
    s = re.sub(r"(?<![^\W_])[Ͱ-ϿЀ-ӿ]+(?![^\W_])", " ", s)
    s = "".join(LOOK_ALIKES.get(x, x) for x in s).lower().replace("ı", "i")
    s = "".join(x for x in unicodedata.normalize("NFKD", s) if unicodedata.category(x) != "Mn")
    return re.sub(r"\s+", " ", s).strip()
