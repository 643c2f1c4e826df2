"""Texts that look plain but are made of other characters: found, and brought to one form.

Method: DuckDB inside the Arrow partitions. Each Arrow batch is a DuckDB relation; regular expressions
over character classes find the cases, and ``translate``, a table of compatibility forms, regular
expressions and ``nfc_normalize`` make the consistent form, all in the embedded SQL.

Scale: one narrow stage, no shuffle; a batch is as large as Arrow makes it, and DuckDB holds one batch
at a time with one thread and a memory limit per Python worker.
"""

from __future__ import annotations

import functools
import sys
import unicodedata
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from offerloom.functions.text import LOOK_ALIKES

MEMORY = "256MB"


def _ranges(cps: Iterable[int]) -> str:
    """A regular-expression class body for code points."""
    out: list[list[int]] = []
    for cp in cps:
        if out and out[-1][1] == cp - 1:
            out[-1][1] = cp
        else:
            out.append([cp, cp])
    return "".join(f"\\x{{{a:X}}}" if a == b else f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in out)


@functools.cache
def compatibility_forms() -> dict[str, str]:
    """Characters with a compatibility decomposition (wide, styled, joined, ...) and what they stand for, by rule.

    Kinds of space and spacing accents, which decompose to a space, are left to the other classes.
    """
    out = {}
    for cp in range(0x80, sys.maxunicode + 1):
        ch = chr(cp)
        if unicodedata.decomposition(ch).startswith("<"):
            to = unicodedata.normalize("NFKC", ch)
            if " " not in to and to != ch:
                out[ch] = to
    return out


COMBINING = r"\p{M}"
#: Format and control characters but tab and line ends, and fillers without a shape.
INVISIBLE = r"\p{Cf}\x{0}-\x{8}\x{E}-\x{1F}\x{7F}-\x{84}\x{86}-\x{9F}\x{115F}\x{1160}\x{2800}\x{3164}\x{FFA0}"
OTHER_SPACE = r"\x{9}-\x{D}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
FOREIGN = r"\p{Cyrillic}\p{Greek}"
WORDLY = r"\p{L}\p{M}\p{N}\p{Cf}_"


@functools.cache
def patterns() -> dict[str, str]:
    joiner = f"[{WORDLY}]*"
    return {
        "form": f"[{_ranges(sorted(map(ord, compatibility_forms())))}]",
        "mark": f"[{COMBINING}]",
        "invisible": f"[{INVISIBLE}]",
        "space": f"[{OTHER_SPACE}]",
        "look_alike": f"\\p{{Latin}}{joiner}[{FOREIGN}]|[{FOREIGN}]{joiner}\\p{{Latin}}",
    }


def _quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _connect():
    import duckdb

    con = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": MEMORY, "temp_directory": ""})
    forms = compatibility_forms()
    con.execute("create table forms (c varchar, t varchar)")
    con.register("forms_in", pa.table({"c": list(forms), "t": list(forms.values())}))
    con.execute("insert into forms select * from forms_in")
    con.unregister("forms_in")
    return con


def _fields_sql(fields: tuple[str, ...]) -> str:
    return " union all ".join(f"select ord, {_quote(f)} as field, {f} as text from batch where {f} is not null" for f in fields)


def _found_sql(fields: tuple[str, ...]) -> str:
    is_so = {n: f"regexp_matches(text, {_quote(p)})" for n, p in patterns().items()}
    # a character that normalising replaces by another one (the Kelvin sign) is a form too
    is_so["form"] += f" or (not {is_so['mark']} and nfc_normalize(text) <> text)"
    reasons = ", ".join(f"case when {x} then {_quote(n)} end" for n, x in is_so.items())
    return f"select ord, field, text, array_to_string([{reasons}], ',') as reasons from ({_fields_sql(fields)})"


def detect(raw_docs: DataFrame, fields: tuple[str, ...] = ("name", "brand")) -> DataFrame:
    """``ord, field, reasons`` (comma-separated) for each text that holds a disguise.

    Reasons: form (wide, styled, joined letters, digits, signs), mark, invisible, space, look_alike
    (Cyrillic or Greek letters in a word that also has Latin ones). Null and empty texts have none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        con = _connect()
        sql = f"select ord, field, reasons from ({_found_sql(fields)}) where reasons <> ''"
        for b in batches:
            con.register("batch", pa.Table.from_batches([b]))
            yield from con.sql(sql).to_arrow_table().cast(pa.schema([("ord", pa.int64()), ("field", pa.string()), ("reasons", pa.string())])).to_batches()
            con.unregister("batch")

    return raw_docs.select("ord", *fields).mapInArrow(run, "ord long, field string, reasons string")


def consistent(raw_docs: DataFrame, fields: tuple[str, ...] = ("name", "brand")) -> DataFrame:
    """``ord, field, clean`` for each text that holds a disguise: its one consistent form.

    Compatibility forms become what they stand for, invisible characters go, marks join their letter
    (those left over go), spaces become plain ones, and look-alikes in words with Latin letters become
    Latin. Repeated plain spaces and words wholly in another script stay.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        con = _connect()
        look = f"translate(w, {_quote(''.join(LOOK_ALIKES))}, {_quote(''.join(LOOK_ALIKES.values()))})"
        mixed = f"regexp_matches(w, {_quote(patterns()['look_alike'])})"
        sql = f"""
            with found as (select ord, field, text from ({_found_sql(fields)}) where reasons <> ''),
            bare as (select ord, field, regexp_replace(regexp_replace(text, {_quote(patterns()['space'])}, ' ', 'g'), {_quote(patterns()['invisible'])}, '', 'g') as text from found),
            chars as (select ord, field, unnest(regexp_extract_all(text, '(?s).')) as c, generate_subscripts(regexp_extract_all(text, '(?s).'), 1) as i from bare where text <> ''),
            joined as (select ord, field, nfc_normalize(string_agg(coalesce(forms.t, chars.c), '' order by i)) as text from chars left join forms using (c) group by ord, field),
            unmarked as (select ord, field, regexp_replace(text, '[{COMBINING}]', '', 'g') as text from joined)
            select b.ord, b.field, coalesce(array_to_string(list_transform(string_split(u.text, ' '), lambda w: case when {mixed} then {look} else w end), ' '), '') as clean
            from bare b left join unmarked u using (ord, field)
        """
        for b in batches:
            con.register("batch", pa.Table.from_batches([b]))
            yield from con.sql(sql).to_arrow_table().cast(pa.schema([("ord", pa.int64()), ("field", pa.string()), ("clean", pa.string())])).to_batches()
            con.unregister("batch")

    return raw_docs.select("ord", *fields).mapInArrow(run, "ord long, field string, clean string")
