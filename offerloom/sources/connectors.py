"""Shop pages and responses as scans: a table of fetched pages in, raw offers out, by a source's settings.

Fetching is outside; a page table has ``url`` and ``body``. HTML sources cut product blocks and fields
by patterns, JSON sources by paths; paging is the fetcher's, told by ``next_page``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerloom.functions.barcode import longest_digits, url_barcode
from offerloom.functions.price import locale_price


@dataclass(frozen=True)
class Source:
    """How one shop's pages are read."""

    market: str
    kind: str = "html"  # html, json, json_ld, json_in_text or html_in_json
    block: str = ""  # html: pattern of a product; json: path of the product array; html_in_json: pattern within the page
    outer: str = ""  # json_in_text: pattern whose first group is the product array; html_in_json: path of the page
    maps: dict[str, tuple[str, str]] = field(default_factory=dict)  # promoted, variants: patterns of keys and values within a block
    fields: dict[str, str] = field(default_factory=dict)  # field to pattern (first group) or path
    price: str = "T"
    base: str = ""
    barcode_from: str = ""  # field whose address holds the code
    unique_hit: bool = False  # search: only a single hit counts
    next_page: str = ""  # offset, page, link or none


#: What the shops have in common, by name: kind of page, price rule, paging, where codes come from.
#: Patterns belong to a deployment and are given to ``register``.
KNOWN = {
    "civil": ("json", "S", "link", "src"), "gratis": ("json", "N", "offset", ""), "ozdilek": ("html", "S", "offset", "src"), "perfumepoint": ("html", "D", "link", "src"),
    "peynircibaba": ("html", "S", "page", "src"), "rossmann": ("html", "T", "link", "src"), "sevil": ("html", "S", "link", "src"), "seyhanlar": ("html", "D", "link", "src"),
    "ceptesok": ("json", "N", "page", ""), "migros": ("html", "D", "page", ""), "gittigidiyor": ("html", "T", "page", ""), "n11": ("html", "T", "page", ""), "ty": ("json", "N", "page", ""),
    "ty_detail": ("json_ld", "N", "none", ""), "a101": ("html", "T", "page", ""), "altunbilekler": ("html", "T", "link", ""), "carrefoursa": ("html", "T", "link", ""),
    "cosmetica": ("html", "T", "link", ""), "eve": ("html", "T", "link", ""), "groseri": ("html", "D", "page", ""), "joker": ("html", "T", "link", ""), "marketyo": ("json", "N", "page", ""),
    "mopas": ("html", "S", "link", ""), "watsons": ("html", "T", "link", ""), "google": ("html", "T", "none", ""), "akakce": ("html", "T", "none", ""), "marketpaketi": ("html", "T", "link", "name"),
}
#: Shops whose search pages count only if they have a single hit.
UNIQUE_HIT = ("a101", "carrefoursa", "groseri", "watsons", "marketyo", "akakce")
#: Shops that are searched by barcode.
SEARCHED = (*UNIQUE_HIT, "altunbilekler", "cosmetica", "eve", "joker", "mopas", "google", "marketpaketi")
_REGISTRY: dict[str, Source] = {}


def register(name: str, block: str, fields: dict[str, str], base: str = "", outer: str = "", kind: str = "", maps: dict[str, tuple[str, str]] | None = None) -> Source:
    """A known shop with a deployment's patterns, ready to read."""
    known, price, paging, code = KNOWN[name]
    _REGISTRY[name] = Source(name, kind or known, block, outer, maps or {}, fields, price, base, code, name in UNIQUE_HIT, paging)
    return _REGISTRY[name]


def sources(search: bool | None = None) -> list[str]:
    """Registered names; ``search`` picks those that are or aren't searched by barcode."""
    return sorted(n for n in _REGISTRY if search is None or (n in SEARCHED) == search)


def _blocks(pages: DataFrame, src: Source) -> DataFrame:
    """A row a product block ``b`` beside the page's columns; pages that can't be read give none."""
    array = lambda c: F.from_json(c, "array<string>")
    cut = lambda c, pat: F.regexp_extract_all(c, F.lit(f"(?s)({pat})"), F.lit(1))
    body = F.col("body")
    each = {
        "html": lambda: cut(body, src.block),
        "json": lambda: array(F.get_json_object(body, src.block)),
        "json_ld": lambda: F.regexp_extract_all(body, F.lit(r"(?s)<script[^>]*ld\+json[^>]*>(.*?)</script>"), F.lit(1)),
        "json_in_text": lambda: array(F.nullif(F.regexp_extract(body, f"(?s){src.outer}", 1), F.lit(""))),
        "html_in_json": lambda: cut(F.get_json_object(body, src.outer), src.block),
    }
    return pages.select(*[c for c in pages.columns if c != "body"], F.explode(each[src.kind]()).alias("b"))


def _maps(src: Source) -> list[Column]:
    found = lambda pat: F.regexp_extract_all("b", F.lit(f"(?s){pat}"), F.lit(1))
    out = []
    for name in ("promoted", "variants"):
        k, v = src.maps.get(name, (None, None))
        pairs = F.filter(F.arrays_zip(found(k).alias("k"), found(v).alias("v")), lambda e: e["k"].isNotNull() & e["v"].isNotNull()) if k else None
        # a key that comes twice keeps its last value
        last = F.filter(pairs, lambda e, i: ~F.exists(F.transform(pairs, lambda x, j: F.struct(x["k"].alias("k"), j.alias("j"))), lambda x: (x["k"] == e["k"]) & (x["j"] > i))) if k else None
        out.append((F.map_from_entries(last) if k else F.lit(None).cast("map<string,string>")).alias(name))
    return out


def _offers(pages: DataFrame, src: Source, keep: tuple[str, ...]) -> DataFrame:
    each = _blocks(pages, src)
    if src.kind.startswith("html"):
        get = lambda f: F.nullif(F.regexp_extract("b", f"(?s){src.fields[f]}", 1), F.lit("")) if f in src.fields else F.lit(None).cast("string")
    else:
        get = lambda f: F.get_json_object("b", src.fields[f]) if f in src.fields else F.lit(None).cast("string")
    d = each.select(*keep, *[get(f).alias(f) for f in ("link", "name", "price", "src", "brand", "barcode")], *_maps(src))
    code = F.coalesce("barcode", url_barcode(F.col("src")) if src.barcode_from == "src" else longest_digits(F.col("name")) if src.barcode_from == "name" else F.lit(None))
    return d.where("link is not null").select(
        F.lit(src.market).alias("market"), F.concat(F.lit(src.base), "link").alias("link"), F.trim("name").alias("name"), locale_price(F.col("price"), src.price).alias("price"),
        "src", "brand", F.array_compact(F.array(code)).alias("barcodes"), "promoted", "variants", *keep)


def read_offers(pages: DataFrame, src: Source) -> DataFrame:
    """``market, link, name, price, src, brand, barcodes, promoted, variants``: the offers on list pages; blocks without a link are left out."""
    return _offers(pages, src, ())


def read_search(pages: DataFrame, src: Source) -> DataFrame:
    """The offers on search pages (``url, body, code``): they get the searched barcode; of shops where only a single hit counts, pages with several give none."""
    out = _offers(pages, src, ("url", "code"))
    if src.unique_hit:
        one = out.groupBy("url").agg(F.count(F.lit(1)).alias("_n")).where("_n = 1").select("url")
        out = out.join(one, "url", "left_semi")
    return out.withColumn("barcodes", F.array_compact(F.array_union("barcodes", F.array("code")))).drop("url", "code")


def page_fields(pages: DataFrame) -> DataFrame:
    """``url, title, h1, n_links`` of HTML pages."""
    return pages.select("url", F.regexp_extract("body", r"(?s)<title>(.*?)</title>", 1).alias("title"), F.regexp_extract("body", r"(?s)<h1>(.*?)</h1>", 1).alias("h1"), F.size(F.regexp_extract_all("body", F.lit(r"<a [^>]*href"), F.lit(0))).cast("long").alias("n_links"))


def zipped(a: str, b: str):
    """Two lists side by side, row by row."""
    return F.inline(F.arrays_zip(a, b))
