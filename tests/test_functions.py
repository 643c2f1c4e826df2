import pytest
from pyspark.sql import functions as F

from offerloom.functions import names
from offerloom.functions import text as T
from offerloom.functions.barcode import clean_barcodes, gtin, longest_digits, url_barcode
from offerloom.functions.collections import longest_first, majority, most_common, overlay
from offerloom.functions.price import convert_price, locale_price
from offerloom.functions.size import measured
from offerloom.functions.text import py_plain


def one(spark, expr, *values):
    kinds = ["string" if isinstance(v, (str, type(None))) else None for v in values]
    df = spark.createDataFrame([tuple(values)], ", ".join(f"c{i} {k or 'array<string>'}" for i, k in enumerate(kinds)))
    return df.select(expr(*[F.col(f"c{i}") for i in range(len(values))]).alias("x")).first()[0]


@pytest.mark.parametrize("a,b", [("  Çırağan  öğüt İZ ", "ciragan ogut iz"), (None, ""), ("", ""), ("tartı 7 g.", "tarti 7 g"), ("sürüm 2.10.4", "surum 2.10.4"), ("tuz&biber-kekik/nane", "tuz biber kekik nane"), ("ﬁltre ½ ㎏", "filtre 12 kg")])
def test_clean_string(spark, a, b):
    assert one(spark, T.clean_string, a) == b


@pytest.mark.parametrize("a", ["kalemleri", "kalemlar", "kalemlari"])
def test_singular(spark, a):
    assert one(spark, T.singular, a) == "kalem"


def test_words_and_windows(spark):
    assert one(spark, lambda c: T.windows(T.tokens(c)), "a b c") == ["a", "a b", "a b c", "b", "b c", "c"]
    assert one(spark, lambda c: T.windows(T.tokens(c)), "") == []
    assert one(spark, lambda c: T.prefixes(T.tokens(c), 4), "a b") == ["a", "a b", "a b", "a b"]
    assert one(spark, lambda c: T.prefixes(T.tokens(c), 4, clamp=True), "a b") == ["a", "a b"]
    assert one(spark, T.non_word_to_space, "<<limon>> ;:") == "limon"
    assert one(spark, T.category_parts, "Bal, Reçel&Pekmez / helva ve tahin and kavut") == ["Bal", "Reçel", "Pekmez", "helva", "tahin", "kavut"]
    assert one(spark, T.dots_in_numbers_only, "1.5 kg.") == "1.5 kg "


def test_plain(spark):
    for a in ("Κahesfοy Zanirokic", "Ｆｕｋａ 𝐏o", "N­İRİJ​AEN", "x крем для рук", "KAHESFOY ZANi̇ROKİC", "Hoﬁ"):
        got = one(spark, T.plain, a)
        assert got == py_plain(a).lower() and got.isascii()
    assert one(spark, T.plain, None) is None


SIZES = [
    ("Fener Sünger 3'lü  k77", 3, "adet"), ("mum 12'li kutu", 12, "adet"), ("Yayla Ayranı %2 Yağlı 2 L şişe", 2000, "ml"), ("krem ph 5.5 150 Ml tüp", 150, "ml"), ("pirinç 3 kg çuval", 3000, "gr"),
    ("k9 16 yıkama", 16, "yıkama"), ("3x150 ML su", 450, "ml"), ("soda 6 x 250 ML cam 44kz", 1500, "ml"), ("0.33 L teneke", 330, "ml"), ("un 2.5 kg", 2500, "gr"),
    ("Deterjan 5 KG 33 Yıkama", 33, "yıkama"), ("70GR 5 Lİ bisküvi", 70, "gr"), ("şurup 1 lt.light", 1000, "ml"), ("B 205 90GR GOFRET", 90, "gr"), ("40+ 75 ML", 75, "ml"),
]


def test_first_sizes(spark):
    df = spark.createDataFrame([(s,) for s, _, _ in SIZES], "s string")
    got = [tuple(r) for r in df.select(names.first_size_udf(T.clean_string("s")).alias("x")).select("x.*").collect()]
    assert got == [(float(n), u) for _, n, u in SIZES]


@pytest.mark.parametrize("hay,needle,want", [
    ("kutu siyah zeytin ezme", "zeytin ezme", "zeytin ezme"), ("taze b sikma suyu", "berrak sikma suyu", "b sikma suyu"), ("yag aycic yagi 1 lt", "aycicek yagi", "aycic yagi"), ("y s yagi", "yayla sade yagi", None),
    ("bir cam x", "cam y", None), ("tek", "tek parca", None), ("", "bal", None), ("mor kalem", "yesil defter", None), (None, "bal", None), ("bal", None, None)])
def test_abbreviated(spark, hay, needle, want):
    assert one(spark, names.abbreviated, hay, needle) == want


def test_name_cleaning(spark):
    assert names.clean_name("zeytin 250 gr ile 87654321 k bal") == ("zeytin bal", [(250.0, "gr")], ["87654321"])
    cases = [
        (["lor sari rujlar 24 lu", "", None], ["lor"], ["ruj"], ["sari"], ["rujlar 24"]),
        (["evrim sivi sabunlari kadin"], ["evrim"], ["sivi sabun"], None, []),  # inside other endings: words that hold one of its words go
        (["kalin black kalem white 12345678"], None, None, ["siyah"], ["kalin kalem white"]),  # the other language's name goes too
        (["a b"], [], [], [], ["a b"]),
    ]
    for n, b, s, c, want in cases:
        df = spark.createDataFrame([(n, b, s, c)], "n array<string>, b array<string>, s array<string>, c array<string>")
        assert df.select(names.filtered_names(F.col("n"), F.col("b"), F.col("s"), F.col("c"))).first()[0] == want


def test_barcodes(spark):
    assert one(spark, clean_barcodes, ["12345678, 0123", "01234567890123", "x", None]) == ["12345678", "1234567890123"]
    assert one(spark, lambda c: gtin(c), "EAN 2000000001302") == "2000000001302"
    assert one(spark, lambda c: gtin(c), "00000000") is None and one(spark, lambda c: gtin(c), "1234567890123") is None
    assert one(spark, longest_digits, "a 12 b 12345") == "12345" and one(spark, longest_digits, "none") is None
    assert one(spark, url_barcode, "/img/2000000001302_1.jpg") == "2000000001302"


def test_prices(spark):
    for a, b in (("12.5 TL", 12.5), ("₺7", 7.0), ("1.234.56", 1.23), ("x", None), ("", None), (None, None), ("5d", None)):
        assert one(spark, convert_price, a) == b
    assert one(spark, lambda c: locale_price(c, "T"), "1.234,5 TL") == 1234.5
    assert one(spark, lambda c: locale_price(c, "S"), "12,5") == 12.5


def test_collections(spark):
    assert one(spark, majority, ["1", "1", "2"]) == "1" and one(spark, majority, ["1", "2"]) is None
    assert one(spark, lambda c: most_common(c, 2), ["a", "b", "b", "c", None]) == ["b", "a"]
    assert one(spark, longest_first, ["a", "ccc", "bb", "dd"]) == ["ccc", "bb", "dd", "a"]
    m = spark.sql("select map('a', '1', 'b', '2') as o, map('b', '3') as n").select(overlay(F.col("o"), F.col("n")).alias("x")).first()[0]
    assert m == {"a": "1", "b": "3"}


@pytest.mark.parametrize("s,num,pack,unit", [
    ("Krem 1.250 ml", 1250, 1, "ml"), ("Su 6 x 0,5 Lt.", 0.5, 6, "lt"), ("Kahve 125 gr. x 6", 125, 6, "gr"), ("Reçel Yarım Kilo", 0.5, 1, "kilo"), ("3 KG 20 Yıkama", 20, 1, "yikama"), ("Jel 13,5 FL. OZ", 13.5, 1, "fl oz"),
    ("Bez 72'lü", 72, 1, "lu"), ("Ruj No:52 %20 İndirim SPF 50 3 Al 2 Öde", None, None, None), ("", None, None, None)])
def test_measured(spark, s, num, pack, unit):
    got = one(spark, measured, s)
    assert (got and (float(got.num), got.pack, got.spelling)) == (None if num is None else (num, pack, unit))


def test_sql_names_say_the_same(spark):
    from offerloom.functions import sql
    from offerloom.functions.barcode import search_barcode

    assert "offer_gtin" in sql.register(spark) and sql.register(spark)
    texts = ["kalemleri", "a", "", None, "b  a c", "x/?utm=1", "x/", "1.234,5 TL", "12.50 TL", "1.2.3", "çay, süt ve bal", "2000000001302", "EAN 02000000001302", "1234567890123", "00123", "01234567890123"]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    df.createOrReplaceTempView("texts_of_test")
    for name, f in {"strip_trailing_slash": T.strip_trailing_slash, "strip_tracking": T.strip_tracking, "singular": T.singular, "sorted_words": T.sorted_words, "category_parts": T.category_parts, "convert_price": convert_price, "search_barcode": search_barcode, "gtin": gtin}.items():
        mine = [r[0] for r in spark.sql(f"select offer_{name}(x) from texts_of_test").collect()]
        assert mine == [r[0] for r in df.select(f(F.col("x"))).collect()], name
    assert spark.sql("select offer_contains_words('a b', 'b'), offer_contains_words('ab', 'b')").first()[:] == (True, False)
