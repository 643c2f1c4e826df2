"""Listings of one product, worded differently by their sellers.

Method: identifiers are taken out and validated (GTIN check digits; brand; part numbers; the words of
a name that are neither brand, kind, quantity nor slogan: its line and description), normalised
(disguises, languages of the kind, abbreviations, typing errors against the corpus's own spellings,
units), and joined on reliable keys: brand, words, kind and variant (pack count and size of a pack, or
shade number). A listing without a variant joins through a right barcode, that is one whose other
listings agree with it in all else, or if its line has only one variant. The links make connected
components, guarded because no link joins listings that contradict each other in any part of the key.

Scale: one parse per listing, native expressions only; corrections join distinct spellings, not
listings; keys meet in hash joins around a smallest member, so a group of n listings makes n - 1 links.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerloom.functions.barcode import gtin
from offerloom.functions.collections import let
from offerloom.functions.size import NO_QUANTITY, UNITS, measured
from offerloom.functions.text import is_mixed_token, plain, tokens
from offerloom.llm.canonical import BRAND_AFTER, BRAND_BEFORE, pigeonhole_join
from offerloom.llm.components import connected_components
from offerloom.session import cut

# --- fixed values, as ``plain`` leaves them ----------------------------------------------------------
#: Kinds of article in the two languages of the shops.
KINDS = (
    ("sampuan", "shampoo"), ("sac kremi", "conditioner"), ("sac boyasi", "hair colour"), ("dus jeli", "shower gel"), ("sivi sabun", "liquid soap"), ("kati sabun", "bar soap"),
    ("dis macunu", "toothpaste"), ("dis fircasi", "toothbrush"), ("roll-on", "roll on"), ("parfum", "perfume"), ("gunes kremi", "sun cream"), ("el kremi", "hand cream"),
    ("yuz kremi", "face cream"), ("temizleme kopugu", "cleansing foam"), ("misel su", "micellar water"), ("ruj", "lipstick"), ("maskara", "mascara"), ("goz kalemi", "eye pencil"),
    ("oje", "nail polish"), ("fondoten", "foundation"), ("allik", "blush"), ("islak mendil", "wet wipes"), ("bebek bezi", "diapers"), ("kavanoz mamasi", "baby food"),
    ("toz deterjan", "washing powder"), ("yumusatici", "softener"), ("sivi bulasik deterjani", "dish liquid"), ("bulasik tableti", "dishwasher tabs"), ("yuzey temizleyici", "surface cleaner"),
    ("camasir suyu", "bleach"), ("kagit havlu", "paper towel"), ("tuvalet kagidi", "toilet paper"), ("filtre kahve", "filter coffee"), ("dokme cay", "loose tea"), ("meyve suyu", "fruit juice"),
    ("gazli icecek", "soft drink"), ("maden suyu", "mineral water"), ("yarim yagli sut", "half fat milk"), ("suzme yogurt", "strained yogurt"), ("kasar peyniri", "cheese"),
    ("siyah zeytin", "black olives"), ("sizma zeytinyagi", "olive oil"), ("aycicek yagi", "sunflower oil"), ("burgu makarna", "fusilli pasta"), ("baldo pirinc", "baldo rice"), ("biskuvi", "biscuit"),
    ("sutlu cikolata", "milk chocolate"), ("gofret", "wafer"), ("cicek bali", "flower honey"), ("cilek receli", "strawberry jam"), ("c vitamini", "vitamin c"), ("yara bandi", "plaster"),
)
SLOGANS = (
    "ucretsiz kargo", "hizli kargo", "ayni gun kargo", "faturali", "stokta", "orijinal urun", "kampanya", "yeni ambalaj", "yeni", "super firsat", "sok fiyat", "ozel seri", "best seller",
    "memnuniyet", "indirim", "alkol", "etki", "official",
)
COLORS = (
    "kirmizi", "mavi", "yesil", "sari", "siyah", "beyaz", "turuncu", "mor", "pembe", "gri", "kahverengi", "bej", "lacivert", "bordo", "turkuaz", "altin", "gumus", "mercan", "seftali", "fusya",
    "krem", "bakir",
)
# -----------------------------------------------------------------------------------------------------
_COLOR = rf"(?:(?:koyu|acik) )?(?:{'|'.join(COLORS)})"
SHADE = rf"(?<![a-z0-9])(?:(?:no|ton|numara) ?[:.]? ?([0-9]{{1,4}})(?: {_COLOR})?|([0-9]{{1,4}}) {_COLOR})(?![a-z0-9])"
_UNIT = "|".join(["fl ?[.]? ?oz", *sorted((u for u in UNITS if u != "fl oz"), key=len, reverse=True)])
_N = r"[0-9]+(?:[.,][0-9]+)*"
QUANTITY = rf"(?:(?<![0-9.,a-z])[0-9]+ ?[x*×] ?)?(?<![0-9.,])(?:{_N}) ?['’`]?(?:{_UNIT})(?![a-z0-9])\.?(?: ?[x*×] ?[0-9]+)?|(?<![a-z])(?:bir bucuk|iki bucuk|ceyrek|yarim|bir|iki|uc|dort|bes|on) (?:kilogram|kilo|kg|litre|lt)(?![a-z])"


#: A word is read as a more frequent one if it is found no more than once beyond this share of the other's listings.
OUTWEIGHS = 0.1
#: Brands that set two phrases against each other, and the least share of what each is set against, for them to mean the same.
LEARN_BRANDS, LEARN_SHARE = 5, 0.2


def kind_forms() -> dict[str, str]:
    """Ways to write a kind, first words also cut to three letters and a dot, and the kind."""
    out = {}
    for names in KINDS:
        for n in names:
            out[n] = names[0]
            first, _, rest = n.partition(" ")
            if rest and len(first) > 3:
                out[f"{first[:3]}. {rest}"] = names[0]
    return out


def _first(pat_hits: Column) -> Column:
    return F.nullif(pat_hits, F.lit(""))


def parse(raw_docs: DataFrame) -> DataFrame:
    """``doc_id, brand_typed, kind, shade, m, rest, codes``: one row a doc (that of the smallest ord), nothing else looked up.

    ``rest`` holds the words that are neither kind, quantity, shade nor slogan; ``codes`` the right
    GTINs and, as part numbers, words that mix letters and digits. Null names stay out.
    """
    d = raw_docs.where("doc_id is not null and name is not null").groupBy("doc_id").agg(
        F.min(F.struct("ord", "name", "brand", "barcodes")).alias("d"))
    forms = kind_forms()
    kinds = F.create_map(*[F.lit(x) for kv in forms.items() for x in kv])
    one_of = "|".join(sorted((f.replace(".", "[.]") for f in forms), key=len, reverse=True))
    kind_at = rf"(?<![a-z])({one_of})(?![a-z])"
    slogan = rf"(?<![a-z])(?:{'|'.join(SLOGANS)})(?![a-z])"

    def words(r: Column) -> Column:
        rest = F.regexp_replace(F.regexp_replace(F.regexp_replace(r, kind_at, " "), slogan, " "), r"[^a-z0-9]+|(?<![a-z0-9])[0-9]+(?![a-z0-9])", " ")
        return F.struct(F.regexp_extract(r, kind_at, 1).alias("kind"), tokens(rest).alias("rest"))

    def parts(p: Column) -> Column:
        q = F.regexp_replace(p, SHADE, " ")
        for pat in NO_QUANTITY[1:]:
            q = F.regexp_replace(q, pat, " ")
        shade = F.coalesce(_first(F.regexp_extract(p, SHADE, 1)), _first(F.regexp_extract(p, SHADE, 2)))
        return F.struct(shade.alias("shade"), let(q, lambda x: F.struct(measured(x, True).alias("m"), let(F.regexp_replace(x, QUANTITY, " "), words).alias("w"))).alias("q"))

    b = plain("d.brand")
    brand = F.regexp_replace(F.regexp_replace(F.regexp_replace(b, BRAND_BEFORE, ""), BRAND_AFTER, ""), BRAND_AFTER, "")
    d = d.select("doc_id", brand.alias("brand_typed"), let(plain("d.name"), parts).alias("x"), F.array_compact(F.transform("d.barcodes", lambda c: gtin(c))).alias("gtins"))
    part_numbers = F.transform(F.filter("x.q.w.rest", is_mixed_token), lambda t: F.concat(F.lit("part "), t))
    codes = F.array_distinct(F.concat(F.coalesce("gtins", F.array().cast("array<string>")), part_numbers))
    return cut(d.select("doc_id", "brand_typed", kinds[F.col("x.q.w.kind")].alias("kind"), F.ltrim("x.shade", F.lit("0")).alias("shade"), F.col("x.q.m").alias("m"), F.col("x.q.w.rest").alias("rest"), codes.alias("codes")))


def with_brands(parsed: DataFrame) -> DataFrame:
    """Adds ``brand`` and takes its words out of ``rest``.

    Brands are the typed values that stand word for word in the name they come with. A name's own brand comes first (the longest, then the most frequent), then the typed value,
    exact or within the edits that its length allows.
    """
    spark = parsed.sparkSession
    typed = parsed.select("brand_typed", F.array_join("rest", " ").alias("t")).where("brand_typed rlike '^[a-z][a-z ]{2,}$'")
    named = typed.where(F.contains(F.concat(F.lit(" "), "t", F.lit(" ")), F.concat(F.lit(" "), "brand_typed", F.lit(" "))))
    brands = cut(named.groupBy(F.col("brand_typed").alias("brand")).agg(F.count(F.lit(1)).alias("n")))
    grams = parsed.select("doc_id", F.explode(F.array_union(F.col("rest"), F.transform(F.sequence(F.lit(1), F.greatest(F.size("rest") - 1, F.lit(1))), lambda i: F.array_join(F.slice("rest", i, 2), " ")))).alias("brand"))
    own = grams.join(brands, "brand").groupBy("doc_id").agg(F.max(F.struct(F.size(F.split("brand", " ")).alias("w"), "n", "brand"))["brand"].alias("own"))
    values = parsed.where("brand_typed is not null").select(F.lit("brand").alias("kind"), F.col("brand_typed").alias("value"), F.regexp_replace("brand_typed", "[^a-z0-9]", "").alias("s")).distinct().where("s <> ''")
    parts = F.split("brand", " ")
    ways = F.array_compact(F.array(F.col("brand"), F.when(F.size(parts) == 2, F.concat(F.get(parts, F.lit(1)), F.get(parts, F.lit(0)))), F.when(F.size(parts) == 2, F.concat(F.left(F.get(parts, F.lit(0)), F.lit(1)), F.get(parts, F.lit(1))))))
    forms = brands.select(F.lit("brand").alias("kind"), F.col("brand").alias("ref_id"), F.posexplode(ways).alias("i", "form"))
    forms = forms.select("kind", "ref_id", F.regexp_replace("form", "[^a-z0-9]", "").alias("form"), F.when(F.col("i") < 2, 2).otherwise(1).alias("most")).withColumn("len", F.length("form"))
    hits = pigeonhole_join(spark, cut(values), cut(forms)).join(brands.withColumnRenamed("brand", "ref_id"), "ref_id")
    near = hits.groupBy(F.col("value").alias("brand_typed")).agg(F.min(F.struct("edits", (-F.col("n")).alias("n"), "ref_id"))["ref_id"].alias("near"))
    got = parsed.join(own, "doc_id", "left").join(near, "brand_typed", "left").withColumn("brand", F.coalesce("own", "near"))
    words = F.split(F.coalesce("brand", F.lit("")), " ")
    return cut(got.select("doc_id", "brand", "kind", "shade", "m", F.array_except("rest", words).alias("rest"), "codes"))


def learned_phrases(branded: DataFrame) -> DataFrame:
    """``phrase, to``: words (an array in order) that say the same as others or nothing, learned from listings with the same code.

    Two listings of one brand and one right GTIN that share two words or more are compared: what only
    the one says against what only the other says. Phrases that ``LEARN_BRANDS`` brands or more set
    against each other, and at least in ``LEARN_SHARE`` of what either is set against, mean the same
    (kinds of article in two languages, abbreviations); those set against nothing mean nothing
    (slogans). So words that the lists above don't have neither split a product nor need an entry;
    a code of another product sets ever other phrases against each other, and none often enough.
    """
    codes = F.explode(F.filter("codes", lambda c: ~c.startswith("part ")))
    each = branded.where("brand is not null").select("doc_id", "brand", F.array_sort(F.array_distinct("rest")).alias("rest"), codes.alias("code"))
    hub = each.groupBy("brand", "code").agg(F.min(F.struct("doc_id", "rest")).alias("hub"))
    both = each.join(hub, ["brand", "code"]).where("doc_id <> hub.doc_id").where(F.size(F.array_intersect("rest", "hub.rest")) > 1)
    mine, other = F.array_join(F.array_except("rest", "hub.rest"), " "), F.array_join(F.array_except("hub.rest", "rest"), " ")
    against = both.select("brand", F.explode(F.array(F.struct(mine.alias("x"), other.alias("y")), F.struct(other.alias("x"), mine.alias("y")))).alias("p")).select("brand", "p.*").where("x <> y")
    n = against.groupBy("x", "y", "brand").agg(F.count(F.lit(1)).alias("n")).groupBy("x", "y").agg(F.count(F.lit(1)).alias("brands"), F.sum("n").alias("n"))
    total = n.groupBy("x").agg(F.sum("n").alias("t"))
    often = n.where(F.col("brands") >= LEARN_BRANDS).join(total, "x").where(F.col("n") >= LEARN_SHARE * F.col("t"))
    sure = cut(often.join(often.select(F.col("y").alias("x"), F.col("x").alias("y")), ["x", "y"], "left_semi").unionByName(often.where("y = ''")).select("x", "y").distinct())
    empty = sure.where("y = ''").select("x")
    same = connected_components(sure.where("x <> '' and y <> ''").join(empty, "x", "left_anti"), "x", "y", "to").where("node <> to")
    known = cut(same.select("node", "to").union(empty.where("x <> ''").select("x", F.lit(""))))
    # a word of a target may itself be read as another one (an abbreviation)
    single = known.where(~F.contains("node", F.lit(" "))).select(F.col("node").alias("w"), F.col("to").alias("then"))
    words = known.select("node", F.explode(F.split("to", " ")).alias("w")).join(single, "w", "left").groupBy("node").agg(F.array_join(F.array_sort(F.collect_set(F.coalesce("then", "w"))), " ").alias("to"))
    return cut(words.select(F.split("node", " ").alias("phrase"), F.trim("to").alias("to")))


def with_learned(branded: DataFrame) -> DataFrame:
    """``rest`` with the learned phrases replaced or taken out."""
    phrases = learned_phrases(branded)
    if phrases.isEmpty():
        return branded
    said = branded.select("doc_id", "rest", F.explode("rest").alias("word")).join(phrases.withColumn("word", F.get("phrase", F.lit(0))), "word").where(F.size(F.array_except("phrase", "rest")) == 0)
    change = said.groupBy("doc_id").agg(F.array_distinct(F.flatten(F.collect_list("phrase"))).alias("gone"), F.collect_set("to").alias("come"))
    new = F.array_union(F.array_except("rest", "gone"), F.flatten(F.transform("come", lambda t: tokens(t))))
    return cut(branded.join(change, "doc_id", "left").withColumn("rest", F.coalesce(new, "rest")).drop("gone", "come"))


def with_words(branded: DataFrame) -> DataFrame:
    """Adds ``words``: the line and the description of a name in order, the spelling corrected.

    The rarest word of a name is checked against the words that stand with all its other words in
    listings of the same brand; of those within the allowed edits it becomes the one most frequent in
    the corpus, if that outweighs it (``OUTWEIGHS``). So neither a list nor a share of brands tells line
    and description words apart, and two words that are both in use stay two. A listing without a brand
    takes that of the only brand whose listings have its words, read in the same way.
    """
    spark = branded.sparkSession
    each = branded.select("doc_id", F.explode("rest").alias("word"))
    seen = each.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    counted = each.join(seen, "word").groupBy("doc_id").agg(F.array_sort(F.collect_set(F.struct("n", "word"))).alias("ws"))
    d = branded.drop("rest").join(counted, "doc_id", "left")
    names = F.array_sort(F.transform("ws", lambda x: x["word"]))
    rare = F.get("ws", F.lit(0))
    d = cut(d.select(*branded.drop("rest").columns, "ws", F.coalesce(names, F.array().cast("array<string>")).alias("names"), rare["word"].alias("rare"), rare["n"].alias("n_rare")))
    found = d.select("brand", "names", F.explode("ws").alias("x")).select("brand", "x.word", "x.n", F.array_join(F.array_remove("names", F.col("x.word")), " ").alias("others"))

    def corrected(own_brand: bool) -> DataFrame:
        """``brand, others, rare, to`` (``to`` with its brand): what a rarest word is read as."""
        scope = F.concat_ws("|", "brand", "others") if own_brand else F.col("others")
        has = F.col("brand").isNotNull()
        spelt = found.where(has).select(scope.alias("kind"), F.concat_ws("\t", "brand", "word").alias("ref_id"), "word", "n").distinct()
        asks = d.where(has if own_brand else ~has).where("rare is not null").withColumn("others", F.array_join(F.array_remove("names", F.col("rare")), " "))
        asks = asks.select(scope.alias("kind"), F.col("rare").alias("value"), F.col("rare").alias("s"), "n_rare").distinct()
        if own_brand:  # where no other word outweighs it, a word stays as it is
            top = spelt.groupBy("kind").agg(F.count(F.lit(1)).alias("c"), F.max("n").alias("top")).where("c > 1")
            asks = asks.join(top, "kind").where(F.col("n_rare") - 1 <= OUTWEIGHS * F.col("top")).drop("c", "top")
        asks = cut(asks)
        spelt = spelt.join(asks.select("kind").distinct(), "kind", "left_semi")
        forms = cut(spelt.select("kind", "ref_id", F.col("word").alias("form"), F.length("word").alias("len"), F.lit(2).alias("most")))
        hits = cut(pigeonhole_join(spark, asks.select("kind", "value", "s"), forms))
        hits = hits.withColumn("word", F.element_at(F.split("ref_id", "\t"), -1)).join(seen, "word").join(asks.select("kind", "value", "n_rare"), ["kind", "value"])
        right = (F.col("word") == F.col("value")) | ((F.struct("n", "word") > F.struct("n_rare", "value")) & (F.col("n_rare") - 1 <= OUTWEIGHS * F.col("n")))
        best = hits.where(right).groupBy("kind", "value").agg(F.max(F.struct("n", "ref_id"))["ref_id"].alias("to"), F.countDistinct(F.substring_index("ref_id", "\t", 1)).alias("brands"))
        return best if own_brand else best.where("brands = 1")

    put = lambda to: F.array_join(F.array_sort(F.array_append(F.array_remove("names", F.col("rare")), to)), " ")
    d = d.withColumn("others", F.array_join(F.array_remove("names", F.col("rare")), " "))
    word = F.element_at(F.split("to", "\t"), -1)
    own = d.where("brand is not null").withColumn("kind_", F.concat_ws("|", "brand", "others")).join(corrected(True).select(F.col("kind").alias("kind_"), F.col("value").alias("rare"), "to"), ["kind_", "rare"], "left")
    lost = d.where("brand is null").join(corrected(False).select(F.col("kind").alias("others"), F.col("value").alias("rare"), "to"), ["others", "rare"], "left")
    lost = lost.withColumn("brand", F.get(F.split("to", "\t"), F.lit(0)))
    words = F.when(F.col("to").isNull(), F.array_join("names", " ")).otherwise(put(word))
    cols = ["doc_id", "brand", "kind", words.alias("words"), "shade", "m", "codes"]
    return cut(own.select(*cols).unionByName(lost.select(*cols)))


def with_variants(d: DataFrame) -> DataFrame:
    """``doc_id, family, variant, codes``: the family is brand, line and description words, and kind.

    Sizes in ounces and pounds, which sellers round to a tenth, become the metric size of the family
    (or else of the corpus) that rounds to them.
    """
    spark = d.sparkSession
    units = spark.createDataFrame([(u, b, float(f), u in ("oz", "ounce", "lb", "lbs", "fl oz")) for u, (b, f) in UNITS.items()], "spelling string, base string, factor double, imperial boolean")
    fam = F.concat_ws("|", "brand", "words", F.coalesce("kind", F.lit("")))
    x = d.withColumn("family", F.when(F.col("brand").isNotNull(), fam)).withColumn("spelling", F.col("m.spelling")).join(F.broadcast(units), "spelling", "left")
    x = x.withColumn("num", F.col("m.num").cast("double")).withColumn("size", F.round(F.col("num") * F.col("factor"), 2))
    x = cut(x.select("doc_id", "family", "shade", "base", "imperial", "num", "factor", "size", F.col("m.pack").alias("pack"), "codes"))
    metric = x.where("not imperial and size is not null").groupBy("family", "base", "size").agg(F.count(F.lit(1)).alias("n"))
    factors = units.where("imperial").select("base", "factor").distinct()
    tenth = F.round(F.col("size") / F.col("factor"), 1)
    mine = metric.join(F.broadcast(factors), "base").groupBy("family", "base", "factor", tenth.alias("num")).agg(F.max(F.struct("n", "size"))["size"].alias("mine"))
    every = metric.groupBy("base", "size").agg(F.sum("n").alias("n")).join(F.broadcast(factors), "base").groupBy("base", "factor", tenth.alias("num")).agg(F.max(F.struct("n", "size"))["size"].alias("any"))
    y = x.join(mine, ["family", "base", "factor", "num"], "left").join(every, ["base", "factor", "num"], "left")
    size = F.when(F.col("imperial"), F.coalesce("mine", "any", F.round("size", 0))).otherwise(F.col("size"))
    variant = F.when(F.col("shade").isNotNull(), F.concat(F.lit("shade "), "shade")).when(F.col("size").isNotNull(), F.concat_ws(" ", "base", F.col("pack").cast("string"), size.cast("decimal(20,2)").cast("string")))
    return cut(y.select("doc_id", "family", variant.alias("variant"), "codes"))


def product_links(raw_docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``family, variant, doc_id`` of the listings that state all, and the links ``src, dst`` that make the groups.

    - listings of one family and variant link to the first of them;
    - a listing without a variant links through a code (a right GTIN or a part number) to the first
      listing of its family and of the variant most often sold under that code;
    - else, if its family has only one variant, to the first listing of that.
    Guard: every link stays in one family, and a listing without a variant gets one link only, so no
    chain of links joins two variants or families whatever codes they share.
    """
    d = with_variants(with_words(with_learned(with_brands(parse(raw_docs))))).where("family is not null")
    known, lacking = d.where("variant is not null"), d.where("variant is null")
    hub = cut(known.groupBy("family", "variant").agg(F.min("doc_id").alias("src")))
    by_code = known.select("family", F.explode("codes").alias("code"), "variant").groupBy("family", "code", "variant").agg(F.count(F.lit(1)).alias("n"))
    code_says = by_code.groupBy("family", "code").agg(F.max(F.struct("n", "variant")).alias("best"))
    told = lacking.select("doc_id", "family", F.explode("codes").alias("code")).join(code_says, ["family", "code"]).groupBy("doc_id").agg(F.max("best")["variant"].alias("said"))
    only = hub.groupBy("family").agg(F.min("variant").alias("only"), F.count(F.lit(1)).alias("n")).where("n = 1").select("family", "only")
    filled = lacking.select("doc_id", "family").join(told, "doc_id", "left").join(only, "family", "left").select("doc_id", "family", F.coalesce("said", "only").alias("variant"))
    members = known.select("doc_id", "family", "variant").unionByName(filled.where("variant is not null"))
    links = members.join(hub, ["family", "variant"]).where("doc_id <> src").select("src", F.col("doc_id").alias("dst"))
    return hub, links


def product_groups(raw_docs: DataFrame) -> DataFrame:
    """``doc_id, product``: docs of one product share the smallest doc_id; docs alone are left out."""
    _, links = product_links(raw_docs)
    return connected_components(links).select(F.col("node").alias("doc_id"), F.col("group_id").alias("product"))


def same_product_pairs(raw_docs: DataFrame) -> DataFrame:
    """``doc_a, doc_b`` (a before b): each pair of different docs that offer the same product.

    Null names and ids stay out; repeated rows of a doc count once; an empty table gives no pair. The
    pairs of a group are its result, so their number is that of the result; ``product_groups`` gives
    the membership alone.
    """
    g = cut(product_groups(raw_docs))
    a, b = g.select("product", F.col("doc_id").alias("doc_a")), g.select("product", F.col("doc_id").alias("doc_b"))
    return a.join(b, "product").where("doc_a < doc_b").select("doc_a", "doc_b")
