import random

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("offerloom.llm")
from offerloom.llm import bpe, canonical, components, disguise, fusion, leaks, listings, pii  # noqa: E402

DOCS = "doc_id string, name string, brand string, barcodes array<string>, sku_id string, ord long, extra string"
SKUS = "sku_id string, doc_ids array<string>, name string, src string, brand string, category string, color string, market string, ts timestamp, ord long"


def test_components(spark):
    rng = random.Random(2)
    pairs = [(f"n{rng.randrange(120):03d}", f"n{rng.randrange(120):03d}") for _ in range(80)] + [("hub", f"x{i:03d}") for i in range(60)] + [(None, "q"), ("s", "s")]
    par = {}

    def find(x):
        while par.setdefault(x, x) != x:
            x = par[x]
        return x

    for a, b in pairs:
        if a and b:
            par[find(a)] = find(b)
    groups = {}
    for x in list(par):
        groups.setdefault(find(x), []).append(x)
    df = spark.createDataFrame(pairs * 2, "src string, dst string")
    assert {r.node: r.group_id for r in components.connected_components(df).collect()} == {x: min(g) for g in groups.values() for x in g}
    assert components.connected_components(df.limit(0)).count() == 0


def test_offer_groups(spark):
    r = spark.createDataFrame([("a", None, None, ["2000000001302"], None, 1, ""), ("b", None, None, ["EAN 02000000001302", None], "s1", 2, ""), ("c", None, None, None, "", 3, ""), ("d", None, None, ["00000000"], None, 4, ""), ("e", None, None, ["00000000"], None, 5, ""), (None, None, None, None, "s1", 6, "")], DOCS)
    k = spark.createDataFrame([("s1", ["c+clone2", "gone"], *[None] * 7, 1), (None, ["d", "e"], *[None] * 7, 2)], SKUS)
    assert {tuple(x) for x in components.offer_groups(r, k).collect()} == {("a", "a"), ("b", "a"), ("c", "a")}


def test_canonical(spark):
    ref = spark.createDataFrame([(1, "brand", "Lukovus Gifetijok", []), (2, "brand", "Ginadayi", []), (3, "brand", "Ginadaye", None), (4, "category", "Bal", ["Honey"]), (5, "color", "Açık Mavi", ["Light Blue"])], "ref_id long, kind string, canonical string, aliases array<string>")
    vals = {("brand", "L. Gifetijok"): 1, ("brand", "Gifetijok Lukovus"): 1, ("brand", "Marka: Luko-vus Gifetijok A.Ş."): 1, ("brand", "Ginadaye "): 3, ("brand", "giandayi"): 2, ("brand", "Xyz"): -1, ("brand", "-"): -1, ("category", "Anasayfa > Ballar"): 4, ("category", "HONEY"): 4, ("category", "Bel"): -1, ("color", "03 Açık Mavi"): 5, ("color", "Açık Mavi / Light Blue"): 5, ("color", "haki"): -1}
    v = spark.createDataFrame([*vals, ("brand", " "), ("brand", None)], "kind string, value string")
    assert {(x.kind, x.value): x.ref_id for x in canonical.map_values(spark, v, ref).collect()} == vals


def brute(a: str, b: str) -> int:
    d = [[max(i, j) if not i * j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def test_pigeonhole_against_brute_force(spark):
    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("abcd") for _ in range(n))
    forms = sorted({word(rng.randrange(3, 10)) for _ in range(40)})
    vals = sorted({word(rng.randrange(2, 11)) for _ in range(150)})
    f = spark.createDataFrame([("k", i, x, len(x), 2) for i, x in enumerate(forms)], "kind string, ref_id long, form string, len int, most int")
    v = spark.createDataFrame([("k", x, x) for x in vals], "kind string, value string, s string")
    got = {(r.value, forms[r.ref_id]) for r in canonical.pigeonhole_join(spark, v, f).collect()}
    limit = lambda n: 0 if n < 4 else 1 if n < 7 else 2
    want = {(x, y) for x in vals for y in forms if brute(x, y) <= limit(len(y))}
    assert want <= got and all(brute(x, y) <= limit(len(y)) + 1 for x, y in got)


def test_surviving(spark):
    t = "2020-01-0{} 00:00:00"
    rows = [("s", None, "N/A", "x", "B", "Diğer", None, "m1", t.format(1), 1), ("s", None, "Ad..", "http://i/placeholder.jpg", " ", "Çay", None, "m1", t.format(2), 2), ("s", None, "Ad", "https://i/1.jpg", None, "Bal", None, "m2", t.format(1), 3), ("t", None, "tek", None, None, None, None, "m1", t.format(1), 4), (None, None, "q", None, None, None, None, None, t.format(1), 5)]
    k = spark.createDataFrame(rows, SKUS.replace("timestamp", "string")).withColumn("ts", F.col("ts").cast("timestamp"))
    m = spark.createDataFrame([("m1", 5, 0), ("m2", 1, 3)], "market string, name_rank int, src_rank int")
    assert {tuple(r) for r in fusion.surviving_records(k, m).collect()} == {("s", "name", 3), ("s", "src", 3), ("s", "brand", 1), ("s", "category", 2)}
    assert fusion.surviving_records(k.limit(0), m).count() == 0
    assert {r.field for r in fusion.fuse(k).where("sku_id = 's'").collect()} == {"name", "src", "brand", "category"}


def test_disguise(spark):
    rows = {1: ("düz Ad ®  x", None), 2: ("ﬁne", ""), 3: ("Аd", "новинка"), 4: ("a​b", None), 5: ("a b", None), 6: ("é́", None), 7: (None, "𝐀b"), 8: ("", None)}
    df = spark.createDataFrame([(k, *v, "q") for k, v in rows.items()], "ord long, name string, brand string, reasons string")
    assert {(r.ord, r.field) for r in disguise.detect(df).collect()} == {(2, "name"), (3, "name"), (4, "name"), (5, "name"), (6, "name"), (7, "brand")}
    clean = {(r.ord, r.field): r.clean for r in disguise.consistent(df).collect()}
    assert clean[(2, "name")] == "fine" and clean[(3, "name")] == "Ad" and clean[(4, "name")] == "ab" and clean[(5, "name")] == "a b" and clean[(7, "brand")] == "Ab"
    assert disguise.detect(df.limit(0)).count() == 0


def test_bpe(spark):
    tiktoken = pytest.importorskip("tiktoken")
    with open(bpe.VOCABULARY, "rb") as f:
        ranks = bpe.read_ranks(f.read())
    enc = tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = ["", None, "Hello  world's <|endoftext|>", "ğüş 🙏🏽 " * 5, "a" * 5000, "\n\n \t x", "ab" * 3000 + "!"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: list(r.ids) for r in bpe.encode_documents(df).collect()}
    assert got == {i: enc.encode_ordinary(t or "") for i, t in enumerate(texts)}


def test_leaks(spark):
    item = "one two three four five six seven eight nine ten eleven"
    e = spark.createDataFrame([(1, item), (2, "short text"), (3, None)], "item_id long, text string")
    rows = [(1, "x ONE, two-three​ four five six seven eight nıne ten! y"), (2, "one two three four five six seven eight nine"), (3, "one two three four five and six seven eight nine ten eleven"), (4, None), (5, "")]
    d = spark.createDataFrame(rows + rows[:1], "doc_id long, text string")
    assert {(r.doc_id, r.item_id) for r in leaks.exact_phrases(d, e).collect()} == {(1, 1)}
    assert {(r.doc_id, r.item_id) for r in leaks.near_phrases(d, e).collect()} >= {(1, 1), (3, 1)}
    assert leaks.exact_phrases(d, e.limit(0)).count() == 0


def test_listings(spark):
    code = "2000000001302"
    rows = [
        ("a", "Cunarnot Cekentizi Deniz Aloe Misel Su 500 ml", "Cunarnot", [code]), ("b", "CEKENTİZİ DENİZ ALOE 0,5 LT MICELLAR WATER CUNARNOT", None, None), ("c", "Cekentizi Deniz Aloe Mis. Su 16,9 FL OZ Ücretsiz Kargo", "cunarnto", None),
        ("d", "Cunarnot Cekentzi Deniz Aloe Misel Su 2x500 ml", "Cunarnot", None), ("e", "Cunarnot Cekentizi Deniz Aloe Misel Su", "Cunarnot", [code]), ("f", "Cunarnot Cekentizi Deniz Aloe Ruj No 12 Mavi", "Cunarnot", [code]),
        ("g", "Cunarnot Cekentizi Deniz Aloe Lipstick 12 Mavi", None, None), ("h", None, "Cunarnot", [code])]
    df = spark.createDataFrame([(*r, None, i, "") for i, r in enumerate(rows)], DOCS)
    got = {tuple(r) for r in listings.same_product_pairs(df).collect()}
    assert got == {("a", "b"), ("a", "c"), ("a", "e"), ("b", "c"), ("b", "e"), ("c", "e"), ("f", "g")}
    assert listings.same_product_pairs(df.limit(0)).count() == 0


def test_small_changes_add_up(spark):
    """A word put in after every sixth: the passage is still found nearly whole; far-off single words are not."""
    w = [f"w{i}" for i in range(60)]
    spread = [x for i, y in enumerate(w) for x in ([y, "yeni"] if i % 6 == 5 else [y])]
    e = spark.createDataFrame([(1, " ".join(w))], "item_id long, text string")
    d = spark.createDataFrame([(1, " ".join(spread)), (2, " ".join(x for i in range(0, 60, 3) for x in (w[i], w[i + 1], *["z"] * 9))), (3, " ".join(w[:20]))], "doc_id long, text string")
    got = {r.doc_id: r.share for r in leaks.near_phrases(d, e, slack=1).collect()}
    assert set(got) == {1} and got[1] >= 0.8
    assert {r.doc_id for r in leaks.near_phrases(d, e, share=0.3).collect()} == {1, 3}


def made_listings(n_brands: int, per_brand: int, seed: int = 5):
    """Listings of known products under many brands, a few misspelt; lines recur with other brands."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("bdfgklmnprstvz") + rng.choice("aeiou") for _ in range(4))
    brands, lines = [word() for _ in range(n_brands)], [word() + "t" for _ in range(12)]
    adjectives, nouns = ["serin", "derin", "gece", "taze"], ["limon", "aloe", "badem"]
    rows, product = [], {}
    for b in brands:
        for i in range(per_brand):
            line, a, x, size = rng.choice(lines), rng.choice(adjectives), rng.choice(nouns), rng.choice((250, 500))
            for seller in range(3):
                at = rng.randrange(1, len(line))
                typed = line[:at] + line[at + 1 :] if seller == 2 and i % 5 == 0 else line
                doc = f"{len(rows):06d}"
                forms = (f"{b} {typed} {a} {x} Şampuan {size} ml", f"{typed} {a} {x} {b} Shampoo {size / 1000:g} lt".upper(), f"{b} Şampuan {typed} {a} {x} {size} cc Hızlı Kargo")
                rows.append((doc, forms[seller], b, None, None, len(rows), ""))
                product.setdefault((b, line, a, x, size), set()).add(doc)
    pairs = {(p, q) for docs in product.values() for p in docs for q in docs if p < q}
    return rows, pairs


@pytest.mark.parametrize("n_brands", [4, 40])
def test_listings_recall_at_two_sizes(spark, n_brands):
    """Lines that many brands use keep their spelling correction: recall doesn't fall with the number of brands."""
    rows, want = made_listings(n_brands, 10)
    got = {tuple(r) for r in listings.same_product_pairs(spark.createDataFrame(rows, DOCS)).collect()}
    assert len(got & want) >= 0.97 * len(want) and len(got & want) >= 0.99 * len(got)


def test_unlisted_words_are_learned_from_shared_codes(spark):
    """A kind in two languages and a slogan that no list has: codes shared by some products teach them, others without codes profit."""
    words, rows, want = ["bir", "iki", "uc", "dort", "bes", "alti", "yedi", "sekiz"], [], set()
    for i, w in enumerate(words):
        b, line = f"Marka{w}".capitalize(), f"Satir{w}"
        code = ["8690000000012", "8690000000029", "8690000000036", "8690000000043", "8690000000050", "8690000000067", None, None][i]
        for form in (f"{b} {line} Serin Limon Lamba Ampul 10 adet", f"{b} {line} Serin Limon Bulbo Lux 10 adet", f"{b} {line} Serin Limon Lamba Ampul 10 adet Kapandik"):
            rows.append((f"{len(rows):03d}", form, b, None if code is None else [code], None, len(rows), ""))
        ids = [f"{3 * i + j:03d}" for j in range(3)]
        want |= {(ids[0], ids[1]), (ids[0], ids[2]), (ids[1], ids[2])}
    df = spark.createDataFrame(rows, DOCS)
    assert {tuple(r) for r in listings.same_product_pairs(df).collect()} == want


def test_part_numbers_give_the_variant(spark):
    rows = [("a", "Cunarnot Cekentizi XK4410B Şampuan 500 ml", "Cunarnot"), ("b", "Cunarnot Cekentizi XK4410B Şampuan 250 ml", "Cunarnot"), ("c", "Cunarnot Cekentizi XK4410B Şampuan", "Cunarnot"), ("d", "Cunarnot Cekentizi XK4410B Şampuan 0,5 lt", "Cunarnot")]
    df = spark.createDataFrame([(*r, None, None, i, "") for i, r in enumerate(rows)], DOCS)
    assert {tuple(r) for r in listings.product_groups(df).collect()} == {("a", "a"), ("c", "a"), ("d", "a")}


def test_pii(spark):
    texts = [f"Sayın yetkili, ben Emre Korvan{e}. Siparişim 63377549{i} numaralıydı. Tel: 0532 555 00 {i}{i}. barkod 200000509414{i}" for i in range(5) for e in ("oğlu", "lı", "er")]
    texts += [f"regards, Grace Ashmer{e}. call me on 212-555-012{i}; write to g.ash{i} [at] mail[.]example.net" for i in range(5) for e in ("wick", "stow")]
    texts += [f"adresim Taşlıbağ Mah. 1535. Sok. No: {i}/13 Karatepecik. TC kimlik no 95314552284" for i in range(53, 56)] + [None, "", "Nichts zu finden."]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r.doc_id, r.kind, r.start_at) for r in pii.find_items(df).collect()}
    want = {(i, k, a) for i, t in enumerate(texts) if t for a, _, k in pii.silver(t)}
    assert got == want and len({k for _, k, _ in got}) == 5
    m = {r.doc_id: r.text for r in pii.masked(df).collect()}
    assert m[28] is None and m[29] == "" and "<ADDRESS>" in m[25] and "<ID_NUMBER>" in m[25]
    assert not pii.national_id("95314552285") and pii.national_id("95314552284")
    assert pii.find_items(df.limit(0)).count() == 0


def test_names_without_a_listed_cue_are_found():
    """No text is skipped: a name in a text with no shape and no listed cue is found by its words and surroundings."""
    given, family = ("Emre", "Elif", "Burak", "Deniz", "Selin"), ("Korvanlı", "Pekberer", "Dorukaler", "Ilgarcan", "Sarvatsoy")
    texts = [f"Kargo hızlıydı. {cue} {g} {f}. Ürün {x}" for cue in ("Alıcı", "faturada", "Teşekkürler,") for g in given for f in family for x in ("güzel", "Kötü")]
    texts += [f"Ürün {x}. Satıcı {y}. Sevgiler, {g}" for x in ("Güzel", "kötü") for y in ("Hızlı", "yavaş") for g in given]
    model = pii.Model.fit(texts)
    asked = {f"Kapıda {g} {f} karşıladı, sonra {g} {f} aradı": 7 for g in given for f in family}
    got = pii.find_in([*asked, "Kapıda kimse karşıladı"], model)
    found = sum((at, at + len(t.split()[1]) + 1 + len(t.split()[2]), "name") in got[t] for t, at in asked.items())
    assert found >= 0.9 * len(asked) and got["Kapıda kimse karşıladı"] == []


def test_skip_edges_carry_a_name_to_its_second_place():
    docs = pii.Docs(["Emre Korvanlı geldi. Korvanlılar Emre"])
    pairs = {(docs.texts[0][docs.starts[0][u] : docs.ends[0][u]], docs.texts[0][docs.starts[0][v] : docs.ends[0][v]]) for _, u, v in docs.edges}
    assert ("Emre", "Emre") in pairs
    em = np.zeros((1, 4, pii.N), np.float32)
    em[0, 0, pii.LABELS.index("B-name")] = 6.0
    em[0, 3, 0] = 1.0
    tr = pii.FORBID
    plain = pii.viterbi(em, tr)[0, 3]
    linked = pii.viterbi(em + pii.propagate(em, tr, np.array([[0, 0, 3]]), 3.0), tr)[0, 3]
    assert plain == 0 and pii.LABELS[linked] == "B-name"


def copied_records(spark, n: int = 200):
    """Four sources that slip now and then, each by itself, a bad one, and two that copy it with its faults."""
    rng, rows = random.Random(4), []
    for e in range(n):
        said = {f"g{i}": f"Brand{e}" if rng.random() < 0.85 else f"Slip{e}{i}" for i in range(4)}
        for s, v in (said | dict.fromkeys(("bad", "c1", "c2"), f"Alt{e}" if rng.random() < 0.3 else f"Brand{e}")).items():
            rows.append((f"e{e}", None, None, None, v, None, None, s, "2020-01-01 00:00:01", len(rows)))
    rows.append(("e0", None, None, None, None, None, None, None, None, len(rows)))
    return spark.createDataFrame(rows, SKUS.replace("timestamp", "string")).withColumn("ts", F.col("ts").cast("timestamp"))


def test_fusion_discounts_a_planted_copier(spark):
    k = copied_records(spark)
    right = lambda df: sum(r.value == f"Brand{r.sku_id[1:]}" for r in df.where("field = 'brand'").collect())
    with_copies, without = right(fusion.fuse(k)), right(fusion.fuse(k, copy_rate=0.0))
    assert with_copies >= 195 > without  # without copy detection the copies win now and then
    known = fusion.estimate(fusion.cut(fusion.latest_claims(k, "sku_id", "market", ("brand",))), 3, 20, 0.8, 0.8, 0.1)
    assert {frozenset(x) for x, d in known.copies.items() if d > 0.5} == {frozenset(x) for x in (("bad", "c1"), ("bad", "c2"), ("c1", "c2"))}
    assert min(known.accuracy[f"g{i}"] for i in range(4)) > known.accuracy["bad"]


def test_fusion_of_many_sources_stays_finite(spark):
    rows = [("s", None, None, None, "Ad" if i % 3 else "Id", None, None, f"m{i:03d}", None, i) for i in range(300)]
    k = spark.createDataFrame(rows, SKUS)
    (r,) = fusion.fuse(k, rounds=1).collect()
    assert r.value == "Ad" and r.posterior == 1.0 and r.votes == 200


def test_declared_trust_is_the_prior(spark):
    """Rows come from posteriors: without the prior the votes would choose another row."""
    k = copied_records(spark)
    trust = spark.createDataFrame([("c1", 9, 0), ("g1", 5, 0), (None, 99, 99)], "market string, name_rank int, src_rank int")
    of = {r.ord: r.market for r in k.collect()}
    got = fusion.surviving_records(k, trust).where("field = 'brand'").collect()
    assert len(got) == 200 and {of[r.ord] for r in got} == {"c1"}
