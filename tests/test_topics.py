import math
import random
import re
from collections import Counter, defaultdict

import pytest

from offerloom.operators import topics


def planted(n: int = 120):
    rng = random.Random(2)
    kinds = {"deniz": ["dalga", "kum", "martı"], "dag": ["zirve", "kar", "kartal"]}
    rows = []
    for i in range(n):
        main = rng.choice(list(kinds))
        rows.append(("a" if i % 2 else "b", f"u{i}", " ".join([main] * 3 + rng.sample(kinds[main], 2))))
    return rows


def test_topics_of_each_subcat(spark):
    df = spark.createDataFrame([*planted(), ("a", "n", None), (None, "m", "x"), ("c", "o", "tek kelime")], "subcat string, uid string, name string")
    got = {}
    for r in topics.subcat_topics(df, k=2, passes=8).collect():
        got.setdefault(r.subcat, set()).add(r.term.split()[0])
    assert got["a"] == got["b"] == {"deniz", "dag"} and got["c"]
    assert topics.subcat_topics(df.limit(0), passes=1).count() == 0


def test_factors(spark):
    df = spark.createDataFrame([(t,) for _, _, t in planted()] + [(None,), ("",)], "text string")
    assert {r.term for r in topics.nmf_topics(df, k=2).collect()} == {"deniz", "dag"}
    got = topics.lsi_topics(df, k=2).collect()
    assert len(got) == 2 and all(0 < r.weight <= 1 for r in got)
    assert topics.nmf_topics(df.where("text = 'none'")).count() == 0


def test_labels_of_many_labels_and_words(spark):
    # as one matrix this model would have 20,000 labels times 40,000 words
    train = spark.range(20_000).selectExpr("'l' || id as subcat", "'kind' || id || ' part' || id as name")
    test = spark.range(0, 20_000, 100).selectExpr("cast(id as string) as uid", "'part' || id || ' new' as name")
    got = topics.predict_labels(train, test).collect()
    assert len(got) == 200 and all(r.subcat == "l" + r.uid for r in got)


@pytest.mark.parametrize("entries", [1_000_000, 20])
def test_labels_against_plain_sums(spark, monkeypatch, entries):
    monkeypatch.setattr(topics, "ENTRIES", entries)
    rng = random.Random(5)
    name = lambda n: " ".join(rng.choice(["tea", "milk", "oil", "5", "Soap", "200ml", "tea", *"abcdefgh", *map("w{}".format, range(30))]) for _ in range(n))
    train = [(name(rng.randint(0, 6)), f"s{rng.randint(0, 25)}") for _ in range(150)] + [(None, "s1"), ("tea", None), ("", "wordless"), ("twin", "y"), ("twin", "x")]
    test = [(f"u{i}", name(rng.randint(0, 8)) + rng.choice(["", " unseen"])) for i in range(60)] + [("u0", "tea"), (None, "milk milk"), ("empty", ""), ("tie", "twin twin twin twin"), ("none", None)]
    docs, counts = Counter(), defaultdict(Counter)
    for t, s in train:
        if t is not None and s is not None:
            docs[s] += 1
            counts[s].update(re.findall(r"\w{2,}", t.lower()))
    vocab = {w for c in counts.values() for w in c}
    want = []
    for u, t in test:
        if t is not None:
            words = [w for w in re.findall(r"\w{2,}", t.lower()) if w in vocab]
            score = {s: math.log(docs[s] + 1) + sum(math.log((counts[s][w] + 1) / (counts[s].total() + len(vocab))) for w in words) for s in docs}
            want.append((u, min(s for s in score if score[s] > max(score.values()) - 1e-9)))
    train, test = spark.createDataFrame(train, "name string, subcat string"), spark.createDataFrame(test, "uid string, name string")
    order = lambda rows: sorted(map(tuple, rows), key=str)
    assert order(topics.predict_labels(train, test).collect()) == order(want)
    assert ("tie", "x") in want
    assert topics.predict_labels(train, test.limit(0)).count() == 0
    for nothing in (train.limit(0), train.where("name = ''")):
        assert topics.predict_labels(nothing, test).count() == 0
