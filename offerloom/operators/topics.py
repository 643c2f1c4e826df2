"""Sub-category prediction, and topics with Spark's own learners."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.clustering import LDA
from pyspark.ml.feature import IDF, CountVectorizer, NGram, RegexTokenizer
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerloom.functions.collections import top_per
from offerloom.functions.text import tokens
from offerloom.session import cut

#: Iterations of the topic learner, each over as many documents as there are.
PASSES = 20

#: Words of the labels in a block, and of the texts in a chunk, which one worker holds together when labels are predicted.
ENTRIES = 1_000_000

#: Scores that differ by less are equal: only the order of adding sets them apart.
TIE = 1e-10


def _best_labels(vocabulary: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """For a chunk of texts (``text, words``) and a block of labels (``label, docs, total, words, counts``): each text's best label of the block.

    With smoothing 1 a word that a label lacks adds nothing but the label's denominator, so a score is the
    label's prior, less its log denominator a word, plus log(1 + count) of the words both have.
    """

    def run(texts: pa.Table, labels: pa.Table) -> pa.Table:
        if not (vocabulary and texts.num_rows and labels.num_rows):
            return pa.table({"text": pa.array([], pa.string()), "label": pa.array([], pa.string()), "score": pa.array([], pa.float64())})
        labels = labels.sort_by("label")
        n = labels.num_rows
        prior, per_word = np.log1p(labels["docs"].to_numpy()), np.log(labels["total"].to_numpy() + vocabulary)
        own = texts["words"].combine_chunks()
        ends = np.cumsum(pc.list_value_length(own).to_numpy())
        vocab = pc.unique(own.flatten())
        ids = pc.index_in(own.flatten(), value_set=vocab).to_numpy()
        theirs = labels["words"].combine_chunks()
        at = pc.fill_null(pc.index_in(theirs.flatten(), value_set=vocab), -1).to_numpy()
        order = np.argsort(at, kind="stable")[np.count_nonzero(at < 0) :]
        who = np.repeat(np.arange(n), pc.list_value_length(theirs).to_numpy())[order]
        gain = np.log1p(labels["counts"].combine_chunks().flatten().to_numpy()[order])
        bounds = np.searchsorted(at[order], np.arange(len(vocab) + 1))
        full: dict[int, np.ndarray] = {}  # words that a quarter of the labels have, as whole rows: at most four times the entries
        for w in np.nonzero(np.diff(bounds) * 4 > n)[0].tolist():
            full[w] = np.zeros(n)
            full[w][who[bounds[w] : bounds[w + 1]]] = gain[bounds[w] : bounds[w + 1]]
        best, top, begin = np.empty(len(ends), "int64"), np.empty(len(ends)), 0
        for i, end in enumerate(ends.tolist()):
            s = prior - (end - begin) * per_word
            for w in ids[begin:end].tolist():
                if w in full:
                    s += full[w]
                else:
                    s[who[bounds[w] : bounds[w + 1]]] += gain[bounds[w] : bounds[w + 1]]
            top[i] = s.max()
            best[i] = np.argmax(s >= top[i] - TIE)
            begin = end
        return pa.table({"text": texts["text"], "label": labels["label"].take(pa.array(best)), "score": pa.array(top)})

    return run


def predict_labels(train: DataFrame, test: DataFrame, text: str = "name", label: str = "subcat", key: str = "uid") -> DataFrame:
    """``key, label``: multinomial naive Bayes over words of two characters or more (smoothing 1); of equal labels the first.

    Neither model nor vocabulary is ever whole in one place: only counts that aren't 0 are kept, and texts
    in chunks meet labels in blocks, whose number grows with both; what a label shares with the texts lies
    in one block. No word is left out. Without any word or label in ``train`` nothing is predicted.
    """
    split = RegexTokenizer(inputCol="text", outputCol="_w", gaps=False, pattern=r"\w{2,}")
    # besides its words every text has the word "", which no text can have otherwise: it counts a label's texts and keeps texts without words
    each = lambda t: split.transform(t).select(*t.columns, F.explode(F.concat(F.array(F.lit("")), "_w")).alias("w"))
    rows = train.select(F.col(label).cast("string").alias("label"), F.col(text).alias("text")).where("label is not null and text is not null")
    counts = cut(each(rows).groupBy("label", "w").agg(F.count(F.lit(1)).alias("n")))
    vocab = cut(counts.select("w").distinct())
    asked = test.where(F.col(text).isNotNull()).select(F.col(key), F.col(text).alias("_text"))
    words = each(asked.select(F.col("_text").alias("text")).distinct()).join(vocab, "w", "left_semi")
    texts = cut(words.groupBy("text").agg(F.array_remove(F.collect_list("w"), "").alias("words")))
    used = counts.join(texts.select(F.explode("words").alias("w")).distinct(), "w", "left_semi").groupBy("label").agg(F.collect_list(F.struct("w", "n")).alias("x"))
    sums = counts.groupBy("label").agg(F.sum(F.when(F.col("w") == "", F.col("n"))).alias("docs"), F.sum(F.when(F.col("w") != "", F.col("n"))).alias("total"))
    x = F.coalesce("x", F.array().cast("array<struct<w:string,n:bigint>>"))
    model = cut(sums.join(used, "label", "left").select("label", "docs", F.coalesce("total", F.lit(0)).alias("total"), F.transform(x, lambda e: e["w"]).alias("words"), F.transform(x, lambda e: e["n"]).alias("counts")))

    size = lambda t: t.agg(F.sum(F.size("words") + 1)).first()[0] or 1
    blocks, asks = math.ceil(size(model) / ENTRIES), size(texts)
    chunks = max(math.ceil(asks / ENTRIES), min(math.ceil(asks / 5000), 2 * train.sparkSession.sparkContext.defaultParallelism))
    over = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = texts.withColumn("chunk", F.pmod(F.xxhash64("text"), F.lit(chunks)).cast("int")).withColumn("block", over(blocks))
    right = model.withColumn("block", F.pmod(F.xxhash64("label"), F.lit(blocks)).cast("int")).withColumn("chunk", over(chunks))
    found = left.groupBy("block", "chunk").cogroup(right.groupBy("block", "chunk")).applyInArrow(_best_labels(max(vocab.count() - 1, 0)), "text string, label string, score double")
    first = F.array_min(F.transform(F.filter("e", lambda y: y["score"] >= F.col("m") - TIE), lambda y: y["label"]))
    best = found.groupBy("text").agg(F.max("score").alias("m"), F.collect_list(F.struct("label", "score")).alias("e")).select(F.col("text").alias("_text"), first.alias(label))
    return asked.join(best, "_text").select(key, label)


def lda_topics(rows: DataFrame, text: str = "text", k: int = 7, vocabulary: int = 800, seed: int = 0) -> DataFrame:
    """``topic, term, weight``: the first term of each topic over words and pairs of words.

    Every one of the ``PASSES`` iterations draws as many documents as there are, with replacement (the
    learner can't draw without), so all count alike and one is left out of all with a chance of e^-20.
    Learning rate as in the reference's learner.
    """
    t = rows.where(F.col(text).isNotNull()).select(F.filter(F.split(F.lower(text), r"\W+"), lambda w: F.length(w) > 1).alias("w"))
    t = NGram(n=2, inputCol="w", outputCol="g").transform(t).select(F.concat("w", "g").alias("t"))
    cv = CountVectorizer(inputCol="t", outputCol="x", vocabSize=vocabulary).fit(t)
    x = cut(cv.transform(t).select("x"))
    lda = LDA(k=k, optimizer="online", seed=seed, maxIter=PASSES, subsamplingRate=1.0, learningOffset=10.0, learningDecay=0.7, featuresCol="x")
    model = lda.fit(x)
    terms = F.array(*map(F.lit, cv.vocabulary))
    return model.describeTopics(1).select("topic", F.get(terms, F.get("termIndices", F.lit(0))).alias("term"), F.get("termWeights", F.lit(0)).alias("weight"))


def _grams(rows: DataFrame, text: str) -> DataFrame:
    """Rows with ``term, n``: their words of two characters or more and pairs of words, counted."""
    w = rows.where(F.col(text).isNotNull()).withColumn("_w", F.filter(F.split(F.lower(text), r"\W+"), lambda w: F.length(w) > 1))
    pairs = F.transform(F.slice("_w", 1, F.greatest(F.size("_w") - 1, F.lit(0))), lambda x, i: F.concat_ws(" ", x, F.get("_w", i + 1)))
    return w.select(*rows.columns, F.explode(F.concat("_w", pairs)).alias("term")).drop(text).groupBy(*[c for c in rows.columns if c != text], "term").agg(F.count(F.lit(1)).alias("n"))


def subcat_topics(rows: DataFrame, k: int = 7, vocabulary: int = 800, passes: int = 10, alpha: float = 0.1, eta: float = 0.1, seed: int = 0) -> DataFrame:
    """``subcat, topic, term``: the first term of each topic of each sub-category; rows have ``subcat, uid, name``.

    Every sub-category has its own ``k`` topics over its ``vocabulary`` most frequent words and pairs,
    and all are fitted at once: latent Dirichlet allocation by expectation maximisation (smoothing
    ``alpha`` of a name's topics and ``eta`` of a topic's terms). Shares lie in tables by (subcat, term)
    and by name, so a pass is two joins and two aggregates over the words whatever the number of
    sub-categories, and a large one is no single task's.
    """
    named = rows.where("subcat is not null and uid is not null").select("subcat", "uid", "name")
    grams = _grams(named, "name")
    vocab = top_per(grams.groupBy("subcat", "term").agg(F.sum("n").alias("t")), ["subcat"], [F.col("t").desc(), F.col("term")], vocabulary).select("subcat", "term")
    words = cut(grams.join(vocab, ["subcat", "term"]))
    start = F.array(*[1 + F.pmod(F.xxhash64("subcat", "term", F.lit(i), F.lit(seed)), F.lit(1000)) / 1000 for i in range(k)])

    def shares(t: DataFrame, keys: list[str], col: str) -> DataFrame:
        """``col`` divided by its sum over the rows of the same keys, topic by topic."""
        total = t.groupBy(*keys).agg(F.array(*[F.sum(F.get(col, F.lit(i))) for i in range(k)]).alias("_t"))
        return t.join(total, keys).withColumn(col, F.zip_with(col, "_t", lambda a, b: a / b)).drop("_t")

    phi = shares(vocab.select("subcat", "term", start.alias("phi")), ["subcat"], "phi")
    theta = words.select("subcat", "uid").distinct().select("subcat", "uid", F.array(*[F.lit(1.0 / k)] * k).alias("theta"))
    for _ in range(passes):
        both = words.join(phi, ["subcat", "term"]).join(theta, ["subcat", "uid"]).withColumn("r", F.zip_with("phi", "theta", lambda a, b: a * b))
        both = cut(both.select("subcat", "uid", "term", F.transform("r", lambda x: x * F.col("n") / F.aggregate("r", F.lit(0.0), lambda a, y: a + y)).alias("r")))
        summed = lambda keys, to, add: both.groupBy(*keys).agg(F.array(*[F.sum(F.get("r", F.lit(i))) + add for i in range(k)]).alias(to))  # noqa: B023, E731
        phi = cut(shares(summed(["subcat", "term"], "phi", eta), ["subcat"], "phi"))
        t = summed(["subcat", "uid"], "theta", alpha)
        theta = cut(t.select("subcat", "uid", F.transform("theta", lambda x: x / F.aggregate("theta", F.lit(0.0), lambda a, y: a + y)).alias("theta")))
    each = phi.select("subcat", "term", F.posexplode("phi").alias("topic", "p"))
    return top_per(each, ["subcat", "topic"], [F.col("p").desc(), F.col("term")]).select("subcat", "topic", "term")


def _matrix(rows: DataFrame, text: str, vocabulary: int) -> tuple[DataFrame, list[str]]:
    """``terms, ns`` (places in the vocabulary and counts) of each row, and the vocabulary, which is bounded by its parameter."""
    grams = _grams(rows.select(text).withColumn("_id", F.monotonically_increasing_id()), text)
    top = grams.groupBy("term").agg(F.sum("n").alias("t")).where("t > 1").orderBy(F.desc("t"), "term").limit(vocabulary)
    words = [r.term for r in top.collect()]
    place = rows.sparkSession.createDataFrame(list(enumerate(words)), "i int, term string")
    each = grams.join(F.broadcast(place), "term").groupBy("_id").agg(F.array_sort(F.collect_list(F.struct("i", "n"))).alias("x"))
    return cut(each.select(F.transform("x", lambda e: e["i"]).alias("terms"), F.transform("x", lambda e: e["n"].cast("double")).alias("ns"))), words


def nmf_topics(rows: DataFrame, text: str = "text", k: int = 7, vocabulary: int = 800, passes: int = 10, inner: int = 10, seed: int = 0) -> DataFrame:
    """``topic, term, weight``: the first term of each factor of a non-negative factorisation (squared error) of the counts.

    A pass fits every row's weights to the factors by multiplicative steps, row by row within its batch,
    and sums what the factors' own step needs; the driver holds the factors only (``k`` by ``vocabulary``).
    """
    x, words = _matrix(rows, text, vocabulary)
    m = len(words)
    if not m:
        return rows.sparkSession.createDataFrame([], "topic int, term string, weight double")
    h = np.random.default_rng(seed).random((k, m)) + 0.1

    def sums(h: np.ndarray) -> np.ndarray:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            a = np.zeros((k, m + k))
            for b in batches:
                for terms, ns in zip(b.terms, b.ns):
                    part, w = h[:, terms], np.full(k, ns.sum() / k)
                    over = part @ ns
                    for _ in range(inner):
                        w *= over / np.maximum(gram @ w, 1e-12)
                    a[:, terms] += np.outer(w, ns)
                    a[:, m:] += np.outer(w, w)
            i, j = np.nonzero(a)
            yield pd.DataFrame({"i": i.astype("int32"), "j": j.astype("int32"), "v": a[i, j]})

        gram = h @ h.T
        out = np.zeros((k, m + k))
        for r in x.mapInPandas(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
            out[r.i, r.j] = r.v
        return out

    for _ in range(passes):
        a = sums(h)
        h *= a[:, :m] / np.maximum(a[:, m:] @ h, 1e-12)
    best = [(i, words[int(h[i].argmax())], float(round(h[i].max() / max(h[i].sum(), 1e-12), 6))) for i in range(k)]
    return rows.sparkSession.createDataFrame(best, "topic int, term string, weight double")


def lsi_topics(rows: DataFrame, text: str = "text", k: int = 2, vocabulary: int = 800) -> DataFrame:
    """``topic, term, weight``: the term of greatest weight in each of the first singular vectors of TF-IDF over words seen twice or more."""
    t = RegexTokenizer(inputCol=text, outputCol="_w", gaps=False, pattern=r"\w{2,}").transform(rows.where(F.col(text).isNotNull()).select(text))
    cv = CountVectorizer(inputCol="_w", outputCol="_c", minDF=2, vocabSize=vocabulary).fit(t)
    c = cv.transform(t)
    x = cut(IDF(inputCol="_c", outputCol="x").fit(c).transform(c).select("x"))
    svd = RowMatrix(MLUtils.convertVectorColumnsFromML(x, "x")).computeSVD(k, computeU=False)
    v = np.abs(svd.V.toArray())
    best = [(i, cv.vocabulary[int(v[:, i].argmax())], float(round(v[:, i].max(), 6))) for i in range(v.shape[1])]
    return rows.sparkSession.createDataFrame(best, "topic int, term string, weight double")


def top_tfidf(rows: DataFrame, group: str, text: str) -> DataFrame:
    """``group, token, score``: the word with the greatest term frequency times log inverse group frequency."""
    t = rows.where(F.col(group).isNotNull()).select(group, F.explode(tokens(F.lower(text))).alias("token"))
    tf = t.groupBy(group, "token").agg(F.count(F.lit(1)).alias("tf"))
    df = tf.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    n = tf.select(F.count_distinct(group).alias("n"))
    s = tf.join(df, "token").join(F.broadcast(n)).withColumn("score", F.round(F.col("tf") * F.log((F.col("n") + 1) / (F.col("df") + 1)), 6))
    return top_per(s, [group], [F.col("score").desc(), F.col("token")]).select(group, "token", "score")


def idf_vectors(rows: DataFrame, text: str) -> DataFrame:
    """Rows with a TF-IDF vector ``features`` of words seen twice or more."""
    t = RegexTokenizer(inputCol=text, outputCol="_w", gaps=False, pattern=r"\w{2,}").transform(rows.where(F.col(text).isNotNull()))
    c = CountVectorizer(inputCol="_w", outputCol="_c", minTF=1, minDF=2).fit(t).transform(t)
    return IDF(inputCol="_c", outputCol="features").fit(c).transform(c).drop("_w", "_c")
