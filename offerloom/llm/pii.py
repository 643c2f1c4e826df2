"""Personal information in free text: found, typed and replaced.

Method: a skip-chain conditional random field. Tokens form a chain with transition potentials; tokens
of a document that repeat or nearly repeat (same letters but for case and ending, same digits) are
joined by skip edges whose potential favours one kind; loopy belief propagation passes messages along
the chain (forward-backward) and the skip edges in turns, so what is clear at one place decides at the
other; the best label sequence under the final messages is read off. Labels are begin and inside of
email, phone, id_number, address and name, and outside.

The model is trained in the query itself, on a bounded sample (``SAMPLE`` documents in hash order) whose
labels come from labelling functions: unmistakable shapes, and shapes after a cue. The cues label the
sample and are no features: the field learns from words, their endings, forms and neighbours, so names
after other words are found too (the README has the recall on held-out cues). Weights and transitions
are fitted piecewise, the skip potential from how often linked tokens agree in the sample. An exact
check follows: an item must also have its kind's shape (check digits included).

Scale: the sample is bounded, its weights (a few MB) are broadcast, and all texts are decoded whole in
one narrow Arrow stage without a shuffle. Features are hashed once per spelling and mixed as arrays
over a batch of texts; messages and decoding run over the batch as well.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled documents the model is fitted on, at most.
SAMPLE = 4000
EPOCHS, TOKENS, RATE, L2 = 8, 4096, 0.3, 1e-6
BATCH, BATCH_CHARACTERS, ROUNDS = 512, 400_000, 2
#: Spellings a worker keeps the features of, before it starts anew.
MOST_SPELLINGS = 300_000
KINDS = ("email", "phone", "id_number", "address", "name")
LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
KIND_OF = np.array([0] + [1 + i for i in range(len(KINDS)) for _ in "BI"])
N = len(LABELS)
BEGINS = np.array([x[0] == "B" for x in LABELS])

# --- fixed values: shapes of items, and cues of the labelling functions -----------------------------
AT = r"(?:@|\[ ?at ?\]|\( ?at ?\)|\{at\})"
DOT = r"(?:\.|\[ ?\. ?\]|\(\.\)|\[dot\]|\(dot\)|\[nokta\])"
EMAIL_END = re.compile(rf"\s?{AT}\s?[\w-]+(?:{DOT}[\w-]+)+", re.I)
AT_SIGN, DIGIT = re.compile(r"@|at ?[\])}]", re.I), re.compile(r"\d")
EMAIL_LOCAL = re.compile(r"[\w.+%-]")
PHONES = re.compile(
    r"(?<![\w+])(?:"
    r"(?:\+90 ?|0090 ?|0 ?)?(?:\(0?5\d{2}\) ?|0?5\d{2}[ .-]?)\d{3}[ .-]?\d{2}[ .-]?\d{2}"
    r"|(?:\+44 ?7\d{3}|07\d{3})[ -]?\d{3}[ -]?\d{3}"
    r"|(?:\+?1[ .-])?(?:\(\d{3}\) ?|\d{3}[.-]|(?<=1 )\d{3} )\d{3}[ .-]\d{4}"
    r"|(?:\+49 ?\d{2,4}|\(0\d{2,4}\)|0\d{2,4})[ /]\d{4,5}[ -]?\d{3,4}"
    r"|(?:\+33 ?\d|0\d)(?:[ .]?\d{2}){4}"
    r"|(?:\+34 ?)?[6-9]\d{2} ?\d{3} ?\d{3}"
    r"|\+\d{1,3}(?:[ .-]?\d{2,4}){3,5}"
    r")(?!\w|[-/ ]\d)"
)
IDS = re.compile(r"(?<![\w+-])(?:\d{11}|\d{3} \d{3} \d{3} \d{2}|\d{3}-\d{2}-\d{4}|\d{3} \d{2} \d{4}|[A-Za-z]\d{8}|[A-Za-z]\d{2}[A-Za-z]\d{5})(?![\w-])")
ADDRESSES = re.compile(
    r"(?<!\w)(?:"
    r"[^\W\d_]+ (?:mah|mh|mahalles[iİı])\b\.? ?\d+\.? (?:sok|sk|sokak|sokağ[ıi])\b\.? ?no ?:? ?\d+(?:/\d+| d ?:? ?\d+)?(?:,? [^\W\d_]+)?"
    r"|[^\W\d_]+ (?:cad|cd|caddes[iİı])\b\.? ?\d+\.? (?:blok )?no ?:? ?\d+(?:/\d+| kat ?\d+| d ?:? ?\d+)*(?:,? [^\W\d_]+)?"
    r"|\d+ [^\W\d_]+ (?:lane|road|avenue|street|st|drive|close|way)\b\.?(?:,? flat \d+)?,? [^\W\d_]+(?: [^\W\d_]+)?"
    r"|[^\W\d_]+(?:straße|strasse|str\.|gasse|allee|platz|weg) \d+[a-z]?, \d{5} [^\W\d_]+"
    r"|\d+(?: bis| ter)?,? (?:rue|avenue|impasse|boulevard|place|chemin) (?:[^\W\d_'’]+['’ ]?){1,6}, \d{5} [\w-]+"
    r"|(?:calle|avenida|plaza|paseo|c/) ?(?:[^\W\d_]+ ){1,6}?(?:nº |n\.º )?\d+, \d{5} [^\W\d_]+(?: [^\W\d_]+)?"
    r"|(?:calle|avenida|plaza|paseo|c/) ?(?:[^\W\d_]+ ){0,5}[^\W\d_]+, \d+, \d{5} [^\W\d_]+(?: [^\W\d_]+)?"
    r")",
    re.I,
)
NAME = re.compile(r"(?<!\w)([^\W\d_]{2,})((?: [^\W\d_]\.)?) ([^\W\d_]{3,})(?!\w)")
NAME_CUES = (
    "teşekkürler,", "tesekkurler,", "yetkili, ben", "alıcı", "alici", "faturada", "ask for", "was for", "signed by", "regards,", "empfänger war", "empfanger war",
    "grüße,", "grusse,", "gruße,", "cordialement,", "était pour", "etait pour", "era para", "saludos,",
)
PHONE_CUES = ("tel", "tel.", "tel:", "tél", "tél :", "phone:", "whatsapp", "beni", "call me on", "text", "unter", "moi au", "llámenme al", "llamenme al", "ara:", "gsm", "mobile", "telefon")
# -----------------------------------------------------------------------------------------------------
TOKEN = re.compile(r"[^\W_]+|_|[^\w\s]")


def national_id(digits: str) -> bool:
    """The two check digits of an 11-digit identity number."""
    d = [int(x) for x in digits]
    return d[0] != 0 and (sum(d[0:9:2]) * 7 - sum(d[1:8:2])) % 10 == d[9] and sum(d[:10]) % 10 == d[10]


def shapes(text: str) -> list[tuple[int, int, str]]:
    """Spans that have the shape of an item, names left out; they may overlap."""
    out = []
    if AT_SIGN.search(text):
        for m in EMAIL_END.finditer(text):
            a = m.start()
            while a and EMAIL_LOCAL.match(text[a - 1]):
                a -= 1
            if a < m.start():
                out.append((a, m.end(), "email"))
    if DIGIT.search(text):
        out += [(m.start(), m.end(), "address") for m in ADDRESSES.finditer(text)]
        for m in IDS.finditer(text):
            s = m.group().replace(" ", "")
            if not s.isdigit() or len(s) != 11 or national_id(s):
                out.append((m.start(), m.end(), "id_number"))
        out += [(m.start(), m.end(), "phone") for m in PHONES.finditer(text)]
    return out


def fold(s: str) -> str:
    return s.replace("İ", "i").lower().replace("i̇", "i")


def silver(text: str, cues: tuple[str, ...] = NAME_CUES) -> list[tuple[int, int, str]]:
    """What the labelling functions are sure of, without overlap."""
    spans = []
    for a, b, k in shapes(text):
        if k == "phone":
            if not fold(text[:a]).rstrip().endswith(PHONE_CUES):
                continue
        spans.append((a, b, k))
    low = fold(text)
    if len(low) == len(text):
        for cue in cues:
            i = low.find(cue)
            while i >= 0:
                if (m := NAME.match(text, i + len(cue) + 1)) and (m[1][0].isupper() or text == text.lower()) and m[3][0].isupper() == m[1][0].isupper():
                    spans.append((m.start(), m.end(), "name"))
                i = low.find(cue, i + 1)
    order = {k: i for i, k in enumerate(("email", "address", "id_number", "phone", "name"))}
    taken: list[tuple[int, int, str]] = []
    for s in sorted(spans, key=lambda s: (order[s[2]], s[0], -s[1])):
        if all(s[1] <= t[0] or s[0] >= t[1] for t in taken):
            taken.append(s)
    return sorted(taken)


def shape_of(w: str) -> str:
    if w.isdigit():
        return f"9{min(len(w), 13)}"
    if w.isalpha():
        return "X" if len(w) == 1 and w.isupper() else "XX" if w.isupper() else "Xx" if w[0].isupper() else "xx"
    return "mix" if len(w) > 1 else w


def _hash(x: str) -> int:
    return zlib.crc32(x.encode("utf-8", "replace")) + 1


class Words:
    """What features need to know of each spelling, computed once per spelling and process."""

    COLUMNS = W, S, E3, E4, ALPHA, NEXT, KEY = range(7)

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.ids: dict[str, int] = {}
        self.known: list[tuple[int, ...]] = [(0,) * len(self.COLUMNS)]  # number 0 stands beyond either end of a text
        self.table = np.zeros((1, len(self.COLUMNS)), np.uint64)

    def add(self, word: str) -> int:
        w, s = fold(word), shape_of(word)
        alpha = w.isalpha()
        # near-repeats of long words (other endings) share a key; digits must repeat exactly
        linked = (s[0] == "9" and len(w) >= 3) or s in ("Xx", "XX", "mix")
        key = w if s[0] == "9" or len(w) < 6 else w[:-1] if len(w) < 9 else w[:7]
        self.known.append((_hash(w), _hash(s), _hash(w[-3:]) if alpha else 0, _hash(w[-4:]) if alpha else 0, int(alpha and len(w) > 1), 1 if w.isdigit() else _hash(w), _hash(key) if linked else 0))
        self.ids[word] = len(self.known) - 1
        return self.ids[word]

    def numbers(self, words: list[str]) -> list[int]:
        ids = self.ids
        return [ids[w] if w in ids else self.add(w) for w in words]

    def columns(self, numbers: np.ndarray) -> np.ndarray:
        if len(self.table) < len(self.known):
            self.table = np.array(self.known, np.uint64)
        return self.table[numbers].T


ONE_LETTER = np.uint64(_hash("X"))
_WORDS = Words()
SLOT_BITS = 22
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _slot(template: int, *cols: np.ndarray) -> np.ndarray:
    """The slot of a feature: its template and values mixed to ``SLOT_BITS`` bits."""
    h = np.full(len(cols[0]), template + 1, np.uint64) * _MIX
    for c in cols:
        h = (h ^ c) * _MIX
        h ^= h >> np.uint64(29)
    return ((h * _MIX) >> np.uint64(64 - SLOT_BITS)).astype(np.int32)


class Docs:
    """A batch of texts: tokens, shapes, feature slots (tokens × templates) and skip edges."""

    PAD = 3

    def __init__(self, texts: list[str]):
        self.texts = texts
        if len(_WORDS.ids) > MOST_SPELLINGS:
            _WORDS.clear()
        self.starts: list[list[int]] = []
        self.ends: list[list[int]] = []
        self.shapes: list[list[tuple[int, int, str]]] = []
        numbers, first, at = [0] * self.PAD, [], self.PAD
        for t in texts:
            found = [(m.start(), m.end(), m.group()) for m in TOKEN.finditer(t)]
            self.starts.append([x[0] for x in found])
            self.ends.append([x[1] for x in found])
            self.shapes.append(shapes(t))
            first.append(at)
            numbers += _WORDS.numbers([x[2] for x in found])
            numbers += [0] * self.PAD
            at += len(found) + self.PAD
        self.length = np.array([len(x) for x in self.starts], np.int64)
        self.doc = np.repeat(np.arange(len(texts)), self.length)
        #: Place of each token in its text, and in the padded row of all texts.
        self.place = np.arange(len(self.doc)) - np.repeat(np.cumsum(self.length) - self.length, self.length)
        row = np.array(first, np.int64)[self.doc] + self.place if len(self.doc) else np.zeros(0, np.int64)
        cols = _WORDS.columns(np.array(numbers, np.int64))
        self.slots = self._features(cols, row)
        self.edges = self._links(cols[Words.KEY][row])

    def _inside(self) -> np.ndarray:
        """For each token the shapes it stands in, one bit for each kind and for begin or inside."""
        out = np.zeros(len(self.doc), np.uint64)
        offset = np.cumsum(self.length) - self.length
        for i, spans in enumerate(self.shapes):
            for a, b, k in spans:
                lo, hi = bisect_left(self.starts[i], a), bisect_right(self.ends[i], b)
                bit = 2 * KINDS.index(k)
                for j in range(lo, hi):
                    out[offset[i] + j] |= np.uint64(1 << (bit + (self.starts[i][j] != a)))
        return out

    def _features(self, cols: np.ndarray, row: np.ndarray) -> np.ndarray:
        w, s, nxt = cols[Words.W], cols[Words.S], cols[Words.NEXT]
        at = lambda c, d: c[row + d]
        w0, s0, p1, p2, p3, s1, n1 = at(w, 0), at(s, 0), at(w, -1), at(w, -2), at(w, -3), at(s, 1), at(nxt, 1)
        alpha = at(cols[Words.ALPHA], 0)
        pair = np.where((alpha > 0) & ((s1 == s0) | (s1 == ONE_LETTER)), s0, np.uint64(0))
        inside = self._inside()
        templates = (
            (np.zeros_like(s0),), (s0,), (s1,), (at(s, -1), s0), (p1,), (p1, s0), (p2, p1, s0), (p3, p2, p1), (n1,), (n1, at(nxt, 2)), (pair,), (w0,), (at(cols[Words.E3], 0),), (at(cols[Words.E4], 0),),
            (inside,), (inside, p1), (inside, s0), (w0, s1), (w0, at(cols[Words.E3], 1)), (at(cols[Words.E4], 1), pair),
        )
        return np.stack([_slot(i, *t) for i, t in enumerate(templates)], 1)

    def _links(self, key: np.ndarray) -> np.ndarray:
        """``text, first place, second place`` of neighbouring repeats within a text."""
        has = np.nonzero(key)[0]
        order = has[np.lexsort((has, key[has], self.doc[has]))]
        a, b = order[:-1], order[1:]
        same = (key[a] == key[b]) & (self.doc[a] == self.doc[b])
        return np.stack([self.doc[a[same]], self.place[a[same]], self.place[b[same]]], 1)

    def gold(self, spans: list[list[tuple[int, int, str]]]) -> np.ndarray:
        y = np.zeros(len(self.doc), np.int64)
        offset = np.cumsum(self.length) - self.length
        for i, own in enumerate(spans):
            for a, b, k in own:
                lo, hi = bisect_left(self.starts[i], a), bisect_right(self.ends[i], b)
                if lo < hi:
                    y[offset[i] + lo : offset[i] + hi] = LABELS.index("I-" + k)
                    y[offset[i] + lo] = LABELS.index("B-" + k)
        return y


def _allowed() -> np.ndarray:
    """Inside follows only begin or inside of its kind."""
    ok = np.ones((N, N), bool)
    for j, b in enumerate(LABELS):
        if b[0] == "I":
            for i, a in enumerate(LABELS):
                ok[i, j] = a != "O" and a[2:] == b[2:]
    return ok


FORBID = np.where(_allowed(), 0.0, -1e4).astype(np.float32)
START = np.array([-1e4 if x[0] == "I" else 0.0 for x in LABELS], np.float32)


def padded(docs: Docs, flat: np.ndarray) -> np.ndarray:
    """Texts × longest × labels; beyond a text only 'outside' is possible."""
    out = np.full((len(docs.texts), max(1, int(docs.length.max(initial=0))), N), -1e4, np.float32)
    out[:, :, 0] = 0
    out[docs.doc, docs.place] = flat
    return out


def viterbi(em: np.ndarray, tr: np.ndarray) -> np.ndarray:
    b, t, _ = em.shape
    score, back = em[:, 0] + START, np.zeros((b, t, N), np.int8)
    for i in range(1, t):
        s = score[:, :, None] + tr[None]
        back[:, i] = s.argmax(1)
        score = s.max(1) + em[:, i]
    y = np.zeros((b, t), np.int64)
    y[:, -1] = score.argmax(1)
    for i in range(t - 1, 0, -1):
        y[:, i - 1] = back[np.arange(b), i, y[:, i]]
    return y


def propagate(em: np.ndarray, tr: np.ndarray, e: np.ndarray, agree: float) -> np.ndarray:
    """The log of the product of skip messages into each token, after ``ROUNDS`` rounds of loopy belief propagation."""
    extra = np.zeros_like(em)
    if not len(e) or agree <= 0:
        return extra
    pot = np.ones((N, N), np.float64)
    same = (KIND_OF[:, None] == KIND_OF[None]) & (KIND_OF[:, None] > 0)
    pot[same] = np.exp(agree)
    trans = np.exp(np.maximum(tr, -60.0)).astype(np.float64)
    fwd, bwd = np.ones((len(e), N)), np.ones((len(e), N))  # first to second, second to first
    b, t, _ = em.shape
    for _ in range(ROUNDS):
        logs = em + extra
        un = np.exp(logs - logs.max(-1, keepdims=True)).astype(np.float64)
        al, be = np.empty((b, t, N)), np.ones((b, t, N))
        al[:, 0] = un[:, 0] * np.exp(np.maximum(START, -60.0))
        al[:, 0] /= al[:, 0].sum(-1, keepdims=True)
        for i in range(1, t):
            x = (al[:, i - 1] @ trans) * un[:, i] + 1e-300
            al[:, i] = x / x.sum(-1, keepdims=True)
        for i in range(t - 2, -1, -1):
            x = (be[:, i + 1] * un[:, i + 1]) @ trans.T + 1e-300
            be[:, i] = x / x.sum(-1, keepdims=True)
        bel = al * be
        cu = bel[e[:, 0], e[:, 1]] / np.maximum(bwd, 1e-12)
        cv = bel[e[:, 0], e[:, 2]] / np.maximum(fwd, 1e-12)
        fwd, bwd = cu @ pot, cv @ pot
        fwd /= np.maximum(fwd.max(-1, keepdims=True), 1e-300)
        bwd /= np.maximum(bwd.max(-1, keepdims=True), 1e-300)
        extra = np.zeros_like(em)
        np.add.at(extra, (e[:, 0], e[:, 2]), np.log(np.maximum(fwd, 1e-12)))
        np.add.at(extra, (e[:, 0], e[:, 1]), np.log(np.maximum(bwd, 1e-12)))
    return extra


def piecewise(ids: np.ndarray, y: np.ndarray, rows: int) -> np.ndarray:
    """Weights of the token factors: a multinomial logistic regression (Adagrad). Row 0 stands for unknown features and stays zero."""
    w = np.zeros((rows, N), np.float32)
    seen = np.full_like(w, 1e-2)
    order = np.random.default_rng(0)
    blocks = np.arange(0, len(y), TOKENS)
    for _ in range(EPOCHS):
        for k in order.permutation(len(blocks)):
            f, t = ids[blocks[k] : blocks[k] + TOKENS], y[blocks[k] : blocks[k] + TOKENS]
            logit = w[f].sum(1)
            e = np.exp(logit - logit.max(1, keepdims=True))
            g = e / e.sum(1, keepdims=True)
            g[np.arange(len(t)), t] -= 1
            used, pos = np.unique(f, return_inverse=True)
            pos, per = pos.ravel(), np.repeat(g, f.shape[1], axis=0)
            grad = np.stack([np.bincount(pos, per[:, c], len(used)) for c in range(N)], 1).astype(np.float32) / len(t) * 100 + L2 * w[used]
            seen[used] += grad**2
            w[used] -= RATE * grad / np.sqrt(seen[used])
            w[0] = 0
    return w


def chain_factors(docs: Docs, y: np.ndarray) -> np.ndarray:
    """The log of how much more often two labels follow each other than chance has it, held within 4."""
    pairs = np.full((N, N), 0.5)
    follows = docs.doc[:-1] == docs.doc[1:]
    np.add.at(pairs, (y[:-1][follows], y[1:][follows]), 1)
    joint = pairs / pairs.sum()
    pmi = np.log(joint / (joint.sum(1, keepdims=True) * joint.sum(0, keepdims=True)))
    return np.clip(pmi, -4, 4).astype(np.float32) + FORBID


class Model:
    """Kept feature slots with their weights, transitions and the skip potential."""

    def __init__(self, slots: np.ndarray, w: np.ndarray, tr: np.ndarray, agree: float):
        self.slots, self.w, self.tr, self.agree = slots, w, tr, agree
        self._row: np.ndarray | None = None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_row": None}

    @classmethod
    def fit(cls, texts: list[str], cues: tuple[str, ...] = NAME_CUES) -> Model:
        docs = Docs([t for t in texts if TOKEN.search(t)])
        y = docs.gold([silver(t, cues) for t in docs.texts])
        slots, pos, counts = np.unique(docs.slots, return_inverse=True, return_counts=True)
        kept = counts > 1
        row = np.where(kept, np.cumsum(kept), 0).astype(np.int32)
        w = piecewise(row[pos.reshape(docs.slots.shape)], y, int(kept.sum()) + 1)
        return cls(slots[kept], w, chain_factors(docs, y), cls.agreement(docs, y))

    @staticmethod
    def agreement(docs: Docs, y: np.ndarray) -> float:
        """Log odds that linked tokens have one kind, over chance, from tokens of a kind in the sample."""
        kind, offset = KIND_OF[y], np.cumsum(docs.length) - docs.length
        ku, kv = (kind[offset[docs.edges[:, 0]] + docs.edges[:, c]] for c in (1, 2))
        either, kinds = int(((ku > 0) | (kv > 0)).sum()), int((kind > 0).sum())
        if not either or not kinds:
            return 0.0
        p, q = (int(((ku == kv) & (ku > 0)).sum()) + 1) / (either + 2), max(kinds / max(len(y), 1), 1e-4)
        return float(np.clip(np.log(p / q), 0.0, 4.0))

    def label(self, docs: Docs) -> list[np.ndarray]:
        """Labels of each text's tokens: no text is left out."""
        if self._row is None:
            self._row = np.zeros(1 << SLOT_BITS, np.int32)
            self._row[self.slots] = np.arange(1, len(self.slots) + 1)
        flat = np.zeros((len(docs.doc), N), np.float32)
        for c in range(docs.slots.shape[1]):
            flat += self.w[self._row[docs.slots[:, c]]]
        em = padded(docs, flat)
        y = viterbi(em + propagate(em, self.tr, docs.edges, self.agree), self.tr)
        return [y[i, :n] for i, n in enumerate(docs.length)]


def items(docs: Docs, i: int, y: np.ndarray) -> list[tuple[int, int, str]]:
    """Spans of text ``i`` labelled by the model that pass the exact check of their kind."""
    out = []
    text, starts, ends = docs.texts[i], docs.starts[i], docs.ends[i]
    for j in np.nonzero(BEGINS[y])[0]:
        kind, s, e = LABELS[y[j]][2:], starts[j], ends[j]
        if kind == "name":
            last = j
            while last + 1 < len(y) and LABELS[y[last + 1]] == "I-name":
                last += 1
            if (m := NAME.match(text, s)) and m.end() <= ends[last]:
                out.append((s, m.end(), kind))
        else:
            held = [x for x in docs.shapes[i] if x[2] == kind and x[0] <= s and e <= x[1]]
            if held:
                out.append(max(held, key=lambda x: x[1] - x[0]))
    return sorted(set(out))


def find_in(texts: list[str], model: Model) -> dict[str, list[tuple[int, int, str]]]:
    """The items of each different text. Texts of like length go together, long ones fewer at once."""
    found: dict[str, list] = {}
    todo = sorted(dict.fromkeys(t for t in texts if t), key=len)
    i = 0
    while i < len(todo):
        k = max(1, min(BATCH, BATCH_CHARACTERS // len(todo[min(i + BATCH, len(todo)) - 1])))
        docs = Docs(todo[i : i + k])
        for j, y in enumerate(model.label(docs)):
            found[docs.texts[j]] = items(docs, j, y)
        i += k
    return found


def sample_texts(documents: DataFrame, text_col: str = "text", most: int = SAMPLE) -> list[str]:
    """At most ``most`` different texts: three quarters that a labelling function may label, the rest any others.

    Texts fall into as many hash buckets as the sample has places, and the first in hash order of each is
    taken: one pass over all texts with a partial aggregate.
    """
    cue = "|".join(re.escape(c) for c in NAME_CUES)
    rich = F.col(text_col).rlike(rf"(?i)@|[0-9]{{6}}|[\[(]at[\])]|{cue}|(mah|cad|rue|calle|lane|road|avenue|stra)")
    h, many = F.xxhash64(text_col), most * 3 // 4
    place = F.when(rich, F.pmod(h, F.lit(many))).otherwise(many + F.pmod(h, F.lit(most - many)))
    first = documents.where(f"{text_col} is not null").groupBy(place.alias("place")).agg(F.min(F.struct(h.alias("h"), F.col(text_col).alias("t")))["t"].alias("t"))
    return [r.t for r in first.orderBy("place").collect()]


def _decode(documents: DataFrame, id_col: str, text_col: str, schema: pa.Schema, ddl: str, emit) -> DataFrame:
    model = Model.fit(sample_texts(documents, text_col))
    sent = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            ids, texts = rb.column(0).to_pylist(), rb.column(1).to_pylist()
            found = find_in(texts, sent.value)
            cols = defaultdict(list)
            for id_, t in zip(ids, texts):
                emit(cols, id_, t, found.get(t, []))
            yield pa.record_batch([pa.array(cols[f.name], f.type) for f in schema], schema=schema)

    return documents.select(id_col, text_col).mapInArrow(run, ddl)


def find_items(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, kind, start_at`` (0-based, in code points) of each item.

    Null and empty texts have none, repeated rows each have theirs, and an empty table or one without a
    labelled text gives an empty result.
    """
    schema = pa.schema([(id_col, pa.int64()), ("kind", pa.string()), ("start_at", pa.int32())])

    def emit(cols, id_, text, spans):
        for a, _, k in spans:
            cols[id_col].append(id_)
            cols["kind"].append(k)
            cols["start_at"].append(a)

    return _decode(documents, id_col, text_col, schema, f"{id_col} long, kind string, start_at int", emit)


def masked(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text, n_items``: every text with its items replaced by ``<KIND>``; null stays null."""
    schema = pa.schema([(id_col, pa.int64()), (text_col, pa.string()), ("n_items", pa.int32())])

    def emit(cols, id_, text, spans):
        out, at = [], 0
        for a, b, k in spans:
            if a >= at:
                out += [text[at:a], f"<{k.upper()}>"]
                at = b
        cols[id_col].append(id_)
        cols[text_col].append(None if text is None else "".join([*out, text[at:]]))
        cols["n_items"].append(len(spans))

    return _decode(documents, id_col, text_col, schema, f"{id_col} long, {text_col} string, n_items int", emit)
