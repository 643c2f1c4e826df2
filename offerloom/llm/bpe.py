"""Token ids of a whole corpus by a public byte-level BPE vocabulary.

Method: the text is cut by the vocabulary's public pattern; within a piece, a segment tree over the
ranks of neighbouring pairs has at its root the leftmost pair of lowest rank; merging it changes at
most three leaves, so a merge costs the logarithm of the piece, however long. It ends when no pair can
be merged.

Scale: one narrow stage, no shuffle. The vocabulary file (size checked) travels as a broadcast
variable; pieces seen before are answered from a bounded memory per Python worker.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from offerloom.session import read_file

#: Where the vocabulary lies unless another path is given.
VOCABULARY = os.environ.get("OFFERLOOM_TOKENIZERS", "/opt/tokenizers") + "/byte_bpe_50k.tiktoken"
#: The largest vocabulary file that is broadcast.
MOST_BYTES = 64 << 20
#: Pieces remembered by a worker, and the longest that are.
REMEMBERED, REMEMBERED_BYTES = 200_000, 64
# Fixed value: the public pattern that cuts texts for this vocabulary.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NONE = 1 << 62


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes to id, from lines of base64 and number."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line.strip())}


class PairTree:
    """Minimum over the leaves; a leaf holds (rank << 32 | position), so the leftmost of equal ranks wins."""

    def __init__(self, keys: list[int]):
        n = 1
        while n < len(keys):
            n *= 2
        self.n = n
        t = [NONE] * (2 * n)
        t[n : n + len(keys)] = keys
        for i in range(n - 1, 0, -1):
            a, b = t[2 * i], t[2 * i + 1]
            t[i] = a if a < b else b
        self.t = t

    def set(self, i: int, key: int) -> None:
        t, i = self.t, i + self.n
        t[i] = key
        while i > 1:
            i >>= 1
            a, b = t[2 * i], t[2 * i + 1]
            key = a if a < b else b
            if t[i] == key:
                break
            t[i] = key


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one piece."""
    n = len(piece)
    part = [piece[i : i + 1] for i in range(n)]
    if n == 1:
        return [ranks[piece]]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))

    def key(i: int) -> int:
        j = after[i]
        if j >= n:
            return NONE
        r = ranks.get(part[i] + part[j])
        return NONE if r is None else r << 32 | i

    tree = PairTree([key(i) for i in range(n)])
    while (top := tree.t[1]) != NONE:
        i = top & 0xFFFFFFFF
        j = after[i]
        part[i] += part[j]
        k = after[i] = after[j]
        if k < n:
            before[k] = i
        tree.set(j, NONE)
        tree.set(i, key(i))
        if (h := before[i]) >= 0:
            tree.set(h, key(h))
    out, i = [], 0
    while i < n:
        out.append(ranks[part[i]])
        i = after[i]
    return out


class Encoder:
    def __init__(self, data: bytes, pattern: str = PATTERN):
        import regex

        self.ranks, self.cut, self.known = read_ranks(data), regex.compile(pattern), {}

    def piece(self, s: str) -> list[int]:
        got = self.known.get(s)
        if got is None:
            b = s.encode("utf-8")
            got = merge(b, self.ranks)
            if len(b) <= REMEMBERED_BYTES and len(self.known) < REMEMBERED:
                self.known[s] = got
        return got

    def encode(self, text: str | None) -> list[int]:
        out: list[int] = []
        for m in self.cut.finditer(text or ""):
            out += self.piece(m.group())
        return out


def encode_documents(documents: DataFrame, path: str = VOCABULARY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids``: the ids of every text, without special tokens.

    Empty and null texts give an empty list; strings of special tokens are ordinary text; repeated
    rows stay repeated; lone surrogates can't occur in Spark strings.
    """
    data = documents.sparkSession.sparkContext.broadcast(read_file(documents.sparkSession, path, MOST_BYTES))
    schema = pa.schema([(id_col, pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder(data.value)
        for b in batches:
            ids = [enc.encode(t) for t in b.column(1).to_pylist()]
            yield pa.record_batch([b.column(0).cast(pa.int64()), pa.array(ids, pa.list_(pa.int32()))], schema=schema)

    return documents.select(id_col, text_col).mapInArrow(run, f"{id_col} long, ids array<int>")
