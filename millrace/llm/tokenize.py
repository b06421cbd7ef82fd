"""Encoding of texts with a byte-level BPE vocabulary of ranks (problem 7).

Texts are cut at spaces, and each distinct part of a batch is split by the vocabulary's pattern once. Pieces not seen
before are put into padded numpy matrices by length, one row per piece. In each round every row finds its leftmost
pair of least rank in a hash table of pairs and merges it, together with the later non-overlapping places of the same
pair, which the next rounds would merge anyway; then the rows are compacted. Rows without a pair leave.

Null text gives null ids; empty text gives an empty list; strings of special tokens are ordinary text. Lone surrogates cannot
occur in Spark strings. The vocabulary is read on the driver and broadcast (below 1 MB in file form); workers keep the
ids of about ``KNOWN`` parts of texts and then start anew.
"""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Folder of the public vocabularies.
TOKENIZERS = os.environ.get("PUBLIC_TOKENIZERS", "/opt/tokenizers")
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
KNOWN = 250_000
#: Spaces after white space, where a text isn't cut, and the cut itself.
_GLUE, _CUT = re.compile(r"\s ").search, re.compile(r"(?<=\S) ").split
#: Marks that are a piece of their own after letters at the end of a chunk.
_MARKS = frozenset(".,;:)?!`")
#: Cells of a matrix; longer rows form a matrix of their own.
CELLS = 1 << 15
_NONE = np.int32(1 << 30)


class PairTable:
    """Open-addressing hash table of (left id, right id) -> merged id."""

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray):
        keys = (left.astype(np.int64) << 20) | right
        self.bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 4))))
        self.key = np.full(1 << self.bits, -1, np.int64)
        self.val = np.full(1 << self.bits, _NONE, np.int32)
        todo, at, self.probes = np.arange(len(keys)), self._home(keys), 0
        while len(todo):
            self.probes += 1
            slot = at[todo]
            free = self.key[slot] < 0
            self.key[slot[free]] = keys[todo[free]]  # of several for a slot the last one stays
            won = self.key[slot] == keys[todo]
            self.val[slot[won]] = merged[todo[won]]
            todo = todo[~won]
            at[todo] = (at[todo] + 1) & ((1 << self.bits) - 1)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left.astype(np.int64) << 20) | right
        at = self._home(keys)
        out = np.where(self.key[at] == keys, self.val[at], _NONE)
        open_ = np.flatnonzero((self.key[at] != keys) & (self.key[at] >= 0))
        for _ in range(self.probes - 1):
            if not len(open_):
                break
            at[open_] = (at[open_] + 1) & ((1 << self.bits) - 1)
            k = self.key[at[open_]]
            hit = k == keys[open_]
            out[open_[hit]] = self.val[at[open_[hit]]]
            open_ = open_[~hit & (k >= 0)]
        return out


class Encoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN):
        self.ranks = ranks
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        left, right, merged = [], [], []
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), merged.append(rank)
        self.table = PairTable(np.array(left, np.int64), np.array(right, np.int64), np.array(merged, np.int32))
        self.split = regex.compile(pattern).findall
        self.known: dict[str | tuple[str], tuple[int, ...]] = {}

    def chunks(self, text: str) -> list[str]:
        """Parts of a text, each but the first without the space before it. No piece of the pattern holds a space that
        follows a character other than white space, so texts may be cut there before the pattern is applied."""
        return _CUT(text) if "  " in text or _GLUE(text) else text.split(" ")

    def _split(self, c: str | tuple[str]) -> list[str]:
        if type(c) is tuple:
            return self.split(c[0])
        if c.isalpha():  # letters only: one piece, whatever the pattern does elsewhere
            return [" " + c]
        if c[-1:] in _MARKS and c[:-1].isalpha():
            return [" " + c[:-1], c[-1]]
        return self.split(" " + c)

    def learn(self, chunks: set[str | tuple[str]]) -> None:
        """Encode chunks that are not yet known; a chunk in a tuple has no space before it."""
        split = [(c, self._split(c)) for c in chunks]
        ids = self.pieces({p for _, s in split for p in s})
        for c, s in split:
            self.known[c] = tuple(i for p in s for i in ids[p])

    def pieces(self, pieces: set[str]) -> dict[str, list[int]]:
        out, todo = {}, []
        for p in pieces:
            b = p.encode("utf-8", "surrogatepass")
            whole = self.ranks.get(b)
            if whole is None:
                todo.append((p, b))
            else:
                out[p] = [whole]
        todo.sort(key=lambda x: len(x[1]))
        at = 0
        while at < len(todo):
            end = at + 1  # the last piece is the longest, so it sets the width
            while end < len(todo) and len(todo[end][1]) * (end - at + 1) <= CELLS:
                end += 1
            part = todo[at:end]
            for (p, _), ids in zip(part, self._matrix([b for _, b in part])):
                out[p] = ids.tolist()
            at = end
        return out

    def _matrix(self, rows: list[bytes]) -> list[np.ndarray]:
        n = np.array([len(r) for r in rows])
        m = np.full((len(rows), int(n.max())), -1, np.int32)
        m[np.arange(m.shape[1]) < n[:, None]] = self.byte[np.frombuffer(b"".join(rows), np.uint8)]
        out: list[np.ndarray] = [None] * len(rows)  # type: ignore[list-item]
        own = np.arange(len(rows))
        while True:
            ok = m[:, 1:] >= 0
            r = np.full(ok.shape, _NONE, np.int32)
            r[ok] = self.table.ranks(m[:, :-1][ok], m[:, 1:][ok])
            least = r.min(axis=1, initial=_NONE)
            done = least == _NONE
            for i in np.flatnonzero(done):
                out[own[i]] = m[i][m[i] >= 0].copy()
            if done.all():
                return out
            m, r, own, least = m[~done], r[~done], own[~done], least[~done]
            hit = np.zeros(m.shape, bool)
            hit[:, :-1] = r == least[:, None]
            # Of neighbouring hits, as in "aaaa", every second one counts, from the left.
            col = np.arange(m.shape[1])
            start = np.maximum.accumulate(np.where(~hit, col + 1, 0), axis=1)
            hit &= (col - start) % 2 == 0
            m = np.where(hit, least[:, None], m)
            gone = np.zeros(m.shape, bool)
            gone[:, 1:] = hit[:, :-1]
            keep = ~gone & (m >= 0)
            n = keep.sum(axis=1)
            packed = np.full((len(m), int(n.max())), -1, np.int32)
            packed[np.arange(packed.shape[1]) < n[:, None]] = m[keep]
            m = packed

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the number of each text's (0 for null and empty)."""
        if len(self.known) > KNOWN:
            self.known.clear()
        parts = []
        for t in texts:
            c = self.chunks(t) if t else []
            if c:
                c[0] = (c[0],)
            parts.append(c)
        new = set().union(*parts).difference(self.known)
        if new:
            self.learn(new)
        of = self.known.__getitem__
        found = [[*map(of, c)] for c in parts]
        n = np.fromiter((sum(map(len, f)) for f in found), np.int32, len(found))
        return np.fromiter(chain.from_iterable(chain.from_iterable(found)), np.int32, int(n.sum())), n


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


_encoders: dict[bytes, Encoder] = {}


def encoder(raw: bytes, pattern: str = PATTERN) -> Encoder:
    """One encoder per worker process and vocabulary."""
    import hashlib

    key = hashlib.sha256(raw + pattern.encode()).digest()
    if key not in _encoders:
        _encoders[key] = Encoder({base64.b64decode(a): int(b) for a, b in (line.split() for line in raw.splitlines() if line.strip())}, pattern)
    return _encoders[key]


def vocabulary(spark: SparkSession, name: str = "byte_bpe_50k", folder: str | None = None):
    with open(os.path.join(folder or TOKENIZERS, f"{name}.tiktoken"), "rb") as f:
        return spark.sparkContext.broadcast(f.read())


#: Rows and characters encoded at a time.
ROWS, CHARS = 500, 2_000_000


def _groups(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    at = chars = 0
    for i, t in enumerate(texts):
        chars += len(t or "")
        if i - at >= ROWS or chars > CHARS:
            if i > at:
                yield at, i
            at, chars = i, len(t or "")
    if at < len(texts):
        yield at, len(texts)


def encode(df: DataFrame, text: str = "text", out: str = "ids", name: str = "byte_bpe_50k", folder: str | None = None, count_only: bool = False) -> DataFrame:
    """``df`` without ``text``, with the ids (array<int>) or, for ``count_only``, their number (int; null for null)."""
    vocab = vocabulary(df.sparkSession, name, folder)
    rest = [c for c in df.columns if c != text and c != out]
    kind = "int" if count_only else "array<int>"
    schema = ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in rest), f"`{out}` {kind}"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocab.value)
        for b in batches:
            texts = b.column(len(rest)).to_pylist()
            for i, j in _groups(texts):
                flat, n = enc.encode(texts[i:j])
                null = np.array([t is None for t in texts[i:j]])
                if count_only:
                    col = pa.array(n, pa.int32(), mask=null)
                else:
                    col = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n)).astype(np.int32)), pa.array(flat), mask=pa.array(null))
                yield pa.RecordBatch.from_arrays([*(c.slice(i, j - i) for c in b.columns[: len(rest)]), col], [*rest, out])

    return df.select(*(F.col(f"`{c}`") for c in rest), text).mapInArrow(run, schema)
