"""Passages of held-out items inside corpus texts, by winnowed fingerprints (problem 3).

The fingerprint of a text is, for each window of ``WINDOW`` consecutive runs of ``GRAM`` words, the least run hash
(the rightmost if several). Two texts that share ``GRAM + WINDOW - 1`` = 13 consecutive words share a whole window, so they
share its least hash: no such span is missed. Fingerprints of corpus and items are joined; each hit pair is
then extended on the words themselves, which removes chance hits and gives the longest shared span.

Null, empty and shorter texts have no fingerprint and leak nothing. Repeated records count once. An item id or record id
that is null is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import words as w
from millrace.session import cut, is_small, keep_keys

SPAN, GRAM = 13, 8
WINDOW = SPAN - GRAM + 1
#: Characters of item text up to which the items are broadcast for the extension.
ITEM_CHARS = 32_000_000


def winnow(h: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Distinct hashes that are least in some window; texts with fewer runs than a window have none."""
    if len(h) < window:
        return np.empty(0, np.uint64)
    return np.unique(np.lib.stride_tricks.sliding_window_view(h, window).min(axis=1))


def fingerprints(df: DataFrame) -> DataFrame:
    """``(id, fp)`` of rows ``(id, text)``, distinct per row."""
    kind = df.schema["id"].dataType.simpleString()

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = w.WordHash()
        for b in batches:
            found = [winnow(w.runs(cache.of(w.words(t)), GRAM)) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), w.long_lists(found)], ["id", "fp"])

    rows = df.select("id", "text").where("id is not null and text is not null").mapInArrow(of, f"id {kind}, fp array<bigint>")
    return rows.select("id", F.explode("fp").alias("fp"))


class Passages:
    """Suffix automaton over the words of a text: finds the longest run that another text shares with it in time linear in that
    text, however often both repeat themselves."""

    def __init__(self, text: list[str]):
        self.next: list[dict[str, int]] = [{}]
        self.link, self.size, self.end = [-1], [0], [0]
        last = 0
        for i, word in enumerate(text):
            now = self._state(dict(), self.size[last] + 1, i + 1)
            p = last
            while p >= 0 and word not in self.next[p]:
                self.next[p][word] = now
                p = self.link[p]
            if p >= 0:
                q = self.next[p][word]
                if self.size[q] != self.size[p] + 1:
                    twin = self._state(dict(self.next[q]), self.size[p] + 1, self.end[q])
                    self.link[twin], self.link[q] = self.link[q], twin
                    while p >= 0 and self.next[p].get(word) == q:
                        self.next[p][word] = twin
                        p = self.link[p]
                    q = twin
                self.link[now] = q
            else:
                self.link[now] = 0
            last = now

    def _state(self, then: dict[str, int], size: int, end: int) -> int:
        self.next.append(then)
        self.link.append(-1)
        self.size.append(size)
        self.end.append(end)
        return len(self.next) - 1

    def longest(self, other: list[str], span: int = SPAN) -> tuple[int, int, int]:
        """Length of the longest shared run of at least ``span`` words and its first places in the text and in the other; 0 if none."""
        best, state, n = (0, 0, 0), 0, 0
        following, link, size = self.next, self.link, self.size
        for j, word in enumerate(other):
            while state and word not in following[state]:
                state = link[state]
                n = size[state]
            to = following[state].get(word)
            if to is not None:
                state, n = to, n + 1
                if n >= span and n > best[0]:
                    best = (n, self.end[state] - n, j + 1 - n)
        return best


def longest_shared(a: list[str], b: list[str], span: int = SPAN) -> tuple[int, int, int]:
    """Length in words of the longest common run of at least ``span`` words, and its places in ``a`` and ``b``; 0 if none."""
    return Passages(a).longest(b, span)


def leaked_passages(items: DataFrame, corpus: DataFrame) -> DataFrame:
    """``(item_id, id, words, item_start, start)`` of each item and corpus record that share at least 13 consecutive words;
    starts count words. Both inputs are ``(id, text)``; repeated records count once, the longest span wins."""
    items = items.select(F.col("id").alias("item_id"), F.col("text").alias("item_text")).where("item_id is not null and item_text is not null").distinct()
    of_items = cut(fingerprints(items.select(F.col("item_id").alias("id"), F.col("item_text").alias("text"))).distinct())
    prints = of_items.select(F.col("id").alias("item_id"), "fp")
    # The items' table is counted, so the broadcast is bounded; beyond that both sides are shuffled by fingerprint.
    if is_small(of_items):
        prints = F.broadcast(prints)
    hits = cut(fingerprints(corpus).join(prints, "fp").select("id", "item_id").distinct())
    texts = keep_keys(corpus.select("id", "text").where("text is not null"), hits.select("id").distinct(), "id").distinct()
    size = items.agg(F.sum(F.length("item_text"))).first()[0] or 0
    pairs = texts.join(hits, "id").join(F.broadcast(items) if size <= ITEM_CHARS else items, "item_id")
    kinds = {c: pairs.schema[c].dataType.simpleString() for c in ("item_id", "id")}

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Passages] = {}
        for b in batches:
            rows = []
            for item, text in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                if item not in known:
                    if len(known) > 500:
                        known.clear()
                    known[item] = Passages(w.words(item))
                rows.append(known[item].longest(w.words(text)))
            keep = pa.array([n > 0 for n, _, _ in rows])
            cols = [b.column(0), b.column(1), *(pa.array([r[k] for r in rows], pa.int32()) for k in range(3))]
            yield pa.RecordBatch.from_arrays(cols, ["item_id", "id", "words", "item_start", "start"]).filter(keep)

    spans = pairs.select("item_id", "id", "item_text", "text").mapInArrow(extend, f"item_id {kinds['item_id']}, id {kinds['id']}, words int, item_start int, start int")
    best = F.max(F.struct("words", (-F.col("item_start")).alias("i"), (-F.col("start")).alias("j"))).alias("s")
    return spans.groupBy("item_id", "id").agg(best).select("item_id", "id", F.col("s.words").alias("words"), (-F.col("s.i")).alias("item_start"), (-F.col("s.j")).alias("start"))
