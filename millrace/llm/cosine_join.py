"""Weighted cosine join of two collections of sparse vectors, without loss.

Vectors are rows ``(id, terms array<bigint>, weights array<double>)`` of L2 norm 1 with distinct positive-weight terms; without
the column ``weights`` all terms of a vector weigh the same, or by a :class:`Rarity`, which spares the column. All pairs with a dot product of at least ``threshold`` are
found:

1. *Residual norm against the other side's vocabulary.* The terms of one side are set in a fixed-size bit table; a
   vector of the other side whose part inside that vocabulary has a norm below the threshold can reach nobody and
   is dropped before any shuffle. A full table only prunes less.
2. *Inverted lists of prefixes.* Terms are ordered by how often they occur (rare first). By the Cauchy-Schwarz bound
   a vector may leave its tail out of the lists as long as the tail's norm, or the tail's sum of products with the
   greatest weight that the term has on the other side, stays below the threshold. Both sides are cut so, and the
   lists are joined by term. Frequencies and greatest weights come from all vectors, in a hashed table of fixed size;
   terms that share a slot share its sums, which keeps one order for all and only loosens the bounds. Both tables are
   merged as trees of ``FAN_IN`` and start anew with four times the size, up to a bound, if they are more than ``FULL``.
3. *Bound on the rest.* At the first term that a pair shares nothing is shared before it, so that product plus the product of both
   residual norms after the term must reach the threshold. Meetings where it doesn't are dropped in the join, before any shuffle.
4. *Sketches.* A parity bit per hashed term (about two bits a term) bounds from above how many terms a pair shares, so pairs travel with
   a sketch and not with their sets.
5. *Exact dot products* of the sets of what is left; only these sets are shuffled.

In a large collection most terms of any vector occur somewhere on the other side, so that (1) drops few vectors. Therefore sets are
written once, by the pass that prunes them (:func:`inside`), without the terms that the other side lacks, and are not shuffled before (5).

Frequent terms end up in tails, so a term that a third of all rows share joins nothing unless a vector consists of such
terms; skewed lists that remain are split by adaptive execution. Empty vectors match nothing. Rows with a null id or
null terms are dropped. Equal ids within a side must have equal vectors; with a column ``weights`` the caller must remove them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import cut, is_small

#: Slack for rounding in comparisons of floating-point sums.
EPS = 1e-9
#: log2 of the bits of the vocabulary table at first and at most: 16 and 128 MiB, whatever the input.
TABLE_BITS, TABLE_MOST = 27, 30
#: log2 of the slots of the table of frequencies and greatest weights at first and at most: 16 and 64 MiB.
STAT_BITS, STAT_MOST = 21, 23
#: Share of used bits or slots beyond which a table is made anew with four times the size.
FULL = 0.6
#: Pages of one place that are merged in one group, however many tasks made them.
FAN_IN = 64
#: Partitions that one task reads at least, beyond two tasks a core, when a table is made: each task writes a table of its own.
PER_TASK = 32
#: Ids that a task remembers, to keep the terms of equal ones once.
SEEN = 200_000
#: 1 as a weight or norm in an entry of the lists.
UNIT = 65535
#: Steps of the sums of a vector's greatest weights in its sketch.
STEPS = 16
_PAGE = 1 << 16
_MUL = np.uint64(0x9E3779B97F4A7C15)


def slots(terms: np.ndarray, bits: int) -> np.ndarray:
    return (terms.view(np.uint64) * _MUL) >> np.uint64(64 - bits)


def _gathered(df: DataFrame) -> DataFrame:
    """``df`` in fewer partitions, so that the tables that its tasks write stay small beside it."""
    return df.coalesce(max(2 * df.sparkSession.sparkContext.defaultParallelism, df.rdd.getNumPartitions() // PER_TASK))


def merged(pages: DataFrame, both) -> pa.Table:
    """Pages ``(page, task, ...)`` merged to one per page by a tree: a group holds at most ``FAN_IN`` of them, so its size
    doesn't depend on the number of tasks. ``both`` merges the pages of a table into one row, without ``task``."""
    schema = pages.schema

    def merge(t: pa.Table) -> pa.Table:
        task = t.column("task").slice(0, 1)
        return both(t.drop(["task"])).append_column("task", task).select(schema.names)

    while True:
        up = pages.withColumn("task", F.floor(F.col("task") / FAN_IN).cast("int"))
        pages = cut(up.groupBy("page", "task").applyInArrow(merge, schema))
        if not pages.agg(F.max("task")).first()[0]:
            return pages.drop("task").toArrow()


def vocabulary_table(df: DataFrame, bits: int = TABLE_BITS) -> bytes:
    """Bit table over the column ``terms``, of ``2**bits`` bits or more if these fill up; see :func:`table_bits`."""

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << (bits - 3), np.uint8)
        some = False
        for b in batches:
            t = b.column(0).flatten().to_numpy(zero_copy_only=False)
            if len(t):
                some = True
                s = slots(t, bits)
                np.bitwise_or.at(table, (s >> np.uint64(3)).astype(np.int64), np.left_shift(1, s & np.uint64(7)).astype(np.uint8))
        if some:
            pages = table.reshape(-1, min(_PAGE, len(table)))
            at = np.flatnonzero(pages.any(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array([TaskContext.get().partitionId()] * len(at), pa.int32()), pa.array([pages[i].tobytes() for i in at], pa.binary())], ["page", "task", "bits"])

    def either(t: pa.Table) -> pa.Table:
        out = None
        for x in t.column("bits"):
            v = np.frombuffer(x.as_buffer(), np.uint8)
            out = v.copy() if out is None else np.bitwise_or(out, v, out=out)
        return pa.table({"page": t.column("page").slice(0, 1), "bits": pa.array([out.tobytes()], pa.binary())})

    rows = merged(_gathered(df.select("terms").where(F.col("terms").isNotNull())).mapInArrow(local, "page int, task int, bits binary"), either)
    size = 1 << (bits - 3)
    table = np.zeros((size // min(_PAGE, size), min(_PAGE, size)), np.uint8)
    for p, x in zip(rows.column("page").to_pylist(), rows.column("bits").to_pylist()):
        table[p] = np.frombuffer(x, np.uint8)
    if bits < TABLE_MOST and np.bitwise_count(table).sum() > FULL * (1 << bits):
        return vocabulary_table(df, min(TABLE_MOST, bits + 2))
    return table.tobytes()


def table_bits(table: bytes) -> int:
    return len(table).bit_length() + 2


def stat_bits(table: bytes) -> int:
    """Size at first of a table of frequencies for the terms of a vocabulary table."""
    return STAT_BITS if np.bitwise_count(np.frombuffer(table, np.uint64)).sum() <= FULL * (1 << STAT_BITS) else STAT_MOST


class Rarity:
    """Weights of terms by how rare they are: the logarithm of 1 + ``total`` / frequency, from a table of slots of fixed size, which is
    broadcast. Vectors are scaled to norm 1."""

    def __init__(self, df: DataFrame, counts: np.ndarray, total: int):
        self.bits = int(np.log2(len(counts)))
        self.held = df.sparkSession.sparkContext.broadcast(np.log1p(total / np.maximum(counts, 1)).astype(np.float16).tobytes())

    def raw(self, t: np.ndarray) -> np.ndarray:
        return np.frombuffer(self.held.value, np.float16)[slots(t, self.bits).astype(np.int64)].astype(np.float64)

    def weights(self, n: np.ndarray, t: np.ndarray) -> np.ndarray:
        w = self.raw(t)
        sums, end = np.concatenate([[0.0], np.cumsum(w * w)]), np.cumsum(n)
        return w / np.repeat(np.sqrt(np.maximum(sums[end] - sums[end - n], 1e-300)), n)


def _rounded_up(x: np.ndarray, kind: type) -> np.ndarray:
    """Positive numbers in fewer bytes, none of them less."""
    y = x.astype(kind)
    return np.where(y < x, np.nextafter(y, kind(np.inf)), y)


def _vectors(b: pa.RecordBatch, names: list[str], rarity: Rarity | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths, terms and weights of a batch of vectors."""
    lists = b.column(names.index("terms"))
    n = lists.value_lengths().to_numpy(zero_copy_only=False)
    t = lists.flatten().to_numpy(zero_copy_only=False)
    if "weights" in names:
        return n, t, b.column(names.index("weights")).flatten().to_numpy(zero_copy_only=False)
    if "norm" in names:
        return n, t, (rarity.raw(t) if rarity else 1.0) / np.repeat(b.column(names.index("norm")).to_numpy(zero_copy_only=False), n)
    return n, t, rarity.weights(n, t) if rarity else np.repeat(1 / np.sqrt(np.maximum(n, 1)), n)


def within(df: DataFrame, table: bytes, threshold: float, rarity: Rarity | None = None) -> DataFrame:
    """Vectors whose part inside the table's vocabulary has a norm of at least ``threshold``."""
    held, bits = df.sparkSession.sparkContext.broadcast(table), table_bits(table)
    names = df.columns

    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.frombuffer(held.value, np.uint8)
        for b in batches:
            n, t, w = _vectors(b, names, rarity)
            s = slots(t, bits)
            inside = (own[(s >> np.uint64(3)).astype(np.int64)] >> (s & np.uint64(7)).astype(np.uint8)) & 1
            total = np.concatenate([[0.0], np.cumsum(w * w * inside)])
            end = np.cumsum(n)
            keep = (total[end] - total[end - n] >= threshold * threshold - 1e-6) & (n > 0)
            if keep.any():
                yield b.filter(pa.array(keep))

    return df.where(F.col("terms").isNotNull()).mapInArrow(prune, df.schema)


def inside(df: DataFrame, table: bytes | None, threshold: float, rarity: Rarity | None = None, key: str = "id") -> DataFrame:
    """Rows that :func:`within` keeps, with the terms inside the table's vocabulary alone (no other adds to a dot product), and ``size`` and
    ``norm`` of the whole vector before scaling. Of equal keys in a task the first has the terms, further ones have none. Without a table all are kept."""
    held, bits = (df.sparkSession.sparkContext.broadcast(table), table_bits(table)) if table else (None, 0)
    rest = [c for c in df.columns if c != "terms"]
    schema = df.select(rest).schema.add("size", T.IntegerType()).add("norm", T.DoubleType()).add("terms", T.ArrayType(T.LongType()))

    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, seen = np.frombuffer(held.value, np.uint8) if held else None, set()
        for b in batches:
            lists = b.column(len(rest))
            n, t = lists.value_lengths().to_numpy(zero_copy_only=False), lists.flatten().to_numpy(zero_copy_only=False)
            w = rarity.raw(t) if rarity else np.ones(len(t))
            known = np.ones(len(t), bool)
            if held:
                s = slots(t, bits)
                known = ((own[(s >> np.uint64(3)).astype(np.int64)] >> (s & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)
            end = np.cumsum(n)
            per_row = lambda x: (c := np.concatenate([[0], np.cumsum(x)]))[end] - c[end - n]  # noqa: B023, E731
            whole, count = per_row(w * w), per_row(known)
            keep = (per_row(w * w * known) >= (threshold * threshold - 1e-6) * whole) & (count > 0)
            at = np.flatnonzero(keep)
            if not len(at):
                continue
            first = np.zeros(len(n), bool)
            keys = b.column(rest.index(key))
            for i in at.tolist():
                if (k := keys[i].as_py()) not in seen:
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add(k)
                    first[i] = True
            offsets = np.concatenate([[0], np.cumsum((count * first)[at])]).astype(np.int32)
            terms = pa.ListArray.from_arrays(pa.array(offsets), pa.array(t[known & np.repeat(first, n)]))
            few = b.take(pa.array(at))
            yield pa.RecordBatch.from_arrays([*few.columns[: len(rest)], pa.array(n[at].astype(np.int32)), pa.array(np.sqrt(whole[at])), terms], [*rest, "size", "norm", "terms"])

    return df.select(*rest, "terms").where(F.col("terms").isNotNull()).mapInArrow(prune, schema)


def term_stats(df: DataFrame, bits: int = STAT_BITS, rarity: Rarity | None = None) -> tuple[np.ndarray, np.ndarray]:
    """By slot, how many vectors have its terms, and the greatest weight; of ``2**bits`` slots or more if these fill up."""
    names, page = df.columns, 1 << 14

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, top = np.zeros(1 << bits, np.uint32), np.zeros(1 << bits, np.uint16)
        for b in batches:
            _, t, w = _vectors(b, names, rarity)
            s = slots(t, bits).astype(np.int64)
            np.add.at(count, s, 1)
            np.maximum.at(top, s, _rounded_up(w, np.float16).view(np.uint16))  # positive numbers are ordered as their bits
        at = np.flatnonzero(count.reshape(-1, page).any(axis=1))
        for k in range(0, len(at), 16):  # a few pages at a time, so that no second copy of the table is held
            some = at[k : k + 16]
            n, high = ([x.reshape(-1, page)[i].tobytes() for i in some] for x in (count, top))
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array([TaskContext.get().partitionId()] * len(some), pa.int32()), pa.array(n, pa.binary()), pa.array(high, pa.binary())], ["page", "task", "n", "top"])

    def both(t: pa.Table) -> pa.Table:
        n = np.minimum(sum(np.frombuffer(x.as_buffer(), np.uint32).astype(np.int64) for x in t.column("n")), 2**32 - 1).astype(np.uint32)
        top = np.maximum.reduce([np.frombuffer(x.as_buffer(), np.uint16) for x in t.column("top")])
        return pa.table({"page": t.column("page").slice(0, 1), "n": pa.array([n.tobytes()], pa.binary()), "top": pa.array([top.tobytes()], pa.binary())})

    rows = merged(_gathered(df).mapInArrow(local, "page int, task int, n binary, top binary"), both)
    count, top = np.zeros((1 << bits) // page * page, np.int64).reshape(-1, page), np.zeros((1 << bits), np.float16).reshape(-1, page)
    for p, n, w in zip(*(rows.column(c).to_pylist() for c in ("page", "n", "top"))):
        count[p], top[p] = np.frombuffer(n, np.uint32), np.frombuffer(w, np.float16)
    if bits < STAT_MOST and np.count_nonzero(count) > FULL * count.size:
        return term_stats(df, min(STAT_MOST, bits + 2), rarity)
    return count.ravel(), top.ravel()


def _shared_slots(*stats: tuple[np.ndarray, np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Tables of one size: a greater one is folded, as the first bits of a slot are its slot in a lesser one."""
    size = min(len(n) for n, _ in stats)
    return [(n.reshape(size, -1).sum(axis=1), top.reshape(size, -1).max(axis=1)) for n, top in stats]


def prefixes(df: DataFrame, own: tuple[np.ndarray, np.ndarray], other: tuple[np.ndarray, np.ndarray], threshold: float, rarity: Rarity | None = None) -> DataFrame:
    """``(id, entry)``: the index part of each vector, its rare terms up to where the tail can no longer reach the threshold alone. An entry
    holds 32 bits of the term (what they confuse only adds candidates), its weight, and the norm of what comes after it, both in ``UNIT``s and
    rounded up. Terms whose slot is empty on the other side add to no dot product and are left out from the start."""
    freq = np.log2(1.0 + own[0] + other[0]).astype(np.float16)  # frequencies only order the terms
    held = df.sparkSession.sparkContext.broadcast((freq.tobytes(), other[1].astype(np.float16).tobytes()))
    names, bits = df.columns, int(np.log2(len(freq)))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        freq, top = (np.frombuffer(x, np.float16) for x in held.value)
        for b in batches:
            n, t, w = _vectors(b, names, rarity)
            s = slots(t, bits).astype(np.int64)
            m, f = top[s].astype(np.float64), freq[s]
            row, term, weight, rest, start = [], [], [], [], 0
            for i, k in enumerate(n.tolist()):
                here = start + np.flatnonzero(m[start : start + k])
                start += k
                here = here[np.lexsort((t[here], f[here]))]
                ws = w[here][::-1]
                norm = np.sqrt(np.cumsum(ws * ws))
                out = int(np.count_nonzero(np.minimum(norm, np.cumsum(ws * m[here][::-1])) < threshold - EPS))
                size = len(here) - out
                if size:
                    row.append(np.full(size, i))
                    term.append(t[here[:size]])
                    weight.append(w[here[:size]])
                    rest.append(np.append(norm[::-1][1:], 0.0)[:size])
            if row:
                short = (np.concatenate(term).view(np.uint64) * _MUL) & np.uint64(0xFFFFFFFF << 32)
                u, v = (np.minimum(np.ceil(np.concatenate(x) * UNIT), UNIT).astype(np.uint64) for x in (weight, rest))
                yield pa.RecordBatch.from_arrays([b.column(names.index("id")).take(pa.array(np.concatenate(row))), pa.array((short | (u << np.uint64(16)) | v).view(np.int64))], ["id", "entry"])

    return df.mapInArrow(index, f"id {df.schema['id'].dataType.simpleString()}, entry bigint")


def sketches(df: DataFrame, rarity: Rarity | None = None) -> DataFrame:
    """``(id, k, norm, bits, top)`` of each id: the number of its terms, their parities, and with a rarity the sums of the squares of its greatest
    weights, in ``STEPS`` steps."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, t = b.column(2).value_lengths().to_numpy(zero_copy_only=False), b.column(2).flatten().to_numpy(zero_copy_only=False)
            h = ((t.view(np.uint64) * _MUL) >> np.uint64(32)).astype(np.int64)
            w = rarity.raw(t) ** 2 if rarity else None
            bits, top, end = [], [], np.cumsum(n)
            for k, e in zip(n.tolist(), end.tolist()):
                size = 1 << min(16, max(6, (2 * k - 1).bit_length()))
                bits.append(np.packbits((np.bincount(h[e - k : e] & (size - 1), minlength=size) & 1).astype(np.uint8), bitorder="little").tobytes())
                if rarity:
                    sums = np.cumsum(np.sort(w[e - k : e])[::-1])
                    top.append(_rounded_up(sums[-(-np.arange(1, STEPS + 1) * k // STEPS) - 1] * (1 + EPS), np.float32).tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n.astype(np.int32)), b.column(1), pa.array(bits, pa.binary()), pa.array(top or [None] * len(n), pa.binary())], ["id", "k", "norm", "bits", "top"])

    kind = df.schema["id"].dataType.simpleString()
    return df.select("id", "norm", "terms").mapInArrow(sketch, f"id {kind}, k int, norm double, bits binary, top binary").dropDuplicates(["id"])


def most_shared(ka: int, x: bytes, kb: int, y: bytes) -> int:
    """Bound from above on the terms that two sketches share: each term of one alone turns one bit at most."""
    u, v, nu, nv = int.from_bytes(x, "little"), int.from_bytes(y, "little"), 8 * len(x), 8 * len(y)
    while nu > nv:
        nu >>= 1
        u = (u >> nu) ^ (u & ((1 << nu) - 1))
    while nv > nu:
        nv >>= 1
        v = (v >> nv) ^ (v & ((1 << nv) - 1))
    return min(ka, kb, (ka + kb - (u ^ v).bit_count()) // 2)


def likely(pairs: DataFrame, left: DataFrame, right: DataFrame, threshold: float, rarity: Rarity | None = None) -> DataFrame:
    """Pairs ``(id_a, id_b)`` whose sketches allow the threshold, of pairs of hashes of ids; ids that share a hash are all tried."""
    kinds = [d.schema["id"].dataType.simpleString() for d in (left, right)]

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = []
            for ka, na, xa, ta, kb, nb, xb, tb in zip(*(c.to_pylist() for c in b.columns[2:])):
                s = most = most_shared(ka, xa, kb, xb)
                if rarity and s > 0:
                    most = min(float(np.frombuffer(top, np.float32)[-(-s * STEPS // k) - 1]) for top, k in ((ta, ka), (tb, kb)))
                ok.append(most >= (threshold - EPS) * na * nb)
            yield b.select(["id_a", "id_b"]).filter(pa.array(ok, pa.bool_()))

    named = lambda d, x: sketches(d, rarity).select(F.xxhash64("id").alias(f"key_{x}"), *(F.col(c).alias(f"{c}_{x}") for c in ("id", "k", "norm", "bits", "top")))
    met = pairs.toDF("key_a", "key_b").join(named(left, "a"), "key_a").join(named(right, "b"), "key_b")
    return met.select("id_a", "id_b", *(f"{c}_{x}" for x in "ab" for c in ("k", "norm", "bits", "top"))).mapInArrow(keep, f"id_a {kinds[0]}, id_b {kinds[1]}")


def among(df: DataFrame, ids: DataFrame) -> DataFrame:
    """Vectors of the given ids, a cut table: exactly, if these are few enough to broadcast, else by a bit table, which lets some others pass."""
    if is_small(ids):
        return df.join(F.broadcast(ids), "id", "left_semi")
    key = F.array(F.xxhash64("id"))
    marked = df.select("id", F.col("size").alias("_size"), F.col("norm").alias("_norm"), F.col("terms").alias("_terms"), key.alias("terms"))
    return within(marked, vocabulary_table(ids.select(key.alias("terms"))), 1.0).select("id", F.col("_size").alias("size"), F.col("_norm").alias("norm"), F.col("_terms").alias("terms"))


def cosine_join(left: DataFrame, right: DataFrame | None, threshold: float, ready: bool = False, rarity: Rarity | None = None, bits: int = STAT_BITS) -> DataFrame:
    """Pairs ``(id_a, id_b, dot, shared, size_a, size_b)`` of ``left`` and ``right`` with ``dot >= threshold``; with no
    ``right``, of ``left`` with itself and ``id_a < id_b``. ``threshold`` must lie in (0, 1]. Inputs are cut
    (checkpointed) after pruning, as they are used several times; with ``ready`` the caller has done both by :func:`inside`. ``bits``: of the
    tables of frequencies at first."""
    if not 0 < threshold <= 1:
        raise ValueError("threshold must lie in (0, 1]")
    own, weighted = right is None, "weights" in left.columns
    cols = [c for c in ("id", "size", "norm", "terms", "weights") if c in left.columns and (ready or c not in ("size", "norm"))]
    usable = lambda d: d.select(cols).where("id is not null and terms is not null")
    pruned = lambda d, table: cut(within(d, table, threshold, rarity) if weighted else inside(d, table, threshold, rarity))
    keyed = lambda d: d if weighted else d.withColumn("id", F.xxhash64("id"))
    left = usable(left)
    if own:
        left = right = cut(left) if weighted else pruned(left, None)
        stats = stats_r = term_stats(left, bits, rarity)
        a = b = prefixes(keyed(left), stats, (np.zeros_like(stats[0]), stats[1]), threshold, rarity)
    else:
        right = usable(right)
        if not ready:
            left = pruned(left, vocabulary_table(right))
            right = pruned(right, vocabulary_table(left))
        stats, stats_r = _shared_slots(term_stats(left, bits, rarity), term_stats(right, bits, rarity))
        a, b = prefixes(keyed(left), stats, stats_r, threshold, rarity), prefixes(keyed(right), stats_r, stats, threshold, rarity)
    met = a.select(F.col("id").alias("id_a"), F.col("entry").alias("a")).join(b.select(F.col("id").alias("id_b"), F.col("entry").alias("b")), F.shiftright("a", 32) == F.shiftright("b", 32))
    (wa, ra), (wb, rb) = ((F.shiftright(c, 16).bitwiseAND(UNIT), F.col(c).bitwiseAND(UNIT)) for c in "ab")
    met = met.where(wa * wb + ra * rb >= (threshold - EPS) * UNIT * UNIT)
    if not weighted and not rarity:  # sets: the lesser size bounds what is shared
        met = met.where(F.least(wa, wb) >= (F.greatest(wa, wb) - 1) * (threshold - EPS))
    if own and weighted:
        met = met.where("id_a < id_b")
    cand = met.select("id_a", "id_b").distinct()
    if not weighted:
        cand = likely(cand, left, right, threshold, rarity)
        cand = cut(cand.where("id_a < id_b") if own else cand)
        left, right = (among(d, cut(cand.select(F.col(c).alias("id")).distinct())).dropDuplicates(["id"]) for d, c in ((left, "id_a"), (right, "id_b")))
    return exact_dots(cand, left, right, rarity).where(F.col("dot") >= threshold - EPS)


def exact_dots(pairs: DataFrame, left: DataFrame, right: DataFrame, rarity: Rarity | None = None) -> DataFrame:
    """``(id_a, id_b, dot, shared, size_a, size_b)`` of given pairs by their vectors; ``shared`` counts the common
    terms. Equal weights need only the sets; others are joined term by term."""
    if "weights" not in left.columns:
        named = lambda d, x: d.select(*(F.col(c).alias(f"{c}_{x}") for c in ("id", "size", "norm", "terms")))
        met = pairs.join(named(left, "a"), "id_a").join(named(right, "b"), "id_b")
    if rarity:
        met = met.select("id_a", "id_b", "size_a", "size_b", "norm_a", "norm_b", "terms_a", "terms_b")
        kind = pairs.schema["id_a"].dataType.simpleString()

        def dots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                rows = []
                for na, nb, x, y in zip(*(b.column(k) for k in range(4, 8))):
                    both = rarity.raw(np.intersect1d(*(v.values.to_numpy(zero_copy_only=False) for v in (x, y))))
                    rows.append((float((both * both).sum() / (na.as_py() * nb.as_py())), len(both)))
                cols = [pa.array([r[k] for r in rows], pa.int32() if k else pa.float64()) for k in range(2)]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *cols, b.column(2), b.column(3)], ["id_a", "id_b", "dot", "shared", "size_a", "size_b"])

        return met.mapInArrow(dots, f"id_a {kind}, id_b {kind}, dot double, shared int, size_a int, size_b int")
    if "weights" not in left.columns:
        sizes = met.select("id_a", "id_b", F.size(F.array_intersect("terms_a", "terms_b")).alias("shared"), "size_a", "size_b")
        return sizes.withColumn("dot", F.col("shared") / F.sqrt(F.col("size_a").cast("double") * F.col("size_b")))
    l = left.select(F.col("id").alias("id_a"), F.size("terms").alias("size_a"), F.explode(F.arrays_zip(F.col("terms").alias("t"), F.col("weights").alias("w"))).alias("x"))
    r = right.select(F.col("id").alias("id_b"), F.size("terms").alias("size_b"), F.explode(F.arrays_zip(F.col("terms").alias("t"), F.col("weights").alias("w"))).alias("y"))
    a = pairs.join(l, "id_a").withColumn("term", F.col("x.t"))
    b = r.withColumn("term", F.col("y.t"))
    return a.join(b, ["id_b", "term"]).groupBy("id_a", "id_b").agg(F.sum(F.col("x.w") * F.col("y.w")).alias("dot"), F.count(F.lit(1)).alias("shared"), F.first("size_a").alias("size_a"), F.first("size_b").alias("size_b"))
