"""Filling windows of fixed capacity with texts (problem 8).

A text longer than the capacity is split into full pieces, which fill windows of their own, and a rest; everything else
stays whole. Items are dealt by hash to partitions of about ``ITEMS`` items, each packed by best-fit decreasing. Lower
bounds from dual feasible functions certify a partition whose number of windows reaches its bound. Partitions with a gap
exchange the items of their windows that aren't full: these are dealt anew among such partitions and packed again, and the
new packing is kept if it takes fewer windows in total, else another deal is tried. This ends when all partitions are certified, the
bound over all items is reached, or after ``ROUNDS`` deals; the report has the gap that is left. No item depends on it.

Items of size 0 and null sizes get no window (``window_id`` null, position 0). Negative sizes are an error.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import cut

ITEMS = 20_000
ROUNDS = 6


def lower_bound(sizes: np.ndarray, counts: np.ndarray, capacity: int) -> int:
    """Windows that any packing needs: the best of two families of dual feasible functions, evaluated on a histogram."""
    if not len(sizes):
        return 0
    s, n = sizes.astype(np.int64), counts.astype(np.int64)
    total = int((s * n).sum())
    best = -(-total // capacity)
    order = np.argsort(s)
    s, n = s[order], n[order]
    num, mass = np.append(0, np.cumsum(n)), np.append(0, np.cumsum(s * n))
    for e in np.unique(s[s <= capacity // 2]):  # items above capacity - e count as a whole window, below e as nothing
        lo, hi = np.searchsorted(s, e), np.searchsorted(s, capacity - e, "right")
        best = max(best, int(num[-1] - num[hi]) + -(-int(mass[hi] - mass[lo]) // capacity))
    for k in range(1, 41):  # u_k: x if (k+1)x is whole, else floor((k+1)x) / k, with x a share of the capacity
        whole = ((k + 1) * s) % capacity == 0
        scaled = np.where(whole, s * k, ((k + 1) * s) // capacity * capacity)
        best = max(best, -(-int((scaled * n).sum()) // (capacity * k)))
    return best


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Window of each item; equal sizes are taken in the given order."""
    out = np.empty(len(sizes), np.int64)
    open_: list[list[int]] = [[] for _ in range(capacity + 1)]
    rest, used = 0, 0  # bit r of rest: there is a window with r left
    for i in np.argsort(-sizes, kind="stable").tolist():
        x = int(sizes[i])
        fit = rest >> x
        if fit:
            r = x + (fit & -fit).bit_length() - 1
            w = open_[r].pop()
            if not open_[r]:
                rest &= ~(1 << r)
        else:
            r, w = capacity, used
            used += 1
        out[i] = w
        r -= x
        if r:
            open_[r].append(w)
            rest |= 1 << r
    return out


def _pack(items: DataFrame, capacity: int) -> DataFrame:
    """``items``: id, piece, size, part. Adds the window within the part, its load, and the part's windows and bound."""
    kind = items.schema["id"].dataType.simpleString()

    def pack(t: pa.Table) -> pa.Table:
        t = t.sort_by([("size", "descending"), ("id", "ascending"), ("piece", "ascending")])
        sizes = t.column("size").to_numpy().astype(np.int64)
        w = best_fit_decreasing(sizes, capacity)
        load = np.bincount(w, weights=sizes).astype(np.int64)
        s, n = np.unique(sizes, return_counts=True)
        need = lower_bound(s, n, capacity)
        for name, col in (("win", w), ("load", load[w]), ("wins", np.full(len(w), len(load))), ("need", np.full(len(w), need))):
            t = t.append_column(name, pa.array(col.astype(np.int64)))
        return t.select(["id", "piece", "size", "part", "win", "load", "wins", "need"])

    return items.select("id", "piece", "size", "part").groupBy("part").applyInArrow(pack, f"id {kind}, piece int, size bigint, part bigint, win bigint, load bigint, wins bigint, need bigint")


def _deal(df: DataFrame, seed: int, parts: int) -> DataFrame:
    return df.withColumn("part", F.lit(seed).cast("bigint") * (1 << 32) + F.pmod(F.xxhash64("id", "piece", F.lit(seed)), F.lit(parts)))


def fill_windows(sizes: DataFrame, capacity: int, items_per_part: int = ITEMS, rounds: int = ROUNDS) -> tuple[DataFrame, dict]:
    """``sizes``: distinct ``id`` and ``size``. Returns ``(id, piece, start, size, window_id, position, window_start)`` (one
    row per text or piece; ``start`` is the piece's first token in its text) and a report: windows, tokens, bound, gap."""
    if capacity < 1:
        raise ValueError("capacity must be positive")
    kind = sizes.schema["id"].dataType.simpleString()
    sizes = cut(sizes.select("id", F.col("size").cast("bigint").alias("size")).where("id is not null"))
    size = F.coalesce("size", F.lit(0))
    items = sizes.select("id", F.floor(F.greatest(size - 1, F.lit(0)) / capacity).cast("int").alias("piece"), size.alias("whole"))
    items = items.select("id", "piece", "whole", (F.col("whole") - F.col("piece").cast("bigint") * capacity).alias("size"))
    full = items.where("piece > 0").select("id", F.explode(F.sequence(F.lit(0), F.col("piece") - 1)).alias("piece")).select("id", "piece", F.lit(capacity).cast("bigint").alias("size"))
    rest = items.where("size > 0").select("id", "piece", "size")
    hist = rest.groupBy("size").count().toArrow()  # at most `capacity` rows
    count = int(np.sum(hist.column("count").to_numpy())) if hist.num_rows else 0
    bound = lower_bound(hist.column("size").to_numpy(), hist.column("count").to_numpy(), capacity) if hist.num_rows else 0
    placed = cut(_pack(_deal(rest, 0, max(1, math.ceil(count / items_per_part))), capacity))
    windows = lambda d: d.groupBy("part").agg(F.first("wins").alias("wins"), F.first("need").alias("need"))
    total = lambda d: windows(d).agg(F.coalesce(F.sum("wins"), F.lit(0)), F.count_if(F.col("wins") > F.col("need"))).first()
    used, gaps = total(placed)
    for seed in range(1, rounds + 1):
        if used <= bound or gaps < 2:
            break
        loose = (F.col("wins") > F.col("need")) & (F.col("load") < capacity)
        again = cut(_pack(_deal(placed.where(loose), seed, gaps), capacity))
        before = placed.where(loose).select("part", "win").distinct().count()
        now, left = total(again)
        if now >= before:  # this deal gains nothing, another one may
            continue
        kept = placed.where(~loose)
        # What stays is closed: its windows are full, or its partition is certified.
        placed = cut(kept.withColumn("need", F.col("wins")).unionByName(again))
        used, gaps = used - before + now, left
    own = full.select("id", "piece", "size", F.concat_ws("-", F.lit("f"), "id", "piece").alias("window_id"), F.lit(0).alias("position"), F.lit(0).cast("bigint").alias("window_start"))
    order = F.array_sort(F.collect_list(F.struct((-F.col("size")).alias("neg"), "id", "piece")))
    wins = placed.groupBy("part", "win").agg(order.alias("v"))
    starts = F.expr("aggregate(v, cast(array(0L) as array<bigint>), (a, x) -> concat(a, array(element_at(a, -1) - x.neg)))")
    packed = wins.select("part", "win", starts.alias("at"), F.posexplode("v").alias("position", "x")).select(F.col("x.id").alias("id"), F.col("x.piece").alias("piece"), (-F.col("x.neg")).alias("size"), F.concat_ws("-", F.lit("p"), "part", "win").alias("window_id"), "position", F.element_at("at", F.col("position") + 1).alias("window_start"))
    none = items.where("whole = 0").select("id", "piece", "size", F.lit(None).cast("string").alias("window_id"), F.lit(0).alias("position"), F.lit(None).cast("bigint").alias("window_start"))
    out = own.unionByName(packed).unionByName(none)
    start = (F.col("piece").cast("bigint") * capacity).alias("start")
    whole = full.count()
    tokens = sizes.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    report = {"capacity_tokens": capacity, "windows": used + whole, "lower_bound": bound + whole, "tokens": tokens, "certified": used <= bound, "gap": used - bound}
    return out.select(F.col("id").cast(kind), "piece", start, "size", "window_id", "position", "window_start"), report
