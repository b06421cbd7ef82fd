"""Samples with target shares per category by the cube method (problem 5).

Each row of a category gets the inclusion probability wanted / available, so that the sums of probabilities over a
category's indicator are the wanted counts. A flight phase moves along null vectors of the category indicators (two
unresolved rows of one category trade probability until one is in or out), which keeps every category's sum exact. It runs
on each part of the rows, parted by a hash of the id; at most one row per category stays unresolved there. These few rows merge
upward, ``FAN_IN`` parts at a time, with a flight phase each, until one group is left; landing then rounds what remains at random. No
part sends more than one row per category upward. Parts, the order in a part and each row's random numbers follow from hashes of its id, so the sample
doesn't depend on the partitions of the session.

Categories, groups and ids with nulls are left out; repeated rows count once. Targets that name no rows are reported with
0 drawn; a category without a target is not sampled. Shares are of ``sample_rows`` of the group, not of what was drawn.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import cut

FAN_IN = 16
#: Rows per part, about; their number is a power of the fan-in.
PART = 50_000
_TINY = 1e-9


def fly(pi: np.ndarray, category: np.ndarray, draws: np.ndarray) -> np.ndarray:
    """Flight phase: probabilities after it, all 0 or 1 but for at most one row per category; sums per category are kept.
    ``draws`` has a random number in [0, 1) per row."""
    out = pi.astype(float).copy()
    waiting: dict[int, int] = {}
    for i, c in enumerate(category.tolist()):
        p = out[i]
        if p <= _TINY or p >= 1 - _TINY:
            out[i] = round(p)
            continue
        j = waiting.get(c)
        if j is None:
            waiting[c] = i
            continue
        q = out[j]
        up, down = min(1 - q, p), min(q, 1 - p)  # how far j can gain from i, and i from j
        if draws[i] * (up + down) < down:
            q, p = q + up, p - up
        else:
            q, p = q - down, p + down
        for k, v in ((j, q), (i, p)):
            out[k] = round(v) if v <= _TINY or v >= 1 - _TINY else v
        open_ = [k for k in (j, i) if 0 < out[k] < 1]
        waiting.pop(c)
        if open_:
            waiting[c] = open_[0]
    return out


def _flight(t: pa.Table, land: bool = False) -> pa.Table:
    """Rows of one part in order after a flight, without those that are out."""
    code = t.column("category").combine_chunks().dictionary_encode().indices.to_numpy() if t.num_rows else np.empty(0, np.int64)
    new = fly(t.column("pi").to_numpy(), code, t.column("u").to_numpy())
    if land:
        open_ = (new > 0) & (new < 1)
        new[open_] = t.column("v").to_numpy()[open_] < new[open_]
    at = t.schema.get_field_index("pi")
    return t.set_column(at, t.schema.field(at), pa.array(new)).filter(pa.array(new > 0))


def _landing(land: bool):
    return lambda t: _flight(t.sort_by([("u", "ascending"), ("id", "ascending")]), land)


def _random(seed: int, tag: str):
    """A number in [0, 1) from a hash of the id."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(f"{seed}|{tag}"), F.col("id").cast("string")), 11) / float(1 << 53)


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Flights over parts that follow each other, batch by batch; what a batch leaves open in a part joins the next one."""
    open_ = None
    for whole in batches:
        at = 0
        parts = whole.column("bucket").to_numpy()
        ends = [*(np.flatnonzero(parts[1:] != parts[:-1]) + 1).tolist(), whole.num_rows] if whole.num_rows else []
        for end in ends:
            t = pa.Table.from_batches([whole.slice(at, end - at)])
            at = end
            if open_ is not None and open_.num_rows:
                if open_.column("bucket")[0].as_py() == t.column("bucket")[0].as_py():
                    t = pa.concat_tables([open_, t])
                else:
                    yield from open_.to_batches()
            t = _flight(t)
            p = t.column("pi").to_numpy()
            open_ = t.filter(pa.array(p < 1))
            yield from t.filter(pa.array(p >= 1)).to_batches()
    if open_ is not None:
        yield from open_.to_batches()


def draw(rows: DataFrame, targets: DataFrame, seed: int = 7) -> tuple[DataFrame, DataFrame]:
    """``rows``: ``id`` and the columns ``stage, split, label``; ``targets``: ``stage, split, label, target_share,
    min_rows, sample_rows``. Returns the sample ``(id, stage, split, label)`` and the report per target: ``wanted``,
    ``available``, ``drawn``, ``missing`` (wanted but not there), ``share`` and ``share_gap`` against the target."""
    keys = ["stage", "split", "label"]
    rows = rows.select("id", *keys).where(" and ".join(f"{c} is not null" for c in ("id", *keys))).distinct()
    rows = cut(rows)
    wanted = F.greatest(F.col("min_rows"), F.round(F.col("target_share") * F.col("sample_rows")).cast("bigint"))
    have = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("available"))
    # One row per target: the table of targets is the bound of what is broadcast, whatever the rows.
    want = cut(targets.withColumn("wanted", wanted).join(have, keys, "left").fillna(0, ["available"]))
    pi = F.least(F.lit(1.0), F.col("wanted") / F.col("available"))
    small = want.count() <= 100_000
    probs = want.where("available > 0 and wanted > 0").select(*keys, pi.alias("pi"))
    state = rows.join(F.broadcast(probs) if small else probs, keys)
    parts = FAN_IN
    while parts * PART < rows.count():
        parts *= FAN_IN
    bucket = F.pmod(F.xxhash64(F.lit(f"{seed}|part"), F.col("id").cast("string")), F.lit(parts))
    state = state.select("id", *keys, "pi", F.concat_ws("\u0001", *keys).alias("category"), bucket.alias("bucket"), _random(seed, "0").alias("u"), _random(seed, "land").alias("v"))
    schema = state.schema
    state = cut(state.repartition("bucket").sortWithinPartitions("bucket", "u", "id").mapInArrow(_in_order, schema))
    done = state.where("pi >= 1")
    left = state.where("pi < 1")
    level = 1
    while parts > 1:
        parts //= FAN_IN
        up = left.withColumn("bucket", F.floor(F.col("bucket") / FAN_IN)).withColumn("u", _random(seed, str(level)))
        up = cut(up.groupBy("stage", "split", "bucket").applyInArrow(_landing(parts == 1), schema))
        done, left = done.unionByName(up.where("pi >= 1")), up.where("pi < 1")
        level += 1
    sample = cut(done.select("id", *keys))
    got = sample.groupBy(*keys).agg(F.count(F.lit(1)).alias("drawn"))
    report = want.join(got, keys, "left").fillna(0, ["drawn"])
    share = F.when(F.col("sample_rows") > 0, F.col("drawn") / F.col("sample_rows"))
    report = report.select(*keys, "target_share", "min_rows", "sample_rows", "wanted", "available", "drawn", (F.col("wanted") - F.col("drawn")).alias("missing"), share.alias("share"), (share - F.col("target_share")).alias("share_gap"))
    return sample, report
