"""Near-duplicate records by MinHash banding, verified on full run sets (problem 1).

1. Each text becomes the set of hashes of its word runs; equal sets form one class, represented by one record.
2. ``BANDS`` x ``ROWS`` minimum hashes are computed per row; at likeness 0.6 the chance that a pair shares no band is
   (1 - 0.6**4) ** 40 = 0.4 %, at 0.65 0.04 %, at 0.8 below 1e-9.
3. Classes are joined on band hashes if their set sizes allow the likeness. Buckets of more than ``HOT`` classes
   are not joined pair by pair: their classes go through the lossless cosine join, whose prefixes keep frequent runs out.
4. Candidate pairs are verified on the full sets, which are computed again for the candidates only.

Records with a null id are dropped; a text with fewer words than a run is like none. Repeated records count once; an id
with several texts is a member of several classes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import words as w
from millrace.llm.cosine_join import cosine_join
from millrace.llm.overlap import cosine_for, run_sets
from millrace.session import cut, keep_keys

BANDS, ROWS = 40, 4
#: Classes in a band bucket up to which its pairs are formed directly.
HOT = 500


def _sketches(df: DataFrame, run: int, bands: int, rows: int) -> DataFrame:
    """``(id, cid, n, bands)`` of each record whose text has a run."""
    rng = np.random.default_rng(20240229)
    mul = rng.integers(1, 1 << 63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    add = rng.integers(0, 1 << 63, bands * rows, dtype=np.uint64)
    kind = df.schema["id"].dataType.simpleString()

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = w.WordHash()
        salt = np.arange(bands, dtype=np.uint64)
        for b in batches:
            at, key, size, out = [], [], [], []
            for i, text in enumerate(b.column(1).to_pylist()):
                s = w.text_runs(text, run, cache)
                if not len(s):
                    continue
                low = np.full(bands * rows, ~np.uint64(0))
                for k in range(0, len(s), 1024):  # bounds the matrix for long texts
                    part = s[k : k + 1024]
                    np.minimum(low, (part[None, :] * mul[:, None] + add[:, None]).min(axis=1), out=low)
                h = salt.copy()
                for x in low.reshape(bands, rows).T:
                    h = w.mix(h * np.uint64(0x9E3779B97F4A7C15) + x)
                at.append(i)
                key.append(w.set_key(s))
                size.append(len(s))
                out.append(h)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int32())), pa.array(key, pa.binary()), pa.array(size, pa.int32()), w.long_lists(out)], ["id", "cid", "n", "bands"])

    return df.select("id", "text").mapInArrow(sketch, f"id {kind}, cid binary, n int, bands array<bigint>")


def class_pairs(records: DataFrame, likeness: float, run: int = 3, bands: int = BANDS, rows: int = ROWS, hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """``(cid_a, cid_b, likeness)`` of classes with different run sets, and the members ``(cid, id)``."""
    records = records.select("id", "text").where("id is not null and text is not null")
    sk = cut(_sketches(records, run, bands, rows))
    members = sk.select("cid", "id").distinct()
    classes = sk.groupBy("cid").agg(F.first("n").alias("n"), F.first("bands").alias("bands"), F.min("id").alias("id"))
    flat = classes.select("cid", "n", F.explode("bands").alias("band"))
    buckets = flat.groupBy("band").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
    placed = cut(flat.join(buckets, "band"))
    cool = placed.where(F.col("k") <= hot)
    x = cool.select("band", F.col("cid").alias("cid_a"), F.col("n").alias("na"))
    y = cool.select("band", F.col("cid").alias("cid_b"), F.col("n").alias("nb"))
    fits = (F.least("na", "nb") >= F.ceil(F.lit(likeness) * F.greatest("na", "nb") - 1e-9))
    pairs = cut(x.join(y, "band").where((F.col("cid_a") < F.col("cid_b")) & fits).select("cid_a", "cid_b").distinct())
    crowded = cut(placed.where(F.col("k") > hot).select("cid").distinct())
    wanted = cut(pairs.select(F.col("cid_a").alias("cid")).union(pairs.select("cid_b")).union(crowded).distinct().join(classes.select("cid", "id"), "cid"))
    again = run_sets(keep_keys(records, wanted.select("id").distinct(), "id"), "text", run)
    sets = cut(keep_keys(again, wanted.select("cid"), "cid").select("cid", "terms").dropDuplicates(["cid"]))
    left = sets.select(F.col("cid").alias("cid_a"), F.col("terms").alias("ta"))
    right = sets.select(F.col("cid").alias("cid_b"), F.col("terms").alias("tb"))
    shared = F.size(F.array_intersect("ta", "tb"))
    found = pairs.join(left, "cid_a").join(right, "cid_b").select("cid_a", "cid_b", (shared / (F.size("ta") + F.size("tb") - shared)).alias("likeness")).where(F.col("likeness") >= likeness)
    if crowded.count():
        vectors = keep_keys(sets, crowded, "cid").select(F.col("cid").alias("id"), "terms")
        j = F.col("shared") / (F.col("size_a") + F.col("size_b") - F.col("shared"))
        more = cosine_join(vectors, None, cosine_for(likeness)).select(F.col("id_a").alias("cid_a"), F.col("id_b").alias("cid_b"), j.alias("likeness")).where(F.col("likeness") >= likeness)
        found = found.unionByName(more).dropDuplicates(["cid_a", "cid_b"])
    return cut(found), members


def near_pairs(records: DataFrame, likeness: float, run: int = 3, hot: int = HOT) -> DataFrame:
    """``(id_a, id_b, likeness)``: every pair of different ids, smaller first; copies are expanded."""
    pairs, members = class_pairs(records, likeness, run, hot=hot)
    a = members.select(F.col("cid").alias("cid_a"), F.col("id").alias("x"))
    b = members.select(F.col("cid").alias("cid_b"), F.col("id").alias("y"))
    near = pairs.join(a, "cid_a").join(b, "cid_b").select("x", "y", "likeness")
    same = a.join(b.withColumnRenamed("cid_b", "cid_a"), "cid_a").where("x < y").select("x", "y", F.lit(1.0).alias("likeness"))
    both = near.unionByName(same).where("x != y")
    return both.groupBy(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b")).agg(F.max("likeness").alias("likeness"))


def near_groups(records: DataFrame, likeness: float, run: int = 3) -> DataFrame:
    """One row per id and class: ``(id, class_id, group_id, copies, links)``. ``copies`` is the size of the class,
    ``links`` the number of other members whose set is near, copies included; ``group_id`` is the least class id that
    links of near classes lead to. Neither pairs of copies nor groups are gathered in one place."""
    pairs, members = class_pairs(records, likeness, run)
    members = cut(members)
    size = members.groupBy("cid").agg(F.count(F.lit(1)).alias("copies"))
    both = cut(pairs.select(F.col("cid_a").alias("u"), F.col("cid_b").alias("v")).unionAll(pairs.select("cid_b", "cid_a")))
    links = both.join(size.select(F.col("cid").alias("v"), F.col("copies").alias("c")), "v").groupBy("u").agg(F.sum("c").alias("more")).withColumnRenamed("u", "cid")
    group = components(both)
    out = members.join(size, "cid").join(links, "cid", "left").join(group, "cid", "left")
    return out.select("id", F.hex("cid").alias("class_id"), F.hex(F.coalesce("root", "cid")).alias("group_id"), "copies", (F.col("copies") - 1 + F.coalesce("more", F.lit(0))).alias("links"))


def components(edges: DataFrame) -> DataFrame:
    """``(cid, root)`` of each vertex of the symmetric edges ``(u, v)``: the least vertex of its component.

    Alternates star contractions (each vertex's greater neighbours are linked to its least one, then its lesser
    ones), which takes a number of rounds logarithmic in the component's size, each a few shuffles of the edges; a hub
    is handled by partial minima, never gathered.
    """
    e = cut(edges.where("u != v").distinct())
    before = None
    while True:
        low = e.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # Large star: greater neighbours go to the least of the closed neighbourhood.
        big = e.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        # Small star: lesser neighbours and the vertex itself go to the least neighbour.
        least = big.groupBy("u").agg(F.min("v").alias("m"))
        small = big.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").unionAll(least.select("u", F.col("m").alias("v"))).distinct()
        down = cut(small)
        now = tuple(down.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            return down.select(F.col("u").alias("cid"), F.col("v").alias("root")).unionAll(down.select(F.col("v").alias("cid"), F.col("v").alias("root"))).distinct()
        before, e = now, down.unionAll(down.select(F.col("v").alias("u"), F.col("u").alias("v")))
