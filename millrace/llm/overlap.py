"""Same or near-same rows across splits (problem 4).

Texts become sets of three-word runs; equal sets form one class, so copies cost one vector. Classes of the training split
are joined with classes of the other splits by :func:`millrace.llm.cosine_join.cosine_join` over unit-weight vectors.
A Jaccard likeness of at least j implies a cosine of at least 2j/(1+j), so nothing is lost; the exact likeness is
then taken from the exact dot products.

Rows whose split is null or no known split, whose id is null, or whose text has fewer than three words overlap nothing.
Repeated rows count once; a sample id with several texts overlaps where any of them does.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm import words as w
from millrace.llm.cosine_join import Rarity, cosine_join, inside, stat_bits, term_stats, vocabulary_table
from millrace.session import cut

RUN = 3
TRAIN, HELD_OUT = "train", ("val", "test", "unseen")
#: Rows whose sets are held at a time.
ROWS = 1000


def run_sets(df: DataFrame, text: str, run: int = RUN) -> DataFrame:
    """``df`` without its text, plus ``cid`` (key of the set, binary) and ``terms`` (sorted run hashes); texts of fewer than ``run`` words are left out."""
    rest = [c for c in df.columns if c != text]
    schema = df.select(rest).schema.add("cid", T.BinaryType()).add("terms", T.ArrayType(T.LongType()))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = w.WordHash()
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                b = whole.slice(at, ROWS)
                found = [w.text_runs(t, run, cache) for t in b.column(len(rest)).to_pylist()]
                keep = [i for i, x in enumerate(found) if len(x)]
                found = [found[i] for i in keep]
                own = b.take(pa.array(keep, pa.int32()))
                yield pa.RecordBatch.from_arrays([*own.columns[: len(rest)], pa.array([w.set_key(x) for x in found], pa.binary()), w.long_lists(found)], [*rest, "cid", "terms"])

    return df.select(*rest, text).mapInArrow(sets, schema)


def clean(c: str):
    return F.lower(F.trim(F.col(c)))


def cosine_for(likeness: float) -> float:
    return 2 * likeness / (1 + likeness)


def _usable(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("id").isNotNull() & F.col("text").isNotNull() & F.col("split").isin(TRAIN, *HELD_OUT))


def _joined(rows: DataFrame, bound: float, rarity: Rarity | None = None) -> tuple[DataFrame, DataFrame]:
    """Pairs of classes ``(id_a, id_b, dot, ...)`` of training and held-out rows, and the members ``(cid, id, split)`` of the classes left after pruning."""
    sets = lambda d: run_sets(d.select("id", "split", "text"), "text")
    vectors = lambda d: d.select(F.col("cid").alias("id"), "size", "norm", "terms").where(F.size("terms") > 0)
    # The held-out vocabulary prunes the training rows, what is left of these prunes the held-out rows: both before any shuffle. In a large
    # table little is pruned, so sets are written once, in this pass, and never shuffled as a whole.
    held = sets(rows.where(F.col("split") != TRAIN))
    train = cut(inside(sets(rows.where(F.col("split") == TRAIN)), vocabulary_table(held), bound, rarity, "cid"))
    table = vocabulary_table(train)
    held = cut(inside(held, table, bound, rarity, "cid"))
    members = cut(train.select("cid", "id", "split").unionByName(held.select("cid", "id", "split")).distinct())
    return cosine_join(vectors(train), vectors(held), bound, ready=True, rarity=rarity, bits=stat_bits(table)), members


def split_classes(rows: DataFrame, likeness: float) -> tuple[DataFrame, DataFrame]:
    """``rows``: id, split, text with clean splits. Returns class pairs ``(train_cid, held_cid, likeness)``, equal
    classes included, and the members ``(cid, id, split)`` of all classes in a pair."""
    met, members = _joined(_usable(rows), cosine_for(likeness))
    j = F.col("shared") / (F.col("size_a") + F.col("size_b") - F.col("shared"))
    pairs = met.select(F.col("id_a").alias("train_cid"), F.col("id_b").alias("held_cid"), j.alias("likeness")).where(F.col("likeness") >= likeness)
    return cut(pairs), members


def weighted_overlaps(rows: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Near-same texts where rare runs count more: ``(train_class, held_class, cosine, train_copies, held_copies)`` of each pair of classes of
    different splits whose weighted vectors have a cosine of at least ``threshold``. Runs that most texts share weigh little, so
    common passages alone make no overlap. Frequencies count all rows that have a text and a split, in a table of slots: runs that share a
    slot count together, so a cosine may be off in its third digit."""
    rows = _usable(rows)
    counts, _ = term_stats(run_sets(rows.select("text"), "text").select("terms"))
    pairs, members = _joined(rows, threshold, Rarity(rows, counts, rows.count()))
    size = members.groupBy("cid", (F.col("split") == TRAIN).alias("train")).agg(F.count(F.lit(1)).alias("n"))
    one = lambda train, c: size.where(F.col("train") == train).select(F.col("cid").alias(f"id_{c}"), F.col("n").alias(f"{c}_copies"))
    met = pairs.join(one(True, "a"), "id_a").join(one(False, "b"), "id_b")
    return met.select(F.hex("id_a").alias("train_class"), F.hex("id_b").alias("held_class"), F.col("dot").alias("cosine"), F.col("a_copies").alias("train_copies"), F.col("b_copies").alias("held_copies"))


def split_overlaps(rows: DataFrame, likeness: float = 0.7) -> DataFrame:
    """``(id_a, id_b, likeness)``: each pair of ids, smaller first, one of the training split and one of another."""
    pairs, members = split_classes(rows, likeness)
    t = members.where(F.col("split") == TRAIN).select(F.col("cid").alias("train_cid"), F.col("id").alias("x"))
    h = members.where(F.col("split") != TRAIN).select(F.col("cid").alias("held_cid"), F.col("id").alias("y"))
    out = pairs.join(t, "train_cid").join(h, "held_cid").where("x != y")
    return out.select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"), "likeness").groupBy("id_a", "id_b").agg(F.max("likeness").alias("likeness"))


def overlap_rows(rows: DataFrame, likeness: float = 0.7) -> DataFrame:
    """One row per overlapping id: ``(id, split, class_id, links, same, best)``. ``links`` counts the ids on the other
    side, ``same`` those with an equal run set, ``best`` is the greatest likeness. Counts are summed over classes, so
    groups of copies are not expanded."""
    pairs, members = split_classes(rows, likeness)
    size = members.groupBy("cid").agg(F.count_if(F.col("split") == TRAIN).alias("n_train"), F.count_if(F.col("split") != TRAIN).alias("n_held"))
    to_train = pairs.join(size.select(F.col("cid").alias("train_cid"), F.col("n_train").alias("n")), "train_cid").select(F.col("held_cid").alias("cid"), F.lit(False).alias("train"), "n", "likeness")
    to_held = pairs.join(size.select(F.col("cid").alias("held_cid"), F.col("n_held").alias("n")), "held_cid").select(F.col("train_cid").alias("cid"), F.lit(True).alias("train"), "n", "likeness")
    links = to_train.unionAll(to_held).groupBy("cid", "train").agg(F.sum("n").alias("links"), F.sum(F.when(F.col("likeness") == 1, F.col("n")).otherwise(0)).alias("same"), F.max("likeness").alias("best"))
    return members.withColumn("train", F.col("split") == TRAIN).join(links, ["cid", "train"]).select("id", "split", F.hex("cid").alias("class_id"), "links", "same", "best")


def overlap_counts(rows: DataFrame, details: DataFrame, likeness: float = 0.7) -> DataFrame:
    """Overlaps per split and source. ``details``: ``id, anchor, sources`` of each row; each row counts under its anchor
    (``source_kind`` anchor) and under each distinct other source (``donor``). Columns: split, source_kind, source,
    rows, rows_same, links."""
    found = overlap_rows(rows, likeness).groupBy("id", "split").agg(F.sum("links").alias("links"), F.sum("same").alias("same"))
    own = details.where("id is not null").groupBy("id").agg(F.min("anchor").alias("anchor"), F.min(F.array_sort(F.array_distinct("sources"))).alias("sources"))
    both = found.join(own, "id")
    kinds = F.concat(
        F.array(F.struct(F.lit("anchor").alias("source_kind"), F.col("anchor").alias("source"))),
        F.transform(F.filter(F.coalesce("sources", F.array().cast("array<string>")), lambda s: s.isNotNull() & ~s.eqNullSafe(F.col("anchor"))), lambda s: F.struct(F.lit("donor").alias("source_kind"), s.alias("source"))),
    )
    flat = both.select("split", "links", "same", F.explode(kinds).alias("k")).select("split", "links", "same", "k.*")
    return flat.groupBy("split", "source_kind", "source").agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("same") > 0).alias("rows_same"), F.sum("links").alias("links"))

