"""Balanced views, anchor and variant pairs, and samples by hash rank."""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.hashing import hash_parts, rank_key
from millrace.operators.positions import dense_positions
from millrace.session import is_small, salted_join

# Labels of the two balanced views, and what a variant is to its anchor.
VIEWS = {"cpt": ("positive", "t1"), "contrastive": ("t2", "t3a", "t3b", "t3c")}
PAIR_KIND = {"t1": "positive", "t2": "swapped", "t3a": "corrupted", "t3b": "corrupted", "t3c": "corrupted"}
_GROUP = ["stage", "split"]


def _labelled(rows: DataFrame, view: str) -> DataFrame:
    """Rows of a view with ``balanced_label``, which is kept where a table has it already."""
    own = F.lower(F.trim("label"))
    label = F.coalesce("balanced_label", own) if "balanced_label" in rows.columns else own
    return rows.withColumn("balanced_label", label).where(own.isin(*VIEWS[view]))


def targets(rows: DataFrame, view: str, cap: int = 0) -> DataFrame:
    """``(stage, split, target)``: the least count among a view's present labels, or ``cap`` if that is positive."""
    n = _labelled(rows, view).groupBy(*_GROUP, "balanced_label").agg(F.count(F.lit(1)).alias("n"))
    return n.groupBy(*_GROUP).agg((F.lit(cap).cast("bigint") if cap > 0 else F.min("n")).alias("target"))


def balanced(rows: DataFrame, view: str, seed: int = 42, cap: int = 0, key: str = "sample_id", order: str = "hash") -> DataFrame:
    """At most ``target`` rows of each label per stage and split; never more rows than there are.

    With ``order`` "hash", the first by a hash of seed, label and key. Only these are ranked, without texts, and without gathering a label
    in one task; the rank gives one limit per label, and rows up to it are kept where they are. Keys should be unique in a label: rows
    with equal keys are kept or left out together, and null keys count as empty.

    With ``order`` "mt", those that Python's generator draws (seed ``{seed}|{label}|{file}``) from the rows of a label in their order by
    key, for parity; the generator shuffles all places of a label, so it runs on the driver and is refused beyond ``DRAWN`` of them."""
    own = _labelled(rows, view)
    t = targets(rows, view, cap)  # one row per stage and split
    keys = [*_GROUP, "balanced_label"]
    h = F.sha1(F.concat_ws("|", F.lit(str(seed)), "balanced_label", key))
    k = F.coalesce(F.col(key), F.lit(""))
    if order == "mt":
        ranked = dense_positions(own, keys, [k])
        return ranked.join(F.broadcast(_drawn(own, t, seed)), [*keys, "pos"], "left_semi").select(own.columns)
    ranked = dense_positions(own.select(*keys, h.alias("_h"), k.alias("_k")), keys, [F.col("_h"), F.col("_k")])
    last = ranked.join(F.broadcast(t), _GROUP).where(F.col("pos") < F.col("target")).groupBy(*keys).agg(F.max(F.struct("_h", "_k")).alias("_last"))
    return own.join(F.broadcast(last), keys).where(F.struct(h.alias("_h"), k.alias("_k")) <= F.col("_last")).select(own.columns)


#: Rows of the labels to draw from up to which the parity order is made on the driver.
DRAWN = 5_000_000


def _drawn(own: DataFrame, t: DataFrame, seed: int) -> DataFrame:
    """``(stage, split, balanced_label, pos)`` that Python's generator draws; labels with no more rows than the target keep all."""
    n = own.groupBy(*_GROUP, "balanced_label").agg(F.count(F.lit(1)).alias("n")).join(t, _GROUP).collect()  # a row per label
    if sum(r["n"] for r in n) > DRAWN:
        raise ValueError(f"more than {DRAWN} rows to shuffle with the parity generator; use the hash order")
    out = []
    for r in n:
        places = list(range(r["n"]))
        if r["n"] > r["target"]:
            file = f"{r['split']}.parquet" if r["balanced_label"] == "positive" else f"{r['split']}_{r['balanced_label']}.parquet"
            random.Random(f"{seed}|{r['balanced_label']}|{file}").shuffle(places)
        out += [(r["stage"], r["split"], r["balanced_label"], i) for i in places[: r["target"]]]
    return own.sparkSession.createDataFrame(out, "stage string, split string, balanced_label string, pos bigint")


def top_by_hash(rows: DataFrame, n: int, tag: str, key: str) -> DataFrame:
    """The first ``n`` rows by a hash of tag and key."""
    return rows.orderBy(rank_key(tag, F.col(key)), F.col(key)).limit(n)


def pairs(rows: DataFrame, *, anchor_rows: DataFrame | None = None) -> DataFrame:
    """Each variant with its anchor's canonical text, by stage, split and anchor. Of several anchors with one key the last by
    sample id is taken; variants without an anchor are left out (see :func:`unpaired`).
    Anchors with very many variants are spread over tasks."""
    a = anchors(rows if anchor_rows is None else anchor_rows)
    v = _variants(rows)
    out = salted_join(v, a, [*_GROUP, "anchor_skill_id"], "sample_id")
    kind = F.element_at(F.create_map(*(F.lit(x) for kv in PAIR_KIND.items() for x in kv)), F.col("_label"))
    return out.select(
        hash_parts(F.col("anchor_skill_id"), F.col("stage"), F.col("split"), F.col("_label"), F.coalesce("sample_id", F.lit(""))).alias("sample_id"),
        "anchor_skill_id", "anchor_text", F.col("text").alias("pair_text"), kind.alias("pair_kind"), F.upper("_label").alias("pair_subkind"), F.col("stage").alias("anchor_stage"), F.col("stage").alias("pair_stage"),
        (kind == "positive").cast("bigint").alias("label"), "source_skill_ids", "sub_strategy", "target_layer", "pool", "split",
    )


def anchors(rows: DataFrame) -> DataFrame:
    p = rows.where(F.lower(F.trim("label")) == "positive").where("anchor_skill_id is not null and text is not null")
    return p.groupBy(*_GROUP, "anchor_skill_id").agg(F.max(F.struct("sample_id", "text")).alias("x")).select(*_GROUP, "anchor_skill_id", F.col("x.text").alias("anchor_text"))


def _variants(rows: DataFrame) -> DataFrame:
    return rows.withColumn("_label", F.lower(F.trim("label"))).where(F.col("_label").isin(*PAIR_KIND))


def unpaired(rows: DataFrame) -> DataFrame:
    """Number of variants without an anchor, by stage, split and label."""
    a = anchors(rows).drop("anchor_text")
    return _variants(rows).join(a, [*_GROUP, "anchor_skill_id"], "left_anti").groupBy(*_GROUP, F.col("_label").alias("label")).agg(F.count(F.lit(1)).alias("rows"))


def pair_counts(p: DataFrame) -> DataFrame:
    return p.groupBy("anchor_stage", "split", "pair_kind", "pair_subkind").agg(F.count(F.lit(1)).alias("rows"))


# --- removing a hold-out ---------------------------------------------------------------------------------------------


def _without(rows: DataFrame, bad: DataFrame, column: Column) -> DataFrame:
    """Rows whose column is null or not among the ids; anti joins keep nulls, which NOT IN would not."""
    small = is_small(bad)
    b = bad.select(F.col(bad.columns[0]).alias("_bad")).distinct()
    return rows.join(F.broadcast(b) if small else b, column == F.col("_bad"), "left_anti")


def scrub(rows: DataFrame, bad: DataFrame, columns: list[str]) -> DataFrame:
    """Rows none of whose columns holds an id of ``bad`` (one column). Missing columns are passed over, nulls are kept."""
    for c in columns:
        if c in rows.columns:
            rows = _without(rows, bad, F.col(c))
    return rows


def donor_ids(c: str, kind: str) -> Column:
    """Donors as an array, whether stored as one or as a list's printed form."""
    return F.col(c) if kind.startswith("array") else F.regexp_extract_all(c, F.lit("'([^']*)'"), F.lit(1))


def scrub_donors(rows: DataFrame, bad: DataFrame, anchor: str = "anchor_skill_id", donors: str = "source_skill_ids", key: str = "sample_id") -> DataFrame:
    """Rows with neither their anchor nor any donor among the ids. Tainted rows are found by exploded ids, so neither side
    is gathered; a row without a key is judged by the ids themselves if these are few enough to broadcast as an array."""
    ids = donor_ids(donors, rows.schema[donors].dataType.simpleString())
    own = rows.withColumn("_ids", F.array_distinct(F.concat(F.coalesce(ids, F.array().cast("array<string>")), F.array(anchor))))
    small = is_small(bad)
    b = bad.select(F.col(bad.columns[0]).alias("_bad")).distinct()
    tainted = own.select(key, "_ids").distinct().select(key, "_ids", F.explode("_ids").alias("_bad")).join(F.broadcast(b) if small else b, "_bad", "left_semi").select(F.col(key).alias("_k"), F.col("_ids").alias("_i")).distinct()
    return own.join(tainted, F.col(key).eqNullSafe(F.col("_k")) & (F.col("_ids") == F.col("_i")), "left_anti").drop("_ids")


def scrub_json_lines(lines: DataFrame, bad: DataFrame, paths: tuple[str, ...] = ("$.metadata.skill_id", "$.metadata.candidate_skill_id")) -> DataFrame:
    """Raw lines (``value``) whose ids aren't in ``bad``; malformed lines are dropped and not counted."""
    ok = lines.where(F.try_parse_json("value").isNotNull())
    for p in paths:
        ok = _without(ok, bad, F.get_json_object("value", p))
    return ok


def scrub_counts(before: DataFrame, after: DataFrame) -> DataFrame:
    k = after.agg(F.count(F.lit(1)).alias("kept"))
    return before.agg(F.count(F.lit(1)).alias("n")).crossJoin(k).select("kept", (F.col("n") - F.col("kept")).alias("dropped"))
