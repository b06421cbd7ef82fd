"""Variants of composed samples: permuted layers, layers from donors, spans from donors.

``samples`` are phase-1 rows with ``skill_id, stage, pool, split, text, metadata_text, instruction_text, resource_text``;
a skill has at most one row per stage. Donors come from the same stage and pool. Variants over the token budget are left
out; positives are not held to it. Choices depend on hashes of ids alone, so a result doesn't depend on partitions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.hashing import digest_halves, digest_mod
from millrace.functions.text import LAYERS, inner, join_parts, tokens, wrap
from millrace.operators.positions import dense_positions

# Orders of permuted layers, and which donor (B or C) gives which layer.
T1 = {"stage1": ("IM",), "stage2": ("MRI", "IMR", "IRM", "RMI", "RIM")}
T2 = {
    "stage1": {"swap_M": {"M": "B"}, "swap_I": {"I": "B"}},
    "stage2": {
        "swap_M": {"M": "B"}, "swap_I": {"I": "B"}, "swap_R": {"R": "B"},
        "swap_MI_B": {"M": "B", "I": "B"}, "swap_MR_B": {"M": "B", "R": "B"}, "swap_IR_B": {"I": "B", "R": "B"},
        "swap_MI_BC": {"M": "B", "I": "C"}, "swap_MR_BC": {"M": "B", "R": "C"}, "swap_IR_BC": {"I": "B", "R": "C"},
    },
}
T3B = {"stage1": ("I",), "stage2": ("I", "R")}
MAX_TOKENS = {"stage1": 4096, "stage2": 10240}
FIELD = {"M": "metadata_text", "I": "instruction_text", "R": "resource_text"}


@dataclass(frozen=True)
class Config:
    seed: int = 20260601
    k_donors: int = 2
    k_span_donors: int = 2
    span_fraction: float = 0.15
    span_cap: int = 1500
    span_min: int = 200
    max_tokens: dict | None = None

    def limit(self, stage: str) -> int:
        return (self.max_tokens or MAX_TOKENS)[stage]


def row(label: str, sub: Column, target: Column, sources: Column, text: Column, anchor: str = "skill_id") -> list[Column]:
    """Columns of a variant row; the id doesn't hold the stage, so it is unique per stage only."""
    return [
        F.sha1(F.concat_ws("|", F.lit(label), sub, F.col(anchor), F.substring(text, 1, 128))).alias("sample_id"),
        F.col(anchor).alias("anchor_skill_id"),
        F.lit(label).alias("label"),
        sub.alias("sub_strategy"),
        target.alias("target_layer"),
        sources.alias("source_skill_ids"),
        text.alias("text"),
        F.length(text).cast("bigint").alias("text_chars"),
        tokens(text).alias("text_tokens_est"),
        F.col("pool"),
        F.col("split"),
        F.col("stage"),
    ]


def _fits(c: Config) -> Column:
    limit = F.when(F.col("stage") == "stage1", c.limit("stage1")).otherwise(c.limit("stage2"))
    return (F.col("text") != "") & (F.col("text_tokens_est") <= limit)


def positive(samples: DataFrame) -> DataFrame:
    return samples.select(*row("positive", F.lit("canonical"), F.lit(""), F.array("skill_id"), F.col("text")))


def permuted(samples: DataFrame, c: Config = Config()) -> DataFrame:
    """T1: each order of the stage's layers but the usual one. Where a layer is missing the text may equal the positive."""
    def orders(stage: str) -> Column:
        return F.array(*(F.struct(F.lit("order=" + ">".join(o)).alias("sub"), join_parts(*(F.col(FIELD[x]) for x in o)).alias("text")) for o in T1[stage]))

    rows = samples.withColumn("x", F.explode(F.when(F.col("stage") == "stage1", orders("stage1")).otherwise(orders("stage2"))))
    rows = rows.select("skill_id", "pool", "split", "stage", F.col("x.sub").alias("sub"), F.col("x.text").alias("text"))
    return rows.select(*row("T1", F.col("sub"), F.lit(""), F.array("skill_id"), F.col("text"))).where(_fits(c))


def donor_pools(samples: DataFrame) -> DataFrame:
    """Each sample's position in its pool: ``stage, pool, pos, skill_id``. Splits follow each other in the usual order, ids
    inside them."""
    rank = F.element_at(F.create_map(*(F.lit(x) for kv in (("train", 0), ("val", 1), ("test", 2), ("unseen", 3)) for x in kv)), F.col("split"))
    return dense_positions(samples.select("stage", "pool", "skill_id", rank.alias("_rank")), ["stage", "pool"], [F.col("_rank"), F.col("skill_id")]).drop("_rank")


def donors(requests: DataFrame, pools: DataFrame, seed: int) -> DataFrame:
    """``requests``: skill_id, stage, pool, pattern, k, n (1 or 2). Adds ``donors``, the first ``n`` distinct other ids of a
    walk over the pool that starts and steps by a digest; requests whose walk has too few are left out.

    Of the walk only the first three places can matter for two donors, so the walk is an equi-join on positions."""
    sizes = pools.groupBy("stage", "pool").agg(F.count(F.lit(1)).alias("size"))  # as many rows as pools
    parts = [F.lit(str(seed)), F.col("skill_id"), F.col("pattern"), F.col("k").cast("string")]
    hi, _ = digest_halves(*parts)
    r = requests.join(F.broadcast(sizes), ["stage", "pool"])
    step = hi.bitwiseOR(F.lit(1).cast("bigint"))
    r = r.withColumns({"start": digest_mod(F.col("size"), *parts), "step": F.when(step % F.col("size") == 0, 1).otherwise(step)})
    r = r.withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(2)))).withColumn("pos", (F.col("start") + F.col("j") * (F.col("step") % F.col("size"))) % F.col("size"))
    p = pools.select("stage", "pool", "pos", F.col("skill_id").alias("donor"))
    met = r.join(p, ["stage", "pool", "pos"]).where("donor != skill_id")
    key = ["skill_id", "stage", "pool", "pattern", "k", "n"]
    one = met.groupBy(*key, "donor").agg(F.min("j").alias("j"))
    walk = one.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("j", "donor"))).alias("v"))  # at most three
    return walk.where(F.size("v") >= F.col("n")).select(*key, F.slice(F.transform("v", lambda x: x["donor"]), 1, F.col("n")).alias("donors"))


def _requests(samples: DataFrame, patterns: dict[str, list[tuple[str, int, int]]]) -> DataFrame:
    """A row per sample and (pattern, n, k count) of its stage."""
    def of(stage: str) -> Column:
        return F.array(*(F.struct(F.lit(p).alias("pattern"), F.lit(n).alias("n"), F.lit(k).alias("k")) for p, n, times in patterns[stage] for k in range(times)))

    return samples.select("skill_id", "stage", "pool", F.explode(F.when(F.col("stage") == "stage1", of("stage1")).otherwise(of("stage2"))).alias("x")).select("skill_id", "stage", "pool", "x.*")


def donor_requests(samples: DataFrame, c: Config = Config()) -> DataFrame:
    """Requests of the layer swaps."""
    return _requests(samples, {s: [(p, 2 if "C" in m.values() else 1, c.k_donors) for p, m in t.items()] for s, t in T2.items()})


def _layers(samples: DataFrame, inside: bool = False) -> DataFrame:
    """``(_id, _st, layer, layer_text)``: each layer of each sample, once; ``inside`` takes off its tags."""
    one = lambda x: F.struct(F.lit(x).alias("layer"), (inner(F.col(FIELD[x]), x) if inside else F.col(FIELD[x])).alias("layer_text"))
    return samples.select(F.col("skill_id").alias("_id"), F.col("stage").alias("_st"), F.explode(F.array(*map(one, "IR" if inside else "MIR"))).alias("x")).select("_id", "_st", "x.*")


def _kept(rows: DataFrame, label: str, stage: str, sub: Column, target: Column, sources: Column, text: Column, c: Config) -> DataFrame:
    """Variant rows within the budget. The text is made once, behind a generator: a filter above it would be pushed below and
    make it again."""
    limit = F.when(F.col(stage) == "stage1", c.limit("stage1")).otherwise(c.limit("stage2"))
    fits = F.filter(F.array(text), lambda t: (t != "") & (tokens(t) <= limit))
    rows = rows.select("skill_id", "stage", "pool", "split", sub.alias("sub"), target.alias("target"), sources.alias("sources"), F.explode(fits).alias("text"))
    return rows.select(*row(label, F.col("sub"), F.col("target"), F.col("sources"), F.col("text")))


def swapped(samples: DataFrame, c: Config = Config(), pools: DataFrame | None = None) -> DataFrame:
    """T2: layers from one or two donors, ``k_donors`` times per pattern.

    Requests hold ids alone. Each layer that a request needs is fetched by its donor's id and sent to the request's sample once;
    the sample's own layers stay where they are."""
    picked = donors(donor_requests(samples, c), pools if pools is not None else donor_pools(samples), c.seed)
    needs = F.create_map(*(v for p, m in {**T2["stage1"], **T2["stage2"]}.items() for v in (F.lit(p), F.array(*(F.struct(F.lit(x).alias("layer"), F.lit("BC".index(d)).alias("slot")) for x, d in m.items())))))
    asked = picked.select("skill_id", "stage", "pool", "pattern", "k", "donors", F.explode(F.element_at(needs, F.col("pattern"))).alias("x"))
    asked = asked.select("skill_id", "stage", "pool", "pattern", "k", "donors", "x.layer", F.get("donors", F.col("x.slot")).alias("_id"), F.col("stage").alias("_st"))
    pieces = asked.join(_layers(samples), ["_id", "_st", "layer"]).repartition("skill_id", "stage")
    key = ["skill_id", "stage", "pool", "pattern", "k"]
    # At most three pieces a request; grouping and the join below need no other shuffle than the one above.
    made = pieces.groupBy(*key).agg(F.map_from_entries(F.collect_list(F.struct("layer", "layer_text"))).alias("new"), F.first("donors").alias("donors"))
    rows = made.join(samples.select("skill_id", "stage", "split", *FIELD.values()), ["skill_id", "stage"])
    part = lambda x: F.coalesce(F.element_at("new", F.lit(x)), F.col(FIELD[x]))
    text = F.when(F.col("stage") == "stage1", join_parts(*map(part, LAYERS["stage1"]))).otherwise(join_parts(*map(part, LAYERS["stage2"])))
    sub = F.concat(F.col("pattern"), F.lit("|k="), F.col("k").cast("string"), F.lit("|donors="), F.array_join("donors", ","))
    return _kept(rows, "T2", "stage", sub, F.array_join(F.array_sort(F.map_keys("new")), "+"), F.concat(F.array("skill_id"), F.col("donors")), text, c)


def _mersenne(df: DataFrame, seed: int) -> DataFrame:
    """Span places as Python's generator draws them, for parity; an Arrow function."""
    import hashlib
    import random

    schema = T.StructType(df.schema.fields + [T.StructField("a", T.LongType()), T.StructField("d", T.LongType())])
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = {n: b.column(names.index(n)).to_pylist() for n in ("skill_id", "layer", "k", "na", "nd", "len")}
            out = []
            for sid, layer, k, na, nd, n in zip(*cols.values()):
                h = hashlib.sha1(f"{seed}|t3b_span|{sid}|{layer}|{k}".encode()).hexdigest()
                rng = random.Random(int(h[:16], 16))
                out.append((rng.randint(0, na - n), rng.randint(0, nd - n)))
            yield b.append_column("a", pa.array([x for x, _ in out], pa.int64())).append_column("d", pa.array([x for _, x in out], pa.int64()))

    return df.mapInArrow(run, schema)


def spliced(samples: DataFrame, c: Config = Config(), pools: DataFrame | None = None, rng: str = "hash") -> DataFrame:
    """T3b: a span of a layer replaced by an equally long span of a donor's same layer. Layers too short give nothing.
    ``rng`` is "hash" (places by digest) or "mt" (places by Python's generator)."""
    asked = _requests(samples, {s: [(f"t3b_{x}", 1, c.k_span_donors) for x in v] for s, v in T3B.items()})
    picked = donors(asked, pools if pools is not None else donor_pools(samples), c.seed)
    picked = picked.select("skill_id", "stage", "pool", "k", F.substring("pattern", 5, 1).alias("layer"), F.get("donors", F.lit(0)).alias("_id"), F.col("stage").alias("_st"))
    given = picked.join(_layers(samples, inside=True), ["_id", "_st", "layer"]).select("skill_id", "stage", "pool", "k", "layer", F.col("_id").alias("donor"), F.col("layer_text").alias("other"))
    rows = given.join(samples.select("skill_id", "stage", "split", *FIELD.values()), ["skill_id", "stage"])
    own = F.when(F.col("layer") == "I", inner(F.col("instruction_text"), "I")).otherwise(inner(F.col("resource_text"), "R"))
    rows = rows.select("*", F.explode(F.array(own)).alias("own"))  # a generator, so that it is computed once
    rows = rows.withColumns({"na": F.length("own"), "nd": F.length("other")})
    n = F.least(F.greatest(F.lit(c.span_min), F.floor(F.col("na") * F.lit(c.span_fraction)).cast("int")), F.lit(c.span_cap), F.col("na"), F.col("nd"))
    rows = rows.withColumn("len", n).where((F.col("len") >= c.span_min) & (F.col("len") > 0))
    if rng == "mt":
        rows = _mersenne(rows, c.seed)
    else:
        place = lambda total, tag: digest_mod(F.col(total) - F.col("len") + 1, F.lit(str(c.seed)), F.lit("t3b_span"), F.col("skill_id"), F.col("layer"), F.col("k").cast("string"), F.lit(tag))
        rows = rows.withColumns({"a": place("na", "a"), "d": place("nd", "d")})
    a, d = F.col("a").cast("int"), F.col("d").cast("int")
    new = F.concat(F.substring(F.col("own"), F.lit(1), a), F.substring(F.col("other"), d + 1, F.col("len")), F.substring(F.col("own"), a + F.col("len") + 1, F.col("na")))
    part = lambda x: F.when(F.col("layer") == x, wrap(new, x)).otherwise(F.col(FIELD[x]))
    text = F.when(F.col("stage") == "stage1", join_parts(F.col(FIELD["M"]), part("I"))).otherwise(join_parts(F.col(FIELD["M"]), part("I"), part("R")))
    sub = F.concat(F.lit("layer="), F.col("layer"), F.lit("|k="), F.col("k").cast("string"), F.lit("|donor="), F.col("donor"), F.lit(f"|frac={c.span_fraction}"))
    return _kept(rows, "T3b", "stage", sub, F.col("layer"), F.array("skill_id", "donor"), text, c)


def variants(samples: DataFrame, c: Config = Config()) -> DataFrame:
    """Positives and all generated variants of the samples, in one table."""
    pools = donor_pools(samples)
    return positive(samples).unionByName(permuted(samples, c)).unionByName(swapped(samples, c, pools)).unionByName(spliced(samples, c, pools))


def label_counts(rows: DataFrame, by: tuple[str, ...] = ("stage", "split", "label")) -> DataFrame:
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"))


def pool_sizes(samples: DataFrame) -> DataFrame:
    return samples.groupBy("stage", "pool").agg(F.count(F.lit(1)).alias("rows"))
