"""Phase-1 samples: up to two composed texts per record under token budgets, with pool and split."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.hashing import pool_and_split
from millrace.functions.text import clean, clip, headed, is_clipped, join_parts, let, tokens, wrap
from millrace.operators.normalize import _FILES, block


@dataclass(frozen=True)
class Budgets:
    """Limits of 0 are no limits."""

    stage1_tokens: int = 4096
    stage2_tokens: int = 10240
    metadata_chars: int = 0
    instruction_chars: int = 0
    file_chars: int = 0
    resource_chars: int = 0

    @property
    def parent_chars(self) -> int:
        """Size from which a record can't give a sample."""
        return max(16 * self.stage2_tokens, 256_000)


def metadata_section(name: Column, description: Column, limit: int = 0) -> Column:
    parts = [headed(clean(c), k) for k, c in (("name: ", name), ("description: ", description))]
    return wrap(clip(join_parts(*parts), limit), "M")


def instruction_section(text: Column, limit: int = 0) -> Column:
    return wrap(clip(clean(text), limit), "I")


def resource_section(files: Column, file_chars: int = 0, total: int = 0) -> Column:
    """Struct ``(text, included, dropped, truncated)``. Files without path and content are skipped; a total of 0 takes all,
    else blocks are clipped and then dropped as the budget, separators included, is used up."""
    kept = F.filter(
        F.transform(F.filter(F.coalesce(files, F.array().cast(_FILES)), lambda f: f.isNotNull()), lambda f: F.struct(clean(f["path"]).alias("path"), clean(f["content"]).alias("content"))),
        lambda f: (f["path"] != "") | (f["content"] != ""),
    )
    blocks = F.transform(kept, lambda f: F.struct(block(F.struct(f["path"].alias("path"), clip(f["content"], file_chars).alias("content"))).alias("b"), is_clipped(f["content"], file_chars).alias("t")))
    if total <= 0:

        def whole(v: Column) -> Column:
            return _section(F.array_join(F.transform(v, lambda x: x["b"]), "\n\n"), F.size(v), F.lit(0), F.size(F.filter(v, lambda x: x["t"])))

        return let(blocks, whole)
    zero = F.struct(F.lit(total).alias("left"), F.array().cast("array<string>").alias("out"), F.lit(0).alias("dropped"), F.lit(0).alias("cut"))

    def step(a: Column, x: Column) -> Column:
        first = F.size(a["out"]) == 0
        room = F.when(first, a["left"]).otherwise(a["left"] - 2)

        def put(b: Column) -> Column:
            more = F.when(x["t"] | is_clipped(x["b"], room), 1).otherwise(0)
            kept = F.struct((a["left"] - F.length(b) - F.when(first, 0).otherwise(2)).alias("left"), F.concat(a["out"], F.array(b)).alias("out"), a["dropped"].alias("dropped"), (a["cut"] + more).alias("cut"))
            gone = F.struct(a["left"].alias("left"), a["out"].alias("out"), (a["dropped"] + 1).alias("dropped"), a["cut"].alias("cut"))
            return F.when((a["left"] > 0) & (room > 0) & (b != ""), kept).otherwise(gone)

        return let(clip(x["b"], room), put)

    return let(F.aggregate(blocks, zero, step), lambda e: _section(F.array_join(e["out"], "\n\n"), F.size(e["out"]), e["dropped"], e["cut"]))


def _section(body: Column, n: Column, dropped: Column, clipped: Column) -> Column:
    none = n == 0
    return F.struct(F.when(none, "").otherwise(wrap(body, "R")).alias("text"), n.alias("included"), dropped.alias("dropped"), F.when(none, 0).otherwise(clipped).alias("truncated"))


def sections(records: DataFrame, b: Budgets = Budgets()) -> DataFrame:
    """``skill_id`` and the three sections of normalized records."""
    return records.select(
        "skill_id",
        metadata_section(F.col("name"), F.col("description_text"), b.metadata_chars).alias("m"),
        instruction_section(F.col("skill_md_non_description"), b.instruction_chars).alias("i"),
        resource_section(F.col("package_files"), b.file_chars, b.resource_chars).alias("r"),
    )


def small_enough(records: DataFrame, b: Budgets = Budgets()) -> DataFrame:
    """Drops records too large for any budget before their texts are touched."""
    size = F.greatest(F.coalesce("text_char_count", F.lit(0)), F.coalesce("package_files_total_bytes", F.lit(0)))
    return records.where(size <= b.parent_chars)


def phase1(records: DataFrame, b: Budgets = Budgets(), **seeds) -> DataFrame:
    """Samples of both stages; stage 2 needs a resource section. A record gives 0 to 2 rows; all carry its pool and split."""
    s = sections(small_enough(records, b), b)

    def sample(stage: str, r: Column, limit: int) -> Column:
        text = join_parts(F.col("m"), F.col("i"), r["text"])
        ok = (text != "") & (tokens(text) <= limit) & ((r["text"] != "") if stage == "stage2" else F.lit(True))
        row = F.struct(F.lit(stage).alias("stage"), text.alias("text"), r["text"].alias("resource_text"), r["included"].alias("n_resource_files_included"), r["dropped"].alias("n_resource_files_dropped"), r["truncated"].alias("n_resource_files_truncated"))
        return F.when(ok, row)

    none = F.struct(F.lit("").alias("text"), F.lit(0).alias("included"), F.lit(0).alias("dropped"), F.lit(0).alias("truncated"))
    both = F.filter(F.array(sample("stage1", none, b.stage1_tokens), sample("stage2", F.col("r"), b.stage2_tokens)), lambda x: x.isNotNull())
    pool, split = pool_and_split(F.col("skill_id"), **seeds)
    rows = s.select("skill_id", F.col("m").alias("metadata_text"), F.col("i").alias("instruction_text"), F.explode(both).alias("x"))
    rows = rows.select("skill_id", "metadata_text", "instruction_text", "x.*")
    sizes = {f"{k}_chars": F.length(c).cast("bigint") for k, c in (("metadata", "metadata_text"), ("instruction", "instruction_text"), ("resource", "resource_text"), ("total", "text"))}
    sizes |= {f"{k}_tokens_est": tokens(F.col(c)) for k, c in (("metadata", "metadata_text"), ("instruction", "instruction_text"), ("resource", "resource_text"), ("total", "text"))}
    return rows.withColumns({**sizes, "sample_id": F.sha1(F.concat_ws("|", "stage", "skill_id", F.substring("text", 1, 128))), "pool": pool, "split": split})


def emit_counts(records: DataFrame, b: Budgets = Budgets()) -> DataFrame:
    """How many records give samples: ``any, stage1, stage2, none, oversize``; counted before rows are exploded."""
    size = F.greatest(F.coalesce("text_char_count", F.lit(0)), F.coalesce("package_files_total_bytes", F.lit(0)))
    over = size > b.parent_chars
    made = F.struct(metadata_section(F.col("name"), F.col("description_text"), b.metadata_chars).alias("m"), instruction_section(F.col("skill_md_non_description"), b.instruction_chars).alias("i"), resource_section(F.col("package_files"), b.file_chars, b.resource_chars).alias("r"))
    # One scan; records that are too large are counted without their texts being touched.
    s = records.select(over.alias("over"), F.explode(F.array(F.when(~over, made))).alias("x")).select("over", "x.m", "x.i", "x.r")
    one = (F.concat("m", "i") != "") & (tokens(join_parts(F.col("m"), F.col("i"))) <= b.stage1_tokens)
    two = (F.col("r.text") != "") & (tokens(join_parts(F.col("m"), F.col("i"), F.col("r.text"))) <= b.stage2_tokens)
    one, two = F.coalesce(one, F.lit(False)), F.coalesce(two, F.lit(False))
    fits = ~F.col("over")
    return s.agg(F.count_if(fits & (one | two)).alias("any"), F.count_if(fits & one).alias("stage1"), F.count_if(fits & two).alias("stage2"), F.count_if(fits & ~(one | two)).alias("none"), F.count_if("over").alias("oversize"))


def section_sizes(samples: DataFrame) -> DataFrame:
    """Mean and maximum of section sizes by stage and split."""
    cols = [f"{k}_{u}" for k in ("metadata", "instruction", "resource", "total") for u in ("chars", "tokens_est")]
    return samples.groupBy("stage", "split").agg(F.count(F.lit(1)).alias("rows"), *(F.avg(c).alias(f"mean_{c}") for c in cols), *(F.max(c).alias(f"max_{c}") for c in cols))


def stage_row(records: DataFrame, limit: int) -> DataFrame:
    """The older form of a training row: five cleaned and clipped texts and their lengths. ``records`` has ``full_text``."""
    from_to = {"name": "stage_name", "description_text": "stage_description", "skill_md_non_description": "stage_markdown", "package_files_text": "stage_files", "full_text": "packed_skill"}
    rows = records.select("skill_id", *(clip(clean(F.col(c)), limit).alias(n) for c, n in from_to.items()))
    return rows.select("*", *(F.length(n).cast("bigint").alias(f"{n}_len") for n in from_to.values()))
