"""Canonical records to normalized records: cleaned fields, description precedence, packed files, full text."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.text import clean, clip, headed, is_clipped, join_parts, let, strip

FILE_CHARS, CONCAT_CHARS = 12_000, 48_000
_FILES = "array<struct<path:string,content:string,size_bytes:bigint,truncated:boolean>>"


def clean_files(files: Column, limit: int = FILE_CHARS) -> Column:
    """Cleaned and clipped files; null gives an empty list. Missing sizes are 0."""
    def one(f: Column) -> Column:
        def row(text: Column) -> Column:
            cut_ = F.coalesce(f["truncated"], F.lit(False)) | is_clipped(text, limit)
            return F.struct(clean(f["path"]).alias("path"), clip(text, limit).alias("content"), F.coalesce(f["size_bytes"].cast("bigint"), F.lit(0)).alias("size_bytes"), cut_.alias("truncated"))

        return let(clean(f["content"]), row)

    present = F.filter(F.coalesce(files, F.array().cast(_FILES)), lambda f: f.isNotNull())
    return F.transform(present, one)


def block(f: Column) -> Column:
    name = F.when(f["path"] == "", "unknown").otherwise(f["path"])
    return strip(F.concat(F.lit("### "), name, F.lit("\n"), f["content"]))


def pack_files(files: Column, budget: int = CONCAT_CHARS) -> Column:
    """Struct ``(text, n_clipped)``: blocks in order while the budget lasts, which each block and its separator use up;
    a budget of 0 or less packs nothing. ``n_clipped`` counts blocks clipped here of files that were whole."""
    zero = F.struct(F.lit(budget).cast("bigint").alias("left"), F.array().cast("array<string>").alias("out"), F.lit(0).alias("n"))

    def step(a: Column, f: Column) -> Column:
        use = (a["left"] > 0) & ((f["path"] != "") | (f["content"] != ""))

        def add(whole: Column) -> Column:
            def put(b: Column) -> Column:
                more = F.when(is_clipped(whole, a["left"].cast("int")) & ~f["truncated"], 1).otherwise(0)
                return F.struct((a["left"] - F.length(b) - 2).alias("left"), F.concat(a["out"], F.array(b)).alias("out"), (a["n"] + more).alias("n"))

            return let(clip(whole, a["left"].cast("int")), put)

        return F.when(use, let(block(f), add)).otherwise(a)

    end = F.aggregate(files, zero, step)
    return let(end, lambda e: F.struct(strip(F.array_join(e["out"], "\n\n")).alias("text"), e["n"].alias("n_clipped")))


def full_text(name: Column, first: Column, description: Column, rest: Column, files: Column, limit: int = CONCAT_CHARS) -> Column:
    """Headed sections of the non-empty parts, clipped."""
    heads = ("# Skill Name", "# First Layer Description", "# Effective Description", "# Remaining Skill Markdown", "# Package Files")
    parts = [headed(c, h + "\n") for h, c in zip(heads, (name, first, description, rest, files))]
    return clip(strip(join_parts(*parts, sep="\n\n")), limit)


def normalize(canonical: DataFrame, file_chars: int = FILE_CHARS, concat_chars: int = CONCAT_CHARS) -> DataFrame:
    """The normalized table without ``record_sha1``. Files are a real array; ``files_json`` is for the sink."""
    files = canonical.select(
        clean(F.col("skill_id")).alias("skill_id"),
        clean(F.col("first_layer.name")).alias("name"),
        clean(F.col("first_layer.description")).alias("first_layer_description"),
        clean(F.col("skill_md.description_section.content")).alias("skill_md_description"),
        clean(F.col("skill_md.non_description")).alias("skill_md_non_description"),
        F.coalesce("skill_md.description_section.found", F.lit(False)).alias("has_explicit_description_heading"),
        clean_files(F.col("package_files"), file_chars).alias("package_files"),
    )
    source = F.when(F.col("skill_md_description") != "", "skill_md_heading").when(F.col("first_layer_description") != "", "first_layer_description").otherwise("empty")
    packed = files.withColumns({"description_source": source, "_p": pack_files(F.col("package_files"), concat_chars)})
    text = F.when(F.col("description_source") == "skill_md_heading", F.col("skill_md_description")).otherwise(F.col("first_layer_description"))
    out = packed.withColumns(
        {
            "description_text": text,
            "used_metadata_description_fallback": F.col("description_source") == "first_layer_description",
            "package_files_count": F.size("package_files").cast("bigint"),
            "package_files_total_bytes": F.aggregate("package_files", F.lit(0).cast("bigint"), lambda a, f: a + f["size_bytes"]),
            "package_files_truncated_count": (F.size(F.filter("package_files", lambda f: f["truncated"])) + F.col("_p.n_clipped")).cast("bigint"),
            "package_file_paths": F.filter(F.transform("package_files", lambda f: f["path"]), lambda p: p != ""),
            "package_files_text": F.col("_p.text"),
        }
    ).drop("_p")
    full = out.withColumn("full_text", full_text(*map(F.col, ("name", "first_layer_description", "description_text", "skill_md_non_description")), clean(F.col("package_files_text")), concat_chars))
    return full.withColumn("text_char_count", F.length("full_text").cast("bigint"))


def record_sha1(df: DataFrame) -> DataFrame:
    """``record_sha1`` over a row's canonical JSON: keys sorted, compact, non-ASCII kept. Python's JSON differs from the
    JVM's in control characters, so this is an Arrow function."""
    import hashlib
    import json

    schema = T.StructType(df.schema.fields + [T.StructField("record_sha1", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sha = [hashlib.sha1(json.dumps(r, sort_keys=True, ensure_ascii=False, separators=(",", ":"), default=str).encode("utf-8", "surrogatepass")).hexdigest() for r in b.to_pylist()]
            yield b.append_column("record_sha1", pa.array(sha, pa.string()))

    return df.mapInArrow(run, schema)


def report(rows: DataFrame) -> DataFrame:
    """Counts, sums and averages of a normalized table; averages of an empty one are 0."""
    zero = lambda c: F.coalesce(c, F.lit(0))
    return rows.agg(
        F.count(F.lit(1)).alias("rows"),
        zero(F.sum("package_files_count")).alias("files"),
        zero(F.sum("package_files_total_bytes")).alias("bytes"),
        zero(F.sum("package_files_truncated_count")).alias("truncated"),
        F.count_if(F.col("used_metadata_description_fallback")).alias("fallbacks"),
        F.count_if(F.col("has_explicit_description_heading")).alias("headings"),
        F.coalesce(F.avg("text_char_count"), F.lit(0.0)).alias("mean_chars"),
        F.coalesce(F.avg("package_files_count"), F.lit(0.0)).alias("mean_files"),
    )
