"""The pN queries over the test tables, and SQL for those that SQL expresses."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import credentials, cube_sample, leaks, near_duplicates, overlap, packing, personal, source_files, tokenize
from millrace.session import cut, load, prepare

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(f: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return f(spark, sf_dir)

    QUERIES[f.__name__] = run
    return run


def _skill_texts(spark: SparkSession, d: str) -> DataFrame:
    text = F.concat(F.coalesce("text", F.lit("")), F.lit("\n"), F.coalesce("package_files_text", F.lit("")))
    return load(spark, d, "normalized_skill_records").select(F.col("skill_id").alias("id"), text.alias("text"))


@query
def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return near_duplicates.near_pairs(_skill_texts(spark, d), 0.6).select(F.col("id_a").alias("skill_id_a"), F.col("id_b").alias("skill_id_b"))


@query
def p1_groups(spark: SparkSession, d: str) -> DataFrame:
    """Classes and groups at the general setting for near-duplicates: five-word runs, 0.8."""
    return near_duplicates.near_groups(_skill_texts(spark, d), 0.8, run=5).withColumnRenamed("id", "skill_id")


@query
def p1_classes(spark: SparkSession, d: str) -> DataFrame:
    """The setting of p1_found without pairs of copies: one row per skill and class with its number of links."""
    return near_duplicates.near_groups(_skill_texts(spark, d), 0.6).withColumnRenamed("id", "skill_id")


def _files(spark: SparkSession, d: str) -> DataFrame:
    return credentials.files(load(spark, d, "normalized_skill_records"))


@query
def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return source_files.made_files(_files(spark, d)).select("skill_id", "path").distinct()


@query
def p2_reasons(spark: SparkSession, d: str) -> DataFrame:
    """Files by reason and by what told it: layout, place or statement."""
    return source_files.made_files(_files(spark, d)).groupBy("reason", "found_by").agg(F.count(F.lit(1)).alias("files"))


@query
def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return credentials.credential_lines(_files(spark, d))


@query
def p6_redacted(spark: SparkSession, d: str) -> DataFrame:
    """Files that hold credentials, with these replaced."""
    return credentials.redacted_files(_files(spark, d)).where("n > 0")


@query
def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _leaks(spark, d).select(F.col("item_id").alias("eval_skill_id"), F.col("id").alias("skill_id"))


@query
def p3_report(spark: SparkSession, d: str) -> DataFrame:
    """Per leaked item: records it leaked into and the longest shared span in words."""
    return _leaks(spark, d).groupBy(F.col("item_id").alias("eval_skill_id")).agg(F.count(F.lit(1)).alias("n_skills"), F.max("words").alias("longest_span"))


def _leaks(spark: SparkSession, d: str) -> DataFrame:
    items = load(spark, d, "challenge_eval").select(F.col("skill_id").alias("id"), F.col("skill_text").alias("text"))
    corpus = load(spark, d, "normalized_skill_records").select(F.col("skill_id").alias("id"), "text")
    return leaks.leaked_passages(items, corpus)


def _variant_texts(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "variant_rows").select(F.col("sample_id").alias("id"), overlap.clean("split").alias("split"), "text")


@query
def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return overlap.split_overlaps(_variant_texts(spark, d), 0.7).select(F.col("id_a").alias("sample_id_a"), F.col("id_b").alias("sample_id_b"))


@query
def p4_rows(spark: SparkSession, d: str) -> DataFrame:
    return overlap.overlap_rows(_variant_texts(spark, d), 0.7).withColumnRenamed("id", "sample_id")


@query
def p4_weighted(spark: SparkSession, d: str) -> DataFrame:
    """Overlaps of classes with weights by rarity, which passages that most rows share don't make."""
    return overlap.weighted_overlaps(_variant_texts(spark, d))


@query
def p4_counts(spark: SparkSession, d: str) -> DataFrame:
    details = load(spark, d, "variant_rows").select(F.col("sample_id").alias("id"), overlap.clean("anchor_skill_id").alias("anchor"), F.col("source_skill_ids").alias("sources"))
    return overlap.overlap_counts(_variant_texts(spark, d), details, 0.7)


def _balanced(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    rows = load(spark, d, "variant_rows").select(F.col("sample_id").alias("id"), *(overlap.clean(c).alias(c) for c in ("stage", "split", "label")))
    return cube_sample.draw(rows, load(spark, d, "sampling_targets"))


@query
def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return _balanced(spark, d)[1].where("missing > 0").select("stage", "split", "label")


@query
def p5_sample(spark: SparkSession, d: str) -> DataFrame:
    return _balanced(spark, d)[0].withColumnRenamed("id", "sample_id")


@query
def p5_report(spark: SparkSession, d: str) -> DataFrame:
    return _balanced(spark, d)[1]


ORACLE_SQL["p5_found"] = """
with have as (
  select lower(trim(stage)) stage, lower(trim(split)) split, lower(trim(label)) label, count(distinct sample_id) n
  from variant_rows group by all)
select t.stage, t.split, t.label from sampling_targets t left join have h on t.stage = h.stage and t.split = h.split and t.label = h.label
where coalesce(h.n, 0) < greatest(t.min_rows, cast(round(t.target_share * t.sample_rows) as bigint))
"""

ORACLE_SQL["p5_report"] = """
with have as (
  select lower(trim(stage)) stage, lower(trim(split)) split, lower(trim(label)) label, count(distinct sample_id) n
  from variant_rows group by all),
 t as (select t.*, greatest(t.min_rows, cast(round(t.target_share * t.sample_rows) as bigint)) wanted, coalesce(h.n, 0) available
  from sampling_targets t left join have h on t.stage = h.stage and t.split = h.split and t.label = h.label)
select *, least(wanted, available) as drawn, wanted - least(wanted, available) as missing,
 least(wanted, available) / sample_rows as share, least(wanted, available) / sample_rows - target_share as share_gap from t
"""


@query
def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokenize.encode(load(spark, d, "documents").select("doc_id", "text"))


def _token_sizes(spark: SparkSession, d: str) -> DataFrame:
    return tokenize.encode(load(spark, d, "documents").select(F.col("doc_id").alias("id"), "text"), out="size", count_only=True)


#: The window of context_windows that p8_windows fills.
WINDOW_NAME = "medium"


@query
def p8_windows(spark: SparkSession, d: str) -> DataFrame:
    capacity = load(spark, d, "context_windows").where(F.col("window_name") == WINDOW_NAME).first()["capacity_tokens"]
    return packing.fill_windows(_token_sizes(spark, d), capacity)[0].withColumnRenamed("id", "doc_id")


@query
def p8_report(spark: SparkSession, d: str) -> DataFrame:
    """Windows, lower bound and fill for each row of context_windows (four rows, at any scale)."""
    sizes = cut(_token_sizes(spark, d))
    out = []
    for r in load(spark, d, "context_windows").orderBy("capacity_tokens").collect():
        report = packing.fill_windows(sizes, r["capacity_tokens"])[1]
        full = max(1, report["windows"]) * r["capacity_tokens"]
        out.append((r["window_name"], r["capacity_tokens"], report["tokens"], report["windows"], report["lower_bound"], report["certified"], report["gap"], report["tokens"] / full))
    return spark.createDataFrame(out, "window_name string, capacity_tokens bigint, tokens bigint, windows bigint, lower_bound bigint, certified boolean, gap bigint, fill double")


@query
def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return personal.personal_pieces(load(spark, d, "documents").select("doc_id", "text")).select("doc_id", "pii_kind", "start_pos")


@query
def p9_redacted(spark: SparkSession, d: str) -> DataFrame:
    return personal.redacted_texts(load(spark, d, "documents").select("doc_id", "text"))
