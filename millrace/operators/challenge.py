"""Directory trees and reviewed lists to evaluation and classifier tables; canonical splits around a hold-out."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.hashing import hash_parts
from millrace.functions.text import clean, clip, description_section, rstrip, strip
from millrace.session import is_small

# Closed vocabularies of gold labels.
SAFE, ALIGN = ("SAFE", "SUSPICIOUS", "MALICIOUS"), ("ALIGNED", "MISALIGNED")
SKILL_CHARS, EVIDENCE_CHARS, FILE_CHARS = 16_000, 20_000, 12_000
_FRONT = re.compile(r"\A---[ \t]*\r?\n(.*?)(?:\r?\n)---[ \t]*(?:\r?\n|\Z)", re.S)


def frontmatter(df: DataFrame, text: str = "skill_md") -> DataFrame:
    """Adds ``front struct<name, description>`` and ``body``: the YAML between ``---`` fences at the start. Without fences
    the body is the whole; invalid YAML or YAML that is no mapping gives empty fields. An Arrow function, as YAML has no JVM
    function here."""
    front = T.StructType([T.StructField("name", T.StringType()), T.StructField("description", T.StringType())])
    schema = T.StructType(df.schema.fields + [T.StructField("front", front), T.StructField("body", T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = [parse_frontmatter(t) for t in b[text]]
            yield b.assign(front=[{"name": n, "description": d} for n, d, _ in got], body=[x for _, _, x in got])

    return df.mapInPandas(run, schema)


def parse_frontmatter(text: str | None) -> tuple[str, str, str]:
    import yaml

    text = text or ""
    m = _FRONT.match(text)
    if not m:
        return "", "", text
    try:
        tree = yaml.safe_load(m[1])
    except yaml.YAMLError:
        tree = None
    tree = tree if isinstance(tree, dict) else {}
    pick = lambda k: "" if tree.get(k) is None else str(tree[k]).strip()
    return pick("name"), pick("description"), text[m.end() :]


def canonical_of(packages: DataFrame, key: Column) -> DataFrame:
    """Canonical records of package rows (``skill_md``, ``package_files``): header, description section, the rest."""
    d = frontmatter(packages).withColumn("sec", description_section(F.col("body")))
    return d.select(
        key.alias("skill_id"),
        F.col("front").alias("first_layer"),
        F.struct(F.struct("sec.found", "sec.heading", "sec.content").alias("description_section"), F.col("sec.rest").alias("non_description")).alias("skill_md"),
        "package_files",
        *(c for c in packages.columns if c not in ("skill_md", "package_files", "skill_id")),
    )


def gold(c: Column, vocabulary: tuple[str, ...]) -> Column:
    """A label of a closed vocabulary in any case, else null."""
    v = F.upper(F.trim(c))
    return F.when(v.isin(*vocabulary), v)


def skill_text(description: Column, body: Column, limit: int = SKILL_CHARS) -> Column:
    """Description, a rule, the body; cut hard. Without a description the rule leads."""
    return F.substring(strip(F.concat(strip(F.coalesce(description, F.lit(""))), F.lit("\n\n---\n\n"), strip(F.coalesce(body, F.lit(""))))), 1, limit)


def eval_rows(reviewed: DataFrame, skills: DataFrame) -> DataFrame:
    """Evaluation rows of reviewed ids that have a record in ``skills`` (skill_id, description, body)."""
    r = reviewed.select("skill_id", source_of(F.col("source")).alias("source"), gold(F.col("final_safe"), SAFE).alias("overall_class"), gold(F.col("final_align"), ALIGN).alias("alignment_class"))
    j = r.join(skills.select("skill_id", "description", "body"), "skill_id")
    return j.select("skill_id", skill_text(F.col("description"), F.col("body")).alias("skill_text"), "overall_class", "alignment_class", "source", F.lit("test").alias("split"))


def evidence(name: Column, description: Column, section: Column, rest: Column, files: Column, limit: int = EVIDENCE_CHARS, file_chars: int = FILE_CHARS) -> Column:
    """Header, evidence and files of a skill as one text, cut hard; files without content are left out."""
    n, d = F.coalesce(name, F.lit("")), F.coalesce(description, F.lit(""))
    sec, body = F.coalesce(section, F.lit("")), F.coalesce(rest, F.lit(""))
    kept = F.filter(F.coalesce(files, F.array().cast("array<struct<path:string,content:string,size_bytes:bigint,truncated:boolean>>")), lambda f: F.coalesce(f["content"], F.lit("")) != "")
    blocks = F.transform(kept, lambda f: F.concat(F.lit("## "), F.coalesce(f["path"], F.lit("")), F.lit("\n"), F.substring(f["content"], 1, file_chars), F.lit("\n")))
    head = F.concat(F.lit("# Skill Name\n"), n, F.lit("\n\n# Evidence\n---\nname: "), n, F.lit("\ndescription: "), d, F.lit("\n---\n\n"))
    middle = F.concat(F.when(sec != "", F.concat(F.lit("## Description\n"), sec, F.lit("\n\n"))).otherwise(""), F.when(body != "", F.concat(strip(body), F.lit("\n\n"))).otherwise(""))
    return F.substring(rstrip(F.concat(head, middle, F.lit("# Files\n"), F.array_join(blocks, "\n"))), 1, limit)


def prompt(name: Column, ev: Column, candidate: Column) -> Column:
    return F.concat(F.lit("Skill name: "), name, F.lit("\n\nEvidence:\n"), ev, F.lit("\n\nCandidate description:\n"), candidate, F.lit("\n\nDoes the candidate description match the skill? Answer yes or no."))


def match_prompt(name: Column, ev: Column, candidate: Column, limit: int) -> Column:
    """The older form of the prompt: struct ``(prompt, evidence)`` of cleaned texts, the evidence clipped."""
    short = clip(clean(ev), limit)
    return F.struct(strip(prompt(clean(name), short, clean(candidate))).alias("prompt"), short.alias("evidence"))


#: Columns of the reviewed list that tell what scanners said.
SCANS = ("static_rule_class", "llm_filter_class", "alignment_class", "behavioral_class", "overall_class", "bench_classification", "hsb_tier", "hsb_category")


def with_labels(canonical: DataFrame, reviewed: DataFrame) -> DataFrame:
    """Canonical records of reviewed ids with the structs ``gold`` and ``scan`` and their source in lower case."""
    scans = F.struct(*(F.col(c) if c in reviewed.columns else F.lit(None).cast("string").alias(c) for c in SCANS))
    golds = F.struct(gold(F.col("final_safe"), SAFE).alias("final_safe"), gold(F.col("final_align"), ALIGN).alias("final_align"))
    return canonical.join(reviewed.select("skill_id", golds.alias("gold"), scans.alias("scan"), source_of(F.col("source")).alias("source")), "skill_id")


def source_of(c: Column) -> Column:
    """A source in lower case; without one it is unknown."""
    low = F.lower(F.coalesce(c, F.lit("")))
    return F.when(low == "", "unknown").otherwise(low)


def first_rows(rows: DataFrame, n: int, order: list[Column]) -> DataFrame:
    """The first ``n`` rows by an explicit order; 0 takes all."""
    return rows.orderBy(*order).limit(n) if n > 0 else rows


def skills_of(canonical: DataFrame) -> DataFrame:
    """Canonical records as the evaluation and classifier rows take them."""
    return canonical.select("skill_id", F.col("first_layer.name").alias("name"), F.col("first_layer.description").alias("description"), F.col("skill_md.description_section.content").alias("section"), F.col("skill_md.non_description").alias("body"), "package_files", *(["has_md"] if "has_md" in canonical.columns else []))


def outcome(reviewed: DataFrame, skills: DataFrame) -> DataFrame:
    """Reviewed rows with ``reason``: the first that holds of no_label, missing_package, no_text; null for usable rows."""
    label = gold(F.col("final_align"), ALIGN)
    text = F.col("has_md") if "has_md" in skills.columns else F.coalesce("body", F.lit("")) != ""
    s = skills.select("skill_id", F.lit(True).alias("_there"), text.alias("_text"))
    j = reviewed.join(s, "skill_id", "left")
    why = F.when(label.isNull(), "no_label").when(F.col("_there").isNull(), "missing_package").when(~F.col("_text"), "no_text")
    return j.select(*reviewed.columns, label.alias("gold"), why.alias("reason"))


def classifier_rows(reviewed: DataFrame, skills: DataFrame, instruction: str = "", normalized_version: str = "v1", output_version: str = "v1") -> DataFrame:
    """Classifier rows of usable reviewed rows; ``skills``: skill_id, name, description, section, body, package_files."""
    ok = outcome(reviewed, skills).where("reason is null").select("skill_id", source_of(F.col("source")).alias("source"), "gold", gold(F.col("final_safe"), SAFE).alias("final_safe"))
    j = ok.join(skills, "skill_id")
    name = F.when(F.coalesce("name", F.lit("")) != "", F.col("name")).otherwise(F.col("skill_id"))
    cand = F.when(F.coalesce("description", F.lit("")) != "", F.col("description")).otherwise(F.coalesce("section", F.lit("")))
    label = (F.col("gold") == "ALIGNED").cast("bigint")
    j = j.withColumns({"_n": name, "_c": cand, "_l": label, "_e": evidence(name, F.col("description"), F.col("section"), F.col("body"), F.col("package_files"))})
    return j.select(
        hash_parts(F.col("skill_id"), F.lit("self"), F.col("_l").cast("string")).alias("example_id"), "skill_id", F.col("skill_id").alias("candidate_skill_id"), F.col("_l").alias("label"), F.when(F.col("_l") == 1, "yes").otherwise("no").alias("target_text"),
        F.lit(instruction).alias("instruction"), prompt(F.col("_n"), F.col("_e"), F.col("_c")).alias("input_text"), F.col("_e").alias("evidence_text"), F.col("_c").alias("candidate_description"), F.col("_e").alias("skill_text"), F.col("gold").alias("alignment_class"),
        F.lower("gold").alias("misalignment_response"), F.lit(normalized_version).alias("normalized_version"), F.lit(output_version).alias("output_version"), "source", "final_safe", F.col("gold").alias("final_align"),
    )


def chat_rows(rows: DataFrame, system: str, template: str) -> DataFrame:
    """Chat form of classifier rows; ``template`` holds ``{skill_text}``."""
    before, after = template.split("{skill_text}")
    say = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    msgs = F.array(say("system", F.lit(system)), say("user", F.concat(F.lit(before), F.col("skill_text"), F.lit(after))), say("assistant", F.col("misalignment_response")))
    return rows.select(msgs.alias("messages"), F.struct("skill_id", "candidate_skill_id", "label", "alignment_class", "normalized_version", "output_version", "source", "final_align").alias("metadata"))


def add_columns(rows: DataFrame) -> DataFrame:
    """Adds ``skill_text`` (from evidence_text, else input_text) and ``alignment_class`` (from label) where missing."""
    if "skill_text" not in rows.columns:
        src = next((c for c in ("evidence_text", "input_text") if c in rows.columns), None)
        if src is None:
            raise ValueError("neither evidence_text nor input_text is there to derive skill_text from")
        rows = rows.withColumn("skill_text", F.col(src))
    if "alignment_class" not in rows.columns:
        if "label" not in rows.columns:
            raise ValueError("no label to derive alignment_class from")
        rows = rows.withColumn("alignment_class", F.when(F.col("label") == 1, "ALIGNED").otherwise("MISALIGNED"))
    return rows


# --- canonical splits ---------------------------------------------------------------------------------------------------


def _small(ids: DataFrame) -> DataFrame:
    ids = ids.distinct()
    return F.broadcast(ids) if is_small(ids) else ids


def train_part(canonical: DataFrame, holdout: DataFrame, key: str = "skill_id") -> DataFrame:
    """Records that aren't held out; null keys stay."""
    return canonical.join(_small(holdout.select(key)), key, "left_anti")


def challenge_part(canonical: DataFrame, holdout: DataFrame, order: list[Column], key: str = "skill_id") -> DataFrame:
    """Held-out records, the first of each id by ``order``. The first is a minimum over the order, combined map-side."""
    rest = [c for c in canonical.columns if c != key]
    met = canonical.join(_small(holdout.select(key)), key, "left_semi")
    first = met.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("x"))
    return first.select(key, *(F.col(f"x.{c}").alias(c) for c in rest))


def fill_missing(found: DataFrame, local: DataFrame, wanted: DataFrame, key: str = "skill_id", ordinal: str = "ord") -> DataFrame:
    """Found records, and local ones for ids that weren't found, with the ordinal of the wanted list."""
    both = found.unionByName(local.join(_small(found.select(key)), key, "left_anti"), allowMissingColumns=True)
    return both.join(wanted.select(key, ordinal), key)


def source_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("source").agg(F.count(F.lit(1)).alias("rows"))
