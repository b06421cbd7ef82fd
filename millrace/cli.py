"""Command line: one stage per command, over files.

    python -m millrace.cli normalize --in canonical.jsonl --out out/normalized/v1 [--verdicts verdicts.csv]
    python -m millrace.cli phase1    --in out/normalized/v1 --out out/full_cpt/v1
    python -m millrace.cli variants  --in out/full_cpt/v1 --out out/pl_hcl/v1
    python -m millrace.cli rewrite   --in out/pl_hcl/v1 --out out/pl_hcl_t3a/v1 [--k 3] [--model-registry models.json --model-key name]
    python -m millrace.cli identify  --in out/pl_hcl/v1 --out out/pl_hcl_t3c/v1 [--k 3]
    python -m millrace.cli balance   --in out/pl_hcl/v1 --out out/balanced/v1 [--rows 0] [--order hash|mt]
    python -m millrace.cli pairs     --in out/pl_hcl/v1 --out out/pairs/v1
    python -m millrace.cli eval      --in packages/ --reviewed reviewed.csv --out out/challenge/v1 [--limit N] [--format csv]
    python -m millrace.cli sft       --in packages/ --reviewed reviewed.csv --out out/sft/v1 [--limit N]
    python -m millrace.cli split-train     --in canonical.jsonl --ids holdout.csv --out out/canonical_train
    python -m millrace.cli split-challenge --in canonical.jsonl --packages packages/ --ids holdout.csv --out out/canonical_challenge
    python -m millrace.cli restore   --in store/ --reviewed reviewed.csv --out packages/ [--dry-run]
    python -m millrace.cli add-columns --in out/sft/v1/classifier --out out/sft_columns/v1
    python -m millrace.cli scrub     --in out/pl_hcl/v1 --out out/pl_hcl/v2 --ids holdout.csv
    python -m millrace.cli scrub-all --in out --ids holdout.csv --versions full_cpt=v1:v2 pl_hcl=v1:v2 sft=v1:v2
    python -m millrace.cli stats     --in out/pl_hcl/v1
    python -m millrace.cli stats-all --in out --versions full_cpt=v1 pl_hcl=v1 sft=v1 [--out report.json]

Outputs are new versions: an existing path is refused. Every stage writes ``_stats.json`` and ``_manifest.json`` into its output and an entry
into ``registry.json`` beside the versions; a setting ``paths.manifests_root`` gets copies of the manifests. ``--config`` reads YAML or JSON with
``${VAR:-default}``. Paths may lie on any file system that Spark reaches.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import balance, challenge, families, identifiers, normalize, samples, spans, stats, variants, verdicts
from millrace.session import cut, prepare
from millrace.sources import files, readers, writers

STAGES = ("normalize", "phase1", "variants", "rewrite", "identify", "balance", "pairs", "eval", "sft", "split-train", "split-challenge", "restore", "add-columns", "scrub", "scrub-all", "stats", "stats-all")
#: Text of the chat rows, where the configuration gives none.
SYSTEM, TEMPLATE = "You review agent skills.", "Read the skill and answer aligned or misaligned.\n\n{skill_text}"


def verdict_path(spark: SparkSession, given: str | None, config: dict) -> str | None:
    """Command line, then configuration, then environment; None if no path is given. A given path that isn't there is an error, since
    without it nothing would be filtered."""
    path = given or (config.get("filter") or {}).get("scan_results") or os.environ.get("SCAN_RESULTS")
    if path and not files.exists(spark, path):
        raise FileNotFoundError(f"no verdicts at {path}")
    return path or None


def run_normalize(spark: SparkSession, a: argparse.Namespace, config: dict) -> dict:
    records, more = readers.json_lines(spark, a.source), {}
    path = verdict_path(spark, a.verdicts, config)
    if path:
        index = readers.verdict_index(readers.with_ordinal(readers.csv_rows(spark, path)), [F.col("ord")])
        index, small = verdicts.counted_index(index)
        judged = verdicts.judge(records.where("skill_id is not null and skill_id != ''"), index, verdicts.Policy.of(config.get("filter")), small)
        writers.write_ids(verdicts.excluded_ids(judged), "skill_id", a.out + "_excluded_ids", [F.col("skill_id")])
        more = {"filter": verdicts.report(judged).first().asDict()}
        records = judged.where("keep").select(*records.columns)
    run = config.get("runtime", {})
    rows = normalize.normalize(records, int(run.get("max_package_file_chars", normalize.FILE_CHARS)), int(run.get("max_concat_chars", normalize.CONCAT_CHARS)))
    writers.write_version(normalize.record_sha1(rows), a.out)
    out = spark.read.parquet(a.out)
    writers.write_ids(out, "skill_id", a.out + "_skill_ids", [F.col("skill_id")])
    return {**normalize.report(out).first().asDict(), **more}


def _reviewed(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    rows = readers.with_ordinal(readers.csv_rows(spark, a.reviewed))
    return challenge.first_rows(rows, a.limit, [F.col("ord")]).drop("ord")


def _packages(spark: SparkSession, root: str) -> DataFrame:
    return challenge.canonical_of(readers.packages(readers.directory_files(spark, root)), F.col("package_dir")).drop("package_dir")


def run_eval(spark: SparkSession, a: argparse.Namespace) -> dict:
    """Canonical records with their labels (``canonical``), and evaluation rows (``eval``)."""
    reviewed, canonical = cut(_reviewed(spark, a)), cut(_packages(spark, a.source))
    writers.write_json_lines(challenge.with_labels(canonical.drop("has_md"), reviewed), f"{a.out}/canonical")
    rows = challenge.eval_rows(reviewed, challenge.skills_of(canonical))
    if a.format == "csv":
        writers.write_csv(rows, f"{a.out}/eval")
        rows = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(f"{a.out}/eval")
    else:
        writers.write_version(rows, f"{a.out}/eval")
        rows = spark.read.parquet(f"{a.out}/eval")
    dist = {c: {str(r[0]): r[1] for r in rows.groupBy(c).count().collect()} for c in ("overall_class", "alignment_class")}
    missing = reviewed.join(canonical.select("skill_id"), "skill_id", "left_anti").count()
    return {**writers.counts(rows), **dist, "by_source_reviewed": {r["source"]: r["rows"] for r in challenge.source_counts(reviewed.select(challenge.source_of(F.col("source")).alias("source"))).collect()}, "missing_package": missing}


def run_sft(spark: SparkSession, a: argparse.Namespace, config: dict) -> dict:
    """Classifier rows (``classifier``) and chat rows (``chat``)."""
    reviewed, skills = cut(_reviewed(spark, a)), cut(challenge.skills_of(_packages(spark, a.source)))
    text = config.get("sft") or {}
    rows = challenge.classifier_rows(reviewed, skills, text.get("instruction", ""), text.get("normalized_version", "v1"), a.out.rstrip("/").rsplit("/", 1)[-1])
    writers.write_version(rows, f"{a.out}/classifier")
    rows = spark.read.parquet(f"{a.out}/classifier")
    writers.write_json_lines(challenge.chat_rows(rows, text.get("system", SYSTEM), text.get("template", TEMPLATE)), f"{a.out}/chat")
    files.remove_stale(spark, a.out, ["classifier_train", "classifier_val", "chat_train", "chat_val"])
    skipped = {str(r["reason"]): r["n"] for r in challenge.outcome(reviewed, skills).where("reason is not null").groupBy("reason").agg(F.count(F.lit(1)).alias("n")).collect()}
    return {**writers.counts(rows), "skipped": skipped, "purpose": "eval_only"}


def run_split(spark: SparkSession, a: argparse.Namespace) -> dict:
    """Raw canonical lines outside or inside a hold-out; what isn't in the corpus is made from packages, in the order of the list."""
    lines = readers.json_lines_tolerant(spark, a.source)
    wanted = readers.with_ordinal(readers.csv_rows(spark, a.ids)).where("skill_id is not null and skill_id != ''")
    rows = lines.where(~F.col("bad")).select("value", F.col("record.skill_id").alias("skill_id"), F.monotonically_increasing_id().alias("_at"), F.input_file_name().alias("_file"))
    bad = lines.where("bad").count()
    if a.stage == "split-train":
        challenge.train_part(rows, wanted).select("value").write.mode("errorifexists").text(a.out)
        kept = spark.read.text(a.out).count()
        return {"rows": kept, "held_out": lines.count() - bad - kept, "malformed": bad}
    first = wanted.groupBy("skill_id").agg(F.min("ord").alias("ord"))
    found = cut(challenge.challenge_part(rows, first, [F.col("_file"), F.col("_at")]).select("skill_id", "value"))
    local = _packages(spark, a.packages) if a.packages else None
    made = found.limit(0) if local is None else local.select("skill_id", writers.json_text(local.drop("has_md")).alias("value"))
    both = challenge.fill_missing(found, made, first)
    both.orderBy("ord").select("value").write.mode("errorifexists").text(a.out)
    n = spark.read.text(a.out).count()
    return {"rows": n, "from_canonical": found.count(), "local": n - found.count(), "missing": first.count() - n, "malformed": bad}


def run_restore(spark: SparkSession, a: argparse.Namespace) -> dict:
    """Copies what packages of collected skills lack from the store ``<in>/<skill_id>/files``."""
    rows = readers.csv_rows(spark, a.reviewed).where(F.lower(F.coalesce("source", F.lit(""))) == "collected").select("skill_id").distinct()
    pairs = rows.select(F.concat(F.lit(a.source.rstrip("/") + "/"), "skill_id", F.lit("/files")).alias("src"), F.concat(F.lit(a.out.rstrip("/") + "/"), "skill_id").alias("dst"))
    return writers.copy_missing(pairs, a.dry_run).agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("copied", "kept", "missing", "bytes"))).first().asDict()


def _versions(given: list[str]) -> dict[str, list[str]]:
    out: dict[str, list[str]] = {}
    for g in given:
        family, _, names = g.partition("=")
        if family not in families.FAMILIES or not names:
            raise ValueError(f"{g!r} is no family=version")
        out.setdefault(family, []).append(names)
    return out


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="millrace")
    p.add_argument("stage", choices=STAGES)
    p.add_argument("--in", dest="source", required=True)
    for name in ("out", "config", "verdicts", "ids", "reviewed", "packages", "model-registry", "model-key"):
        p.add_argument(f"--{name}")
    p.add_argument("--versions", nargs="*", default=[])
    p.add_argument("--k", type=int, default=3)
    p.add_argument("--rows", type=int, default=0)
    p.add_argument("--limit", type=int, default=0)
    p.add_argument("--order", choices=["hash", "mt"], default="hash")
    p.add_argument("--format", choices=["parquet", "csv"], default="parquet")
    p.add_argument("--dry-run", action="store_true")
    a = p.parse_args(argv)
    need = {"out": a.stage not in ("stats", "stats-all", "scrub-all"), "ids": a.stage in ("scrub", "scrub-all", "split-train", "split-challenge"), "reviewed": a.stage in ("eval", "sft", "restore")}
    for name, asked in need.items():
        if asked and not getattr(a, name):
            p.error(f"--{name} is required")
    config = readers.load_config(a.config) if a.config else {}
    copies = (config.get("paths") or {}).get("manifests_root")
    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    prepare(spark)
    if a.stage == "stats-all":
        tree = families.report(spark, a.source, _versions(a.versions))
        print(families.report_text(tree))
        if a.out:
            files.write_json(spark, tree, a.out)
        return
    if a.stage == "scrub-all":
        bad = readers.csv_rows(spark, a.ids)
        for family, pairs in _versions(a.versions).items():
            for pair in pairs:
                old, _, new = pair.partition(":")
                print(family, old, new, families.scrub_version(spark, a.source, family, old, new, bad, copies)["totals"])
        return
    if a.stage == "restore":
        print(run_restore(spark, a))
        return
    if a.stage in ("normalize", "eval", "sft", "split-train", "split-challenge"):
        done = run_normalize(spark, a, config) if a.stage == "normalize" else run_eval(spark, a) if a.stage == "eval" else run_sft(spark, a, config) if a.stage == "sft" else run_split(spark, a)
        writers.finish(spark, a.out, a.stage, a.source, done, copies)
        return
    rows = spark.read.parquet(a.source)
    if a.stage == "stats":
        rows = stats.family_totals(rows, tuple(c for c in ("stage", "split", "label") if c in rows.columns))
        cols = rows.columns
        print(stats.table_text(rows.orderBy(*cols).collect(), cols))  # levels of a few codes, not of rows
        return
    more: dict = {}
    if a.stage == "phase1":
        writers.write_version(samples.phase1(rows), a.out, ["stage", "split"])
        out = spark.read.parquet(a.out)
        more = {"emitted": samples.emit_counts(rows).first().asDict(), "sections": [r.asDict() for r in samples.section_sizes(out).orderBy("stage", "split").collect()]}
    elif a.stage == "variants":
        writers.write_version(variants.variants(rows), a.out, ["stage", "split", "label"])
        more = {"donor_pools": [r.asDict() for r in variants.pool_sizes(rows).orderBy("stage", "pool").collect()]}
    elif a.stage == "rewrite":
        model = readers.model_path(files.read_json(spark, a.model_registry), a.model_key) if a.model_registry else "flip"
        done = readers.done_keys(spark, a.out)
        tried = cut(spans.attempts(readers.positives(rows), a.k, model=model.rstrip("/").rsplit("/", 1)[-1], done=done))
        writers.append(spans.emitted(tried), a.out)
        more = {"outcomes": identifiers.outcome_counts(tried)}
    elif a.stage == "identify":
        tried = cut(identifiers.attempts(readers.positives(rows), a.k))
        writers.write_version(identifiers.emitted(tried), a.out, ["stage", "split"])
        more = {"outcomes": identifiers.outcome_counts(tried)}
    elif a.stage == "balance":
        view = lambda v: balance.balanced(rows, v, cap=a.rows, order=a.order).withColumn("view", F.lit(v))
        writers.write_version(view("cpt").unionByName(view("contrastive"), allowMissingColumns=True), a.out, ["view", "stage", "split"])
        more = {"targets": {v: [r.asDict() for r in balance.targets(rows, v, a.rows).collect()] for v in balance.VIEWS}}
    elif a.stage == "pairs":
        writers.write_version(balance.pairs(rows), a.out, ["anchor_stage", "split"])
        more = {"unpaired": [r.asDict() for r in balance.unpaired(rows).collect()]}
    elif a.stage == "add-columns":
        writers.write_version(challenge.add_columns(rows), a.out)
    else:
        bad = readers.csv_rows(spark, a.ids).select("skill_id")
        kept = balance.scrub(rows, bad, ["skill_id", "candidate_skill_id"])
        writers.write_version(balance.scrub_donors(kept, bad) if "source_skill_ids" in rows.columns else balance.scrub(kept, bad, ["anchor_skill_id"]), a.out)
        more = {"total": rows.count()}
    writers.finish(spark, a.out, a.stage, a.source, {**writers.counts(spark.read.parquet(a.out)), **more}, copies)


if __name__ == "__main__":
    main()
