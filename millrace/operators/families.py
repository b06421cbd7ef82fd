"""The three dataset families (pre-training samples, variants and pairs, classifier and chat rows): scrubbing a hold-out into new versions, and reports.

Versions are folders ``<root>/<family>/<version>``: a partitioned Parquet table for ``full_cpt`` and ``pl_hcl``; a Parquet table
``classifier`` and JSON lines ``chat``, either of which may be missing, for ``sft``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import balance, stats
from millrace.sources import files, writers

FAMILIES = ("full_cpt", "pl_hcl", "sft")
_PARTS = ("stage", "split", "label")


def scrubbed(rows: DataFrame, family: str, bad: DataFrame) -> DataFrame:
    """Rows of a family without the held-out ids: by id, by anchor and donors, or by id and candidate."""
    if family == "full_cpt":
        return balance.scrub(rows, bad, ["skill_id"])
    if family == "pl_hcl":
        return balance.scrub_donors(rows, bad) if "source_skill_ids" in rows.columns else balance.scrub(rows, bad, ["anchor_skill_id"])
    return balance.scrub(rows, bad, ["skill_id", "candidate_skill_id"])


def scrub_version(spark: SparkSession, root: str, family: str, old: str, new: str, bad: DataFrame, copies: str | None = None) -> dict:
    """Writes a version of a family without the held-out ids, with statistics, manifest and registry. Returns kept, dropped and
    total per table and in all; malformed chat lines are dropped and not counted."""
    source, out = f"{root.rstrip('/')}/{family}/{old}", f"{root.rstrip('/')}/{family}/{new}"
    if not files.exists(spark, source):
        raise FileNotFoundError(source)
    if files.exists(spark, out):
        raise FileExistsError(out)
    tables, bad = {}, bad.select("skill_id").where("skill_id is not null").distinct()
    if family == "sft":
        if files.exists(spark, f"{source}/classifier"):
            rows = spark.read.parquet(f"{source}/classifier")
            writers.write_version(scrubbed(rows, family, bad), f"{out}/classifier")
            tables["classifier"] = (rows.count(), spark.read.parquet(f"{out}/classifier").count())
        if files.exists(spark, f"{source}/chat"):
            lines = spark.read.text(f"{source}/chat").where(F.trim("value") != "")
            balance.scrub_json_lines(lines, bad).write.mode("errorifexists").text(f"{out}/chat")
            tables["chat"] = (lines.where(F.try_parse_json("value").isNotNull()).count(), spark.read.text(f"{out}/chat").count())
    else:
        rows = spark.read.parquet(source)
        writers.write_version(scrubbed(rows, family, bad), out, [c for c in _PARTS if c in rows.columns] or None)
        tables["rows"] = (rows.count(), spark.read.parquet(out).count())
    per = {t: {"total": n, "kept": k, "dropped": n - k} for t, (n, k) in tables.items()}
    totals = {c: sum(t[c] for t in per.values()) for c in ("total", "kept", "dropped")}
    writers.finish(spark, out, "scrub", source, {"rows": totals["kept"], "totals": totals, "per_table": per}, copies, derived_from=old, scrubbed_ids=bad.count())
    return {"totals": totals, "per_table": per}


def version_report(spark: SparkSession, root: str, family: str, version: str) -> dict | None:
    """Rows by stage and split, labels by split, and the total of a version; None if it isn't there."""
    path = f"{root.rstrip('/')}/{family}/{version}"
    if not files.exists(spark, path):
        return None
    out: dict = {"version": version, "tables": {}, "label_dist": {}}
    parts = {"rows": path} if family != "sft" else {t: f"{path}/{t}" for t in ("classifier", "chat") if files.exists(spark, f"{path}/{t}")}
    for name, p in parts.items():
        if name == "chat":
            out["tables"][name] = [{"rows": spark.read.text(p).where("value != ''").count()}]
            continue
        rows = spark.read.parquet(p)
        levels = tuple(c for c in ("stage", "split") if c in rows.columns)
        counted = rows.groupBy(*levels).agg(F.count(F.lit(1)).alias("rows")).collect()  # a row per code
        out["tables"][name] = sorted((r.asDict() for r in counted), key=lambda r: tuple(str(r[c]) for c in levels))
        if "label" in rows.columns:
            by = [c for c in ("split",) if c in rows.columns]
            for r in rows.groupBy(*by, "label").count().collect():
                out["label_dist"].setdefault(str(r["split"]) if by else "all", {})[str(r["label"])] = r["count"]
    out["total_rows"] = sum(r["rows"] for t in out["tables"].values() for r in t)
    return out


def report(spark: SparkSession, root: str, versions: dict[str, list[str]]) -> dict:
    """Reports of the given versions by family; versions that aren't there are left out."""
    return {f: [r for v in versions.get(f, []) if (r := version_report(spark, root, f, v))] for f in FAMILIES}


def report_text(tree: dict) -> str:
    """Plain tables of a report."""
    out = []
    for family, versions in tree.items():
        rows = [{"version": v["version"], "table": t, "stage": r.get("stage", ""), "split": r.get("split", ""), "rows": r["rows"]} for v in versions for t, rs in v["tables"].items() for r in rs]
        rows += [{"version": v["version"], "table": "total", "stage": "", "split": "", "rows": v["total_rows"]} for v in versions]
        if rows:
            out.append(f"== {family} ==\n" + stats.table_text(rows, ["version", "table", "stage", "split", "rows"]))
    return "\n\n".join(out)
