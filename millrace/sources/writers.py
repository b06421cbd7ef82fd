"""Sinks: versioned Parquet tables, JSON lines, id lists, statistics, manifests, registries, tree copies."""

from __future__ import annotations

import hashlib
import os
import shutil
from collections.abc import Iterator
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources import files


def write_version(df: DataFrame, path: str, by: list[str] | None = None, codec: str = "zstd") -> None:
    """A new version; an existing path is refused. ``by`` fans rows out into partition folders."""
    w = df.write.mode("errorifexists").option("compression", codec)
    (w.partitionBy(*by) if by else w).parquet(path)


def append(df: DataFrame, path: str, codec: str = "zstd") -> None:
    """Adds rows, so that a resumed run keeps what it had."""
    df.write.mode("append").option("compression", codec).parquet(path)


def json_text(df: DataFrame) -> Column:
    """A row as JSON, keys sorted, nulls kept."""
    return F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"})


def write_json_lines(df: DataFrame, path: str) -> None:
    df.select(json_text(df).alias("value")).write.mode("errorifexists").text(path)


def write_ids(df: DataFrame, column: str, path: str, order: list[Column]) -> None:
    """One id per line in a given order. Sorting ranges the ids over partitions; files follow each other by name."""
    df.orderBy(*order).select(F.col(column).cast("string").alias("value")).write.mode("errorifexists").text(path)


def write_csv(df: DataFrame, path: str) -> None:
    """A table as CSV with a header, for readers without Parquet."""
    df.write.mode("errorifexists").option("header", True).option("escape", '"').csv(path)


def file_sha256(path: str) -> str:
    h = hashlib.sha256()
    with open(path, "rb") as f:
        for block in iter(lambda: f.read(1 << 20), b""):
            h.update(block)
    return h.hexdigest()


#: Columns by which the rows of a written table are counted, where it has them.
LEVELS = ("view", "stage", "split", "anchor_stage", "label", "pair_kind", "source")


def counts(rows: DataFrame) -> dict:
    """Number of rows, and by each of the table's code columns; a few rows reach the driver."""
    out = {"rows": rows.count()}
    for c in LEVELS:
        if c in rows.columns:
            out[f"by_{c}"] = {str(r[0]): r[1] for r in rows.groupBy(c).count().collect()}
    return out


def write_manifest(spark: SparkSession, folder: str, name: str, version: str, stats: dict, now: str | None = None, **more) -> dict:
    """``_stats.json`` and ``_manifest.json`` beside the data (names that table readers pass over), with the size and SHA-256 of each
    data file. One row per file reaches the driver."""
    base = folder.rstrip("/")
    listed = files.data_files(spark, base).orderBy("path").collect()
    cut = lambda p: p.split("/" + base.rsplit("/", 1)[-1] + "/", 1)[-1]
    out = {"dataset_name": name, "output_version": version, "created_at": now or datetime.now(timezone.utc).isoformat(timespec="seconds"), "output_dir": base, "stats": stats, "files": {cut(r["path"]): {"size_bytes": r["size_bytes"], "sha256": r["sha256"]} for r in listed}, **more}
    files.write_json(spark, stats, f"{base}/_stats.json")
    files.write_json(spark, out, f"{base}/_manifest.json")
    return out


def register(spark: SparkSession, path: str, name: str, entry: dict) -> list[dict]:
    """Adds or replaces a version in a registry file, sorted by creation."""
    rows = files.read_json(spark, path)["versions"] if files.exists(spark, path) else []
    rows = sorted([r for r in rows if r["version"] != entry["version"]] + [entry], key=lambda r: (r.get("created_at", ""), r["version"]))
    files.write_json(spark, {"dataset_name": name, "versions": rows}, path)
    return rows


def finish(spark: SparkSession, folder: str, stage: str, source: str, stats: dict, copies: str | None = None, **more) -> dict:
    """What every stage writes after its data: statistics, manifest, a copy of the manifest below ``copies``, and its entry in the registry
    of the dataset. The folder is ``<dataset>/<version>``."""
    dataset, version = (["", *folder.rstrip("/").split("/")])[-2:]
    m = write_manifest(spark, folder, dataset, version, stats, phase_name=stage, input_path=source, **more)
    if copies:
        files.write_json(spark, m, f"{copies.rstrip('/')}/{dataset}__{version}.json")
    top = folder.rstrip("/").rsplit("/", 1)[0] if "/" in folder.rstrip("/") else "."
    register(spark, f"{top}/registry.json", dataset, {"version": version, "created_at": m["created_at"], "input_path": source, "output_dir": m["output_dir"], "phase_name": stage, "num_output_samples": stats.get("rows"), **more})
    return m


def copy_tree(src: str, to: str, dry_run: bool = False) -> dict[str, int]:
    """Copies a package tree; existing files and top-level SKILL.md, skill.md, manifest.json stay. Counts files and bytes."""
    n = {"copied": 0, "kept": 0, "missing": 0, "bytes": 0}
    if not os.path.isdir(src):
        return {**n, "missing": 1}
    for top, _, names in os.walk(src, followlinks=True):
        rel = os.path.relpath(top, src)
        for name in names:
            if rel == "." and name in ("SKILL.md", "skill.md", "manifest.json"):
                continue
            target = os.path.join(to, rel, name)
            if os.path.exists(target):
                n["kept"] += 1
                continue
            n["copied"] += 1
            n["bytes"] += os.path.getsize(os.path.join(top, name))
            if not dry_run:
                os.makedirs(os.path.dirname(target), exist_ok=True)
                shutil.copy2(os.path.join(top, name), target)
    return n


def copy_missing(pairs: DataFrame, dry_run: bool = False) -> DataFrame:
    """``pairs``: ``src, dst`` of package trees on a file system that all executors share. Each tree is copied by the executor that has its
    row; running it again copies what is missing. Returns ``src, copied, kept, missing, bytes``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([{"src": s, **copy_tree(s, d, dry_run)} for s, d in zip(b["src"], b["dst"])], columns=["src", "copied", "kept", "missing", "bytes"])

    return pairs.select("src", "dst").mapInPandas(run, "src string, copied bigint, kept bigint, missing bigint, bytes bigint")
