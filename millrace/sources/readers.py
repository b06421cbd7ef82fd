"""Scans: JSON lines (strict and tolerant), CSV, Parquet projections, directory trees, done keys, configuration."""

from __future__ import annotations

import json
import os
import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

FILES = "array<struct<path:string,content:string,size_bytes:bigint,truncated:boolean>>"
CANONICAL = (
    "skill_id string, first_layer struct<name:string,description:string>, "
    "skill_md struct<description_section:struct<found:boolean,heading:string,content:string>,non_description:string>, "
    f"package_files {FILES}"
)


def json_lines(spark: SparkSession, path: str, schema: str = CANONICAL) -> DataFrame:
    """Strict scan: blank lines are skipped, a malformed line fails the job. Missing fields are null."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def json_lines_tolerant(spark: SparkSession, path: str, schema: str = CANONICAL, key: str | None = "skill_id") -> DataFrame:
    """``value`` (the raw line) and ``record``, null for a malformed line; ``bad`` also marks records without the key.
    Blank lines are skipped. Callers count with ``count_if(bad)`` and keep raw lines as they were."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    parsed = T.StructType(T._parse_datatype_string(schema).fields + [T.StructField("_bad", T.StringType())])
    rec = F.from_json("value", parsed, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    out = lines.withColumn("record", rec)
    bad = F.col("record").isNull() | F.col("record._bad").isNotNull()
    if key:
        bad = bad | F.coalesce(F.col(f"record.{key}") == "", F.lit(True))
    return out.withColumn("bad", bad).withColumn("record", F.when(F.col("record._bad").isNull(), F.col("record").dropFields("_bad")))


def csv_rows(spark: SparkSession, path: str) -> DataFrame:
    """Header, quoted line breaks, all columns strings."""
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)


def with_ordinal(df: DataFrame, name: str = "ord") -> DataFrame:
    """Input order as a number: file by file, row by row. One task reads a file in order; files sort by their path."""
    return df.withColumn("_path", F.input_file_name()).withColumn("_row", F.monotonically_increasing_id()).withColumn(name, F.struct("_path", "_row")).drop("_path", "_row")


def verdict_index(rows: DataFrame, order: list[Column]) -> DataFrame:
    """One verdict per id: ids trimmed, blank ids left out, classes trimmed and in upper case, the last row by ``order``
    wins (ties by the classes themselves, so that the result is defined). Null classes become empty.

    The window's group is one id's verdicts; where a single id may own a great part of the rows, partial maxima
    serve: a max over a struct is combined map-side."""
    cls = [c for c in rows.columns if c.endswith("_class")]
    norm = rows.select(F.trim("skill_id").alias("skill_id"), *(F.upper(F.trim(F.coalesce(c, F.lit("")))).alias(c) for c in cls), F.struct(*order).alias("_ord"))
    norm = norm.where("skill_id is not null and skill_id != ''")
    best = norm.groupBy("skill_id").agg(F.max(F.struct("_ord", *cls)).alias("v"))
    return best.select("skill_id", *(F.col(f"v.{c}").alias(c) for c in cls))


def parquet_columns(spark: SparkSession, path: str, columns: list[str]) -> DataFrame | None:
    """Projection on the columns that exist; None for a missing path."""
    try:
        df = spark.read.parquet(path)
    except AnalysisException:
        return None
    return df.select([c for c in columns if c in df.columns])


def positives(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows labelled positive, with those of the columns that exist."""
    rows = df.where(F.lower(F.trim("label")) == "positive")
    return rows.select([c for c in columns if c in df.columns]) if columns else rows


def done_keys(spark: SparkSession, path: str) -> DataFrame:
    """Distinct ``(stage, anchor_skill_id, target_layer)`` of an output; empty for a missing or unreadable one."""
    try:
        df = spark.read.parquet(path).select("stage", "anchor_skill_id", "target_layer")
    except AnalysisException:
        df = spark.createDataFrame([], "stage string, anchor_skill_id string, target_layer string")
    return df.distinct()


def not_done(tasks: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    return tasks.join(done.select(keys).distinct(), keys, "left_anti")


def row_count(df: DataFrame) -> int:
    """Reads no columns of a Parquet table."""
    return df.count()


def line_count(spark: SparkSession, path: str) -> int:
    return spark.read.text(path).where("value != ''").count()


#: Bytes of a file that are read as text.
FILE_BYTES = 200_000


def directory_files(spark: SparkSession, root: str) -> DataFrame:
    """``(package_dir, path, content, size_bytes, truncated)`` of all files below ``root``: the first part of the
    path is the package, invalid UTF-8 is replaced, only the first bytes are decoded."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "length", "content")
    empty = [(p, 0, bytearray()) for p in _empty_files(spark, root)]  # Spark's file scan passes over these
    if empty:
        raw = raw.unionByName(spark.createDataFrame(empty, raw.schema))
    base = os.path.abspath(root.removeprefix("file://")).rstrip("/")
    rel = F.regexp_replace("path", "^(?:file:)?/*" + re.escape(base.lstrip("/")) + "/", "")
    parts = F.split(rel, "/")
    text = F.make_valid_utf8(F.substring("content", 1, FILE_BYTES).cast("string"))
    return raw.select(parts[0].alias("package_dir"), F.array_join(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(1))), "/").alias("path"), text.alias("content"), F.col("length").alias("size_bytes"), (F.col("length") > FILE_BYTES).alias("truncated")).where("path != ''")


def _empty_files(spark: SparkSession, root: str) -> list[str]:
    """Paths of empty files, by the same listing of metadata that a scan makes."""
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(root)
    found, out = path.getFileSystem(sc._jsc.hadoopConfiguration()).listFiles(path, True), []
    while found.hasNext():
        f = found.next()
        if f.getLen() == 0:
            out.append(f.getPath().toString())
    return out


def packages(files: DataFrame) -> DataFrame:
    """One row per package: ``skill_md`` (SKILL.md, else skill.md, else empty) and its other files, by path parts. Files of
    one package are gathered, which a package's own size bounds."""
    top = F.lower("path").isin("skill.md", "manifest.json") & F.col("path").isin("SKILL.md", "skill.md", "manifest.json")
    keyed = files.withColumn("parts", F.split("path", "/"))
    md = F.max(F.when(F.col("path") == "SKILL.md", F.col("content"))), F.max(F.when(F.col("path") == "skill.md", F.col("content")))
    rest = F.array_sort(F.collect_list(F.when(~top, F.struct("parts", "path", "content", "size_bytes", "truncated"))))
    out = keyed.groupBy("package_dir").agg(F.coalesce(*md, F.lit("")).alias("md"), F.coalesce(*md).isNotNull().alias("has_md"), rest.alias("f"))
    return out.select("package_dir", F.regexp_replace("md", "\r\n?", "\n").alias("skill_md"), "has_md", F.transform("f", lambda x: x.dropFields("parts")).alias("package_files"))


# --- configuration (driver) ----------------------------------------------------------------------------------------

_VAR = re.compile(r"\$\{(\w+)(?::-([^}]*))?\}")


def interpolate(value, env: dict[str, str] | None = None):
    """``${VAR}`` and ``${VAR:-default}`` in all strings of a tree; a variable that is set but empty gives the empty string."""
    env = os.environ if env is None else env
    if isinstance(value, dict):
        return {k: interpolate(v, env) for k, v in value.items()}
    if isinstance(value, list):
        return [interpolate(v, env) for v in value]
    if isinstance(value, str):
        return _VAR.sub(lambda m: env.get(m[1], m[2] if m[2] is not None else ""), value)
    return value


def load_config(path: str, required: tuple[str, ...] = (), env: dict[str, str] | None = None) -> dict:
    """YAML or JSON; a missing required section is an error."""
    with open(path, encoding="utf-8") as f:
        if path.endswith(".json"):
            tree = json.load(f)
        else:
            import yaml

            tree = yaml.safe_load(f)
    if not isinstance(tree, dict):
        raise ValueError("the configuration must be a mapping")
    missing = [s for s in required if s not in tree]
    if missing:
        raise ValueError(f"missing sections: {', '.join(missing)}")
    return interpolate(tree, env)


def first_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key by an explicit order."""
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def model_path(registry: dict, key: str) -> str:
    """The value of ``key`` anywhere in a tree of model paths, the first in reading order; one that isn't ready is an error."""

    def walk(tree: dict):
        for k, v in tree.items():
            if isinstance(v, dict):
                yield from walk(v)
            elif k == key:
                yield v

    path = next(walk(registry), None)
    if not path or path in ("downloading", "not_available"):
        raise ValueError(f"no path for the model {key!r}")
    return path
