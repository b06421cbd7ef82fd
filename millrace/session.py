"""Session settings, the shared folder, and shipping of this package to executors."""

from __future__ import annotations

import os
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and characters up to which a one-column key set may be broadcast.
BROADCAST_ROWS, BROADCAST_CHARS = 1_000_000, 64_000_000


def local_session(cpus: int | str = "*", memory: str = "8g", partitions: int = 8) -> SparkSession:
    """A session for tests and the bench; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("millrace")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def prepare(spark: SparkSession) -> None:
    """Checkpoint folder and package for the executors; idempotent per context.

    The folder is the cluster's ``spark.checkpoint.dir``. Only where that is unset, as in tests on one
    machine, a temporary folder is used; a cluster without the setting is refused, because a folder of one
    machine is not shared.
    """
    sc = spark.sparkContext
    local = sc.master.startswith("local") and not sc.master.startswith("local-cluster")
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        folder = sc.getConf().get("spark.checkpoint.dir")
        if folder is None and not local:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="millrace-"))
    if not local and getattr(sc, "_millrace_shipped", None) is None:
        sc.addPyFile(_package_zip())
        sc._millrace_shipped = True


def _package_zip() -> str:
    root = Path(__file__).resolve().parent
    to = os.path.join(tempfile.mkdtemp(prefix="millrace-"), "millrace.zip")
    with zipfile.ZipFile(to, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, str(p.relative_to(root.parent)))
    return to


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there (survives lost executors)."""
    prepare(df.sparkSession)
    return df.checkpoint(eager=True)


def is_small(keys: DataFrame, most: int = BROADCAST_ROWS) -> bool:
    """Whether a table is small enough to broadcast, by its counted rows and the characters of its text columns; one pass."""
    texts = [f.name for f in keys.schema.fields if f.dataType.simpleString() in ("string", "binary")]
    size = sum((F.coalesce(F.sum(F.length(c)), F.lit(0)) for c in texts), F.lit(0))
    rows, chars = keys.agg(F.count(F.lit(1)), size).first()
    return rows <= most and chars <= BROADCAST_CHARS


def keep_keys(df: DataFrame, keys: DataFrame, on: str | list[str], most: int = BROADCAST_ROWS, how: str = "left_semi") -> DataFrame:
    """Semi (or anti) join against a materialised key table: broadcast if its counted rows and bytes are few, else shuffled.

    ``keys`` should be a cut table, as it is counted first. Nothing is dropped in either way; the count only picks
    the join strategy.
    """
    return df.join(F.broadcast(keys) if is_small(keys, most) else keys, on, how)


#: Rows of one key beyond which its rows are spread over ``SALTS`` tasks by :func:`salted_join`.
HOT_ROWS, SALTS = 1_000_000, 64


def salted_join(many: DataFrame, one: DataFrame, on: list[str], spread: str, hot_rows: int = HOT_ROWS, salts: int = SALTS) -> DataFrame:
    """Inner join of ``many`` with ``one``, which has few rows per key, where a key may hold a great part of ``many``.

    Keys with more than ``hot_rows`` rows are found by a count; there are at most rows / ``hot_rows`` of them. Their rows are
    spread by a hash of the column ``spread``, and their rows of ``one`` are repeated ``salts`` times; all other keys are joined as usual."""
    hot = cut(many.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows).select(*on, F.lit(True).alias("_hot")))
    if hot.isEmpty():
        return many.join(one, on)
    known = lambda d: d.join(F.broadcast(hot) if is_small(hot) else hot, on, "left")
    x = known(many).withColumn("_salt", F.when(F.col("_hot"), F.pmod(F.xxhash64(spread), F.lit(salts))).otherwise(F.lit(0).cast("bigint")))
    y = known(one).withColumn("_salt", F.explode(F.when(F.col("_hot"), F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))).otherwise(F.array(F.lit(0).cast("bigint"))))).drop("_hot")
    return x.drop("_hot").join(y, [*on, "_salt"]).drop("_salt")


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def remove(path: str) -> None:
    shutil.rmtree(path, ignore_errors=True)
