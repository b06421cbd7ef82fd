"""Small files and paths on any file system that Spark reaches, by Hadoop's own calls on the driver."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    system, p = _system(spark, path)
    return system.exists(p)


def read_text(spark: SparkSession, path: str) -> str:
    system, p = _system(spark, path)
    stream = system.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    system, p = _system(spark, path)
    stream = system.create(p, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()


def read_json(spark: SparkSession, path: str) -> dict:
    return json.loads(read_text(spark, path))


def write_json(spark: SparkSession, tree: dict, path: str) -> None:
    write_text(spark, path, json.dumps(tree, indent=2, sort_keys=True, ensure_ascii=False, default=str) + "\n")


def remove_stale(spark: SparkSession, folder: str, names: list[str]) -> list[str]:
    """Removes what older builds left in a folder; returns the names that were there."""
    gone = []
    for n in names:
        system, p = _system(spark, f"{folder}/{n}")
        if system.exists(p):
            system.delete(p, True)
            gone.append(n)
    return gone


def data_files(spark: SparkSession, folder: str) -> DataFrame:
    """``(path, size_bytes, sha256)`` of each data file below a folder, partition folders included; hashed by the executors. Files
    whose names begin with an underscore or a dot are none."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return files.select("path", F.col("length").alias("size_bytes"), F.sha2("content", 256).alias("sha256"))
