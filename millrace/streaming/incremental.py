"""Incremental runs: a stream of new record files through a batch operator, each record once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.session import cut


def run_new(spark: SparkSession, source: str, schema: str, operator: Callable[[DataFrame], DataFrame], out: str, state: str, key: str = "skill_id") -> StreamingQuery:
    """Applies ``operator`` to the records of new JSON-lines files below ``source`` and writes its result to the Parquet table
    ``out``, a folder per batch. Records whose key an earlier batch had are left out: the keys alone are kept in ``out`` + ``_keys`` for that, and
    a batch reads those and not the table. A batch that is run again after a failure writes its own folders anew, so nothing is
    added twice. ``state`` is the stream's checkpoint folder. Ends when all files present are done."""
    seen = out.rstrip("/") + "_keys"

    def add(batch: DataFrame, number: int) -> None:
        rows = batch.where(F.col(key).isNotNull()).dropDuplicates([key])
        try:
            known = spark.read.option("basePath", seen).parquet(seen).where(F.col("batch") != number).select(key)
            rows = rows.join(known, key, "left_anti")
        except AnalysisException:
            pass  # the first batch
        rows = cut(rows)
        operator(rows).write.mode("overwrite").parquet(f"{out}/batch={number}")
        rows.select(key).write.mode("overwrite").parquet(f"{seen}/batch={number}")

    stream = spark.readStream.schema(schema).json(source)
    return stream.writeStream.foreachBatch(add).option("checkpointLocation", state).trigger(availableNow=True).start()


def late_counts(events: DataFrame, time: str, window: str = "1 day", late: str = "7 days", by: str = "event_type") -> DataFrame:
    """Counts per time window with a watermark; works on batches and streams. Rows later than ``late`` are dropped by a stream."""
    rows = events.withWatermark(time, late) if events.isStreaming else events
    return rows.groupBy(F.window(time, window).alias("w"), by).agg(F.count(F.lit(1)).alias("rows")).select(F.col("w.start").alias("start"), by, "rows")
