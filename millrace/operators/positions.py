"""Dense positions inside groups without gathering a group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from millrace.session import cut

_ROW_BITS = 33


def dense_positions(df: DataFrame, group: list[str], order: list[Column], name: str = "pos") -> DataFrame:
    """0-based position of each row in its group by ``order``, which should be total for a defined result.

    Rows are range-partitioned by group and order, numbered inside their partition, and shifted by the counts of the
    partitions before. Only one row per partition and group takes part in the window. A group of a third of all rows is
    spread like any other. Null group values form groups of their own.
    """
    keys = [F.col(c) for c in group]
    ranged = cut(df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order))
    rows = ranged.withColumn("_id", F.monotonically_increasing_id())
    part = F.shiftright("_id", _ROW_BITS)
    rows = rows.withColumns({"_part": part, "_row": F.col("_id") - F.shiftleft(part, _ROW_BITS)}).drop("_id")
    first = rows.groupBy(*group, "_part").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(W.partitionBy(*group).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    shift = first.withColumn("_shift", before - F.col("_first")).drop("_n", "_first")
    shift = shift.withColumnsRenamed({c: f"_g{i}" for i, c in enumerate(group)})
    on = [rows[c].eqNullSafe(shift[f"_g{i}"]) for i, c in enumerate(group)] + [rows["_part"] == shift["_part"]]
    return rows.join(shift, on).select(*df.columns, (F.col("_row") + F.col("_shift")).alias(name))
