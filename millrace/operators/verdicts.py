"""Filtering records by verdicts, and its report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import cut, is_small


@dataclass(frozen=True)
class Policy:
    """Classes that exclude a record, and whether a record without a verdict is kept. An empty list excludes nothing."""

    overall: tuple[str, ...] = ("MALICIOUS", "SUSPICIOUS")
    alignment: tuple[str, ...] = ("MISALIGNED",)
    keep_unscanned: bool = True

    @classmethod
    def of(cls, tree: dict | None) -> Policy:
        """From a configuration section; classes in any case, an unknown action keeps."""
        tree = tree or {}
        names = lambda k, d: tuple(str(x).strip().upper() for x in (tree[k] if tree.get(k) is not None else d))
        return cls(names("exclude_overall_classes", cls.overall), names("exclude_alignment_classes", cls.alignment), str(tree.get("unscanned_action", "keep")).strip().lower() != "drop")


def judge(records: DataFrame, verdicts: DataFrame, policy: Policy, bounded: bool = False) -> DataFrame:
    """Records with the flags ``scanned, by_overall, by_alignment, keep``. ``verdicts`` is an index with one row per id; the
    records' id is compared as it is, so a padded one counts as unscanned. ``bounded`` says that the index was counted and
    is small enough to broadcast; else the join strategy is left to the optimizer."""
    v = verdicts.select("skill_id", F.col("overall_class").alias("_o"), F.col("alignment_class").alias("_a"), F.lit(True).alias("_s"))
    j = records.join(F.broadcast(v) if bounded else v, "skill_id", "left")
    scanned = F.coalesce("_s", F.lit(False))
    o = scanned & F.coalesce(F.col("_o").isin(*policy.overall), F.lit(False))
    a = scanned & F.coalesce(F.col("_a").isin(*policy.alignment), F.lit(False))
    keep = F.when(scanned, ~(o | a)).otherwise(F.lit(policy.keep_unscanned))
    return j.select(*records.columns, scanned.alias("scanned"), o.alias("by_overall"), a.alias("by_alignment"), keep.alias("keep"))


def counted_index(index: DataFrame) -> tuple[DataFrame, bool]:
    """The index, cut, and whether it is small enough to broadcast."""
    index = cut(index)
    return index, is_small(index)


def report(judged: DataFrame) -> DataFrame:
    """One row of counts; records are counted, not distinct ids."""
    n = F.count_if
    drop = ~F.col("keep")
    return judged.agg(
        n(F.col("scanned") & F.col("keep")).alias("kept"),
        n("by_overall").alias("excluded_by_overall"),
        n("by_alignment").alias("excluded_by_alignment"),
        n(F.col("by_overall") | F.col("by_alignment")).alias("excluded_by_either"),
        n(~F.col("scanned") & F.col("keep")).alias("unscanned_kept"),
        n(~F.col("scanned") & drop).alias("unscanned_dropped"),
    )


def excluded_ids(judged: DataFrame) -> DataFrame:
    """Ids excluded by a verdict; unscanned records that were dropped are not among them."""
    return judged.where(F.col("by_overall") | F.col("by_alignment")).select("skill_id")
