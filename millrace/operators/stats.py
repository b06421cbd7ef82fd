"""Counts over dataset families."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import is_small


def histogram(rows: DataFrame, column: str) -> DataFrame:
    return rows.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("rows"))


def family_totals(rows: DataFrame, levels: tuple[str, ...] = ("output_version", "stage", "split")) -> DataFrame:
    """Counts of each level and all totals above it (null marks a total, told apart by ``level``)."""
    return rows.rollup(*levels).agg(F.grouping_id().alias("level"), F.count(F.lit(1)).alias("rows"))


def with_domain(counts: DataFrame, domain: DataFrame, on: list[str], column: str = "rows") -> DataFrame:
    """Counts with zeros for combinations of a domain that don't occur."""
    return (F.broadcast(domain) if is_small(domain) else domain).join(counts, on, "left").fillna(0, [column])


def table_text(rows: list, columns: list[str]) -> str:
    """A plain table of collected report rows."""
    cells = [columns, *([("" if r[c] is None else str(r[c])) for c in columns] for r in rows)]
    width = [max(len(r[i]) for r in cells) for i in range(len(columns))]
    line = lambda r: " | ".join(x.ljust(w) for x, w in zip(r, width)).rstrip()
    return "\n".join([line(cells[0]), "-+-".join("-" * w for w in width), *map(line, cells[1:])])
