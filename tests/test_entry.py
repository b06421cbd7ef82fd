import __spark_entry__ as e
import pytest


def test_contract(spark):
    q, o = e.queries(), e.oracle_sql()
    assert set(o) <= set(q)
    assert e.entry(spark).count() > 0


def test_core_does_not_need_the_subpackage():
    import pathlib

    root = pathlib.Path(e.__file__).parent / "millrace"
    for p in root.rglob("*.py"):
        if "llm" not in p.relative_to(root).parts:
            assert "millrace.llm" not in p.read_text(), p


@pytest.mark.parametrize("name", ["verdict_filter_report", "clean_text_docs", "donor_assignment_k2", "balanced_contrastive", "scrub_array_donors"])
def test_against_sql(spark, name):
    import os

    import duckdb

    d = e.DATA
    con = duckdb.connect()
    for t in os.listdir(d):
        con.execute(f"create view {t.removesuffix('.parquet')} as select * from '{d}/{t}'")
    a, b = e.queries()[name](spark, d), con.sql(e.oracle_sql()[name])
    cols = sorted(a.columns)
    assert cols == sorted(b.columns)
    assert sorted(map(str, ([r[c] for c in cols] for r in a.collect()))) == sorted(map(str, ([r[b.columns.index(c)] for c in cols] for r in b.fetchall())))
