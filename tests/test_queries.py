"""Every query that has SQL against DuckDB on the smallest tables, where they are."""

import glob
import os

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def cells(rows):
    return sorted(str([round(float(v), 6) if isinstance(v, float) else int(v) if isinstance(v, bool) else v for v in (r[c] for c in sorted(r))]) for r in rows)


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    if not os.path.isdir(SF):
        pytest.skip("no test tables here")
    c = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(n for n in entry.oracle_sql() if not n.startswith("op") and n != "pipeline"))
def test_against_sql(spark, duck, name):
    got = [r.asDict() for r in entry.queries()[name](spark, SF).collect()]
    rel = duck.sql(entry.oracle_sql()[name])
    want = [dict(zip(rel.columns, r, strict=True)) for r in rel.fetchall()]
    assert cells(got) == cells(want)


def test_every_query_is_named_once_and_entry_runs(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    if os.path.isdir(SF):
        assert entry.entry(spark).count() > 0
