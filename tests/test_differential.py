"""Every query with a SQL form must agree with DuckDB on the small tables."""

import pytest

import __spark_entry__ as entry
from tools.oracle_check import digest, duck, type_mismatches
from tests.conftest import SF_SMALL

ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_is_registered_with_a_callable():
    qs = entry.queries()
    assert set(ORACLE) <= set(qs)
    assert all(callable(f) for f in qs.values())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_duckdb(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLE[name])
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    assert not type_mismatches(df.schema, d_cols, [str(t) for t in con.sql(ORACLE[name]).types])
    assert len(rows) == len(d_rows)
    assert digest(df.columns, rows)[0] == digest(d_cols, d_rows)[0]


def test_entry_smoke(spark):
    out = entry.entry(spark).collect()
    assert len(out) == 24
    assert [r.start_hour for r in out] == list(range(24))
