"""Every registered query runs on the smallest tables and equals its SQL where it has one."""

from pathlib import Path

import __spark_entry__ as entry
import duckdb
import pytest

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables here")


def _plain(v):
    if v is None or v != v:
        return "null"
    return repr(round(float(v), 6)) if isinstance(v, float) else repr(float(v)) if isinstance(v, int) and not isinstance(v, bool) else str(v)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for f in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def test_entry(spark):
    assert entry.entry(spark).columns == ["module", "register_name", "difference"]


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, sql, name):
    got = entry.queries()[name](spark, str(DATA))
    rows = got.collect()
    text = entry.oracle_sql().get(name)
    if text is None:
        return
    want = sql.execute(text)
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert _rows(got.columns, rows) == _rows(columns, want.fetchall())
