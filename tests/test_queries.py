"""Every registered query of the library against its SQL, on the smallest tables."""

import math
from pathlib import Path

import pytest

from gridweave.plans import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for f in Path(SF).iterdir():
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def value(v):
    return None if v is None or isinstance(v, float) and math.isnan(v) else v + 0.0 if isinstance(v, float) else v


def key(row):
    return tuple((v is None, v if v is not None else 0) for v in row)


def same(x, y):
    """Equal, or numbers that differ by less than what their last digit was rounded to."""
    return x == y or isinstance(x, float) and isinstance(y, (int, float)) and x == pytest.approx(y, rel=1e-6, abs=2e-4)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    mine = sorted((tuple(value(r[c]) for c in columns) for r in df.collect()), key=key)
    other = duck.execute(SQL[name])
    names = [c[0] for c in other.description]
    assert sorted(names) == columns
    theirs = sorted((tuple(value(r[names.index(c)]) for c in columns) for r in other.fetchall()), key=key)
    assert len(mine) == len(theirs)
    for a, b in zip(mine, theirs):
        assert all(same(x, y) for x, y in zip(a, b)), (a, b)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs_without_sql(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 6
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
