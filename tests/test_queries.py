"""Every registered query of the library against its SQL in DuckDB, on the smallest tables."""

import decimal

import duckdb
import pytest

from claimforge.plans import testbed
from claimforge.plans.queries import ORACLES, QUERIES

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    out = duckdb.connect()
    for name in testbed.BASE:
        out.sql(f"CREATE VIEW {name} AS SELECT * FROM '{DIR}/{name}.parquet'")
    return out


def plain(row):
    return str([float(v) if isinstance(v, decimal.Decimal) else v for v in row])


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, DIR)
    columns = sorted(df.columns)
    got = sorted(plain(r) for r in df.select(columns).collect())
    if name in ORACLES:
        want = con.sql(ORACLES[name])
        assert sorted(want.columns) == columns
        at = [want.columns.index(c) for c in columns]
        assert got == sorted(plain([r[k] for k in at]) for r in want.fetchall())
    else:
        assert got


def test_entry_has_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
