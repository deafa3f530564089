"""Every registered query of this part against its SQL, on the smallest tables."""

import os

import duckdb
import pytest

from strataforge.plans.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return con


def plain(rows):
    def cell(v):
        return round(float(v), 4) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)

    return sorted(str([cell(v) for v in r]) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, tables, name):
    got = QUERIES[name](spark, SF)
    want = tables.sql(ORACLES[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    mine = [[r[c] for c in columns] for r in got.collect()]
    order = [want.columns.index(c) for c in columns]
    assert plain(mine) == plain([[r[k] for k in order] for r in want.fetchall()])


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).first()["reconciled"]
    assert set(ORACLES) <= set(__spark_entry__.queries())
