"""Queries that SQL can state, against DuckDB on the smallest tables."""

import os

import duckdb
import pytest

from strataforge.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    got, want = QUERIES[name](spark, SF), con.sql(ORACLES[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)

    def plain(rows):
        return sorted(str([round(float(v), 5) if isinstance(v, float) else v for v in r]) for r in rows)

    place = [want.columns.index(c) for c in columns]
    assert plain([r[c] for c in columns] for r in got.collect()) == plain([r[k] for k in place] for r in want.fetchall())
