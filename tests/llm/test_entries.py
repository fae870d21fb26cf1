"""Queries of the operators against DuckDB, where SQL can express them."""

import duckdb
import pytest

from dayferry.llm.entries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "conversations"):
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    found = con.execute(ORACLES[name])
    columns = [d[0] for d in found.description]
    df = QUERIES[name](spark, sf_dir)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(str, map(tuple, df.select(*columns).collect()))) == sorted(map(str, found.fetchall()))


def test_all_operators():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
