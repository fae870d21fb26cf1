"""Every registered query against DuckDB on the same files: names, types and values."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as contract
from dayferry.workload.oracles import ORACLES
from dayferry.workload.queries import QUERIES
from dayferry.workload.standins import SCHEMAS, table

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

TYPES = {
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "decimal(18,4)": "DECIMAL(18,4)",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    yield con
    con.close()


def _value(x):
    return "nan" if isinstance(x, float) and math.isnan(x) else x


def _rows(rows, names):
    order = sorted(range(len(names)), key=names.__getitem__)
    return Counter(tuple(_value(r[i]) for i in order) for r in rows)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    relation = duck.execute(ORACLES[name])
    columns = {d[0]: str(d[1]) for d in relation.description}
    assert {n: TYPES[t] for n, t in df.dtypes} == columns
    expected = _rows(relation.fetchall(), list(columns))
    assert expected
    assert _rows(df.collect(), df.columns) == expected


@pytest.mark.parametrize("name", sorted(SCHEMAS))
def test_declared_schemas(spark, sf_dir, name):
    declared = table(spark, sf_dir, name).schema
    assert spark.read.parquet(f"{sf_dir}/{name}.parquet").schema == declared


def test_entry(spark):
    assert contract.entry(spark).count() > 0
