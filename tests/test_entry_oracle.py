"""Entry contract and Spark-vs-DuckDB equality of every registered query
(on the smallest fixture; scripts/oracle_check.py runs the same at sf0.01)."""

import math
import re

import duckdb
import pytest

from conftest import SF001
from __spark_entry__ import entry, oracle_sql, queries

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def test_registry_keys():
    q, s = queries(), oracle_sql()
    assert set(s) <= set(q)
    # Every query of the library has SQL; those of the llm subpackage have tests of their own.
    assert {n for n in set(q) - set(s) if not re.match(r"op\d+_|pipeline$", n)} == set()


def test_entry_flagship(spark):
    df = entry(spark)
    rows = df.collect()
    assert len(rows) == 15
    assert df.columns[:3] == ["Rank", "Pattern_Type", "Pattern_Name"]
    assert [r.Rank for r in sorted(rows, key=lambda r: r.Rank)] == list(range(1, 16))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return None
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


DUCK_TO_SPARK = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
                 "BOOLEAN": "boolean", "DATE": "date", "TIMESTAMP": "timestamp_ntz"}


@pytest.mark.parametrize("name", sorted(set(oracle_sql())))
def test_oracle_equal(spark, duck, name):
    sdf = queries()[name](spark, SF001)
    rel = duck.sql(oracle_sql()[name])
    assert dict(sdf.dtypes) == {c: DUCK_TO_SPARK.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
    res = duck.execute(oracle_sql()[name])
    dcols = [c[0] for c in res.description]
    assert sorted(sdf.columns) == sorted(dcols)
    assert _canon(sdf.columns, [tuple(r) for r in sdf.collect()]) == _canon(dcols, res.fetchall())
