"""Every registered query against its DuckDB oracle on the smallest generated data."""

import math
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tillsight.plans.catalog import QUERIES
from tillsight.sources.testdata import TABLES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="generated data missing")


def _canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    norm = [tuple(("nan" if isinstance(r[i], float) and math.isnan(r[i]) else r[i])
                  for i in order) for r in rows]
    return sorted(norm, key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet')")
    return c


def test_every_query_has_oracle():
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())


_SPARK_KIND = {"LongType": "int64", "IntegerType": "int32", "DoubleType": "double",
               "StringType": "string", "DateType": "date", "BooleanType": "bool"}
_DUCK_KIND = {"BIGINT": "int64", "INTEGER": "int32", "DOUBLE": "double", "VARCHAR": "string",
              "DATE": "date", "BOOLEAN": "bool"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = queries()[name](spark, SF_DIR)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _canon(rows, df.columns) == _canon(res.fetchall(), ocols)
    rel = con.sql(oracle_sql()[name])
    duck = {n: _DUCK_KIND.get(str(t), str(t)) for n, t in zip(rel.columns, rel.types)}
    ours = {f.name: _SPARK_KIND.get(type(f.dataType).__name__, str(f.dataType))
            for f in df.schema.fields}
    assert ours == duck


def test_entry(spark):
    df = entry(spark)
    assert df.count() == 1 and "top_category" in df.columns
