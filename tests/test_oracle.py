"""Every catalog query against its DuckDB SQL on the sf0.001 tables."""

import math

import duckdb
import pytest

from __spark_entry__ import ROWS_ONLY, entry, oracle_sql, queries
from strata.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9f}"
    return "" if v is None else str(v)


def _rows(pdf):
    cols = sorted(pdf.columns)
    return sorted(tuple(_norm(r[c]) for c in cols) for r in pdf[cols].to_dict("records"))


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["vehicle", "drivers"]
    assert 0 < df.count() <= 10


def test_every_query_has_sql_except_random_ones():
    assert set(QUERIES) <= set(queries())
    assert set(QUERIES) - set(oracle_sql()) == ROWS_ONLY


@pytest.mark.parametrize("name", sorted(set(QUERIES) & set(oracle_sql())))
def test_query_matches_oracle(spark, con, name):
    sdf = queries()[name](spark, SF)
    got = sdf.toPandas()
    rel = con.sql(oracle_sql()[name])
    want = rel.df()
    assert sorted(got.columns) == sorted(want.columns)
    types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString()) for f in sdf.schema.fields}
    assert types == {c: str(t) for c, t in zip(rel.columns, rel.types)}
    assert len(got) == len(want)
    assert _rows(got) == _rows(want)
