"""Every training-data query that SQL can express, against its DuckDB SQL."""

import duckdb
import pytest

from strata.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "labels"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    got = QUERIES[name](spark, SF)
    want = con.sql(ORACLE_SQL[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE"}
    assert {f.name: kinds[f.dataType.simpleString()] for f in got.schema} == dict(zip(want.columns, map(str, want.types)))
    rows = sorted(map(repr, got.select(*columns).toPandas().itertuples(index=False, name=None)))
    assert rows == sorted(map(repr, want.df()[columns].itertuples(index=False, name=None)))
