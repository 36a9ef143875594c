"""Registered queries against their DuckDB SQL over whole tables."""

import duckdb
import pytest

from tools.check_oracles import rows_of, type_differences
from webfeed.llm import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark", "labels", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_matches_oracle(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    rel = duck.sql(registry.ORACLES[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert type_differences(df.schema, rel.columns, rel.types) == {}
    assert rows_of(df.columns, df.collect()) == rows_of(rel.columns, rel.fetchall())
