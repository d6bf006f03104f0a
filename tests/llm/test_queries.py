"""Parity of the training-data queries with their DuckDB SQL, and the registry."""

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline
from tests.test_queries import _digest
from tidemark.llm.queries import ORACLE, QUERIES
from tidemark.sources.tables import TABLES, table_path


@pytest.fixture(scope="module")
def duck(smoke_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(smoke_dir, t)}')")
    return con


def test_one_query_per_operator_and_the_pipeline():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(E.queries())
    assert len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle_parity(spark, duck, smoke_dir, name):
    df = QUERIES[name](spark, smoke_dir)
    got = _digest(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(ORACLE[name])
    assert got == _digest([c[0] for c in res.description], res.fetchall())


@pytest.mark.parametrize("name", ["op2_license_scans", "op3_quality_rules", "op4_url_filters", "op6_line_dedup"])
def test_native_queries_run_no_python(spark, smoke_dir, name):
    plan = QUERIES[name](spark, smoke_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "MapInArrow", "CartesianProduct", "NestedLoop"))
