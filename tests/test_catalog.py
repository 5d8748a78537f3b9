"""Every catalog query against its DuckDB oracle on the smallest benchmark tables (the driver's check)."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_module
from tariff_engine.plans import catalog

SF_DIR = "/root/testdata/sf0.001"
DUCK_TYPES = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("customer", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet')")
    return con


def _canon(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple("nan" if isinstance(r[i], float) and math.isnan(r[i]) else r[i] for i in order) for r in data]
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) == set(catalog.oracle_sql())
    assert set(catalog.queries()) <= set(entry_module.queries())


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="benchmark tables not present")
@pytest.mark.parametrize("name", [n for n in catalog.CATALOG if n.startswith("dq_")])
def test_quality_queries_find_something(duck, name):
    found = duck.sql(f"SELECT SUM(failing_rows) FROM ({catalog.oracle_sql()[name]})").fetchall()[0][0]
    assert found > 0


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="benchmark tables not present")
@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_oracle(spark, duck, name):
    df = catalog.queries()[name](spark, SF_DIR)
    rel = duck.sql(catalog.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    spark_types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    assert {c: DUCK_TYPES[spark_types[c]] for c in rel.columns} == dict(zip(rel.columns, map(str, rel.types)))
    assert _canon(df.columns, [tuple(r) for r in df.collect()]) == _canon(rel.columns, rel.fetchall())


def test_entry_smoke(spark):
    df = entry_module.entry(spark)
    assert df.count() > 0
    assert "our_rank" in df.columns
