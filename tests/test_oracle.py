"""Every registered query against DuckDB, values and types, and what its plan must not contain."""

import re

import pytest

import __spark_entry__ as entry
from compare import connect, duckdb_table, duckdb_types, spark_table

SF = "/root/testdata/sf0.01"
QUERIES = entry._credit_queries()
ORACLES = {name: sql for name, sql in entry.oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"CartesianProduct|Python|PythonUDF|MapInPandas", plan)
    got = spark_table(df)
    if name in ORACLES:
        assert got == duckdb_table(duck, ORACLES[name])
        assert dict(df.dtypes) == duckdb_types(duck, ORACLES[name])
    else:
        assert got[1]


def test_flagship(spark):
    assert entry.entry(spark).columns == ["nombre_industria", "total_creditos", "creditos_morosos", "indice_mora_pct"]


def test_oracles_belong_to_queries():
    assert set(ORACLES) == set(QUERIES)
