"""Every registered query against its SQL in a second engine, on the smallest test tables."""

from __future__ import annotations

import datetime
import math
import re
from concurrent.futures import ThreadPoolExecutor

import duckdb
import pytest

from adspark import workload

FOLDER = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE",
         "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}
# Steps that pair up whole groups or leave the JVM.
BAD_STEPS = re.compile(r"CartesianProduct|BroadcastNestedLoopJoin|PythonUDF|ArrowEval|MapInPandas")
QUERIES, SQL = workload.queries(), workload.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


@pytest.fixture(scope="module")
def results(request, spark):
    """The chosen queries, several at a time: on tables this small most of the time is planning."""

    def run(name):
        df = QUERIES[name](spark, FOLDER)
        rows = df.collect()
        return df.dtypes, rows, df._jdf.queryExecution().executedPlan().toString()

    names = [i.callspec.params["name"] for i in request.session.items if i.originalname == "test_query"]
    with ThreadPoolExecutor(6) as pool:
        yield {name: pool.submit(run, name) for name in names}


def text(v) -> str:
    if v is None:
        return ""
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v + 0.0:.5f}"
    if isinstance(v, datetime.datetime):
        return v.isoformat(sep=" ")
    return str(v)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, results, duck):
    dtypes, rows, plan = results[name].result()
    got = duck.execute(SQL[name])
    columns = [d[0] for d in got.description]
    assert {n: TYPES[t] for n, t in dtypes} == {d[0]: str(d[1]) for d in got.description}
    order = [columns.index(c) for c, _ in dtypes]
    expected = sorted(tuple(text(r[i]) for i in order) for r in got.fetchall())
    assert sorted(tuple(text(v) for v in r) for r in rows) == expected
    assert not BAD_STEPS.search(plan)
