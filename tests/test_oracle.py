"""Every registered query against the second engine on the smallest test tables."""

from __future__ import annotations

import math
import os
import threading
from concurrent.futures import ThreadPoolExecutor

import pytest

import __spark_entry__ as entry
from tests.plans import plan

duckdb = pytest.importorskip("duckdb")

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")

# pairs of everything with everything, and Python called row by row
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")
PRINTING = threading.Lock()

KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def second_engine():
    connection = duckdb.connect()
    for file in sorted(os.listdir(SF_DIR)):
        name = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{file}'")
    return connection


@pytest.fixture(scope="module")
def answers(spark, request):
    """All chosen queries, four at a time: (types, rows, plan) by name."""

    def run(query):
        found = query(spark, SF_DIR)
        with PRINTING:
            text = plan(found)
        return found.dtypes, found.collect(), text

    names = [
        item.callspec.params["name"]
        for item in request.session.items
        if item.module is request.module and hasattr(item, "callspec")
    ]
    pool = ThreadPoolExecutor(4)
    yield {name: pool.submit(run, entry.queries()[name]) for name in names}
    pool.shutdown(cancel_futures=True)


def shown(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


def table(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(shown(row[i]) for i in order) for row in rows)


def test_names_agree():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(answers, second_engine, name):
    types, rows, text = answers[name].result()
    for operator in UNWANTED:
        assert operator not in text
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    result = second_engine.execute(sql)
    kinds = {column[0]: str(column[1]) for column in result.description}
    assert {name: KINDS[kind] for name, kind in types} == kinds
    assert table([name for name, _ in types], rows) == table(list(kinds), result.fetchall())
