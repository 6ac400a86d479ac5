"""Every registered query against its SQL counterpart on the same tables."""

import glob
import os
from decimal import Decimal

import duckdb
import pytest

from __spark_entry__ import entry
from ledgerflow.catalog.oracle import ORACLE
from ledgerflow.catalog.queries import QUERIES


@pytest.fixture(scope="module")
def tables(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def comparable(value):
    if isinstance(value, Decimal):
        return f"{value:.6f}"
    if isinstance(value, float):
        return f"{value:.6f}"
    return str(value)


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda place: columns[place])
    return sorted([comparable(row[place]) for place in order] for row in rows)


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, sf_dir, tables, name):
    result = QUERIES[name](spark, sf_dir)
    expected = tables.execute(ORACLE[name])
    columns = [column[0] for column in expected.description]
    assert sorted(result.columns) == sorted(columns)
    assert sorted_rows(result.columns, result.collect()) == sorted_rows(columns, expected.fetchall())


    plan = result._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert node not in plan


def test_flagship_counts(spark):
    assert entry(spark).count() == 315
