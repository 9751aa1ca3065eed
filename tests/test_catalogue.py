"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest
from conftest import SF_DIR, same_rows
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from docstrata import catalogue

QUERIES = catalogue.QUERIES
SQL = catalogue.SQL


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    texts = [tuple(None if r[i] is None else str(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(texts, key=repr)


def test_every_query_has_sql_and_is_registered():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(SQL) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    cursor = duck.execute(SQL[name])
    columns = [d[0] for d in cursor.description]
    assert canonical(df.columns, df.collect()) == canonical(columns, cursor.fetchall())


def test_entry(spark):
    assert not entry_point.entry(spark).isEmpty()


def test_many_documents_are_built_by_many_tasks(spark, monkeypatch):
    """No task builds more than its share, as what it builds is sorted there."""
    few = catalogue.delivery_documents(spark, SF_DIR)
    monkeypatch.setattr(catalogue, "DOCUMENTS_PER_TASK", 500)
    many = catalogue.delivery_documents(spark, SF_DIR)
    sizes = many.groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.count("*")).first()
    assert sizes[1] >= 10 and sizes[0] <= 1000
    assert same_rows(few, many)
