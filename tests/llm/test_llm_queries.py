"""Registered queries against their SQL, and the pipeline against plain Python."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry_point
import corpus_pipeline
from docstrata.llm import queries
from docstrata.llm.tables import reachable

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def test_all_are_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry_point.queries())
    assert set(queries.SQL) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, SF_DIR)
    cursor = duck.execute(queries.SQL[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    want = sorted((tuple(r) for r in cursor.fetchall()), key=repr)
    got = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
    assert got == want


def test_queries_without_sql_cover_every_document(spark):
    ids = {r[0] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id").collect()}
    for name in ("op1_quality", "op3_pack", "op11_language"):
        assert {r["doc_id"] for r in queries.QUERIES[name](spark, SF_DIR).collect()} == ids


def test_pipeline_stage_by_stage(spark, tmp_path):
    from test_operators import components, contaminated, cut, ranks

    reachable(spark)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    names = docs.columns
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r["doc_id"]: r for r in docs.collect()}
        rows = [(d, r["text"]) for d, r in before.items()]
        stage(spark, docs, SF_DIR).write.parquet(str(tmp_path / str(number)))
        docs = spark.read.parquet(str(tmp_path / str(number)))
        if number == 4:
            assert {r["doc_id"] for r in docs.collect()} == set(before)
            break
        assert docs.columns == names, name
        after = {r["doc_id"]: r for r in docs.collect()}
        if number == 0:
            assert 0 < len(after) < len(before) and all(before[d] == r for d, r in after.items())
        elif number == 1:
            assert set(after) == {d for d, _, _, kept in components(rows, 2, 80) if kept}
        elif number == 2:
            want = {}
            for d, n, gone, kept in cut(rows, 50):
                if gone == 0 or gone < n:
                    want[d] = kept if gone else before[d]["text"]
            assert {d: r["text"] for d, r in after.items()} == want
            assert all(r["n_chars"] == len(r["text"]) for d, r in after.items() if r["text"] != before[d]["text"])
        elif number == 3:
            found = contaminated(rows, items, 13)
            assert set(after) == {d for d, n, hit, _ in found if not hit or 20 * len(hit) < n}
    assert ranks(r["doc_id"] for r in corpus_pipeline.run(spark, SF_DIR).collect()) == ranks(
        r["doc_id"] for r in docs.collect()
    )
