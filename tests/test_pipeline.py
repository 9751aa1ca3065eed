from __future__ import annotations

import datetime as dt
import json
import os
from dataclasses import replace
from pathlib import Path

import pytest
from conftest import same_rows
from pyspark.sql import functions as F

import docstrata as ds
from docstrata.plans import pipeline
from docstrata.streaming import incremental

SPEC = ds.delivery_spec(file_prefix="site_data")


def document(order: str, *dockets: str, grade: str = "g") -> bytes:
    items = [{"docketId": d, "grade": grade} for d in dockets]
    return json.dumps({"orders": [{"orderId": order, "lineId": "1", "dockets": items}]}).encode()


class Job:
    def __init__(self, spark, root: Path, mode: str, layout: str = "document"):
        self.spark, self.root, self.mode, self.layout = spark, root, mode, layout
        self.source = root / "tobe_ingested"
        self.archive = root / "ingested"
        for folder in (self.source, self.archive):
            folder.mkdir(parents=True, exist_ok=True)
        self.tables = ds.Tables.below(str(root / "tables"))

    def put(self, name: str, content: bytes, age: int = 0) -> None:
        path = self.source / name
        path.write_bytes(content)
        os.utime(path, (1_700_000_000 - age, 1_700_000_000 - age))

    def run(self, **options):
        audit = ds.run_incremental_ingest(
            self.spark,
            SPEC,
            str(self.source),
            self.tables,
            self.mode,
            self.layout,
            **options,
        )
        return {r["source_filename"]: r for r in audit.collect()}

    def master(self):
        return ds.read_master(self.spark, SPEC, self.tables, merged=self.mode == "merge")

    def dockets(self) -> list[tuple]:
        rows = self.master().select("ORDER_ID", "DOCKET_ID", "GRADE").collect()
        return sorted(map(tuple, rows))


@pytest.fixture(params=["append", "append_dedup", "merge"])
def job(request, spark, tmp_path):
    return Job(spark, tmp_path, request.param)


def test_incremental_runs(job):
    assert job.run() == {} and job.dockets() == []
    job.put("site_data_1201_20260319.json", document("o1", "a", "b", "a"))
    job.put("site_data_a_b_c.json", document("no", "x"))
    job.put("site_data_1.json", document("no", "x"))
    audit = job.run()
    assert {n: a["status"] for n, a in audit.items()} == {
        "site_data_1201_20260319.json": "loaded",
        "site_data_a_b_c.json": "name_mismatch",
        "site_data_1.json": "name_mismatch",
    }
    loaded = audit["site_data_1201_20260319.json"]
    assert (loaded["documents"], loaded["row_count"], loaded["distinct_keys"]) == (1, 3, 2)
    once = [("o1", "a", "g"), ("o1", "b", "g")]
    first = sorted([*once, once[0]]) if job.mode == "append" else once
    assert job.dockets() == first

    assert job.run() == {} and job.dockets() == first

    job.put("site_data_1_2.json", document("o1", "a", "c", grade="new"))
    assert list(job.run()) == ["site_data_1_2.json"]
    new = [("o1", "a", "new"), ("o1", "c", "new")]
    if job.mode == "merge":
        assert job.dockets() == [new[0], once[1], new[1]]
    else:
        assert job.dockets() == sorted(first + new)


def test_newest_file_wins_within_a_batch(spark, tmp_path):
    job = Job(spark, tmp_path, "append_dedup")
    job.put("site_data_1_1.json", document("o", "a", grade="newer"))
    job.put("site_data_2_2.json", document("o", "a", grade="older"), age=100)
    job.run()
    assert job.dockets() == [("o", "a", "newer")]


def test_same_document_twice_is_a_version_but_no_change(spark, tmp_path):
    job = Job(spark, tmp_path, "append_dedup")
    for name, grade in (("1", "g"), ("2", "g"), ("3", "h")):
        job.put(f"site_data_{name}_x.json", document("o", "a", grade=grade))
        job.run()
        views = ds.register_views(job.master(), SPEC, "t_")
        assert views["master"].count() == int(name)
        changed = grade == "h"
        assert spark.sql("SELECT * FROM t_change_summary").count() == changed
        assert views["change_log"].count() == changed
    row = views["change_log"].first()
    assert (row["column_name"], row["old_value"], row["new_value"]) == ("GRADE", "g", "h")
    assert row["current_version_num"] == 3
    assert spark.sql("SELECT GRADE FROM t_latest").collect() == [("h",)]


def test_bad_bytes_are_replaced(job):
    job.put("site_data_1_1.json", document("o", "a").replace(b'"a"', b'"a\xff"'))
    job.run()
    assert job.dockets() == [("o", "a�", "g")]


def test_abort_commits_nothing_and_quarantine_resumes(job):
    job.put("site_data_1_1.json", document("o", "a"))
    job.put("site_data_1_2.json", b'{"orders": [{')
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        job.run()
    assert job.dockets() == [] and ds.read_audit(job.spark, job.tables).isEmpty()
    audit = job.run(on_error="quarantine")
    assert audit["site_data_1_2.json"]["rejected"] == 1
    assert job.dockets() == [("o", "a", "g")]
    rejects = ds.read_rejects(job.spark, job.tables).collect()
    assert [(r["source_filename"], r["text"]) for r in rejects] == [
        ("site_data_1_2.json", '{"orders": [{')
    ]


@pytest.mark.parametrize("after", ["write_table", "_audit"])
def test_failure_inside_a_batch_leaves_one_copy(job, monkeypatch, after):
    job.put("site_data_0_0.json", document("o", "z"))
    job.run()
    job.put("site_data_1_1.json", document("o", "a", "b"))
    work = getattr(pipeline, after)
    calls = []

    def fails(*args, **options):
        result = work(*args, **options)
        calls.append(args)
        if after == "_audit" or len(calls) == 2:
            raise RuntimeError("executor lost")
        return result

    with monkeypatch.context() as patch:
        patch.setattr(pipeline, after, fails)
        with pytest.raises(Exception, match="executor lost"):
            job.run()
    job.run()
    assert job.dockets() == [("o", "a", "g"), ("o", "b", "g"), ("o", "z", "g")]


def test_file_that_arrives_during_a_run_waits_for_the_next(spark, tmp_path, monkeypatch):
    job = Job(spark, tmp_path, "append")
    job.put("site_data_1_1.json", document("o", "a"))
    commit = incremental.commit_batch

    def slow(*args, **options):
        job.put("site_data_2_2.json", document("o", "late"))
        return commit(*args, **options)

    with monkeypatch.context() as patch:
        patch.setattr(incremental, "commit_batch", slow)
        assert list(job.run()) == ["site_data_1_1.json"]
    assert job.dockets() == [("o", "a", "g")]
    assert list(job.run()) == ["site_data_2_2.json"]
    assert job.dockets() == [("o", "a", "g"), ("o", "late", "g")]


def test_files_are_archived_and_foreign_ones_stay(spark, tmp_path):
    job = Job(spark, tmp_path, "append")
    names = [f"site_data_{i}_{i}.json" for i in range(3)]
    job.put("site_data_a_b_c.json", b"not ours")
    for i, name in enumerate(names):
        job.put(name, document("o", str(i)))
        job.run(archive_dir=str(job.archive))
    assert sorted(p.name for p in job.archive.rglob("*.json")) == names
    assert [p.name for p in job.source.glob("*.json")] == ["site_data_a_b_c.json"]
    report = ds.read_archived(spark, job.tables).collect()
    assert sorted(Path(r["source_path"]).name for r in report) == names
    assert {r["status"] for r in report} == {"archived"}
    assert len(job.dockets()) == 3
    job.put(names[0], document("o", "again"), age=5)
    job.run(archive_dir=str(job.archive))
    assert sorted(p.name for p in job.archive.rglob("*.json")) == sorted([*names, names[0]])

    rebuilt = ds.Tables.below(str(tmp_path / "rebuilt"))
    for _ in range(2):
        audit = ds.rebuild(spark, SPEC, str(job.archive), rebuilt)
        assert sorted({r["source_filename"] for r in audit.collect()}) == names
    again = ds.read_master(spark, SPEC, rebuilt)
    assert same_rows(again.drop("INGESTION_TS"), job.master().drop("INGESTION_TS"))


def test_a_late_file_a_new_delivery_and_one_name_in_two_folders(spark, tmp_path):
    job = Job(spark, tmp_path, "append")
    job.put("site_data_1_1.json", document("o", "a"))
    job.run()
    job.put("site_data_0_0.json", document("o", "late"), age=30 * 86_400)
    assert list(job.run()) == ["site_data_0_0.json"]
    job.put("site_data_1_1.json", document("o", "a", grade="second"), age=-10)
    assert list(job.run()) == ["site_data_1_1.json"]
    assert job.dockets() == [("o", "a", "g"), ("o", "a", "second"), ("o", "late", "g")]
    for folder in ("x", "y"):
        (tmp_path / "two" / folder).mkdir(parents=True)
        (tmp_path / "two" / folder / "site_data_1_1.json").write_bytes(document(folder, "d"))
    audit = ds.ingest(spark, SPEC, str(tmp_path / "two"), job.tables, "append", recursive=True)
    assert [r["documents"] for r in audit.collect()] == [1, 1]


def test_no_batch_replaces_another(job):
    job.put("site_data_1_1.json", document("o", "a"))
    job.run()
    for n in (1, 2):
        folder = job.root / f"more{n}"
        folder.mkdir()
        (folder / "site_data_2_2.json").write_bytes(document(f"p{n}", "b"))
        ds.ingest(job.spark, SPEC, str(folder), job.tables, job.mode)
    both = [("o", "a", "g"), ("p1", "b", "g"), ("p2", "b", "g")]
    assert job.dockets() == both
    ds.rebuild(job.spark, SPEC, [str(job.source), *(str(job.root / f"more{n}") for n in (1, 2))], job.tables, job.mode)
    assert job.dockets() == both
    job.put("site_data_3_3.json", document("q", "c"))
    job.run()
    assert job.dockets() == [*both, ("q", "c", "g")]
    (job.source / "site_data_4_4.json").write_bytes(b"{")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        ds.rebuild(job.spark, SPEC, str(job.source), job.tables, job.mode)
    assert job.dockets() == [*both, ("q", "c", "g")]


def test_a_batch_without_audit_is_not_seen(spark, tmp_path):
    job = Job(spark, tmp_path, "append")
    job.put("site_data_1_1.json", document("o", "a"))
    job.run()
    ds.write_table(job.master(), f"{job.tables.master}/batch_id=1")
    assert job.dockets() == [("o", "a", "g")]


def test_merge_writes_the_batch_only_and_compaction_cleans_up(spark, tmp_path):
    job = Job(spark, tmp_path, "merge")
    for i in range(3):
        job.put(f"site_data_{i}_0.json", document("o", "a", str(i), grade=str(i)))
        job.run()
    folders = sorted(p.name for p in Path(job.tables.master).iterdir() if p.is_dir())
    assert folders == ["batch_id=0", "batch_id=1", "batch_id=2"]
    assert sum(len(list((Path(job.tables.master) / f).glob("*.parquet"))) for f in folders) <= 6
    before = job.dockets()
    assert before == [("o", "0", "0"), ("o", "1", "1"), ("o", "2", "2"), ("o", "a", "2")]
    ds.compact(spark, SPEC, job.tables, merged=True)
    assert [p.name for p in Path(job.tables.master).iterdir() if p.is_dir()] == ["batch_id=3"]
    assert job.dockets() == before
    assert job.run() == {}
    job.put("site_data_9_0.json", document("o", "a", grade="9"))
    job.run()
    assert job.dockets()[-1] == ("o", "a", "9")


def test_the_later_line_and_element_win(spark, tmp_path):
    job = Job(spark, tmp_path, "append_dedup", "lines")
    lines = [document("o", "a", grade="zzz"), document("o", "b", grade="z"), document("o", "a", grade="aaa-later")]
    twice = json.loads(document("p", "c", "c"))
    twice["orders"][0]["dockets"][0]["grade"] = "zzz"
    twice["orders"][0]["dockets"][1]["grade"] = "later"
    job.put("site_data_1_1.json", b"\n".join([*lines, json.dumps(twice).encode()]))
    job.run()
    assert job.dockets() == [("o", "a", "aaa-later"), ("o", "b", "z"), ("p", "c", "later")]


def test_lines_are_numbered_across_blocks(spark, tmp_path):
    spec = replace(SPEC, provenance=True)
    lines = [document("o", str(i)) for i in range(2000)]
    lines[7] = b""
    (tmp_path / "site_data_1_1.json").write_bytes(b"\n".join(lines))
    tables = ds.Tables.below(str(tmp_path / "tables"))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        ds.ingest(spark, spec, str(tmp_path), tables, "append", "lines")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    rows = ds.read_master(spark, spec, tables).select("DOCKET_ID", "line_pos").collect()
    assert len(rows) == 1999 and all(int(d) == n for d, n in rows)


def test_many_batches_in_one_run(spark, tmp_path):
    job = Job(spark, tmp_path, "merge")
    for i in range(5):
        job.put(f"site_data_{i}_0.json", document("o", "same", str(i), grade=str(i)), age=5 - i)
    audit = job.run(max_files_per_batch=2)
    assert {r["batch_id"] for r in audit.values()} == {0, 1, 2}
    assert job.dockets() == [("o", str(i), str(i)) for i in range(5)] + [("o", "same", "4")]


def test_lines_layout(spark, tmp_path):
    job = Job(spark, tmp_path, "append", "lines")
    lines = [document("o", "a"), b"", document("p", "b", "c"), b"[" + document("q", "d") + b"]"]
    job.put("site_data_1_1.json", b"\n".join(lines))
    audit = job.run()
    assert audit["site_data_1_1.json"]["documents"] == 3
    assert [d for _, d, _ in job.dockets()] == ["a", "b", "c", "d"]


def test_batch_equals_incremental(spark, tmp_path):
    job = Job(spark, tmp_path, "append_dedup")
    stamp = dt.datetime(2026, 1, 1)
    for i in range(4):
        job.put(f"site_data_{i}_0.json", document(str(i), "a", "b", "a"))
    job.run(ingestion_ts=stamp)
    other = ds.Tables.below(str(tmp_path / "batch"))
    ds.ingest(spark, SPEC, str(job.source), other, mode="append_dedup", ingestion_ts=stamp)
    assert same_rows(job.master(), ds.read_master(spark, SPEC, other))


def test_schema_evolution_reads_old_batches(spark, tmp_path):
    job = Job(spark, tmp_path, "append")
    job.put("site_data_1_1.json", document("o", "a"))
    job.run()
    wider = SPEC.with_field(ds.FieldSpec("NEW_COLUMN", "newFieldPath", level=1))
    text = document("o", "b").replace(b'"grade"', b'"newFieldPath": "n", "grade"')
    job.put("site_data_2_2.json", text)
    ds.run_incremental_ingest(spark, wider, str(job.source), job.tables, "append")
    master = ds.read_master(spark, wider, job.tables)
    rows = sorted(map(tuple, master.select("DOCKET_ID", "NEW_COLUMN").collect()))
    assert rows == [("a", None), ("b", "n")]


def test_discover_and_load(spark, tmp_path):
    names = [
        "site_data_1201_20260319.json",
        "site_data_a_b_c.json",
        "site_data_1.json",
        "site_data_1_2xjson",
    ]
    for name in names:
        (tmp_path / name).write_bytes(document("o", "a"))
    found = ds.discover_files(spark, str(tmp_path), SPEC.name_regex)
    assert [r["file_name"] for r in found.collect()] == names[:1]
    assert found.first()["file_bytes"] == len(document("o", "a"))
    landing = ds.load_documents(spark, str(tmp_path), "orders", SPEC.name_regex)
    row = landing.select("source_filename", "document_pos", F.to_json("payload")).collect()
    assert len(row) == 1 and tuple(row[0])[:2] == (names[0], 0)
    assert json.loads(row[0][2])[0]["orderId"] == "o"


def test_unknown_options_are_refused(spark, raw):
    with pytest.raises(ValueError, match="mode"):
        ds.ingest_texts(raw("{}"), SPEC, "replace")
    with pytest.raises(ValueError, match="layout"):
        ds.read_raw(spark, "/tmp", layout="csv").count()
    with pytest.raises(ValueError):
        ds.flatten_documents(raw("{}"), SPEC, on_error="ignore")


def test_the_landing_table_holds_typed_rows_and_every_text(spark, tmp_path):
    """Values are read from the documents once; texts without rows still count."""
    job = Job(spark, tmp_path, "append_dedup", "lines")
    none, bare, both = document("n"), document("b", "x"), b'{"orders": []}'
    two = b"[" + document("o", "p", "q", "r") + b", null, " + document("o", "p") + b"]"
    job.put("site_data_1_1.json", b"\n".join([none, bare, b"", two, b"{", both, b"[]"]))
    row = job.run(on_error="quarantine")["site_data_1_1.json"]
    found = [row[c] for c in ("documents", "rejected", "row_count", "distinct_keys")]
    assert found == [6, 1, 5, 4]
    landing = spark.read.parquet(job.tables.landing)
    kinds = {f.name: f.dataType.simpleString() for f in landing.schema}
    assert not any("variant" in k or "array" in k for k in kinds.values())
    assert (kinds["ORDER_QUANTITY"], kinds["ORDER_DATE"]) == ("decimal(18,6)", "timestamp_ntz")
    assert landing.where("_first").count() == 7 and landing.where("_row").count() == 5


def test_open_times_are_found_from_the_landing_table(spark, tmp_path):
    fields = (replace(f, format="auto") if f.name == "ORDER_DATE" else f for f in SPEC.fields)
    spec = replace(SPEC, fields=tuple(fields), provenance=True)
    line = '{"orders": [{"orderId": "o", "dockets": [{"docketId": "a", "orderDate": "%s"}]}]}'
    (tmp_path / "site_data_1_1.json").write_text("\n".join(line % d for d in ("13/02/2026 10:20:30", "01/03/2026", "")))
    tables = ds.Tables.below(str(tmp_path / "tables"))
    ds.ingest(spark, spec, str(tmp_path), tables, "append", "lines")
    rows = ds.read_master(spark, spec, tables).select("ORDER_DATE", "line_pos", "element_pos").collect()
    dates = [dt.datetime(2026, 2, 13, 10, 20, 30), dt.datetime(2026, 3, 1), None]
    assert sorted(map(tuple, rows), key=lambda r: r[1]) == [(d, n, [0, 0]) for n, d in enumerate(dates)]


def test_sketches_are_made_of_files_and_not_of_keys(spark):
    rows = spark.range(1000).selectExpr("concat('f', id % 2) AS source_filename", "CAST(id AS STRING) AS k")
    plan = ds.ingestion_audit(rows, "k", sketched=True)._jdf.queryExecution().executedPlan().toString()
    sketches = [line for line in plan.split("\n") if "hll_sketch_agg" in line]
    assert len(sketches) == 2 and all("keys=[source_filename#" in s and "_key" not in s.split("functions")[0] for s in sketches)
