"""The change log kept batch by batch, and the bucketed master, against the whole master."""

from __future__ import annotations

import datetime as dt
import random
from dataclasses import replace
from pathlib import Path

import pytest
from conftest import same_rows
from pyspark.sql import functions as F

import docstrata as ds
from docstrata.plans import changelog
from docstrata.sources import bucketed
from docstrata.sources.tables import AUDIT_SCHEMA, layout_of, write_master

FIELDS = (ds.FieldSpec("K", "k"), ds.FieldSpec("V", "v"), ds.FieldSpec("W", "w", "int"))
SPEC = ds.PipelineSpec(
    root="r", levels=(), fields=FIELDS, natural_key=("K", "V"), view_key=("K", "V"), version_key=("K",), order_col="TS"
)


def day(n: int) -> dt.datetime:
    return dt.datetime(2026, 1, 1) + dt.timedelta(days=n)


class Master:
    """Batches of rows (K, V, W, day) as the jobs would have written them."""

    def __init__(self, spark, root):
        self.spark, self.spec = spark, SPEC
        self.tables = ds.Tables.below(f"{root}/tables")
        self.log = ds.ChangeTables.below(f"{root}/log")
        self.batches = 0

    def add(self, rows, replaces: bool = False, spec=SPEC) -> None:
        self.spec = spec
        rows = [(k, v, w, day(d)) for k, v, w, d in rows]
        df = self.spark.createDataFrame(rows, "K string, V string, W int, TS timestamp_ntz").coalesce(2)
        write_master(ds.align_to_schema(df, spec.master_schema()), spec, f"{self.tables.master}/batch_id={self.batches}")
        said = {"replaces": replaces, "master_schema": layout_of(spec)}
        columns = [f for f in AUDIT_SCHEMA if f.name != "batch_id"]
        audit = self.spark.range(1).select(*(F.lit(said.get(f.name)).cast(f.dataType).alias(f.name) for f in columns))
        ds.write_table(audit, f"{self.tables.audit}/batch_id={self.batches}")
        self.batches += 1

    def update(self, **options):
        return ds.update_change_log(self.spark, self.spec, self.tables, self.log, **options)

    def kept(self):
        return ds.read_change_log(self.spark, self.spec, self.log)

    def whole(self):
        rows = ds.read_master(self.spark, self.spec, self.tables)
        return ds.change_log(rows, "K", "TS", hot_rows=None)

    def check(self):
        kept, whole = self.kept(), self.whole()
        assert kept.columns == whole.columns
        assert same_rows(kept, whole)


@pytest.fixture
def master(spark, tmp_path):
    return Master(spark, tmp_path)


def test_batches_in_order(master):
    assert master.update() == [] and master.kept().count() == 0
    master.add([("a", "1", 1, 0), ("b", "1", 1, 0), (None, "x", 1, 0)])
    assert master.update(buckets=8) == [0]
    master.check()
    master.add([("a", "1", 2, 1), ("c", "1", 1, 1)])
    master.add([("a", "1", 2, 2), ("a", None, None, 3), ("c", "2", 1, 2)])
    assert master.update(buckets=8) == [1, 2]
    assert master.update(buckets=8) == []
    master.check()
    assert master.kept().where("K = 'a'").count() == 3


def test_late_and_repeated_rows(master):
    master.add([("a", "1", 1, 5), ("b", "1", 1, 5), ("c", "1", 1, 5)])
    master.update(buckets=4)
    master.add([("a", "0", 1, 2), ("b", "1", 1, 5), ("c", "2", 1, 5), ("c", None, 1, 5)])  # before, again, tied
    master.update(buckets=4)
    master.check()
    master.add([("a", "3", 1, 9), ("b", "1", 1, 5), ("b", "1", 2, 7), ("b", "0", 2, 1)])
    master.update(buckets=4)
    master.check()
    assert master.kept().where("K = 'b'").select(F.max("current_version_num")).first()[0] == 5


@pytest.mark.parametrize("seed", range(3))
def test_any_order_of_rows(master, seed):
    rnd = random.Random(seed)
    for _ in range(4):
        rows = [
            (rnd.choice([None, *"abcdefgh"]), rnd.choice([None, "x", "y"]), rnd.choice([None, 1, 2]), rnd.randrange(6))
            for _ in range(rnd.choice([0, 3, 30]))
        ]
        master.add(rows)
        master.update(buckets=4)
        master.check()


def test_hot_keys_and_unnamed_buckets(master, monkeypatch):
    monkeypatch.setattr(changelog, "_NAMED", 1)
    for n in range(3):
        master.add([("hot", str(i % 7), i % 3, 3 * n + i % 2) for i in range(60)] + [(f"k{i}", "v", n, n) for i in range(5)])
        master.update(buckets=16, hot_rows=20)
        master.check()


def test_a_batch_reads_and_writes_only_its_buckets(master):
    master.add([(f"k{i}", "v", 1, 0) for i in range(200)])
    master.update(buckets=32)
    master.add([("k1", "v", 2, 1)])
    master.update(buckets=32)
    state = master.spark.read.parquet(f"{master.log.state}/batch_id=1")
    assert state.select("bucket").distinct().count() == 1 and state.count() < 30
    log = master.spark.read.parquet(f"{master.log.log}/batch_id=1")
    assert log.count() == 1
    touched = master.spark.createDataFrame([(3,)], "bucket int")
    rows = changelog._in_buckets(changelog._state(master.spark, SPEC, master.log), touched)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "In(bucket" in plan or "EqualTo(bucket" in plan.split("PushedFilters")[1]
    master.check()


def test_a_batch_that_died_is_run_again(master, monkeypatch):
    master.add([("a", "1", 1, 0)])
    master.update(buckets=4)
    master.add([("a", "2", 1, 1)])
    work = changelog.write_table
    for allowed in range(3):
        calls = []

        def dies(df, path, *mode, calls=calls, allowed=allowed):
            calls.append(path)
            if len(calls) > allowed:
                raise RuntimeError("driver lost")
            work(df, path, *mode)

        with monkeypatch.context() as patch:
            patch.setattr(changelog, "write_table", dies)
            with pytest.raises(RuntimeError):
                master.update(buckets=4)
        assert master.kept().count() == 0
    master.update(buckets=4)
    master.check()


def test_a_replaced_master_and_another_number_of_buckets_start_over(master):
    master.add([("a", "1", 1, 0), ("a", "2", 1, 1)])
    master.update(buckets=4)
    master.add([("a", "2", 1, 1), ("a", "9", 1, 2)])
    master.update(buckets=4)
    master.add([("a", "5", 1, 0), ("a", "6", 1, 1), ("b", "6", 1, 1)], replaces=True)
    assert master.update(buckets=4) == [2]
    master.check()
    master.add([("b", "7", 1, 2)])
    assert master.update(buckets=7) == [2, 3]
    master.check()
    folders = {p.name for p in Path(master.log.log).iterdir() if p.is_dir()}
    assert folders == {"batch_id=3"}


def test_a_column_that_came_later(master):
    master.add([("a", "1", 1, 0)])
    master.update(buckets=4)
    wider = replace(SPEC, fields=(*FIELDS, ds.FieldSpec("X", "x")))
    master.add([("a", "2", 1, 1)], spec=wider)
    master.update(buckets=4)
    master.check()


def test_a_merged_master_is_refused(master, monkeypatch):
    master.add([("a", "1", 1, 0)])
    master.add([("a", "1", 1, 0)])
    live = changelog.live_batches
    monkeypatch.setattr(changelog, "live_batches", lambda *a: [replace(b, resolved=True) for b in live(*a)])
    with pytest.raises(ValueError, match="merged"):
        master.update()


# --- bucketed master ------------------------------------------------------------------


def exchanges(df) -> bool:
    df.collect()
    return "Exchange" in df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_master_needs_no_exchange(master, spark, tmp_path):
    for n in range(3):
        master.add([(f"k{i % 9}", str(i * n % 4), i % 2, n) for i in range(40)] + [(None, "x", 1, n)])
        table = ds.publish_bucketed(spark, SPEC, master.tables, f"bucketed_{tmp_path.name}", str(tmp_path / "b"), 8)
    whole = ds.read_master(spark, SPEC, master.tables)
    assert same_rows(table, whole)
    forms = {
        "latest": lambda df: ds.latest_view(df, SPEC),
        "versions": lambda df: ds.number_versions(df, "K", "TS", hot_rows=None),
        "summary": lambda df: ds.change_summary(df, "K", ["TS"]),
        "exact": lambda df: ds.change_summary(df, "K", ["TS"], exact=True),
        "records": lambda df: ds.changed_records(df, "K", ["TS"], hot_rows=None),
        "log": lambda df: ds.change_log(df, "K", "TS", hot_rows=None),
    }
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, form in forms.items():
            assert same_rows(form(table), form(whole)), name
            assert exchanges(form(whole)) and not exchanges(form(table)), name
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_bucketed_master_follows_the_batches(master, spark, tmp_path):
    name, place = f"follows_{tmp_path.name}", str(tmp_path / "b")
    master.add([("a", "1", 1, 0)])
    ds.publish_bucketed(spark, SPEC, master.tables, name, place, 4)
    first = {p: p.stat().st_mtime_ns for p in Path(place).rglob("*.parquet")}
    master.add([("a", "2", 1, 1), ("b", "1", 1, 1)])
    table = ds.publish_bucketed(spark, SPEC, master.tables, name, place, 4)
    assert table.count() == 3 and all(p.stat().st_mtime_ns == t for p, t in first.items())
    spark.sql(f"DROP TABLE {name}")  # the catalog forgets, the folder does not
    assert ds.publish_bucketed(spark, SPEC, master.tables, name, place, 4).count() == 3
    assert all(p.stat().st_mtime_ns == t for p, t in first.items())
    wider = replace(SPEC, fields=(*FIELDS, ds.FieldSpec("X", "x")))
    master.add([("c", "1", 1, 2)], spec=wider)
    table = ds.publish_bucketed(spark, wider, master.tables, name, place, 4)
    assert same_rows(table, ds.read_master(spark, wider, master.tables))
    master.add([("z", "1", 1, 0)], replaces=True, spec=wider)
    assert ds.publish_bucketed(spark, wider, master.tables, name, place, 4).count() == 1
    assert bucketed.published(spark, name) == {3}
    other = replace(wider, fields=(*FIELDS[:2], ds.FieldSpec("W", "w", "bigint"), wider.fields[3]))
    with pytest.raises(ValueError, match="another name"):
        ds.publish_bucketed(spark, other, master.tables, name, place, 4)


def test_no_row_is_shipped_beside_its_place_in_the_order(spark):
    """Batches stamped later have no late keys, which the stamps alone tell; the state keeps
    the greatest version with NULLs last, and how many there were."""
    spec = ds.delivery_spec()
    names = spec.master_schema().names

    def versions(*rows):
        made = spark.createDataFrame(rows, "k string, day int, g string, n bigint")
        at = F.make_timestamp_ntz(F.lit(2026), F.lit(1), F.col("day"), F.lit(0), F.lit(0), F.lit(0))
        own = {"DOCKET_ID": F.col("k"), "GRADE": F.col("g"), spec.order_col: at}
        columns = (own.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in spec.master_schema())
        return made.select(*columns, F.col("n").alias("_rows"), F.lit(0).alias("bucket"))

    known = versions(("a", 1, "x", 3), ("b", 2, None, 1), ("c", 2, "y", 2))
    later = versions(("a", 3, "x", 1), ("a", 3, None, 1), ("d", 3, "z", 1)).drop("_rows")
    assert changelog._late_keys(later, known, spec) is None
    mixed = versions(("a", 1, "w", 1), ("b", 2, "v", 1), ("b", 5, "v", 1), ("c", 2, None, 1)).drop("_rows")
    late = changelog._late_keys(mixed, known, spec)
    assert sorted(r["DOCKET_ID"] for r in late.collect()) == ["a", "b"]
    moved = changelog._moved_on(later, known, spec)
    assert moved.columns[-2:] == ["_rows", "bucket"] and set(names) <= set(moved.columns)
    day = {1: dt.datetime(2026, 1, 1), 2: dt.datetime(2026, 1, 2), 3: dt.datetime(2026, 1, 3)}
    got = {r["DOCKET_ID"]: (r["GRADE"], r[spec.order_col], r["_rows"]) for r in moved.collect()}
    assert got == {"a": (None, day[3], 5), "b": (None, day[2], 1), "c": ("y", day[2], 2), "d": ("z", day[3], 1)}
    assert "SortAggregate" not in moved._jdf.queryExecution().executedPlan().toString()
