from __future__ import annotations

import datetime as dt

import pytest
from conftest import same_rows
from pyspark.sql import functions as F

import docstrata as ds

SCHEMA = "k int, v string, x int"


@pytest.mark.parametrize("broadcast_bytes", [-1, 10_000])
def test_merge_upsert(spark, broadcast_bytes):
    target = [(1, "a", 1), (1, "b", 2), (2, "c", 3), (None, "d", 4)]
    source = [(1, "Z", None), (3, "n", 5), (None, "q", 6)]
    target, source = (spark.createDataFrame(r, SCHEMA) for r in (target, source))
    merged = ds.merge_upsert(target, source, "k", broadcast_bytes)
    expected = [
        (1, "Z", None),
        (1, "Z", None),
        (2, "c", 3),
        (None, "d", 4),
        (3, "n", 5),
        (None, "q", 6),
    ]
    assert sorted(map(tuple, merged.collect()), key=repr) == sorted(expected, key=repr)
    known = source.where("k IS NOT NULL")
    once = ds.merge_upsert(target, known, "k", broadcast_bytes)
    assert same_rows(ds.merge_upsert(once, known, "k", broadcast_bytes), once)


def test_merge_of_a_small_batch_does_not_shuffle_the_target(spark):
    target = spark.range(100_000).select("id", F.col("id").alias("v"))
    source = spark.range(99_990, 100_010).select("id", F.lit(-1).cast("long").alias("v"))
    automatic = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = {}
        for limit in (10_000, -1):
            merged = ds.merge_upsert(target, source, "id", broadcast_bytes=limit)
            assert merged.where("v = -1").count() == 20 and merged.count() == 100_010
            plans[limit] = merged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", automatic)
    update, _ = plans[10_000].split("LeftAnti")
    assert "BroadcastHashJoin" in update and "hashpartitioning" not in update
    update, _ = plans[-1].split("LeftAnti")
    assert "BroadcastHashJoin" not in update and "LeftOuter" in update


def test_merge_on_two_keys_with_a_hot_one(spark):
    target = spark.range(3000).select(
        F.lit("h").alias("a"), (F.col("id") % 2).alias("b"), F.col("id").alias("v")
    )
    source = spark.createDataFrame([("h", 1, -1), ("h", 2, -2)], "a string, b long, v long")
    for limit in (-1, 10_000):
        merged = ds.merge_upsert(target, source, ["a", "b"], limit)
        counts = {r["b"]: r["n"] for r in merged.groupBy("b").agg(F.count("*").alias("n")).collect()}
        assert counts == {0: 1500, 1: 1500, 2: 1}
        assert merged.where("b = 1").select("v").distinct().collect() == [(-1,)]


def test_align_to_schema(spark):
    schema = ds.delivery_spec().master_schema()
    row = spark.createDataFrame([(7, dt.datetime(2026, 1, 1))], "ORDER_ID int, INGESTION_TS timestamp_ntz")
    aligned = ds.align_to_schema(row, schema)
    assert aligned.schema.names == schema.names
    assert aligned.first()["ORDER_ID"] == "7" and aligned.first()["GRADE"] is None
    with pytest.raises(ValueError, match="nope"):
        ds.align_to_schema(row.withColumn("nope", F.lit(1)), schema)


def test_quality(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 3), (None, "d", 4)], SCHEMA)
    assert tuple(ds.validate_master(df, "k").first()) == (4, 2)
    assert tuple(ds.validate_master(df, ["k", "v"], approximate=True).first()) == (4, 3)
    assert sorted(map(tuple, ds.key_violations(df, "k").collect()), key=repr) == [(1, 2), (None, 1)]
    assert tuple(ds.freshness(df, "x").first()) == (4, 4)
    audit = ds.ingestion_audit(df, ["k", "v"], by="k").orderBy(F.col("k").asc_nulls_first())
    assert list(map(tuple, audit.collect())) == [(None, 1, 1), (1, 2, 2), (2, 1, 1)]


def test_list_dockets_bounds_are_inclusive_and_pushed_down(spark, tmp_path):
    days = [dt.datetime(2026, 4, 1, 23, 59), dt.datetime(2026, 4, 2), dt.datetime(2026, 4, 3, 23, 59), dt.datetime(2026, 4, 4)]
    rows = [("p", d, c) for d in days for c in ("c1", "c2")] + [("q", days[1], "c1")]
    df = spark.createDataFrame(
        rows, "PROJECT_ID string, ORDER_DATE timestamp_ntz, CUSTOMER_ORDER_ID string"
    )
    ds.write_table(df, str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    found = ds.list_dockets(df, "p", "2026-04-02", "2026-04-03")
    assert {r["ORDER_DATE"] for r in found.collect()} == set(days[1:3]) and found.count() == 4
    assert ds.list_dockets(df, "p", "2026-04-02", "2026-04-03", "c1").count() == 2
    plan = found._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters")[1]
    assert "GreaterThanOrEqual(ORDER_" in pushed and "EqualTo(PROJECT_ID" in pushed


def test_restrict_and_preview(spark):
    df = spark.createDataFrame([("p", 1), ("q", 2), (None, 3)], "PROJECT_ID string, x int")
    wanted = spark.createDataFrame([("p",), ("p",), (None,)], "id string")
    assert ds.restrict_to_projects(df, wanted, list_col="id").collect() == [("p", 1)]
    assert [r["x"] for r in ds.preview(df, 2, "x").collect()] == [1, 2]
    assert ds.preview(df, 2).count() == 2


def test_key_filter_reaches_the_scan_through_the_latest_view(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, 1), ("a", 2, 2), ("b", 1, 3)], "k string, ts int, v int")
    ds.write_table(df, str(tmp_path / "t"))
    latest = ds.latest_per_key(spark.read.parquet(str(tmp_path / "t")), "k", "ts")
    one = latest.where(F.col("k") == "a")
    assert one.collect() == [("a", 2, 2)]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(k,a)" in plan.split("PushedFilters")[1]
