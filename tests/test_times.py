from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

import docstrata as ds
from docstrata.spec import NOT_YET


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2026-03-19T09:41:43.287", dt.datetime(2026, 3, 19, 9, 41, 43, 287000)),
        ("2026-03-19T09:41:43Z", dt.datetime(2026, 3, 19, 9, 41, 43)),
        ("2026-03-19", dt.datetime(2026, 3, 19)),
        ("junk", None),
        ("", None),
        (None, None),
        (NOT_YET, None),
        (NOT_YET + ".000", dt.datetime(1900, 1, 1)),
    ],
)
@pytest.mark.parametrize("offset", [None, "+08:00"])
def test_wall_clock(spark, text, expected, offset):
    if offset and text and (text.endswith("Z") or len(text) == 10):
        pytest.skip("offset-less texts only")
    row = spark.createDataFrame([(text,)], "t string")
    row = row.select(ds.parse_time(F.col("t"), sentinels=[NOT_YET], assume_offset=offset))
    assert row.first()[0] == expected


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_instant_does_not_depend_on_the_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        row = spark.createDataFrame([("2026-03-19T09:41:43",)], "t string")
        instant = ds.parse_time(F.col("t"), "timestamp", assume_offset="+08:00")
        seconds = row.select(F.unix_micros(instant)).first()[0] // 1_000_000
        assert dt.datetime.fromtimestamp(seconds, dt.UTC) == dt.datetime(
            2026, 3, 19, 1, 41, 43, tzinfo=dt.UTC
        )
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_convert_zone(spark):
    row = spark.sql("SELECT TIMESTAMP_NTZ'2026-03-19 20:00:00' AS t")
    assert row.select(ds.convert_zone("t", "UTC", "Asia/Hong_Kong")).first()[0] == dt.datetime(
        2026, 3, 20, 4
    )


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_stamp_is_one_wall_clock_in_the_named_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        stamps = ds.stamp_ingestion(spark.range(100).repartition(4), "ts", "Asia/Hong_Kong")
        found = {r[0] for r in stamps.select("ts").collect()}
        now = dt.datetime.now(dt.UTC).replace(tzinfo=None) + dt.timedelta(hours=8)
        assert len(found) == 1 and abs((found.pop() - now).total_seconds()) < 60
        fixed = dt.datetime(2026, 1, 2, 3, 4, 5, 6)
        stamped = ds.stamp_ingestion(spark.range(1), "ts", "UTC", fixed)
        assert stamped.first()["ts"] == fixed
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
