"""Time columns: safe parsing, zones, ingestion stamps."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, functions as F

_DATE = r"^\s*\d{4}-\d{1,2}-\d{1,2}"
_MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
_REST = r"(?:[ T]+(.*?))?\s*$"
#: Ways to write a time: the pattern of one, and its ISO form. Those that can be mistaken
#: for one another come in the order in which an equal number of readable values decides.
_SPELLINGS = {
    "iso": (_DATE, None),
    "year_first": (r"^\s*(\d{4})/(\d{1,2})/(\d{1,2})" + _REST, "$1-$2-$3 $4"),
    "day_first": (r"^\s*(\d{1,2})[/.](\d{1,2})[/.](\d{4})" + _REST, "$3-$2-$1 $4"),
    "month_first": (r"^\s*(\d{1,2})/(\d{1,2})/(\d{4})" + _REST, "$3-$1-$2 $4"),
    "month_name": (r"^\s*(\d{1,2})[- ]([A-Za-z]{3})[- ](\d{4})" + _REST, "$3-$2-$1 $4"),
    "compact": (r"^\s*(\d{4})(\d{2})(\d{2})(?:T?(\d{2})(\d{2})(\d{2}))?\s*$", "$1-$2-$3 $4:$5:$6"),
}
#: Digits since 1970 and how many of them are a second.
_EPOCHS = {"epoch_seconds": ((9, 10), 0), "epoch_millis": ((12, 13), 3), "epoch_micros": ((15, 16), 6)}
TIME_FORMATS = (*_SPELLINGS, *_EPOCHS)
AUTO = "auto"


def parse_time(
    text: Column,
    type: str = "timestamp_ntz",
    sentinels: Sequence[str] = (),
    assume_offset: str | None = None,
    format: str = "iso",
) -> Column:
    """Text to a time, NULL when it cannot be read; ``format`` is one of ``TIME_FORMATS``.

    ``timestamp_ntz`` keeps the wall clock and ignores an offset in the text;
    ``timestamp`` gives the instant.  A text equal to one of ``sentinels`` is
    NULL; the comparison is exact and made before the offset is appended.  A text
    without a date is no time: the cast would take today's.
    """
    for s in sentinels:
        text = F.nullif(text, F.lit(s))
    if format in _EPOCHS:
        return _epoch(text, type, *_EPOCHS[format])
    text = _iso(text, format)
    if assume_offset:
        text = F.concat(text, F.lit(assume_offset))
    return F.when(text.rlike(_DATE), text).try_cast(type)


def _iso(text: Column, format: str) -> Column:
    """The ISO form of a text; NULL if it is not written in this format."""
    pattern, form = _SPELLINGS[format]
    if form is None:
        return text
    if format == "month_name":
        month = F.array_position(F.array(*map(F.lit, _MONTHS)), F.lower(F.regexp_extract(text, pattern, 2)))
        form = F.concat(F.lit("$3-"), F.lpad(month.cast("string"), 2, "0"), F.lit("-$1 $4"))
        iso = F.when(month > 0, F.regexp_replace(text, F.lit(pattern), form))
    else:
        iso = F.regexp_replace(text, pattern, form)
    iso = F.regexp_replace(F.rtrim(iso), r"[ :]+$", "")
    # One digit for day or month is no ISO date: zeros in front of them.
    iso = F.regexp_replace(iso, r"^(\d{4})-(\d)-", "$1-0$2-")
    iso = F.regexp_replace(iso, r"^(\d{4}-\d{2})-(\d)(?!\d)", "$1-0$2")
    return F.when(text.rlike(pattern), iso)


def _epoch(text: Column, type: str, digits: tuple[int, int], exponent: int) -> Column:
    text = F.trim(text)
    number = F.when(text.rlike(f"^-?\\d{{{digits[0]},{digits[1]}}}$"), text).cast("long")
    instant = F.timestamp_micros(number * F.lit(10 ** (6 - exponent)).cast("long"))
    if type == "timestamp":
        return instant
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), instant.cast("timestamp_ntz"))


def count_formats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """How many values of each text column each format can read, in one pass.

    One row per column and format: ``column_name``, ``format``, ``readable`` and
    ``total`` (values that are not NULL).
    """
    counts = []
    for c in columns:
        for f in TIME_FORMATS:
            readable = F.count_if(parse_time(F.col(c), format=f).isNotNull())
            counts.append(
                F.struct(F.lit(c).alias("column_name"), F.lit(f).alias("format"), readable.alias("readable"), F.count(c).alias("total"))
            )
    if not columns:
        return df.sparkSession.createDataFrame([], "column_name string, format string, readable long, total long")
    return df.agg(F.array(*counts).alias("_c")).select(F.inline("_c"))


def detect_formats(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """The format that reads most values of each column; ``iso`` where none reads any, and
    of formats that read equally many the first of ``TIME_FORMATS``."""
    best = dict.fromkeys(columns, ("iso", 0))
    for r in count_formats(df, columns).collect():
        place = -TIME_FORMATS.index(r["format"])
        have, count = best[r["column_name"]]
        if (r["readable"], place) > (count, -TIME_FORMATS.index(have)):
            best[r["column_name"]] = (r["format"], r["readable"])
    return {c: f for c, (f, _) in best.items()}


def convert_zone(col: Column | str, source: str, target: str) -> Column:
    """Wall clock in zone ``source`` to the wall clock in zone ``target``."""
    col = F.col(col) if isinstance(col, str) else col
    return F.convert_timezone(F.lit(source), F.lit(target), col)


def instant_to_wall_clock(col: Column, zone: str) -> Column:
    """Instant (``timestamp``) to wall clock in ``zone``, whatever the session zone."""
    return F.convert_timezone(F.current_timezone(), F.lit(zone), col.cast("timestamp_ntz"))


def now_in_zone(zone: str) -> dt.datetime:
    """The driver's clock as a wall clock in ``zone``."""
    return dt.datetime.now(ZoneInfo(zone)).replace(tzinfo=None)


def stamp_ingestion(
    df: DataFrame, column: str, zone: str, ts: dt.datetime | None = None
) -> DataFrame:
    """Add the load time, one value per statement, as wall clock in ``zone``.

    Jobs that write more than one output pass ``ts``, so that all outputs carry
    the same stamp.
    """
    if ts is None:
        value = instant_to_wall_clock(F.current_timestamp(), zone)
    else:
        value = F.lit(ts.isoformat(sep=" ")).cast("timestamp_ntz")
    return df.withColumn(column, value)
