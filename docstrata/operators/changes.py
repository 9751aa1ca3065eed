"""What changed between the versions of a key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame, functions as F

from docstrata.functions.fingerprint import (
    as_text,
    column_list,
    columns_except,
    comparable,
    row_hash,
)
from docstrata.operators.flatten import to_key_value
from docstrata.operators.versions import (
    HOT_ROWS,
    hot_keys,
    number_versions,
    oldest_first,
    split_hot,
    with_predecessor,
)
from docstrata.spec import ENGINE_COLUMNS

STRATEGIES = ("lag", "join")


def change_summary(
    df: DataFrame, key: str | Sequence[str], exclude: Sequence[str] = (), exact: bool = False
) -> DataFrame:
    """Keys with several rows and more than one distinct content.

    Content is every column but the key, ``exclude`` (the ingestion stamp) and
    engine columns.  Counting distinct fingerprints is two-phase, (key,
    fingerprint) then key, so a hot key is spread; ``exact`` compares the
    content itself instead of its 64-bit fingerprint.
    """
    keys = column_list(key)
    ignored = {*keys, *exclude, *ENGINE_COLUMNS}
    if exact:
        tracked = columns_except(df, ignored)
        content = F.struct(*(comparable(df, c).alias(c) for c in tracked))
    else:
        content = row_hash(df, ignored)
    counts = (
        df.select(*keys, content.alias("_content"))
        .groupBy(*keys)
        .agg(
            F.count("*").alias("row_count"),
            F.count_distinct("_content").alias("distinct_non_ingestion_versions"),
        )
    )
    return counts.where(
        (F.col("row_count") > 1) & (F.col("distinct_non_ingestion_versions") > 1)
    )


def changed_records(
    df: DataFrame,
    key: str | Sequence[str],
    exclude: Sequence[str] = (),
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """All versions of every key in the change summary; NULL keys never match.

    Rows of hot keys stay where they are and meet the broadcast list of changed
    hot keys, which is as short as the list of hot keys.
    """
    keys = column_list(key)
    changed = change_summary(df, keys, exclude).select(*keys)
    hot = hot_keys(df, keys, hot_rows) if hot_rows else None
    if hot is None:
        return df.join(changed, keys, "left_semi").select(*df.columns)
    large, others = split_hot(df, keys, hot[0])
    changed_large, changed_others = split_hot(changed, keys, hot[0])
    rest = others.join(changed_others, keys, "left_semi")
    found = large.join(F.broadcast(changed_large), keys, "left_semi")
    return rest.unionByName(found).select(*df.columns)


def fingerprints(
    df: DataFrame,
    key: str,
    value: object = None,
    exclude: Sequence[str] = (),
    show: Sequence[str] = (),
) -> DataFrame:
    """Fingerprint of every version, with the ``show`` columns left out of it and
    displayed: are they all that changed?

    For the one key ``value``, or for all keys, which then come first.
    """
    ignored = {key, *exclude, *show, *ENGINE_COLUMNS}
    content = row_hash(df, ignored).alias("row_hash")
    if value is None:
        return df.select(key, content, *show)
    return df.where(F.col(key) == F.lit(value)).select(content, *show)


def change_log(
    df: DataFrame,
    key: str | Sequence[str],
    order_by: str | Sequence[str],
    exclude: Sequence[str] = (),
    tiebreak: Sequence[str] | None = None,
    strategy: str = "lag",
    sort: bool = False,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """One row per column that differs between consecutive versions of a key.

    NULL counts as a value; rows with a NULL key drop out.  Columns are compared
    in their own type and shown as text.  ``lag`` carries the previous version
    along the version window: one shuffle, and rows are only widened into
    columns where something changed.  ``join`` pairs every column of every
    version with the one before, as a check on the former.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}")
    keys, order_by = column_list(key), column_list(order_by)
    ignored = {*keys, *order_by, *exclude, *ENGINE_COLUMNS}
    tracked = columns_except(df, ignored)
    df = with_key(df, keys)
    find = _changes_by_lag if strategy == "lag" else _changes_by_join
    log = find(df, keys, order_by, tracked, tiebreak, hot_rows)
    return log.orderBy(*keys, "current_version_num", "column_name") if sort else log


def with_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.where(reduce(and_, (F.col(k).isNotNull() for k in keys)))


def changed_columns(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    tracked: Sequence[str],
    order: Sequence[Column],
    hot_rows: int | None,
    kept: Sequence[str] = (),
) -> DataFrame:
    """Consecutive versions with ``_changes``: a struct per tracked column, or NULL."""
    stamp = order_by[0]
    rows = with_predecessor(df, keys, order, [stamp, *tracked], hot_rows, unfold=False)

    def old(c: str) -> Column:
        return F.col(f"_prev_{c}")

    changes = (
        F.when(
            ~comparable(df, c, old(c)).eqNullSafe(comparable(df, c)),
            F.struct(
                F.lit(c).alias("column_name"),
                as_text(df, c, old(c)).alias("old_value"),
                as_text(df, c).alias("new_value"),
            ),
        )
        for c in tracked
    )
    return rows.where(F.col("_before") > 0).select(
        *keys,
        (F.col("_before") + 1).alias("current_version_num"),
        old(stamp).alias("previous_ingestion_ts"),
        F.col(stamp).alias("current_ingestion_ts"),
        *kept,
        F.array(*changes).alias("_changes"),
    )


def _changes_by_lag(df, keys, order_by, tracked, tiebreak, hot_rows) -> DataFrame:
    order = oldest_first(df, keys, order_by, tiebreak)
    return explode_changes(changed_columns(df, keys, order_by, tracked, order, hot_rows), keys)


def explode_changes(versions: DataFrame, keys: Sequence[str], also: Sequence[str] = ()) -> DataFrame:
    """One row per changed column of :func:`changed_columns`."""
    kept = [*keys, "current_version_num", "previous_ingestion_ts", "current_ingestion_ts", *also]
    # The array is never empty; the outer form spares a filter that would
    # compare every column a second time.
    changes = versions.select(*kept, F.explode_outer("_changes").alias("_change"))
    return changes.where(F.col("_change").isNotNull()).select(
        *kept, "_change.column_name", "_change.old_value", "_change.new_value"
    )


def _changes_by_join(df, keys, order_by, tracked, tiebreak, hot_rows) -> DataFrame:
    stamp = order_by[0]
    versions = number_versions(
        df, keys, order_by, tiebreak, "current_version_num", "previous_ingestion_ts", hot_rows
    )
    versions = versions.withColumn("current_ingestion_ts", F.col(stamp))
    ids = [*keys, "current_version_num"]
    stamps = ["previous_ingestion_ts", "current_ingestion_ts"]
    current = to_key_value(versions, [*ids, *stamps], tracked, value="new_value")
    previous = to_key_value(versions, ids, tracked, value="old_value").withColumn(
        "current_version_num", F.col("current_version_num") + 1
    )
    return (
        current.join(previous, [*ids, "column_name"])
        .where(~F.col("old_value").eqNullSafe(F.col("new_value")))
        .select(*ids, *stamps, "column_name", "old_value", "new_value")
    )


def noise_columns(
    df: DataFrame,
    key: str | Sequence[str],
    order_by: str | Sequence[str],
    exclude: Sequence[str] = (),
    tiebreak: Sequence[str] | None = None,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """How often each column changes, and in how many versions it alone changed."""
    keys, order_by = column_list(key), column_list(order_by)
    tracked = columns_except(df, {*keys, *order_by, *exclude, *ENGINE_COLUMNS})
    df = with_key(df, keys)
    order = oldest_first(df, keys, order_by, tiebreak)
    versions = changed_columns(df, keys, order_by, tracked, order, hot_rows)
    changed = [F.col("_changes")[i].isNotNull().cast("int") for i in range(len(tracked))]
    each = versions.select(
        reduce(add, changed).alias("_columns"), F.explode_outer("_changes").alias("_c")
    )
    return (
        each.where(F.col("_c").isNotNull())
        .groupBy("_c.column_name")
        .agg(
            F.count("*").alias("changes"),
            F.count_if(F.col("_columns") == 1).alias("changed_alone"),
        )
    )
