"""One row per key: the newest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from docstrata.functions.fingerprint import column_list, comparable, columns_except
from docstrata.operators.versions import HOT_ROWS, frequent_keys, split_hot
from docstrata.spec import PipelineSpec


def newest_first(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], tiebreak: Sequence[str] | None
) -> list[Column]:
    """Total descending order, NULLs last; the default tie-break is every other column.

    Rows that still tie are equal in every column, so which one wins is moot.
    """
    if tiebreak is None:
        tiebreak = columns_except(df, [*keys, *order_by])
    return [comparable(df, c).desc_nulls_last() for c in (*order_by, *tiebreak)]


def latest_per_key(
    df: DataFrame,
    keys: str | Sequence[str],
    order_by: str | Sequence[str],
    tiebreak: Sequence[str] | None = None,
    keep_rank: bool = False,
    early: bool = True,
) -> DataFrame:
    """The newest row of each key; NULL is a key like any other.

    Written as ``row_number() == 1``: Spark then keeps one row per key and task
    before the shuffle, so a key with a third of all rows sends one row per
    input task, not its rows.  That sorts the rows of every input task; without
    ``early`` they are sorted after the shuffle only.  ``keep_rank`` leaves the
    rank column ``rn``.
    """
    keys, order_by = column_list(keys), column_list(order_by)
    window = Window.partitionBy(*keys).orderBy(*newest_first(df, keys, order_by, tiebreak))
    if early:
        latest = df.withColumn("rn", F.row_number().over(window)).where(F.col("rn") == 1)
    else:
        newer = df.withColumn("_newer", F.lag(F.lit(True)).over(window))
        latest = newer.where(F.col("_newer").isNull()).drop("_newer").withColumn("rn", F.lit(1))
    return latest if keep_rank else latest.drop("rn")


def latest_view(
    master: DataFrame, spec: PipelineSpec, keep_rank: bool = False, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Latest version of every record of the master table.

    Runs a small job to look for hot keys. Only their rows are sorted before the shuffle,
    to send one per task; others have few versions, and a task of the scan can hold more
    rows than it can sort without spilling.
    """
    keys, order = column_list(spec.view_key), spec.order_col
    hot = frequent_keys(master, keys, hot_rows)
    if hot is None:
        return latest_per_key(master, keys, order, keep_rank=keep_rank, early=False)
    large, others = split_hot(master, keys, hot)
    rest = latest_per_key(others, keys, order, keep_rank=keep_rank, early=False)
    return rest.unionByName(latest_per_key(large, keys, order, keep_rank=keep_rank))
