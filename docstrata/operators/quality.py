"""Counts that tell whether a table is sound."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from docstrata.functions.fingerprint import column_list, row_hash

#: Registers of a sketch, as a power of two: 16 KB for many keys, less for few.
SKETCH_BITS = 14


def validate_master(df: DataFrame, key: str | Sequence[str], approximate: bool = False) -> DataFrame:
    """Row count and number of distinct keys without NULL.

    ``approximate`` estimates the latter without a shuffle by key.
    """
    keys = column_list(key)
    if approximate:
        distinct = F.approx_count_distinct(F.when(~_any_null(keys), F.xxhash64(*keys)))
    else:
        distinct = F.count_distinct(*keys)
    return df.agg(F.count("*").alias("row_count"), distinct.alias("distinct_keys"))


def key_violations(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Key values the declared primary key forbids: repeated or NULL."""
    keys = column_list(keys)
    counts = df.groupBy(*keys).agg(F.count("*").alias("row_count"))
    return counts.where((F.col("row_count") > 1) | _any_null(keys))


def freshness(df: DataFrame, order_col: str = "INGESTION_TS") -> DataFrame:
    """Newest stamp and row count."""
    return df.agg(
        F.max(order_col).alias("max_ingestion_ts"), F.count("*").alias("row_count")
    )


def ingestion_audit(
    rows: DataFrame,
    keys: str | Sequence[str],
    by: str | Sequence[str] = "source_filename",
    sketched: bool = False,
) -> DataFrame:
    """Rows and distinct keys per source file; ``sketched`` adds ``key_sketch``, which
    adds up over files and batches (see :func:`estimated_keys`) as counts do not."""
    keys, by = column_list(keys), column_list(by)
    # Keys are brought together first: a sketch beside a distinct count would be kept, sorted
    # and shuffled for every key.
    own = {k: f"_key{i}" for i, k in enumerate(keys)}
    each = rows.select(*by, *(F.col(k).alias(n) for k, n in own.items()))
    each = each.groupBy(*by, *own.values()).agg(F.count("*").alias("_rows"))
    counts = {"row_count": F.sum("_rows"), "distinct_keys": F.count("*")}
    if sketched:
        plain = each.select(*own.values())
        counts["key_sketch"] = F.hll_sketch_agg(row_hash(plain), F.lit(SKETCH_BITS))
    return each.groupBy(*by).agg(*(c.alias(name) for name, c in counts.items()))


def estimated_keys(audit: DataFrame, by: str | Sequence[str] = ()) -> DataFrame:
    """Distinct keys of any span of the audit (``distinct_keys``), without its rows.

    An estimate: the standard error is 1.04 / sqrt(2 ** SKETCH_BITS), 0.8 percent; small
    sets are counted almost exactly.
    """
    union = F.hll_sketch_estimate(F.hll_union_agg("key_sketch"))
    return audit.groupBy(*column_list(by)).agg(F.coalesce(union, F.lit(0)).alias("distinct_keys"))


def _any_null(keys: Sequence[str]) -> Column:
    return reduce(or_, (F.col(k).isNull() for k in keys))
