"""Arrays and objects to rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from docstrata.functions.fingerprint import as_text, column_list


def flatten(
    df: DataFrame, value_col: str, alias: str, path: str | None = None, positions: bool = True
) -> DataFrame:
    """One row per element of the variant array in ``value_col`` (inner).

    Replaces ``value_col`` by ``alias`` and, if wanted, ``<alias>_pos``.  A
    scalar, JSON null, NULL or ``[]`` gives no row.
    """
    return _explode(df, value_col, path, {"value": alias} | ({"pos": f"{alias}_pos"} if positions else {}))


def flatten_nested(df: DataFrame, value_col: str, levels: Sequence[tuple[str, str]]) -> DataFrame:
    """Flatten an array inside an array: ``levels`` is ``(path, alias)`` outside in.

    The value of every level is kept under its alias.  For wide elements prefer
    extracting a level's columns before opening the next one, as
    :func:`docstrata.sources.documents.flatten_documents` does.
    """
    source = value_col
    for path, alias in levels:
        df = flatten(df.withColumn("_array", F.variant_get(source, path, "variant")), "_array", alias)
        source = alias
    return df


def flatten_object(df: DataFrame, value_col: str, key: str = "key", value: str = "value") -> DataFrame:
    """One row per field of the variant object in ``value_col``."""
    return _explode(df, value_col, None, {"key": key, "value": value}).where(F.col(key).isNotNull())


def _explode(df: DataFrame, value_col: str, path: str | None, names: dict[str, str]) -> DataFrame:
    source = F.col(value_col)
    if path:
        df = df.withColumn(value_col, F.variant_get(source, path, "variant"))
    elements = df.sparkSession.tvf.variant_explode(F.col(value_col).outer())
    elements = elements.select(*(F.col(c).alias(n) for c, n in names.items()))
    return df.lateralJoin(elements).drop(value_col)


def to_key_value(
    df: DataFrame,
    ids: Sequence[str],
    cols: str | Sequence[str] | None = None,
    key: str = "column_name",
    value: str = "value",
) -> DataFrame:
    """One row per column of each row, NULL values included, values as text."""
    cols = [c for c in df.columns if c not in set(ids)] if cols is None else column_list(cols)
    pairs = F.array(
        *(F.struct(F.lit(c).alias(key), as_text(df, c).alias(value)) for c in cols)
    )
    return df.select(*ids, F.explode_outer(pairs).alias("_pair")).select(
        *ids, f"_pair.{key}", f"_pair.{value}"
    )
