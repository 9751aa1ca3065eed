"""Row content: column lists, comparable forms, fingerprints."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

#: Types Spark cannot compare, group or sort; their JSON text stands in.
NO_EQUALITY = (T.VariantType, T.MapType)


def column_list(cols: str | Sequence[str]) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def columns_except(df: DataFrame, exclude: Iterable[str]) -> list[str]:
    """Column names without the excluded ones (``* EXCEPT (...)``)."""
    gone = set(exclude)
    return [c for c in df.columns if c not in gone]


def comparable(df: DataFrame, name: str, value: Column | None = None) -> Column:
    """Column ``name`` (or another value of its type) in a form that has ``=``."""
    value = F.col(name) if value is None else value
    return F.to_json(value) if isinstance(df.schema[name].dataType, NO_EQUALITY) else value


def as_text(df: DataFrame, name: str, value: Column | None = None) -> Column:
    """Column ``name`` (or another value of its type) as text; nested values as JSON."""
    value = F.col(name) if value is None else value
    nested = (*NO_EQUALITY, T.StructType, T.ArrayType)
    return F.to_json(value) if isinstance(df.schema[name].dataType, nested) else value.cast("string")


def row_hash(df: DataFrame, exclude: Iterable[str] = ()) -> Column:
    """64-bit fingerprint of all columns but the excluded ones.

    ``xxhash64`` skips NULLs, so ``(NULL, 'a')`` and ``('a', NULL)`` would
    collide; the NULL flags are hashed along with the values.
    """
    cols = columns_except(df, exclude)
    return F.xxhash64(*(comparable(df, c) for c in cols), *(F.col(c).isNull() for c in cols))
