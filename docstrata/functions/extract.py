"""Typed values out of semi-structured ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from docstrata.functions.times import parse_time
from docstrata.spec import TIMESTAMP_TYPES, FieldSpec


def final_value(leaf: Column, field: FieldSpec) -> Column:
    """From the raw leaf (see ``FieldSpec.leaf_type``) to the value of ``field``."""
    if field.type in TIMESTAMP_TYPES:
        return parse_time(leaf, field.type, field.sentinels, field.assume_offset, field.format)
    if not field.sentinels:
        return leaf
    for s in field.sentinels:
        leaf = F.nullif(leaf, F.lit(s))
    if field.type == "string":
        return leaf
    value = leaf.try_cast(field.type)
    if not field.strict:
        return value
    message = F.concat(F.lit(f"{field.name}: not a {field.type}: "), leaf)
    return F.when(value.isNotNull() | leaf.isNull(), value).otherwise(F.raise_error(message))


def leaf_value(value: Column, field: FieldSpec, path: str = "$") -> Column:
    """The value of ``field`` at a path of a variant; missing or JSON null gives NULL."""
    get = F.variant_get if field.strict else F.try_variant_get
    return final_value(get(value, path, field.leaf_type.simpleString()), field)


def path_value(value: Column, field: FieldSpec) -> Column:
    """The value of ``field`` inside the variant of its element."""
    return leaf_value(value, field, "$." + field.path)


def extract(
    df: DataFrame, value_col: str, fields: Sequence[FieldSpec], drop: bool = True
) -> DataFrame:
    """One typed column per field from the variant column ``value_col``."""
    kept = [c for c in df.columns if not (drop and c == value_col)]
    return df.select(*kept, *(path_value(F.col(value_col), f).alias(f.name) for f in fields))
