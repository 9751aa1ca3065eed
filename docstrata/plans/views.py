"""Views that stay: catalog views over the folders of a pipeline, computed when they are read.

The text of a view names folders, so each read lists them anew, and asks the audit which
batches count: a view made before a batch shows it. Nothing has to be registered again after
an ingest, a merge, a compaction or a rebuild; a changed column list needs new views, as it
does in any catalog.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession, types as T

from docstrata.functions.fingerprint import NO_EQUALITY
from docstrata.sources.tables import Tables, live_batches, prepare, qualified, widened
from docstrata.spec import ENGINE_COLUMNS, PipelineSpec

VIEWS = ("master", "latest", "change_summary", "change_log")


def create_views(spark: SparkSession, spec: PipelineSpec, tables: Tables, prefix: str) -> list[str]:
    """Creates or replaces ``<prefix>master``, ``latest``, ``change_summary`` and
    ``change_log`` in the catalog; returns their names.

    ``prefix`` may name a database.  Batches written before a column show NULL in it; where
    earlier batches have a column in another type, or another layout by day, the table has
    to be compacted first.
    """
    prepare(spark, spec, tables)
    master = f"{prefix}master"
    texts = {
        "master": master_sql(spark, spec, tables),
        "latest": latest_sql(spec, master),
        "change_summary": summary_sql(spec, master),
        "change_log": log_sql(spec, master),
    }
    for name, text in texts.items():
        spark.sql(f"CREATE OR REPLACE VIEW {prefix}{name} AS {text}")
    return [f"{prefix}{name}" for name in texts]


def master_sql(spark: SparkSession, spec: PipelineSpec, tables: Tables) -> str:
    """All rows of committed batches, without the files that merges rewrote."""
    schema = spec.master_schema()
    live = live_batches(spark, tables)
    written = [b.schema or schema for b in live]
    for stored in written:
        types = {f.name: f.dataType for f in stored}
        for f in schema:
            if f.name in types and types[f.name] != f.dataType:
                widened(f, types[f.name])
                raise ValueError(f"{f.name} was written in another type; compact the table first")
    if len({b.day_col for b in live} | ({spec.day_col} if live else set())) > 1:
        raise ValueError("batches are laid out in different ways; compact the table first")
    # Reading all footers for the columns of all files is only needed if they differ.
    differ = any(set(s.names) != set(schema.names) for s in written)
    option = " WITH ('mergeSchema' = 'true')" if differ else ""
    files, audit, dead = (f"parquet.`{qualified(spark, p)}`" for p in (tables.master, tables.audit, tables.dead))
    columns = ", ".join(f"CAST({_name(f.name)} AS {f.dataType.simpleString()}) AS {_name(f.name)}" for f in schema)
    return f"""SELECT {columns} FROM {files}{option} AS f
WHERE batch_id IN (SELECT batch_id FROM {audit})
  AND batch_id >= (SELECT coalesce(max(batch_id), 0) FROM {audit} WHERE replaces)
  AND NOT EXISTS (SELECT 1 FROM {dead} AS d WHERE d.file_name = f._metadata.file_name
    AND d.batch_id IN (SELECT batch_id FROM {audit}))"""


def latest_sql(spec: PipelineSpec, master: str) -> str:
    """The latest version of every record."""
    schema = spec.master_schema()
    rest = [c for c in schema.names if c not in (*spec.view_key, spec.order_col)]
    order = ", ".join(f"{_comparable(schema[c])} DESC NULLS LAST" for c in (spec.order_col, *rest))
    return f"""SELECT {_names(schema.names)} FROM (
  SELECT *, row_number() OVER (PARTITION BY {_names(spec.view_key)} ORDER BY {order}) AS rn FROM {master})
WHERE rn = 1"""


def summary_sql(spec: PipelineSpec, master: str) -> str:
    """Keys with several rows and more than one content."""
    schema = spec.master_schema()
    ignored = {*spec.version_key, spec.order_col, *spec.exclude, *ENGINE_COLUMNS}
    tracked = [c for c in schema.names if c not in ignored]
    content = [_comparable(schema[c]) for c in tracked] + [f"{_name(c)} IS NULL" for c in tracked]
    return f"""SELECT {_names(spec.version_key)}, count(*) AS row_count,
  count(DISTINCT xxhash64({", ".join(content)})) AS distinct_non_ingestion_versions
FROM {master} GROUP BY {_names(spec.version_key)}
HAVING row_count > 1 AND distinct_non_ingestion_versions > 1"""


def log_sql(spec: PipelineSpec, master: str) -> str:
    """The columns that differ between consecutive versions of a key."""
    schema = spec.master_schema()
    keys, stamp = spec.version_key, spec.order_col
    rest = [c for c in schema.names if c not in (*keys, stamp)]
    tracked = [c for c in rest if c not in {*spec.exclude, *ENGINE_COLUMNS}]
    order = ", ".join(f"{_comparable(schema[c])} ASC NULLS LAST" for c in (stamp, *rest))
    carried = ", ".join(f"'{c}', {_name(c)}" for c in (stamp, *tracked))

    def change(c: str) -> str:
        field, old = schema[c], f"_prev.{_name(c)}"
        differs = f"NOT ({_comparable(field, old)} <=> {_comparable(field)})"
        texts = f"'old_value', {_text(field, old)}, 'new_value', {_text(field)}"
        return f"IF({differs}, named_struct('column_name', '{c}', {texts}), NULL)"

    return f"""SELECT {_names(keys)}, current_version_num, _prev.{_name(stamp)} AS previous_ingestion_ts,
  {_name(stamp)} AS current_ingestion_ts, _c.column_name, _c.old_value, _c.new_value
FROM (
  SELECT *, CAST(row_number() OVER w AS BIGINT) AS current_version_num, lag(named_struct({carried})) OVER w AS _prev
  FROM {master} WHERE {" AND ".join(f"{_name(k)} IS NOT NULL" for k in keys)}
  WINDOW w AS (PARTITION BY {_names(keys)} ORDER BY {order}))
LATERAL VIEW explode(array({", ".join(change(c) for c in tracked)})) AS _c
WHERE current_version_num > 1 AND _c IS NOT NULL"""


def _name(column: str) -> str:
    return f"`{column}`"


def _names(columns: Sequence[str]) -> str:
    return ", ".join(_name(c) for c in columns)


def _comparable(field: T.StructField, value: str | None = None) -> str:
    value = value or _name(field.name)
    return f"to_json({value})" if isinstance(field.dataType, NO_EQUALITY) else value


def _text(field: T.StructField, value: str | None = None) -> str:
    value = value or _name(field.name)
    nested = isinstance(field.dataType, (*NO_EQUALITY, T.StructType, T.ArrayType))
    return f"to_json({value})" if nested else f"CAST({value} AS STRING)"
