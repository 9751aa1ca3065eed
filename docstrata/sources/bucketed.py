"""The master as a catalog table, bucketed and sorted by the version key.

Latest rows, version numbers, change summary and change log all bring the rows of a
version key together. In a bucketed table they are together, so none of them shuffles the
master; each batch is shuffled once, when it is published.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from docstrata.sources.tables import Batch, Tables, list_folders, live_batches, qualified, read_batches
from docstrata.spec import PipelineSpec

BUCKETS = 200


def publish_bucketed(
    spark: SparkSession,
    spec: PipelineSpec,
    tables: Tables,
    name: str,
    location: str,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Brings the table up to the committed batches and returns it.

    A partition per batch, one file per bucket in each: only batches that are missing are
    written, and those that a rebuild or a compaction replaced are dropped.  A merge moves
    rows between batches, so a merged master is published anew.  The table keeps its data
    in ``location`` and its buckets for good; another number of buckets needs another table.
    A batch that is repeated replaces its partition.
    """
    create_bucketed(spark, spec, name, location, buckets)
    live = live_batches(spark, tables)
    there = published(spark, name)
    moved = any(b.resolved for b in live[1:])
    wanted = {b.batch_id for b in live}
    for batch_id in sorted(there - wanted if not moved else there):
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (batch_id = {batch_id})")
    for batch in live:
        if moved or batch.batch_id not in there:
            _publish(spark, spec, tables, name, batch, buckets)
    return spark.table(name).select(*spec.master_schema().names)


def create_bucketed(
    spark: SparkSession, spec: PipelineSpec, name: str, location: str, buckets: int = BUCKETS
) -> None:
    """The table, if the catalog does not have it; what is in its folder counts as published.
    Columns the spec has since are added; a column of another type needs another table."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spec.master_schema())
    keys = ", ".join(f"`{k}`" for k in spec.version_key)
    known = spark.catalog.tableExists(name)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}, batch_id BIGINT) USING parquet "
        f"PARTITIONED BY (batch_id) CLUSTERED BY ({keys}) SORTED BY ({keys}, `{spec.order_col}`) "
        f"INTO {buckets} BUCKETS LOCATION '{qualified(spark, location)}'"
    )
    if not known and list_folders(spark, location):
        spark.sql(f"MSCK REPAIR TABLE {name}")
    there = {f.name: f.dataType for f in spark.table(name).schema}
    for f in spec.master_schema():
        if f.name not in there:
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS (`{f.name}` {f.dataType.simpleString()})")
        elif there[f.name] != f.dataType:
            raise ValueError(f"{name} has {f.name} as {there[f.name].simpleString()}; publish under another name")


def published(spark: SparkSession, name: str) -> set[int]:
    """The batches the table has."""
    return {int(r[0].partition("=")[2]) for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}


def _publish(
    spark: SparkSession, spec: PipelineSpec, tables: Tables, name: str, batch: Batch, buckets: int
) -> None:
    names = [c for c in spark.table(name).columns if c != "batch_id"]
    declared = set(spec.master_schema().names)
    rows = read_batches(spark, spec, tables, [batch])
    rows = rows.select(*(F.col(n) if n in declared else F.lit(None).alias(n) for n in names))
    # One task per bucket, so that a partition has one file for each.
    dealt = rows.repartition(buckets, *(F.col(k) for k in spec.version_key))
    view = f"_publish_{uuid.uuid4().hex}"
    dealt.createOrReplaceTempView(view)
    listed = ", ".join(f"`{n}`" for n in names)
    spark.sql(
        f"INSERT OVERWRITE TABLE {name} PARTITION (batch_id = {batch.batch_id}) "
        f"SELECT {listed} FROM {view}"
    )
    spark.catalog.dropTempView(view)
