"""Parquet tables of a pipeline: master, landing, audit, rejects.

The master is a folder per batch. What readers see is decided by the audit alone: the
batches it holds, from the last one on that replaced those before it, each read under the
schema it was written with, without the files that a later merge rewrote.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import reduce
from operator import and_
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from docstrata.operators.latest import latest_per_key
from docstrata.spec import PipelineSpec

AUDIT_SCHEMA = (
    T.StructType()
    .add("source_path", T.StringType())
    .add("source_filename", T.StringType())
    .add("file_bytes", T.LongType())
    .add("file_micros", T.LongType())
    .add("status", T.StringType())
    .add("documents", T.LongType())
    .add("rejected", T.LongType())
    .add("row_count", T.LongType())
    .add("distinct_keys", T.LongType())
    .add("ingestion_ts", T.TimestampNTZType())
    .add("replaces", T.BooleanType())
    .add("resolved", T.BooleanType())
    .add("stream_batch", T.LongType())
    .add("key_sketch", T.BinaryType())
    .add("master_schema", T.StringType())
    .add("batch_id", T.LongType())
)
DEAD_SCHEMA = T.StructType().add("file_name", T.StringType()).add("batch_id", T.LongType())
DAY = "order_day"
#: The folder of no batch, see :func:`prepare`.
NO_BATCH = -1
REJECTS_SCHEMA = (
    T.StructType()
    .add("source_filename", T.StringType())
    .add("file_modified_at", T.TimestampNTZType())
    .add("text", T.StringType())
    .add("batch_id", T.LongType())
)
ARCHIVED_SCHEMA = (
    T.StructType()
    .add("source_path", T.StringType())
    .add("file_micros", T.LongType())
    .add("archived_to", T.StringType())
    .add("status", T.StringType())
    .add("reason", T.StringType())
)


@dataclass(frozen=True)
class Tables:
    """Paths of the tables one pipeline writes."""

    master: str
    landing: str
    audit: str
    rejects: str
    archived: str
    manifest: str
    dead: str

    @classmethod
    def below(cls, root: str) -> Tables:
        root = root.rstrip("/")
        names = ("master", "landing", "audit", "rejects", "archived", "manifest", "dead")
        return cls(*(f"{root}/{n}" for n in names))


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("compression", "zstd").parquet(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table under a declared schema; files from before a column have NULL in
    it, and a table not written yet is empty."""
    try:
        return spark.read.schema(schema).parquet(path).select(*schema.names)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def read_audit(spark: SparkSession, tables: Tables) -> DataFrame:
    return read_table(spark, tables.audit, AUDIT_SCHEMA)


def read_rejects(spark: SparkSession, tables: Tables) -> DataFrame:
    rejects = read_table(spark, tables.rejects, REJECTS_SCHEMA)
    return rejects.where(F.col("batch_id").isin(committed_batches(spark, tables)))


def read_archived(spark: SparkSession, tables: Tables) -> DataFrame:
    """What became of each file that was to be archived."""
    return read_table(spark, tables.archived, ARCHIVED_SCHEMA)


def next_batch(spark: SparkSession, tables: Tables) -> int:
    """The number after the highest in the audit: no batch ever takes another's place,
    and one that failed before its audit was written is run again under its number."""
    highest = read_audit(spark, tables).agg(F.max("batch_id")).first()[0]
    return 0 if highest is None else highest + 1


@dataclass(frozen=True)
class Batch:
    """A batch that readers see: the schema and day column it was written with (None
    where the audit does not say), and whether keys were resolved when it was written."""

    batch_id: int
    schema: T.StructType | None
    day_col: str | None
    resolved: bool


def live_batches(spark: SparkSession, tables: Tables) -> list[Batch]:
    """All batches with an audit, from the last on that replaced what was there before
    (a rebuild or a compaction)."""
    audit = read_audit(spark, tables)
    found = audit.groupBy("batch_id").agg(
        F.bool_or("replaces").alias("replaces"),
        F.bool_and(F.coalesce("resolved", F.lit(False))).alias("resolved"),
        F.max("master_schema").alias("schema"),
    )
    rows = found.collect()
    start = max((r["batch_id"] for r in rows if r["replaces"]), default=-1)
    out = []
    for r in sorted(rows, key=lambda r: r["batch_id"]):
        if r["batch_id"] >= start:
            layout = json.loads(r["schema"]) if r["schema"] else {"schema": None, "day_col": None}
            schema = T.StructType.fromJson(layout["schema"]) if layout["schema"] else None
            out.append(Batch(r["batch_id"], schema, layout["day_col"], r["resolved"]))
    return out


def committed_batches(spark: SparkSession, tables: Tables) -> list[int]:
    """The numbers of the batches that readers see."""
    return [b.batch_id for b in live_batches(spark, tables)]


def layout_of(spec: PipelineSpec) -> str:
    """What the audit says about how a batch was written."""
    return json.dumps({"schema": spec.master_schema().jsonValue(), "day_col": spec.day_col})


def write_master(rows: DataFrame, spec: PipelineSpec, path: str, mode: str = "overwrite") -> None:
    """Rows of one batch; with a day column in a folder per day, a hot day in several
    files and days of few rows in one. Rows without a day have a folder of their own."""
    if spec.day_col is None:
        write_table(rows, path, mode)
        return
    days = rows.withColumn(DAY, F.to_date(spec.day_col)).hint("rebalance", DAY)
    days.write.mode(mode).partitionBy(DAY).parquet(path)


def read_master(
    spark: SparkSession,
    spec: PipelineSpec,
    tables: Tables,
    merged: bool = False,
    days: bool = False,
) -> DataFrame:
    """The rows of all committed batches.

    ``merged`` keeps, of the rows of a natural key, those of the newest batch; rows with
    a NULL in the key match nothing.  Where every batch was merged when it was written,
    nothing is left to do and nothing is shuffled.  ``days`` keeps the ``order_day``
    column of a master laid out by day; a filter on it reads only the folders of its days.
    """
    schema = spec.master_schema()
    shown = [*schema.names, *([DAY] if days else [])]
    live = live_batches(spark, tables)
    rows = read_batches(spark, spec, tables, live)
    if merged and not all(b.resolved for b in live):
        keyed = reduce(and_, (F.col(k).isNotNull() for k in spec.natural_key))
        newest = latest_per_key(rows.where(keyed), spec.natural_key, "batch_id")
        rows = newest.unionByName(rows.where(~keyed))
    return rows.select(*shown)


def read_batches(
    spark: SparkSession, spec: PipelineSpec, tables: Tables, batches: list[Batch]
) -> DataFrame:
    """The rows of some batches under the schema of today, with ``batch_id``,
    ``order_day`` and ``file_name``.  Batches written alike are read together."""
    schema = spec.master_schema()
    alike: dict[str, list[Batch]] = {}
    for b in batches:
        alike.setdefault(f"{b.day_col} {(b.schema or schema).json()}", []).append(b)
    parts = [_read_alike(spark, schema, tables, group) for group in alike.values()]
    if not parts:
        whole = T.StructType([*schema, T.StructField("batch_id", T.LongType())])
        whole = whole.add(DAY, T.DateType()).add("file_name", T.StringType())
        return spark.createDataFrame([], whole)
    return reduce(DataFrame.unionByName, parts)


def _read_alike(
    spark: SparkSession, schema: T.StructType, tables: Tables, group: list[Batch]
) -> DataFrame:
    stored, day_col = group[0].schema or schema, group[0].day_col
    read = T.StructType([*stored, T.StructField("batch_id", T.LongType())])
    if day_col:
        read = read.add(DAY, T.DateType())
    folders = [f"{tables.master}/batch_id={b.batch_id}" for b in group]
    files = spark.read.option("basePath", tables.master).schema(read).parquet(*folders)
    kept = {f.name: f.dataType for f in stored}
    columns = [
        (widened(f, kept[f.name]) if f.name in kept else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema
    ]
    day = F.col(DAY) if day_col else F.lit(None).cast("date").alias(DAY)
    rows = files.select(*columns, "batch_id", day, F.col("_metadata.file_name").alias("file_name"))
    dead = read_dead(spark, tables)
    return rows if dead is None else rows.join(F.broadcast(dead), "file_name", "left_anti")


def widened(field: T.StructField, stored: T.DataType) -> Column:
    """A stored column in its declared type.

    Allowed is what keeps every value: more digits behind the point, whole numbers to
    decimals, dates to times, anything to text.  A value with more digits before the
    point than the declared type has raises when it is read; any other change of type is
    refused at once.
    """
    if stored == field.dataType:
        return F.col(field.name)
    if not _keeps_values(stored, field.dataType):
        raise ValueError(
            f"{field.name} was written as {stored.simpleString()}, which "
            f"{field.dataType.simpleString()} cannot hold without loss"
        )
    value = F.col(field.name).try_cast(field.dataType)
    message = F.concat(F.lit(f"{field.name}: too large for {field.dataType.simpleString()}: "), F.col(field.name).cast("string"))
    return F.when(value.isNotNull() | F.col(field.name).isNull(), value).otherwise(F.raise_error(message))


_WHOLE = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}


def _keeps_values(stored: T.DataType, declared: T.DataType) -> bool:
    if isinstance(declared, T.StringType):
        return not isinstance(stored, (T.StructType, T.ArrayType, T.MapType, T.BinaryType))
    if isinstance(declared, T.DecimalType):
        if isinstance(stored, T.DecimalType):
            return declared.scale >= stored.scale
        return type(stored) in _WHOLE
    if type(stored) in _WHOLE and type(declared) in _WHOLE:
        return _WHOLE[type(stored)] <= _WHOLE[type(declared)]
    if isinstance(stored, T.DateType):
        return isinstance(declared, (T.TimestampType, T.TimestampNTZType))
    return isinstance(stored, T.FloatType) and isinstance(declared, T.DoubleType)


def read_dead(spark: SparkSession, tables: Tables) -> DataFrame | None:
    """Names of the master files that committed merges rewrote and that are still there."""
    try:
        dead = spark.read.schema(DEAD_SCHEMA).parquet(tables.dead)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    batches = read_audit(spark, tables).select("batch_id").distinct()
    return dead.join(batches, "batch_id", "left_semi").select("file_name")


def remove_superseded(spark: SparkSession, tables: Tables) -> None:
    """Deletes the folders of master and rejects that no reader sees any more, and the
    files that merges rewrote."""
    remove_dead(spark, tables)
    live = {f"batch_id={n}" for n in committed_batches(spark, tables)}
    for table in (tables.master, tables.rejects):
        for folder in list_folders(spark, table):
            if folder.startswith("batch_id=") and folder not in (*live, f"batch_id={NO_BATCH}"):
                delete(spark, f"{table}/{folder}")


def remove_dead(spark: SparkSession, tables: Tables) -> None:
    """Deletes the files that committed merges rewrote; readers that began before the
    merge must be done."""
    dead = read_dead(spark, tables)
    if dead is None:
        return
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
    there = files.option("recursiveFileLookup", "true").load(tables.master)
    there = there.select(F.col("_metadata.file_path").alias("p"), F.col("_metadata.file_name").alias("file_name"))
    for f in there.join(F.broadcast(dead), "file_name", "left_semi").toLocalIterator():
        delete(spark, unquote(f["p"]))
    for folder in list_folders(spark, tables.dead):
        if folder != f"batch_id={NO_BATCH}":
            delete(spark, f"{tables.dead}/{folder}")


def prepare(spark: SparkSession, spec: PipelineSpec, tables: Tables) -> None:
    """Gives every table of a pipeline that views read a first, empty folder; that of the
    master has all columns of today."""
    master = f"{tables.master}/batch_id={NO_BATCH}"
    delete(spark, master)
    day = f"/{DAY}=__HIVE_DEFAULT_PARTITION__" if spec.day_col else ""
    write_table(spark.createDataFrame([], spec.master_schema()), master + day)
    for path, schema in ((tables.audit, AUDIT_SCHEMA), (tables.dead, DEAD_SCHEMA)):
        if not list_folders(spark, path):
            columns = T.StructType([f for f in schema if f.name != "batch_id"])
            write_table(spark.createDataFrame([], columns), f"{path}/batch_id={NO_BATCH}")


def list_folders(spark: SparkSession, path: str) -> list[str]:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(where):
        return []
    return [f.getPath().getName() for f in system.listStatus(where) if f.isDirectory()]


def delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def qualified(spark: SparkSession, path: str) -> str:
    """A path with the scheme and host of its file system, the same for every process."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.makeQualified(where).toString().rstrip("/")


def move(spark: SparkSession, source: str, target: str) -> bool:
    """Renames a file, with the folders it needs; false if it could not be moved."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(target).getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(path(target).getParent())
    return system.rename(path(source), path(target))
