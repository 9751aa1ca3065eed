"""The composed pipeline: documents to master table, views on top."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from docstrata.functions.times import now_in_zone, stamp_ingestion
from docstrata.operators.changes import change_log, change_summary
from docstrata.operators.latest import latest_per_key, latest_view
from docstrata.operators.quality import ingestion_audit
from docstrata.operators.upsert import align_to_schema, merge_upsert
from docstrata.operators.versions import HOT_ROWS
from docstrata.sources.documents import (
    fixed_formats,
    flatten_documents,
    landing_rows,
    parsed_texts,
    rows_of_landing,
    with_open_texts,
)
from docstrata.sources.files import read_files, read_raw
from docstrata.sources.scratch import durable
from docstrata.sources.tables import (
    AUDIT_SCHEMA,
    Batch,
    Tables,
    delete,
    layout_of,
    live_batches,
    next_batch,
    read_archived,
    read_audit,
    read_batches,
    read_master,
    read_rejects,
    remove_dead,
    remove_superseded,
    write_master,
    write_table,
)
from docstrata.spec import PipelineSpec

VIEWS = ("master", "latest", "change_summary", "change_log")
MODES = ("append", "append_dedup", "merge")
# Where a row was, most telling first.
_ORIGIN = (
    "file_modified_at",
    "source_filename",
    "source_path",
    "block_start",
    "line_pos",
    "document_pos",
    "element_pos",
)


def batch_rows(
    flat: DataFrame, spec: PipelineSpec, mode: str, ingestion_ts: dt.datetime | None = None
) -> DataFrame:
    """Master rows of one batch of flat rows.

    All rows of a batch carry one stamp, so "newest" within the batch is decided
    by file time, file name, the place in the file and finally by every column.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    rows = stamp_ingestion(flat, spec.order_col, spec.zone, ingestion_ts)
    if mode == "append":
        return rows
    origin = [c for c in _ORIGIN if c in flat.columns]
    rest = [f.name for f in spec.fields if f.name not in spec.natural_key]
    return latest_per_key(rows, spec.natural_key, origin, tiebreak=rest)


def ingest_texts(
    raw: DataFrame,
    spec: PipelineSpec,
    mode: str = "append_dedup",
    master: DataFrame | None = None,
    on_error: str = "abort",
    engine: str = "typed",
    ingestion_ts: dt.datetime | None = None,
) -> DataFrame:
    """The master table after ingesting the raw texts; no table is written.

    ``append`` adds every row, ``append_dedup`` one per natural key of the
    batch, ``merge`` updates the rows of ``master`` with the same natural key.
    """
    flat = flatten_documents(raw, spec, on_error, engine)
    schema = spec.master_schema()
    rows = batch_rows(_with_lines(flat), spec, mode, ingestion_ts).select(*schema.names)
    if master is None:
        return rows
    master = align_to_schema(master, schema)
    if mode == "merge":
        # Read several times by the merge: parsed and de-duplicated once.
        return merge_upsert(master, durable(rows), spec.natural_key)
    return master.unionByName(rows)


def _with_lines(rows: DataFrame) -> DataFrame:
    """Rows that did not come from files have no line."""
    return rows if "line_pos" in rows.columns else rows.withColumn("line_pos", F.lit(0).cast("long"))


def _with_files(raw: DataFrame) -> DataFrame:
    """Raw texts that did not come from files count as one file per name."""
    known = {
        "source_path": F.col("source_filename"),
        "file_bytes": F.lit(0).cast("long"),
        "file_micros": F.unix_micros(F.col("file_modified_at").cast("timestamp")),
        "block_start": F.lit(0).cast("long"),
    }
    missing = {c: v for c, v in known.items() if c not in raw.columns}
    return _with_lines(raw.withColumns(missing) if missing else raw)


def commit_batch(
    raw: DataFrame,
    spec: PipelineSpec,
    tables: Tables,
    mode: str = "append_dedup",
    on_error: str = "abort",
    ingestion_ts: dt.datetime | None = None,
    foreign: DataFrame | None = None,
    replaces: bool = False,
    stream_batch: int | None = None,
) -> int:
    """Ingest one batch of raw texts into the tables; returns its number.

    The audit is written last and marks the batch as done; readers do not see it
    before.  Every output is the whole of a batch, so a batch that failed is run again
    under the same number and replaces what the first attempt left.  The landing table
    holds the parsed rows of the latest batch (:func:`landing_rows`); everything after the
    parse reads it.
    ``foreign`` lists files that are none of the pipeline's, for the audit.  With
    ``replaces`` the batch takes the place of all before it.  ``stream_batch`` is the
    number a stream has for it, for the audit.
    """
    spark = raw.sparkSession
    batch_id = next_batch(spark, tables)
    before = [] if replaces else live_batches(spark, tables)
    audit = _build_batch(
        raw, spec, tables, mode, on_error, ingestion_ts, foreign, replaces, stream_batch, batch_id, before
    )
    write_table(audit, f"{tables.audit}/batch_id={batch_id}")
    return batch_id


def _build_batch(
    raw: DataFrame,
    spec: PipelineSpec,
    tables: Tables,
    mode: str,
    on_error: str,
    ingestion_ts: dt.datetime | None,
    foreign: DataFrame | None,
    replaces: bool,
    stream_batch: int | None,
    batch_id: int,
    before: list[Batch],
) -> DataFrame:
    """Everything of a batch but its audit, which is returned."""
    spark = raw.sparkSession
    # What a failed merge of this number left must not count for this batch.
    delete(spark, f"{tables.dead}/batch_id={batch_id}")
    stamp = ingestion_ts or now_in_zone(spec.zone)
    parsed = parsed_texts(_with_files(raw), spec, on_error).withColumn(
        "text", F.when(F.col("_docs").isNull(), F.col("text"))
    )
    # Flat rows: a nested table of half-read leaves costs thrice as much to write, and every
    # reader would open it and extract the same values again.
    read = with_open_texts(spec)
    landing = landing_rows(parsed, read)
    write_table(landing, tables.landing)
    landed = spark.read.schema(landing.schema).parquet(tables.landing)

    documents = landed.drop("text")
    if spec.provenance:
        documents = number_lines(documents)
    spec = fixed_formats(lambda s: rows_of_landing(documents, s), spec)
    flat = rows_of_landing(documents, read, spec)
    rows = batch_rows(flat, spec, mode, stamp).select(*spec.master_schema().names)
    folder = f"{tables.master}/batch_id={batch_id}"
    write_master(rows, spec, folder)
    resolved = mode == "merge" and all(b.resolved for b in before)
    if mode == "merge" and before:
        merge_files(spark, spec, tables, before, batch_id)

    rejects = landed.where(F.col("text").isNotNull())
    rejects = rejects.select("source_filename", "file_modified_at", "text")
    write_table(rejects, f"{tables.rejects}/batch_id={batch_id}")
    audit = _audit(landed, flat, foreign, spec, stamp, replaces)
    audit = audit.withColumns(
        {
            "resolved": F.lit(resolved),
            "stream_batch": F.lit(stream_batch).cast("long"),
            "master_schema": F.lit(layout_of(spec)),
        }
    )
    return audit.select(*(f.name for f in AUDIT_SCHEMA if f.name != "batch_id"))


def merge_files(
    spark: SparkSession, spec: PipelineSpec, tables: Tables, before: list[Batch], batch_id: int
) -> None:
    """Rewrites the master files that hold a natural key of a written batch.

    The keys of the batch find the files, of which the other rows are written beside the
    batch; all other files stay as they are.  The names of the rewritten files go to the
    dead table, which counts once the audit has the batch, so readers see either all old
    files or all new ones.  Files that an earlier merge rewrote are deleted now.
    """
    remove_dead(spark, tables)
    keys = list(spec.natural_key)
    folder = f"{tables.master}/batch_id={batch_id}"
    batch = spark.read.schema(spec.master_schema()).parquet(folder).select(*keys)
    live = read_batches(spark, spec, tables, before)
    touched = live.join(batch, keys, "left_semi").select("file_name").distinct()
    dead = f"{tables.dead}/batch_id={batch_id}"
    write_table(touched, dead)
    touched = spark.read.schema("file_name string").parquet(dead)
    rest = live.join(F.broadcast(touched), "file_name", "left_semi").join(batch, keys, "left_anti")
    write_master(rest.select(*spec.master_schema().names), spec, folder, "append")


def number_lines(rows: DataFrame) -> DataFrame:
    """Lines of a landing table numbered from 0 in their file instead of in their task.

    A task numbers the lines of a block in a row, so what is missing is how many lines
    the blocks before it have: one row per block.
    """
    blocks = rows.groupBy("source_path", "block_start").agg(
        F.min("line_pos").alias("_start"), F.count_if("_first").alias("_lines")
    )
    before = Window.partitionBy("source_path").orderBy("block_start")
    ahead = F.sum("_lines").over(before.rowsBetween(Window.unboundedPreceding, -1))
    blocks = blocks.select(
        "source_path", "block_start", (F.coalesce(ahead, F.lit(0)) - F.col("_start")).alias("_shift")
    )
    numbered = rows.join(blocks, ["source_path", "block_start"])
    return numbered.withColumn("line_pos", F.col("line_pos") + F.col("_shift")).select(*rows.columns)


def _audit(
    landed: DataFrame,
    flat: DataFrame,
    foreign: DataFrame | None,
    spec: PipelineSpec,
    stamp: dt.datetime,
    replaces: bool,
) -> DataFrame:
    """One row per file of the batch, also for files that gave no rows."""
    files = landed.groupBy("source_path", "source_filename", "file_bytes", "file_micros").agg(
        F.lit("loaded").alias("status"),
        F.coalesce(F.sum("_documents"), F.lit(0)).alias("documents"),
        F.count_if(F.col("text").isNotNull()).alias("rejected"),
    )
    counts = ingestion_audit(flat, spec.natural_key, "source_path", sketched=True)
    audit = files.join(counts, "source_path", "left").fillna(0, ["row_count", "distinct_keys"])
    if foreign is not None:
        none = {c: F.lit(0).cast("long") for c in ("documents", "rejected", "row_count", "distinct_keys")}
        none["key_sketch"] = F.lit(None).cast("binary")
        others = foreign.withColumns({"status": F.lit("name_mismatch"), **none})
        audit = audit.unionByName(others.select(*audit.columns))
    return stamp_ingestion(audit.withColumn("replaces", F.lit(replaces)), "ingestion_ts", spec.zone, stamp)


def ingest(
    spark: SparkSession,
    spec: PipelineSpec,
    directory: str | Sequence[str],
    tables: Tables,
    mode: str = "append_dedup",
    layout: str = "document",
    on_error: str = "abort",
    recursive: bool = False,
    ingestion_ts: dt.datetime | None = None,
    replaces: bool = False,
) -> DataFrame:
    """Load every file of a folder as one batch; returns its audit rows."""
    folders = [directory] if isinstance(directory, str) else list(directory)
    raw = reduce(
        DataFrame.unionByName,
        (
            read_raw(spark, d, spec.name_regex, spec.name_glob, layout, recursive)
            for d in folders
        ),
    )
    batch_id = commit_batch(raw, spec, tables, mode, on_error, ingestion_ts, None, replaces)
    return read_audit(spark, tables).where(F.col("batch_id") == batch_id)


def rebuild(
    spark: SparkSession,
    spec: PipelineSpec,
    archives: str | Sequence[str],
    tables: Tables,
    mode: str = "append_dedup",
    layout: str = "document",
    on_error: str = "abort",
    ingestion_ts: dt.datetime | None = None,
) -> DataFrame:
    """Load all archived files again, subfolders included, in place of all there is.

    The tables change when the new batch is complete; a malformed file leaves them as
    they were.  The audit keeps the files of earlier batches, so a later incremental run
    does not load them again.
    """
    audit = ingest(
        spark, spec, archives, tables, mode, layout, on_error, True, ingestion_ts, replaces=True
    )
    remove_superseded(spark, tables)
    return audit


def replay(
    spark: SparkSession,
    spec: PipelineSpec,
    tables: Tables,
    mode: str = "append_dedup",
    layout: str = "document",
    on_error: str = "abort",
) -> list[int]:
    """Loads the archived files again, batch by batch as they were delivered, in place of
    all there is; returns the numbers of the new batches.

    Each batch has the stamp it had, and each file the name, place and time it had when it
    arrived, so versions and change log are what they were.  The batches are built below
    the new numbers, beside what is there; their audit is written in one go when all are
    complete, and takes the place of the old one.  Nothing changes if a file fails.
    """
    if mode == "merge":
        raise ValueError("a merged master keeps no versions to replay; use rebuild")
    audit, archived = read_audit(spark, tables), read_archived(spark, tables)
    loaded = audit.where("status = 'loaded'").select("source_path", "source_filename", "file_bytes", "file_micros", "batch_id", "ingestion_ts")
    places = archived.where("status = 'archived'").groupBy("source_path", "file_micros")
    places = places.agg(F.min("archived_to").alias("archived_to"))
    files = durable(loaded.join(places, ["source_path", "file_micros"], "left"))
    # A file is loaded once; where a rebuild loaded it again, its first batch counts.
    first = files.groupBy("source_path", "file_bytes", "file_micros").agg(
        F.min_by(F.struct("batch_id", "ingestion_ts", "source_filename", "archived_to"), "batch_id").alias("f")
    )
    files = durable(first.select("source_path", "file_bytes", "file_micros", "f.*"))
    lost = files.where("archived_to IS NULL").first()
    if lost is not None:
        raise ValueError(f"not in the archive: {lost['source_path']}")
    start, done, audits = next_batch(spark, tables), [], []
    batches = files.select("batch_id", "ingestion_ts").distinct().orderBy("batch_id", "ingestion_ts")
    for n, b in enumerate(batches.collect()):
        own = files.where((F.col("batch_id") == b["batch_id"]) & F.col("ingestion_ts").eqNullSafe(F.lit(b["ingestion_ts"])))
        raw = _as_delivered(spark, own, layout)
        audit = _build_batch(raw, spec, tables, mode, on_error, b["ingestion_ts"], None, n == 0, None, start + n, [])
        audits.append(durable(audit))  # the next batch takes the landing table
        done.append(start + n)
    if done:
        whole = reduce(
            DataFrame.unionByName, (a.withColumn("batch_id", F.lit(n)) for n, a in zip(done, audits, strict=True))
        )
        whole.write.mode("append").partitionBy("batch_id").parquet(tables.audit)
        remove_superseded(spark, tables)
    return done


def _as_delivered(spark: SparkSession, files: DataFrame, layout: str) -> DataFrame:
    """The texts of archived files of one batch under the identity they arrived with."""
    paths = [r[0] for r in files.select("archived_to").collect()]  # one batch: max_files_per_batch
    raw = read_files(spark, paths, layout, encoded=False)
    plain = F.regexp_replace(F.url_decode(F.replace("source_path", F.lit("+"), F.lit("%2B"))), "^file:/+", "file:/")
    named = F.regexp_replace("archived_to", "^file:/+", "file:/")
    known = files.select(
        named.alias("_at"),
        F.col("source_filename").alias("_name"),
        F.col("source_path").alias("_path"),
        F.col("file_bytes").alias("_bytes"),
        F.col("file_micros").alias("_micros"),
    )
    rows = raw.withColumn("_at", plain).join(F.broadcast(known), "_at")
    return rows.select(
        F.col("_name").alias("source_filename"),
        F.timestamp_micros("_micros").cast("timestamp_ntz").alias("file_modified_at"),
        F.col("_path").alias("source_path"),
        F.col("_bytes").alias("file_bytes"),
        F.col("_micros").alias("file_micros"),
        "block_start",
        "line_pos",
        "text",
    )


def compact(spark: SparkSession, spec: PipelineSpec, tables: Tables, merged: bool = False) -> None:
    """Writes the master as one batch, ``merged`` without the rows that newer ones
    replaced, and deletes the folders of the batches before it."""
    batch_id = next_batch(spark, tables)
    delete(spark, f"{tables.dead}/batch_id={batch_id}")
    resolved = merged or all(b.resolved for b in live_batches(spark, tables))
    rows = read_master(spark, spec, tables, merged)
    write_master(rows, spec, f"{tables.master}/batch_id={batch_id}")
    kept = read_rejects(spark, tables).drop("batch_id")
    write_table(kept, f"{tables.rejects}/batch_id={batch_id}")
    said = {
        "status": "compacted",
        "documents": 0,
        "rejected": 0,
        "row_count": 0,
        "distinct_keys": 0,
        "ingestion_ts": now_in_zone(spec.zone),
        "replaces": True,
        "resolved": resolved,
        "master_schema": layout_of(spec),
    }
    columns = T.StructType([f for f in AUDIT_SCHEMA if f.name != "batch_id"])
    marker = spark.createDataFrame([tuple(said.get(f.name) for f in columns)], columns)
    write_table(marker, f"{tables.audit}/batch_id={batch_id}")
    remove_superseded(spark, tables)


def register_views(
    master: DataFrame,
    spec: PipelineSpec,
    prefix: str = "",
    hot_rows: int | None = HOT_ROWS,
    names: Sequence[str] = VIEWS,
) -> dict[str, DataFrame]:
    """Temp views over the master: all rows, latest version, change summary and log.

    They show the files of this moment; register them again after the next ingest.
    Only the latest version and the change log, if they are among ``names``, run a job now,
    to look for hot keys.
    """
    unversioned = [spec.order_col, *spec.exclude]
    make = {
        "master": lambda: master,
        "latest": lambda: latest_view(master, spec),
        "change_summary": lambda: change_summary(master, spec.version_key, unversioned),
        "change_log": lambda: change_log(
            master, spec.version_key, spec.order_col, spec.exclude, hot_rows=hot_rows
        ),
    }
    views = {name: make[name]() for name in names}
    for name, view in views.items():
        view.createOrReplaceTempView(f"{prefix}{name}")
    return views
