"""Small helpers the operators share."""

from __future__ import annotations

import os
import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from docstrata.sources.scratch import scratch_path
from docstrata.sources.tables import delete

BROADCAST_BYTES = 64 << 20
ARROW_BYTES = 4 << 20
_ARROW_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def reachable(spark: SparkSession, arrow_bytes: int = ARROW_BYTES) -> None:
    """Lets the Python workers of a local session import this package, wherever the
    session was started; on a cluster the package is installed.  Arrow batches of texts
    are bounded by their bytes, in the JVM and in its workers, not by a number of rows; a
    session that already has a lower bound keeps it.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, *paths]))
    limit = re.sub(r"\D", "", spark.conf.get(_ARROW_LIMIT))
    if int(limit or 0) == 0 or int(limit) > arrow_bytes:
        spark.conf.set(_ARROW_LIMIT, str(arrow_bytes))


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Columns by their exact names, whatever else the table has (names that differ
    only in case included); the first one of a repeated name."""
    plain = df.toDF(*(f"_{i}" for i in range(len(df.columns))))
    return plain.select(*(F.col(f"_{df.columns.index(n)}").alias(n) for n in names))


def enclose(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """The table with its columns renamed by position (``_0``, ``_1``, ...), so that no
    name of its own can clash with those an operator adds, and the names."""
    return df.toDF(*(f"_{i}" for i in range(len(df.columns)))), df.columns


def inner(names: list[str], name: str) -> str:
    """What ``enclose`` calls a column."""
    return f"_{names.index(name)}"


def disclose(df: DataFrame, names: list[str], *results: str) -> DataFrame:
    """The columns under their own names again, and results after them; a column of
    the input with the name of a result gives way to it."""
    new = {r.lower() for r in results}
    kept = [F.col(f"_{i}").alias(n) for i, n in enumerate(names) if n.lower() not in new]
    return df.select(*kept, *results)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Scratch:
    """Intermediate tables of one call, each written once below the shared folder and
    read from there, so a lost executor costs at most the tasks it was running."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = scratch_path(spark, name)
        self.written: list[tuple[DataFrame, str]] = []
        self.count = 0

    def write(self, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{self.count}"
        self.count += 1
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.written.append((out, path))
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Deletes tables that nothing reads any more."""
        for kept, path in list(self.written):
            if any(kept is t for t in tables):
                delete(self.spark, path)
                self.written = [w for w in self.written if w[1] != path]

    def keep_only(self, *tables: DataFrame) -> None:
        self.drop(*(t for t, _ in self.written if not any(t is k for k in tables)))


def small_side(df: DataFrame, row_bytes: int | Column) -> DataFrame:
    """A checkpointed table as the side of a join: broadcast where its measured size
    is below the bound, shuffled like any other beyond it."""
    width = F.lit(row_bytes) if isinstance(row_bytes, int) else row_bytes
    size = df.agg(F.sum(width.cast("long"))).first()[0] or 0
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


__all__ = [
    "BROADCAST_BYTES",
    "Scratch",
    "disclose",
    "enclose",
    "inner",
    "pick",
    "reachable",
    "small_side",
    "table",
]
