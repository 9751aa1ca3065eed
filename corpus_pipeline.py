"""The stages that turn documents into packed training sequences.

Each stage reads what the one before it wrote. All but the last return the columns of
their input; the last returns where every piece of every document goes.

Defined cases, in every stage: a null or empty text is a document without words, which only
the quality model can reject; rows that share a doc_id are one document to the
near-duplicates and keep their rows elsewhere; a null doc_id is kept; very long texts are
read whole; of equal documents the one with the smallest id stays; an empty table stays
empty; further columns pass through, whatever their names, up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docstrata.llm import decontaminate, neardup, packing, quality, queries, substrings
from docstrata.llm.tables import reachable, table
from docstrata.sources.scratch import scratch_path


#: The workers of an executor serve all stages one after the other and keep what they
#: once needed, so batches are smaller here.
ARROW_BYTES = 1 << 20


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model, trained on those at hand, does not reject."""
    reachable(spark, ARROW_BYTES)
    model = queries.quality_model(spark, docs, sf_dir)
    return quality.accepted(docs, model)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies."""
    reachable(spark, ARROW_BYTES)
    return neardup.representatives(docs, words=2)


def unrepeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that a smaller document has; those that lose nothing
    stay as they are, those that lose all words go."""
    reachable(spark, ARROW_BYTES)
    return substrings.deduplicate(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark items cover less than a twentieth."""
    reachable(spark, ARROW_BYTES)
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes."""
    reachable(spark, ARROW_BYTES)
    return packing.pack(docs)


STAGES = [
    ("quality classifier", good),
    ("MinHash near-dedup", distinct),
    ("substring dedup", unrepeated),
    ("benchmark decontamination", uncontaminated),
    ("best-fit packing", packed),
]
#: The quality model and the tokenizer are beyond SQL; the tests hold the stages
#: against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"pipeline-{number}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
