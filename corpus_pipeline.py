"""From raw documents to packed training sequences, in five stages.

Every stage takes (spark, docs, sf_dir) and works on all documents that the
one before kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodestar.llm import langid, mixing, packing, quality, simhash
from lodestar.session import materialize
from lodestar.sources.tables import load


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble accepts."""
    return quality.accepted(docs, load(spark, sf_dir, "labels", "doc_id", "quality"))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters, at least half of those that the model can judge in one language."""
    return langid.monolingual(docs, least=0.5, unlearned=True)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every SimHash group."""
    return simhash.keep_one(docs, shingle=4, distance=4)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents of a source below its target come twice, others once or not at all."""
    return mixing.mixed_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of ``packing.CAPACITY`` words."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("language id", language_stage),
    ("simhash near-dedup", near_duplicate_stage),
    ("source mixing", mixing_stage),
    ("best-fit packing", packing_stage),
]
# Learned models (stages 1 and 2), graph search (3) and best fit (5) have no SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
