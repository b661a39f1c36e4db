"""The training-corpus pipeline: language ID, exact dedup, near-dedup, decontamination, mixing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's docs. All but the last return the
columns of docs. The filtering stages keep rows by doc_id: rows that share a
doc_id stay or go together, and rows without one are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isohyet.llm.common import materialise, table
from isohyet.llm.decontamination import contaminated
from isohyet.llm.exact_dedup import exact_duplicates
from isohyet.llm.language_id import keep_identified
from isohyet.llm.mixing import mix
from isohyet.llm.near_dedup import near_duplicates


def without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """``docs`` without the doc_ids in ``dropped(doc_id)``; the planner knows the true size of that list."""
    dropped = materialise(dropped.select("doc_id").where("doc_id is not null").distinct(), "dropped")
    return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is determined."""
    return keep_identified(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the longest, then the smallest doc_id."""
    return without(docs, exact_duplicates(docs).where(~F.col("kept")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group that five-word shingles link at 0.8."""
    return without(docs, near_duplicates(docs).where(~F.col("kept")))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return without(docs, contaminated(docs, table(spark, sf_dir, "benchmark")))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of what is left: doc_id, size, source_size, target, taken, source, rate, copies."""
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken", "source", "rate", "copies")


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
