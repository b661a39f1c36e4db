"""Helpers shared by the corpus operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: ASCII white space as the contracts name it.
WORD = "[^\\x20\\x09-\\x0D]+"
SPACE = "[\\x20\\x09-\\x0D]+"
#: Shuffle files of a plan that is written once go when it has been written.
_TIDY = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor shares: ``spark.checkpoint.dir``, or where it is unset, one in the warehouse."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    return at.rstrip("/") if at else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/isohyet"


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Session settings for the actions inside, and the old ones afterwards."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def materialise(df: DataFrame, name: str, batch_rows: int | None = None) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back.

    Cuts the lineage with files that outlive any executor, and gives the
    planner the true size of the data for its join choices. ``batch_rows``
    bounds the rows of an Arrow batch, where a row makes much of a long text.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    batch = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(batch_rows)} if batch_rows else {}
    with settings(spark, _TIDY | batch):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables of ``materialise`` that no later step reads. Where the driver cannot reach the store, they stay."""
    from pyarrow import fs

    for df in tables:
        path = df.written_to
        try:
            store, at = fs.FileSystem.from_uri(path if ":" in path.split("/")[0] else f"file://{path}")
            store.delete_dir(at)
        except (OSError, pa.ArrowInvalid):
            continue


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ranked(rows: DataFrame, column: str, name: str) -> DataFrame:
    """``rows`` with ``name``, the place of ``column`` from 0, nulls last; ties in any order.

    Places come from a range partitioning and the row counts of its
    partitions, so no task sorts all rows.
    """
    order = F.col(column).asc_nulls_last()
    placed = materialise(rows.repartitionByRange(order).withColumn("_part", F.spark_partition_id()), "ranked")
    before, total = [], 0
    for r in sorted(placed.groupBy("_part").agg(F.count("*").alias("n")).collect()):  # a number for each partition
        before += [F.lit(r["_part"]), F.lit(total)]
        total += r["n"]
    start = F.create_map(*before)[F.col("_part")] if before else F.lit(0)
    return placed.withColumn(name, F.row_number().over(Window.partitionBy("_part").orderBy(order)) - 1 + start).drop("_part")


def ordered_ids(docs: DataFrame) -> DataFrame:
    """``docs`` with ``doc``, a long that orders like doc_id; null for null. Ids that are no integers go by their place."""
    if isinstance(docs.schema["doc_id"].dataType, T.IntegralType):
        return docs.withColumn("doc", F.col("doc_id").cast("long"))
    places = ranked(docs.select("doc_id").where("doc_id is not null").distinct(), "doc_id", "doc").select(F.col("doc_id").alias("_id"), F.col("doc").cast("long").alias("doc"))
    return docs.join(materialise(places, "ids"), F.col("doc_id") == F.col("_id"), "left").drop("_id")
