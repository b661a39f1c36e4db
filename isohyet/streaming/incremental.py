"""Incremental ingestion: new daily files recompute the cells and years that they touch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

#: Archive and results are cut into so many parts by cell in every year.
PARTS = 16
_PLACE = ["cell_id", "year"]


def part_of(cell: Column, parts: int) -> Column:
    """The part of a cell, the same in the archive and in the results."""
    return F.pmod(F.xxhash64(cell.cast("long")), F.lit(parts)).cast("int")


def within(touched: DataFrame) -> Column:
    """Whether a row lies in a (year, part) that ``touched`` has, as a predicate that prunes partitions."""
    by_year: dict[int, list[int]] = {}
    for r in touched.select("year", "part").distinct().collect():  # years times parts at most
        by_year.setdefault(r["year"], []).append(r["part"])
    out = F.lit(False)
    for year, places in sorted(by_year.items()):
        out |= (F.col("year") == year) & F.col("part").isin(sorted(places))
    return out


def _stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """A table by its path; None before anything is written there."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as absent:
        if absent.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def ingest(
    spark: SparkSession,
    incoming: str,
    schema: T.StructType,
    archive: str,
    results: str,
    checkpoint: str,
    compute: Callable[[DataFrame], DataFrame],
    reach: int = 1,
    parts: int = PARTS,
) -> StreamingQuery:
    """Starts a run over all new files under ``incoming`` and returns the query.

    A batch adds its rows to ``archive``, and what it has there is the table of
    changes: the (cell, year) that it touched. Only these, and the years that
    ``reach`` adds, are read again, computed by ``compute``, and merged into
    ``results``. Both tables are partitioned by year and part, a hash of the cell,
    so other parts and years are not opened; in those that are, a semi join on
    (cell, year) leaves the rest out. ``reach`` is how many years back a result of
    ``compute`` looks: so many years before are read too, and so many after are
    computed again. It is not for results that depend on all years of a cell, such
    as standardised precipitation with its calibration.

    A batch that runs again replaces its own rows, so the outcome is the same; of
    rows for one cell and day, the latest batch wins. ``compute`` takes daily rows
    and returns rows with cell_id and year.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumns({"year": F.year("date"), "part": part_of(F.col("cell_id"), parts), "batch": F.lit(batch_id)})
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year", "part", "batch").parquet(archive)
        stored = _stored(spark, archive, rows.schema)
        if stored is None:  # a first batch without rows
            return
        changed = stored.where(F.col("batch") == batch_id).select(*_PLACE, "part").distinct()
        stale = changed.select("cell_id", "part", F.explode(F.sequence(F.col("year"), F.col("year") + reach)).alias("year")).distinct()
        needed = stale.select("cell_id", "part", F.explode(F.sequence(F.col("year") - reach, F.col("year"))).alias("year")).distinct()
        history = stored.where(within(needed)).join(needed.select(*_PLACE), _PLACE, "left_semi")
        values = [c for c in batch.columns if c not in ("cell_id", "date")]
        latest = history.groupBy("cell_id", "date").agg(F.max_by(F.struct(*values), "batch").alias("v")).select("cell_id", "date", "v.*")
        fresh = compute(latest).join(stale.select(*_PLACE), _PLACE, "left_semi").withColumn("part", part_of(F.col("cell_id"), parts))
        before = _stored(spark, results, fresh.schema)
        if before is not None:
            kept = before.where(within(stale)).join(stale.select(*_PLACE), _PLACE, "left_anti")
            fresh = fresh.unionByName(kept)
        # Files are moved into place when all are written, so the rows that stay are read before they are replaced.
        fresh.hint("rebalance", "year", "part").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year", "part").parquet(results)

    stream = spark.readStream.schema(schema).parquet(incoming)
    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
