"""Sources and sinks: Parquet and CSV tables laid out for cell and year access."""

from __future__ import annotations

import logging
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.prepare import nan_to_null, year_range

BASELINE_COLUMNS = (
    "tx90p_threshold", "tx10p_threshold", "tn90p_threshold", "tn10p_threshold", "tas_25p_threshold", "tas_75p_threshold",
    "pr95p_threshold", "pr99p_threshold", "pr_25p_threshold", "pr_75p_threshold",
)
log = logging.getLogger(__name__)
#: The metadata entry of a baseline's years.
PERIOD = "baseline_period"
#: Cells in a partition of a series store.
SERIES_BLOCK = 1024
SERIES_PART = "cell_block"
POINTS = T.StructType(
    [
        T.StructField("saleid", T.LongType()),
        T.StructField("parcelid", T.LongType()),
        T.StructField("parcel_level_latitude", T.DoubleType()),
        T.StructField("parcel_level_longitude", T.DoubleType()),
    ]
)


def read_daily(spark: SparkSession, path: str, first: int, last: int) -> DataFrame:
    """Daily rows of some years; a table partitioned by year is read for these years only."""
    return nan_to_null(year_range(spark.read.parquet(path), first, last))


def read_stores(spark: SparkSession, paths: dict[str, str], first: int, last: int) -> dict[str, DataFrame]:
    return {name: read_daily(spark, path, first, last) for name, path in paths.items()}


def read_glob(spark: SparkSession, pattern: str) -> DataFrame:
    """Several files as one table; columns that some lack are null there."""
    return spark.read.option("mergeSchema", True).parquet(pattern)


def read_points(spark: SparkSession, path: str) -> DataFrame:
    """The points of a CSV file, whose header must have both coordinates."""
    header = spark.read.csv(path, header=True).columns
    missing = {"parcel_level_latitude", "parcel_level_longitude"} - set(header)
    if missing:
        raise ValueError(f"points need the columns {sorted(missing)}")
    schema = T.StructType([next((f for f in POINTS if f.name == c), T.StructField(c, T.StringType())) for c in header])
    return spark.read.schema(schema).csv(path, header=True)


def write_baseline(df: DataFrame, path: str, first: int, last: int) -> None:
    """Thresholds by cell and day of year; the years that they come from stay with the column of days."""
    df.withMetadata("doy", {PERIOD: f"{first}-{last}"}).write.mode("overwrite").parquet(path)


def read_baseline(
    spark: SparkSession,
    path: str,
    required: Sequence[str] = BASELINE_COLUMNS,
    optional: Sequence[str] = (),
    allow_missing: bool = False,
    period: str | None = None,
    strict: bool = False,
) -> tuple[DataFrame, list[str]]:
    """Thresholds by cell and day of year, and the names of those that are missing or all null.

    No table at ``path`` is a FileNotFoundError. A missing required column raises
    unless ``allow_missing``; so does a table without cell_id or doy, or with days
    outside 1 to 366. Another ``period`` than the one the table was written with
    (``write_baseline``), or none, is a warning, and with ``strict`` an error.
    """
    try:
        df = nan_to_null(spark.read.parquet(path))
    except AnalysisException as absent:
        if absent.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"no baseline at {path}: compute it with baseline_percentiles first") from absent
    keys = [c for c in ("cell_id", "doy") if c not in df.columns]
    if keys:
        raise ValueError(f"a baseline needs the columns {keys}")
    missing = [c for c in required if c not in df.columns]
    if missing and not allow_missing:
        raise ValueError(f"the baseline lacks {missing}")
    if period is not None and (found := df.schema["doy"].metadata.get(PERIOD)) != period:
        message = f"the baseline covers {found or 'unknown years'}, not {period}"
        if strict:
            raise ValueError(message)
        log.warning(message)
    there = [c for c in (*required, *optional) if c in df.columns]
    facts = df.agg(F.min("doy").alias("__low"), F.max("doy").alias("__high"), *[F.count(c).alias(c) for c in there]).first()
    if facts["__low"] is not None and not (1 <= facts["__low"] and facts["__high"] <= 366):
        raise ValueError(f"days of year run from {facts['__low']} to {facts['__high']}")
    empty = [c for c in there if not facts[c]]
    if empty:
        log.warning("all values are missing in %s", empty)
    return df.select("cell_id", "doy", *there), missing + empty


def write_by_year(df: DataFrame, path: str) -> None:
    """Replaces the years that ``df`` has and leaves the others; running it again gives the same table.

    Rows are dealt by year, and Spark splits years that are too large for a task.
    """
    (
        df.hint("rebalance", "year")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("year")
        .parquet(path)
    )


def write_series_store(df: DataFrame, path: str, overwrite: bool = False, block: int = SERIES_BLOCK) -> None:
    """All years of a cell side by side, for reading time series. An existing store is an error unless ``overwrite``.

    Every ``block`` neighbouring cell_ids are a partition, so a reader of some cells
    opens their partitions only.
    """
    ordered = df.withColumn(SERIES_PART, F.floor(F.col("cell_id") / block)).repartitionByRange("cell_id").sortWithinPartitions("cell_id", "year")
    ordered.write.mode("overwrite" if overwrite else "errorifexists").partitionBy(SERIES_PART).parquet(path)


def read_series(spark: SparkSession, path: str, cells: DataFrame | None = None, block: int = SERIES_BLOCK) -> DataFrame:
    """A series store; with ``cells(cell_id)``, the rows of these cells, from the partitions that hold them.

    The partitions are named in the scan, so they are pruned whatever the planner
    makes of the join; there are a block's fraction as many as cells.
    """
    store = spark.read.parquet(path)
    if cells is None:
        return store.drop(SERIES_PART)
    wanted = cells.select(F.floor(F.col("cell_id") / block).alias("p")).distinct().where("p is not null").collect()
    rows = store.where(F.col(SERIES_PART).isin([r["p"] for r in wanted])) if wanted else store.where("false")
    return rows.join(cells.select("cell_id").distinct(), "cell_id", "left_semi").select(*[c for c in store.columns if c != SERIES_PART])


def write_bucketed(df: DataFrame, table: str, buckets: int, path: str | None = None, order: Sequence[str] = ("date", "year", "doy")) -> None:
    """Writes a catalog table in buckets by cell_id, sorted by cell and those of the ``order`` columns that it has; an older one is replaced.

    Tables of as many buckets are co-located: inside ``colocated`` their joins on a
    cell and aggregates and windows by cell run where the rows lie. Rows are dealt
    by cell before, so a bucket is one file.
    """
    dealt = df.repartition(buckets, "cell_id").write.mode("overwrite").format("parquet").bucketBy(buckets, "cell_id")
    dealt = dealt.sortBy("cell_id", *[c for c in order if c in df.columns])
    (dealt.option("path", path) if path else dealt).saveAsTable(table)


@contextmanager
def colocated(spark: SparkSession) -> Iterator[None]:
    """Plans made inside may join on cell and day where both sides are dealt by cell, instead of dealing both anew."""
    wanted = {"spark.sql.requireAllClusterKeysForCoPartition": "false", "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false"}
    before = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def append_year(df: DataFrame, path: str) -> None:
    """Adds a year to a table written by ``write_by_year``; a year that is there is replaced."""
    write_by_year(df, path)


def write_extraction(df: DataFrame, path: str, order: Sequence[str] = ("saleid", "parcelid", "year")) -> None:
    """Extracted values as CSV, in the order of those of the ``order`` columns that are there, over all files."""
    there = [c for c in order if c in df.columns]
    (df.orderBy(*there) if there else df).write.mode("overwrite").csv(path, header=True)


def write_report(df: DataFrame, path: str, kind: str = "json") -> None:
    """A statistics report, a row per variable, as JSON or CSV."""
    if kind == "json":
        df.write.mode("overwrite").json(path)
    elif kind == "csv":
        df.write.mode("overwrite").csv(path, header=True)
    else:
        raise ValueError("kind must be json or csv")


def combine(parts: Sequence[DataFrame]) -> DataFrame:
    """Concatenates results of different years by column name."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out
