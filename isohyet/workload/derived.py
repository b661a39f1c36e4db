"""The weather-like view of the star-schema tables that the registered queries run on.

Every supplier is a grid cell; its line items by ship date shape each day's
values. Arithmetic is on integers, so that Spark and SQL agree to the bit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Cells that a task unfolds into days.
CELLS_OF_TASK = 512


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """cell_id, lat_idx, lon_idx, lat, lon, region: a grid five cells wide."""
    s, n = read(spark, sf_dir, "supplier"), read(spark, sf_dir, "nation")
    lat_idx, lon_idx = F.expr("cast((s_suppkey - 1) div 5 as int)"), F.expr("cast((s_suppkey - 1) % 5 as int)")
    return s.join(n, s["s_nationkey"] == n["n_nationkey"]).select(
        F.col("s_suppkey").cast("long").alias("cell_id"),
        lat_idx.alias("lat_idx"),
        lon_idx.alias("lon_idx"),
        (25 + lat_idx / 8.0).alias("lat"),
        (-125 + lon_idx / 2.0).alias("lon"),
        F.col("n_regionkey").cast("int").alias("region"),
    )


def tasks_by_cell(spark: SparkSession, sf_dir: str) -> int:
    """How many tasks the days of all cells are dealt to."""
    return max(spark.sparkContext.defaultParallelism, -(-read(spark, sf_dir, "supplier").count() // CELLS_OF_TASK))


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """cell_id, date, lat, lon, region, tas, tasmax, tasmin, pr, tdew, vpdmax, vpdmin for the years of the ship dates.

    Line items and suppliers are dealt by cell, and only then does a cell unfold
    into its days, where it lies: the days themselves are never dealt or sorted,
    and what groups them by cell finds them together. Days without line items
    follow the others, where the zipped sums have ended and are null; all of it
    is compiled code. The number of tasks grows with the cells, so that of a
    task's days does not.
    """
    items, grid, tasks = read(spark, sf_dir, "lineitem"), cells(spark, sf_dir), tasks_by_cell(spark, sf_dir)
    sold = items.select(
        F.col("l_suppkey").cast("long").alias("cell_id"), F.to_date("l_shipdate").alias("date"),
        F.round(F.col("l_quantity") * F.col("l_discount") * 100).cast("long").alias("p"), F.col("l_quantity").cast("long").alias("q"),
    ).where("cell_id is not null and date is not null").repartition(tasks, "cell_id")
    obs = sold.groupBy("cell_id", "date").agg(F.sum("p").alias("p"), F.sum("q").alias("q")).groupBy("cell_id").agg(F.collect_list(F.struct("date", "p", "q")).alias("seen"))
    years = items.agg(F.year(F.min("l_shipdate")).alias("first"), F.year(F.max("l_shipdate")).alias("last"))
    whole = grid.repartition(tasks, "cell_id").join(obs.hint("merge"), "cell_id", "left").crossJoin(F.broadcast(years))
    whole = whole.withColumn("seen", F.coalesce("seen", F.expr("cast(array() as array<struct<date: date, p: bigint, q: bigint>>)")))
    others = F.expr("array_except(sequence(make_date(first, 1, 1), make_date(last, 12, 31)), seen.date)")
    days = F.arrays_zip(F.concat("seen.date", others).alias("date"), F.col("seen.p").alias("p"), F.col("seen.q").alias("q"))
    d = whole.select(*grid.columns, F.inline(days))
    d = d.withColumns({"day_no": F.datediff("date", F.lit("1970-01-01").cast("date")).cast("long"), "doy": F.dayofyear("date").cast("long")})
    d = d.withColumn("pm", F.expr("(coalesce(p, 0) * 3 + day_no * 37 + (day_no % 89) * (day_no % 83) + cell_id * 11) % 100"))
    d = d.withColumn("base", F.expr("24 - (abs(doy - 200) * 40) div 180 - lat_idx % 12 + (coalesce(q, 25) + (day_no % 29) * 7 + cell_id * 3) % 17 - 8"))
    there = "q is not null or (day_no + cell_id) % 97 <> 0"
    return d.select(
        "cell_id", "date", "lat", "lon", "region",
        F.expr(f"case when {there} then cast(base as double) end").alias("tas"),
        F.expr(f"case when {there} then cast(base + 4 + pm % 7 as double) end").alias("tasmax"),
        F.expr(f"case when {there} then cast(base - 4 - pm % 5 as double) end").alias("tasmin"),
        F.expr("case when pm < 55 then 0.0D else (pm - 55) * (pm - 55) / 20.0D end").alias("pr"),
        F.expr(f"case when {there} then cast(base - 6 - pm % 5 as double) end").alias("tdew"),
        F.expr("(pm % 50) / 10.0D").alias("vpdmax"),
        F.expr("(pm % 20) / 20.0D").alias("vpdmin"),
    )


#: The same view for SQL: CTEs cells and daily (with year, doy, day_no, month).
PREFIX = """
WITH cells AS (
  SELECT CAST(s_suppkey AS BIGINT) AS cell_id, CAST((s_suppkey - 1) // 5 AS INT) AS lat_idx, CAST((s_suppkey - 1) % 5 AS INT) AS lon_idx,
         25 + ((s_suppkey - 1) // 5) / 8.0::DOUBLE AS lat, -125 + ((s_suppkey - 1) % 5) / 2.0::DOUBLE AS lon, CAST(n_regionkey AS INT) AS region
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
obs AS (
  SELECT CAST(l_suppkey AS BIGINT) AS cell_id, CAST(l_shipdate AS DATE) AS date,
         sum(CAST(round(l_quantity * l_discount * 100) AS BIGINT)) AS p, sum(CAST(l_quantity AS BIGINT)) AS q
  FROM lineitem GROUP BY 1, 2),
years AS (SELECT year(min(l_shipdate)) AS first, year(max(l_shipdate)) AS last FROM lineitem),
calendar AS (SELECT CAST(unnest(generate_series(make_date(first, 1, 1), make_date(last, 12, 31), INTERVAL 1 DAY)) AS DATE) AS date FROM years),
raw0 AS (
  SELECT c.*, k.date, o.p, o.q, CAST(date_diff('day', DATE '1970-01-01', k.date) AS BIGINT) AS day_no, dayofyear(k.date) AS doy,
         CAST(year(k.date) AS BIGINT) AS year, CAST(month(k.date) AS BIGINT) AS month
  FROM cells c CROSS JOIN calendar k LEFT JOIN obs o ON o.cell_id = c.cell_id AND o.date = k.date),
raw1 AS (
  SELECT *, (coalesce(p, 0) * 3 + day_no * 37 + (day_no % 89) * (day_no % 83) + cell_id * 11) % 100 AS pm,
         24 - (abs(doy - 200) * 40) // 180 - lat_idx % 12 + (coalesce(q, 25) + (day_no % 29) * 7 + cell_id * 3) % 17 - 8 AS base,
         q IS NOT NULL OR (day_no + cell_id) % 97 <> 0 AS there
  FROM raw0),
daily AS (
  SELECT cell_id, date, lat, lon, region, day_no, doy, year, month,
         CASE WHEN there THEN CAST(base AS DOUBLE) END AS tas,
         CASE WHEN there THEN CAST(base + 4 + pm % 7 AS DOUBLE) END AS tasmax,
         CASE WHEN there THEN CAST(base - 4 - pm % 5 AS DOUBLE) END AS tasmin,
         CASE WHEN pm < 55 THEN 0.0::DOUBLE ELSE (pm - 55) * (pm - 55) / 20.0::DOUBLE END AS pr,
         CASE WHEN there THEN CAST(base - 6 - pm % 5 AS DOUBLE) END AS tdew,
         (pm % 50) / 10.0::DOUBLE AS vpdmax, (pm % 20) / 20.0::DOUBLE AS vpdmin
  FROM raw1)
"""
