"""Ingestion by cell and year: what is read again, and what stays."""

from datetime import date, timedelta

from pyspark.sql import functions as F

from isohyet.streaming.incremental import ingest, part_of

SCHEMA = "cell_id long, date date, pr double"


def days(cells, years, value):
    return [(c, date(y, 1, 1) + timedelta(i), float(value + c)) for c in cells for y in years for i in range(365)]


def totals(days_):
    return days_.groupBy("cell_id", F.year("date").alias("year")).agg(F.sum("pr").alias("pr"), F.count("*").alias("n"))


class Run:
    def __init__(self, spark, base, compute, **how):
        self.spark, self.base, self.compute, self.how, self.n = spark, base, compute, how, 0

    def drop(self, rows):
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{self.base}/in/{self.n}")
        self.n += 1
        schema = self.spark.createDataFrame([], SCHEMA).schema
        ingest(self.spark, f"{self.base}/in/*", schema, f"{self.base}/archive", f"{self.base}/results", f"{self.base}/progress", self.compute, **self.how).awaitTermination()

    def results(self):
        return {(r["cell_id"], r["year"]): (r["pr"], r["n"]) for r in self.spark.read.parquet(f"{self.base}/results").collect()}


def test_a_drop_of_one_cell_rereads_that_cell(spark, tmp_path):
    seen = []

    def compute(daily):
        seen.append({(r["cell_id"], r["y"]): r["n"] for r in daily.groupBy("cell_id", F.year("date").alias("y")).agg(F.count("*").alias("n")).collect()})
        return totals(daily)

    run = Run(spark, str(tmp_path), compute, reach=0, parts=4)
    cells, years = range(20), (2001, 2002, 2003)
    run.drop(days(cells, years, 1))
    assert len(seen[-1]) == 60
    before = {f: f.stat().st_mtime_ns for f in tmp_path.glob("results/**/*.parquet")}
    run.drop([(7, date(2002, 3, 5), 1000.0)])
    assert seen[-1] == {(7, 2002): 365}
    part = spark.sql("select 7L as c").select(part_of(F.col("c"), 4)).first()[0]
    untouched = [f for f in before if f"year=2002/part={part}/" not in str(f)]
    assert len(untouched) < len(before) and all(f.exists() and f.stat().st_mtime_ns == before[f] for f in untouched)
    want = {(c, y): ((1.0 + c) * 365, 365) for c in cells for y in years} | {(7, 2002): (8.0 * 364 + 1000, 365)}
    assert run.results() == want


def test_reach_widens_reading_by_cell(spark, tmp_path):
    seen = []

    def compute(daily):
        seen.append(sorted({(r["cell_id"], r["y"]) for r in daily.select("cell_id", F.year("date").alias("y")).distinct().collect()}))
        return totals(daily)

    run = Run(spark, str(tmp_path), compute, reach=1, parts=3)
    run.drop(days((1, 2), (2001, 2002, 2003, 2004), 1))
    run.drop([(2, date(2002, 6, 1), 5.0), (9, date(2004, 1, 1), 3.0)])
    # 2002 and 2003 are stale; 2001 to 2003 are read.
    assert seen[-1] == [(2, 2001), (2, 2002), (2, 2003), (9, 2004)]
    assert run.results()[9, 2004] == (3.0, 1) and run.results()[1, 2002] == (2.0 * 365, 365) and len(run.results()) == 9


def test_empty_drops_and_repeats(spark, tmp_path):
    run = Run(spark, str(tmp_path), totals)
    run.drop([])
    run.drop([(1, date(2001, 1, 1), 2.0)])
    run.drop([])
    run.drop([(1, date(2001, 1, 1), 4.0), (1, date(2001, 1, 2), 1.0)])  # the later batch wins
    assert run.results() == {(1, 2001): (5.0, 2)}
