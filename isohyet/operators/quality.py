"""Data-quality checks over whole tables.

Checks on values take ``long(variable, year, value)``. Each returns rows of
check, variable, year, status (PASS, WARNING, FAIL), metric and message, so that
results of different checks form one table.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from math import inf

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.catalog import CATALOG
from .quantiles import with_quantiles

#: Physical ranges.
VALUE_RANGES = {
    "tg_mean": (-50, 50),
    "tx_mean": (-50, 60),
    "tn_mean": (-60, 40),
    "frost_days": (0, 365),
    "ice_days": (0, 365),
    "summer_days": (0, 365),
    "tropical_nights": (0, 365),
    "heat_wave_frequency": (0, 50),
    "growing_degree_days": (0, 10000),
    "heating_degree_days": (0, 15000),
    "cooling_degree_days": (0, 10000),
    "prcptot": (0, 10000),
    "rx1day": (0, 1000),
    "rx5day": (0, 2000),
    "cdd": (0, 365),
    "cwd": (0, 365),
    "sdii": (0, 200),
    "r10mm": (0, 365),
    "r20mm": (0, 365),
    "dry_days": (0, 365),
    "humid_days": (0, 365),
}
#: Indices that can be zero nearly everywhere.
MOSTLY_ZERO = ("frost_days", "ice_days", "tropical_nights", "r99p", "r95p", "heat_wave_frequency")
MIN_LONG = -(2**63)


def result(check: str, status: Column, metric: Column, message: Column | str = "", variable: Column | None = None, year: Column | None = None) -> list[Column]:
    return [
        F.lit(check).alias("check"),
        (F.lit(None).cast("string") if variable is None else variable).alias("variable"),
        (F.lit(None).cast("int") if year is None else year.cast("int")).alias("year"),
        status.alias("status"),
        metric.cast("double").alias("metric"),
        (F.lit(message) if isinstance(message, str) else message).alias("message"),
    ]


def level(fail: Column, warn: Column | None = None) -> Column:
    """FAIL, WARNING or PASS; an unknown condition does not count."""
    out = F.when(fail, "FAIL")
    return (out if warn is None else out.when(warn, "WARNING")).otherwise("PASS")


def _per_variable(long: DataFrame) -> DataFrame:
    out = long.groupBy("variable").agg(
        F.count("*").alias("n"), F.count("value").alias("there"), F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"),
        F.min("value").alias("low"), F.max("value").alias("high"), F.count_if(F.col("value") == 0).alias("zeros"),
    )
    return with_quantiles(out, long, ["variable"], (0.25, 0.5, 0.75), "q")


def completeness(spark: SparkSession, found: Sequence[str], expected: Sequence[str], extra_limit: int = 5) -> DataFrame:
    """A missing index fails; more than ``extra_limit`` unexpected ones is a warning."""
    have = spark.createDataFrame([(x,) for x in found], "variable string")
    want = spark.createDataFrame([(x,) for x in expected], "variable string")
    gone = want.join(have, "variable", "left_anti").select(*result("completeness", F.lit("FAIL"), F.lit(0), "missing", F.col("variable")))
    extra = have.join(want, "variable", "left_anti").agg(F.count("*").alias("n"))
    share = 100.0 * len(set(found) & set(expected)) / max(1, len(set(expected)))
    extra = extra.select(*result("completeness_extra", level(F.lit(False), F.col("n") > extra_limit), F.col("n"), "unexpected indices"))
    done = extra.select(*result("completeness_percent", level(F.lit(share < 100)), F.lit(share), "percent complete"))
    return gone.unionByName(extra).unionByName(done)


def physical_limits() -> dict[str, tuple[float, float]]:
    """What a catalog index can be at most, by its unit: temperatures, temperature ranges, day counts, water."""
    out = {}
    for name, index in CATALOG.items():
        if index.unit == "degC" and index.group in ("temperature", "humidity"):
            out[name] = (0, inf) if {"tasmax", "tasmin"} <= set(index.inputs) else (-60, 60)
        elif index.unit == "1" and (index.dtype == "int" or index.spell or index.season):
            out[name] = (0, 366)
        elif index.unit.startswith("mm") or index.unit == "K days":
            out[name] = (0, inf)
    return out


def _limits(ranges: Mapping[str, tuple[float, float]]) -> tuple[Column, Column]:
    """The bounds of a row's variable; null where none are known."""
    return tuple(F.element_at(F.create_map(*[F.lit(x) for k, v in ranges.items() for x in (k, float(v[i]))]), F.col("variable")) for i in (0, 1))


def value_checks(long: DataFrame, ranges: Mapping[str, tuple[float, float]] | None = None, mostly_zero: Sequence[str] = MOSTLY_ZERO) -> DataFrame:
    """Coverage, value range, constancy, six-sigma extremes, zeros and shape of each variable."""
    return _judged(_per_variable(long), ranges, mostly_zero)


def _judged(s: DataFrame, ranges: Mapping[str, tuple[float, float]] | None = None, mostly_zero: Sequence[str] = MOSTLY_ZERO) -> DataFrame:
    """The checks of ``value_checks`` on a row of numbers for each variable."""
    low, high = _limits({**physical_limits(), **VALUE_RANGES, **(ranges or {})})
    missing = F.coalesce(1 - F.try_divide(F.col("there"), F.col("n")), F.lit(0.0))
    far = F.try_divide(F.greatest(F.abs(F.col("low") - F.col("mean")), F.abs(F.col("high") - F.col("mean"))), F.col("std"))
    zero = F.try_divide(F.col("zeros"), F.col("there"))
    skew = F.try_divide(F.abs(F.col("mean") - F.col("q")[1]), F.col("std"))
    spread = F.try_divide(F.col("high") - F.col("low"), F.col("q")[2] - F.col("q")[0])
    name = F.col("variable")
    checks = [
        ("coverage", level(missing > 0.5, missing > 0.3), missing),
        ("value_range", level((F.col("low") < low) | (F.col("high") > high)), F.greatest(low - F.col("low"), F.col("high") - high)),
        ("constant", level(F.lit(False), F.col("std") < 1e-10), F.col("std")),
        ("extremes", level(F.lit(False), far > 6), far),
        ("zeros", level((zero > 0.99) & ~name.isin(*mostly_zero), zero > 0.99), zero),
        ("skew", level(F.lit(False), skew > 2), skew),
        ("spread", level(F.lit(False), spread > 10), spread),
    ]
    rows = F.array(*[F.struct(F.lit(c).alias("check"), st.alias("status"), m.cast("double").alias("metric")) for c, st, m in checks])
    out = s.select("variable", F.explode(rows).alias("r"))
    return out.select("r.check", "variable", F.lit(None).cast("int").alias("year"), "r.status", "r.metric", F.lit("").alias("message"))


def year_checks(years: DataFrame, first: int, last: int) -> DataFrame:
    """Missing, repeated and unexpected years of ``years(year)`` (one row per file or table), and gaps between them."""
    spark = years.sparkSession
    want = spark.range(first, last + 1).select(F.col("id").cast("int").alias("year"))
    have = years.groupBy(F.col("year").cast("int").alias("year")).agg(F.count("*").alias("n"))
    gone = want.join(have, "year", "left_anti").select(*result("year_missing", F.lit("FAIL"), F.lit(1), "missing", None, F.col("year")))
    twice = have.where("n > 1").select(*result("year_repeated", F.lit("FAIL"), F.col("n"), "repeated", None, F.col("year")))
    extra = have.join(want, "year", "left_anti").select(*result("year_extra", F.lit("WARNING"), F.lit(1), "unexpected", None, F.col("year")))
    # One row per year, so a single window is small.
    gap = have.withColumn("next", F.lead("year").over(Window.orderBy("year"))).where("next - year > 1")
    gap = gap.select(*result("year_gap", F.lit("WARNING"), F.col("next") - F.col("year") - 1, F.concat(F.lit("gap before "), F.col("next").cast("string")), None, F.col("year")))
    return gone.unionByName(twice).unionByName(extra).unionByName(gap)


def yearly_anomalies(long: DataFrame, coverage_z: float = 3.0, mean_z: float = 4.0, min_years: int = 3) -> DataFrame:
    """Years whose coverage or mean is far from the variable's other years (population z-score)."""
    per = long.groupBy("variable", "year").agg((F.count("value") / F.count("*")).alias("coverage"), F.avg("value").alias("mean"))
    w = Window.partitionBy("variable")
    z = lambda c: F.try_divide(F.abs(F.col(c) - F.avg(c).over(w)), F.stddev_pop(c).over(w))
    scored = per.withColumns({"years": F.count("*").over(w), "cz": z("coverage"), "mz": z("mean")}).where(F.col("years") >= min_years)
    out = lambda name, c, limit: scored.where(F.col(c) > limit).select(*result(name, F.lit("WARNING"), F.col(c), "", F.col("variable"), F.col("year")))
    return out("coverage_anomaly", "cz", coverage_z).unionByName(out("mean_anomaly", "mz", mean_z))


def relationships(wide: DataFrame, rules: Mapping[str, Column] | None = None) -> DataFrame:
    """Rows that break a relation between indices. A null side breaks nothing."""
    if rules is None:
        known = {
            "tx_max >= tn_min": ("tx_max", "tn_min"),
            "frost_days >= ice_days": ("frost_days", "ice_days"),
            "r95p >= r99p": ("r95p", "r99p"),
        }
        rules = {n: F.col(a) >= F.col(b) for n, (a, b) in known.items() if a in wide.columns and b in wide.columns}
    one = wide.agg(*[F.count_if(~r).alias(f"{i}") for i, r in enumerate(rules.values())])
    rows = F.array(*[F.struct(F.lit(n).alias("variable"), F.col(f"`{i}`").alias("broken")) for i, n in enumerate(rules)])
    out = one.select(F.explode(rows).alias("r")).select("r.*")
    return out.select(*result("relationship", level(F.col("broken") > 0), F.col("broken"), "", F.col("variable")))


def deviation(long: DataFrame, reference: DataFrame, tolerance: float = 0.1) -> DataFrame:
    """Means against known-good means ``reference(variable, mean)``; a reference mean of 0 is skipped."""
    now = long.groupBy("variable").agg(F.avg("value").alias("now"))
    share = F.abs(F.col("now") - F.col("mean")) / F.abs("mean")
    out = now.join(reference.where("mean <> 0").select("variable", "mean"), "variable")
    return out.select(*result("deviation", level(F.lit(False), share > tolerance), share, "", F.col("variable")))


def suspicious_trends(long: DataFrame, share: float = 0.1, min_years: int = 5) -> DataFrame:
    """Trends in annual means of more than ``share`` of the overall mean per year."""
    per = long.groupBy("variable", "year").agg(F.avg("value").alias("m"))
    fit = per.groupBy("variable").agg(F.count("m").alias("n"), F.regr_slope("m", "year").alias("slope"), F.abs(F.avg("m")).alias("mean"))
    fit = fit.where(F.col("n") >= min_years)
    return fit.select(*result("trend", level(F.lit(False), F.abs("slope") > share * F.col("mean")), F.col("slope"), "", F.col("variable")))


def grid_checks(cells: DataFrame, n_lat: int, n_lon: int, lat: tuple[float, float] = (24.0, 50.0), lon: tuple[float, float] = (-125.0, -66.0)) -> DataFrame:
    """Grid size (less than 5 % off is a warning), coordinate nulls, range (within 1 degree) and spacing of ``cells(lat, lon)``."""
    parts = []
    for name, n, (low, high) in (("lat", n_lat, lat), ("lon", n_lon, lon)):
        lines = cells.select(F.col(name).alias("x")).distinct()
        w = Window.orderBy("x")  # grid lines only
        s = lines.withColumn("d", F.col("x") - F.lag("x").over(w)).agg(
            F.count("x").alias("n"), F.count_if(F.col("x").isNull() | F.isnan("x")).alias("bad"), F.min("x").alias("low"), F.max("x").alias("high"),
            F.try_divide(F.stddev_pop("d"), F.avg("d")).alias("uneven"),
        )
        off = F.abs(F.col("n") - n) / n
        v = F.lit(name)
        parts += [
            s.select(*result("grid_size", level(off >= 0.05, off > 0), F.col("n"), "", v)),
            s.select(*result("grid_missing", level(F.col("bad") > 0), F.col("bad"), "", v)),
            s.select(*result("grid_range", level((F.col("low") < low - 1) | (F.col("high") > high + 1)), F.col("low"), "", v)),
            s.select(*result("grid_spacing", level(F.lit(False), F.col("uneven") > 0.01), F.col("uneven"), "", v)),
        ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def axis_order(axis: DataFrame, position: str, value: str) -> DataFrame:
    """Whether ``value`` rises with ``position`` throughout, or falls: for a stored coordinate or time axis."""
    w = Window.orderBy(position)  # lines of an axis only
    before = axis.select(F.col(value).alias("x"), F.lag(value).over(w).alias("last"), F.row_number().over(w).alias("n")).where("n > 1")
    s = before.agg(F.count_if(F.coalesce(F.col("x") <= F.col("last"), F.lit(True))).alias("down"), F.count_if(F.coalesce(F.col("x") >= F.col("last"), F.lit(True))).alias("up"))
    return s.select(*result("axis_order", level((F.col("down") > 0) & (F.col("up") > 0)), F.least("down", "up"), "", F.lit(value)))


def grid_consistency(rows: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Years whose cell count or bounds differ from the first year's: ``rows(year, cell_id, lat, lon)``."""
    per = rows.groupBy("year").agg(
        F.count_distinct("cell_id").alias("n"), F.min("lat").alias("a"), F.max("lat").alias("b"), F.min("lon").alias("c"), F.max("lon").alias("d")
    )
    w = Window.orderBy("year")  # one row per year
    off = F.lit(False)
    for x in "abcd":
        off |= F.abs(F.col(x) - F.first(x).over(w)) > tolerance
    return per.withColumn("off", off | (F.col("n") != F.first("n").over(w))).select(*result("grid_consistency", level(F.col("off")), F.col("n"), "", None, F.col("year")))


def count_checks(long: DataFrame, counts: Sequence[str]) -> DataFrame:
    """Counts outside 0 to 366, and the smallest 64-bit integer where a missing time was written as a number."""
    mine = long.where(F.col("variable").isin(*counts)) if counts else long
    s = mine.groupBy("variable").agg(F.count_if(~F.col("value").between(0, 366)).alias("out"), F.count_if(F.col("value") == float(MIN_LONG)).alias("sentinel"))
    a = s.select(*result("count_range", level(F.col("out") > 0), F.col("out"), "", F.col("variable")))
    return a.unionByName(s.select(*result("sentinel", level(F.col("sentinel") > 0), F.col("sentinel"), "", F.col("variable"))))


def overall_coverage(long: DataFrame) -> DataFrame:
    """Share of values that are there: below 10 % fails, below 30 % warns."""
    share = F.col("share")
    s = long.agg((F.count("value") / F.count("*")).alias("share"))
    return s.select(*result("overall_coverage", level(share < 0.1, share < 0.3), share))


def physical_validity(long: DataFrame) -> DataFrame:
    """Ranges by what the catalog says of a variable (``physical_limits``); one that it does not know passes."""
    s = long.groupBy("variable").agg(F.min("value").alias("low"), F.max("value").alias("high"))
    least, most = _limits(physical_limits())
    return s.select(*result("physical_validity", level((F.col("low") < least) | (F.col("high") > most)), F.col("low"), "", F.col("variable")))


def index_counts(found: Mapping[str, int], expected: Mapping[str, int], spark: SparkSession) -> DataFrame:
    """The number of indices per group against the catalog's."""
    rows = spark.createDataFrame([(g, n, found.get(g, 0)) for g, n in expected.items()], "variable string, want int, have int")
    return rows.select(*result("index_count", level(F.col("have") != F.col("want")), F.col("have"), "", F.col("variable")))


def issue_rollup(long: DataFrame) -> DataFrame:
    """Overall missing percent, the number of variables more than half missing, and the number of variables."""
    per = long.groupBy("variable").agg(F.count("*").alias("n"), F.count("value").alias("there"))
    return per.agg(
        F.count("*").alias("variables"), (100 * (1 - F.sum("there") / F.sum("n"))).alias("missing_percent"), F.count_if(F.col("there") < 0.5 * F.col("n")).alias("half_missing")
    )


def rollup(results: DataFrame) -> DataFrame:
    """How many results have each status."""
    return results.groupBy("status").agg(F.count("*").alias("n"))


def observed_write(
    df: DataFrame,
    variables: Sequence[str],
    write: Callable[[DataFrame], None],
    ranges: Mapping[str, tuple[float, float]] | None = None,
    stop_on: str | None = "FAIL",
) -> DataFrame:
    """Writes wide ``df`` by ``write`` and checks what was written, in the same pass.

    The numbers that the checks need are gathered by the tasks that write, so
    there is no second scan. Returns the results of coverage, range, constancy,
    extremes and zeros, a few rows for each variable, or raises if one has the status
    ``stop_on``; the table is there then, for a look. ``write`` must run one job
    over the whole of what it is given. No variables or no rows give coverage 0 of 0,
    which passes.
    """
    seen = Observation()
    of = lambda v: F.col(v).cast("double")
    facts = {
        "there": lambda v: F.count(v), "mean": lambda v: F.avg(of(v)), "std": lambda v: F.stddev_pop(of(v)), "low": lambda v: F.min(of(v)), "high": lambda v: F.max(of(v)),
        "zeros": lambda v: F.count_if(of(v) == 0),
    }
    numbers = [f(v).alias(f"{k}_{i}") for i, v in enumerate(variables) for k, f in facts.items()]
    write(df.observe(seen, F.count(F.lit(1)).alias("n"), *numbers))
    got = seen.get
    spark = df.sparkSession
    rows = [(v, got["n"], *(got[f"{k}_{i}"] for k in facts), None) for i, v in enumerate(variables)]
    summary = spark.createDataFrame(rows, "variable string, n long, there long, mean double, std double, low double, high double, zeros long, q array<double>")
    results = _judged(summary, ranges).where(~F.col("check").isin("skew", "spread"))  # these need quantiles
    return assert_quality(results, stop_on) if stop_on else results


def assert_quality(results: DataFrame, stop_on: str = "FAIL") -> DataFrame:
    """Returns the results, or raises with a few of them if any has the status ``stop_on``."""
    bad = results.where(F.col("status") == stop_on)
    shown = bad.orderBy("check", "variable", "year").limit(10).collect()  # examples for the message
    if shown:
        raise ValueError(f"data quality: {[(r['check'], r['variable'], r['year'], r['metric']) for r in shown]}")
    return results
