"""Values of gridded results at points."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.tables import read_series


#: Axes of up to so many lines go to every task; longer ones are joined.
MAX_LINES = 100_000


def axis(cells: DataFrame, name: str) -> DataFrame:
    """A grid axis: each line with the next one, null for the last.

    Where cells have the axis's index (``lat_idx`` for ``lat``), lines meet the
    next by it; otherwise distinct lines are put in order, of which a grid has as
    many as the root of its cells.
    """
    index = f"{name}_idx"
    if index not in cells.columns:
        lines = cells.select(F.col(name).alias("line")).where("line is not null").distinct()
        return lines.withColumn("next", F.lead("line").over(Window.orderBy("line")))
    lines = cells.where(F.col(name).isNotNull()).groupBy(F.col(name).alias("line")).agg(F.first(index).alias("i"))
    # An index may fall along the axis, so the nearest larger line is on either side.
    beside = lines.select(F.col("line").alias("other"), F.explode(F.array(F.col("i") - 1, F.col("i") + 1)).alias("i"))
    return lines.join(beside, "i", "left").groupBy("line").agg(F.min(F.when(F.col("other") > F.col("line"), F.col("other"))).alias("next"))


class Axis:
    """The intervals of a grid axis, and how values find theirs.

    The axis's extent is cut into as many equal stretches as it has lines. An
    interval stands in every stretch that it touches, so all of them are at most
    two rows a line, and a value meets the few intervals of its stretch by an equi
    join. Lines may lie at any distances.
    """

    def __init__(self, cells: DataFrame, name: str) -> None:
        lines = axis(cells, name)
        # Three numbers, not the lines.
        self.first, self.last, self.n = lines.agg(F.min("line"), F.max("line"), F.count("line")).first()
        self.name = name
        if not self.n:
            return
        closed = F.col("next") == F.lit(self.last)
        # The last line is no interval of its own, unless it is the only one.
        of = lines.where(F.col("next").isNotNull() | F.lit(self.n == 1)).select(F.col("line").alias(f"{name}_lo"), F.coalesce("next", "line").alias(f"{name}_hi"), F.coalesce(closed, F.lit(True)).alias("_closed"))
        stretches = F.sequence(self._stretch(F.col(f"{name}_lo")), self._stretch(F.col(f"{name}_hi")))
        self.intervals = of.withColumn("_stretch", F.explode(stretches))
        if self.n <= MAX_LINES:
            self.intervals = F.broadcast(self.intervals)

    def _stretch(self, value: Column) -> Column:
        share = (value - F.lit(self.first)) / F.lit((self.last - self.first) or 1.0)
        return F.least(F.floor(share * self.n), F.lit(self.n - 1)).cast("long")

    def place(self, points: DataFrame, value: Column, clip: bool = False) -> DataFrame:
        """``points`` with the interval that holds ``value``, <name>_lo and <name>_hi; nulls off the axis, for null and for NaN.

        With ``clip``, values past an end take the end, <name>_at being the value then.
        """
        name = self.name
        if not self.n:
            nothing = F.lit(None).cast("double")
            return points.withColumns({c: nothing for c in ([f"{name}_at"] if clip else []) + [f"{name}_lo", f"{name}_hi"]})
        at = F.when(value.isNotNull() & ~F.isnan(value), F.least(F.greatest(value, F.lit(self.first)), F.lit(self.last)) if clip else value)
        held = points.withColumn(f"{name}_at", at)
        inside = (F.col(f"{name}_at") >= F.col(f"{name}_lo")) & ((F.col(f"{name}_at") < F.col(f"{name}_hi")) | F.col("_closed") & (F.col(f"{name}_at") == F.col(f"{name}_hi")))
        inside &= F.when(F.col(f"{name}_at").between(self.first, self.last), self._stretch(F.col(f"{name}_at"))) == F.col("_stretch")
        out = held.join(self.intervals, inside, "left").drop("_closed", "_stretch")
        return out if clip else out.drop(f"{name}_at")


def corner_cells(points: DataFrame, cells: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """The cells around each point of the grid, with their weights above 0: point_id, cell_id (null where the grid lacks it), weight."""
    placed = Axis(cells, "lon").place(Axis(cells, "lat").place(points, F.col(lat)), F.col(lon))

    def share(coord: str, value: str) -> Column:
        width = F.col(f"{coord}_hi") - F.col(f"{coord}_lo")
        return F.when(width > 0, (F.col(value) - F.col(f"{coord}_lo")) / width).otherwise(0.0)

    corners = F.array(
        *[
            F.struct(F.col(f"lat_{a}").alias("lat"), F.col(f"lon_{b}").alias("lon"), (wa * wb).alias("weight"))
            for a, wa in (("lo", 1 - share("lat", lat)), ("hi", share("lat", lat)))
            for b, wb in (("lo", 1 - share("lon", lon)), ("hi", share("lon", lon)))
        ]
    )
    corner = placed.where("lat_lo is not null and lon_lo is not null").select("point_id", F.explode(corners).alias("k")).select("point_id", "k.*").where("weight > 0")
    return corner.join(cells.select("cell_id", "lat", "lon"), ["lat", "lon"], "left").select("point_id", "cell_id", "weight")


def extract_bilinear(points: DataFrame, annual: DataFrame, cells: DataFrame, indices: Sequence[str], lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Bilinear values at points for every year: the columns of points, year, and the indices.

    ``points`` has a unique ``point_id`` and coordinates; ``cells(cell_id, lat,
    lon)`` is a regular or irregular rectilinear grid. A point off the grid, or
    with a missing corner of non-zero weight, gives nulls. All years of the
    results appear for every point.
    """
    with_cell = corner_cells(points, cells, lat, lon)
    need = with_cell.groupBy("point_id").agg(F.count("*").alias("need"))
    years = annual.select("year").distinct()
    sums = [F.when(F.count(i) == F.first("need"), F.sum(F.col(i) * F.col("weight"))).alias(i) for i in indices]
    values = with_cell.join(need, "point_id").join(annual, "cell_id").groupBy("point_id", "year").agg(*sums)
    return points.join(F.broadcast(years)).join(values, ["point_id", "year"], "left").select(*points.columns, "year", *indices)  # a row per year of the record


def extract_series(
    spark: SparkSession, points: DataFrame, path: str, cells: DataFrame, indices: Sequence[str], first: int | None = None, last: int | None = None, lat: str = "lat", lon: str = "lon"
) -> DataFrame:
    """``extract_bilinear`` from a series store: of the store, only the partitions of the cells around the points are read.

    ``first`` and ``last`` bound the years; a year that the store lacks is absent.
    """
    around = corner_cells(points, cells, lat, lon).where("cell_id is not null").select("cell_id").distinct()
    annual = read_series(spark, path, around)
    for bound, keep in ((first, F.col("year") >= F.lit(first)), (last, F.col("year") <= F.lit(last))):
        annual = annual if bound is None else annual.where(keep)
    return extract_bilinear(points, annual, cells, indices, lat, lon)


def extract_axis(points: DataFrame, annual: DataFrame, cells: DataFrame, indices: Sequence[str], method: str = "ceil", lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Values of one cell per point: ``ceil`` takes the first grid line at or above each coordinate, ``nearest`` the closest.

    Points past the last line take the last one; years without a value are absent.
    """
    if method not in ("ceil", "nearest"):
        raise ValueError("method must be ceil or nearest")
    out = points
    for coord, value in (("lat", lat), ("lon", lon)):
        out = Axis(cells, coord).place(out, F.col(value), clip=True)
        at, low, high = (F.col(f"{coord}_{x}") for x in ("at", "lo", "hi"))
        takes_low = at <= low if method == "ceil" else at - low <= high - at
        out = out.withColumn(f"__{coord}", F.when(takes_low, low).otherwise(high)).drop(f"{coord}_at", f"{coord}_lo", f"{coord}_hi")
    cell = cells.select("cell_id", F.col("lat").alias("__lat"), F.col("lon").alias("__lon"))
    return out.join(cell, ["__lat", "__lon"]).join(annual.select("cell_id", "year", *indices), "cell_id").select(*points.columns, "cell_id", "year", *indices)


def align_nearest(left: DataFrame, right: DataFrame, lat0: float, lon0: float, step: float, tolerance: float = 0.01) -> DataFrame:
    """Pairs the cells of two grids whose coordinates agree within ``tolerance``: left_id, right_id.

    Both sides snap to grid steps and join on integers; the tolerance is checked
    after. Cells without a partner are absent.
    """

    def snapped(df: DataFrame, side: str) -> DataFrame:
        i = lambda c, zero: F.round((F.col(c) - zero) / step).cast("int")
        return df.select(i("lat", lat0).alias("i"), i("lon", lon0).alias("j"), F.col("cell_id").alias(f"{side}_id"), F.col("lat").alias(f"{side}_lat"), F.col("lon").alias(f"{side}_lon"))

    near = (F.abs(F.col("left_lat") - F.col("right_lat")) <= tolerance) & (F.abs(F.col("left_lon") - F.col("right_lon")) <= tolerance)
    return snapped(left, "left").join(snapped(right, "right"), ["i", "j"]).where(near).select("left_id", "right_id")


def missing_growth(before: DataFrame, after: DataFrame, column: str, limit: float = 0.1) -> None:
    """Raises if the share of missing values grew by more than ``limit``."""
    share = lambda df: df.agg(F.avg(F.col(column).isNull().cast("int"))).first()[0] or 0.0
    grown = share(after) - share(before)
    if grown > limit:
        raise ValueError(f"missing values of {column} grew by {grown:.1%}")


def misaligned(a: DataFrame, b: DataFrame, rtol: float = 1e-6) -> DataFrame:
    """Where two daily tables do not line up: side, cell_id, date, problem.

    ``a`` and ``b`` have cell_id, date, lat, lon. Rows of one side only, and
    cells with coordinates that differ by more than ``rtol``, are listed. The days
    of a cell and month are the bits of a number on either side, which are compared:
    one pass over both tables, in which days are not joined, dealt or sorted.
    """
    sides, spots = ("a", "b"), [f"{c}_{s}" for c in ("lat", "lon") for s in "ab"]

    def marked(df: DataFrame, side: str) -> DataFrame:
        bit = F.expr("shiftleft(1, coalesce(dayofmonth(date), 0))")  # bit 0 stands for no date
        mine = lambda c, of, kind: (c if of == side else F.lit(None).cast(kind))
        return df.select(
            "cell_id", F.trunc("date", "MONTH").alias("month"), *[mine(bit, s, "int").alias(s) for s in sides],
            *[mine(F.col(c).cast("double"), s, "double").alias(f"{c}_{s}") for c in ("lat", "lon") for s in sides],
        )

    ends = [f(F.col(c)).alias(f"{c}_{k}") for c in spots for k, f in (("low", F.min), ("high", F.max))]
    months = marked(a, "a").unionByName(marked(b, "b")).groupBy("cell_id", "month").agg(*[F.coalesce(F.bit_or(s), F.lit(0)).alias(s) for s in sides], *ends)
    # A row without a cell or a date has no partner.
    met = lambda s: F.when(F.col("cell_id").isNotNull(), F.col(s).bitwiseAND(F.lit(-2))).otherwise(0)
    alone = lambda s, other: F.col(s).bitwiseAND(F.bitwise_not(met(other))).cast("long").alias(s)
    gaps = F.struct("month", alone("a", "b"), alone("b", "a"))
    ends = [f(F.col(f"{c}_{k}")).alias(f"{c}_{k}") for c in spots for k, f in (("low", F.min), ("high", F.max))]
    found = months.groupBy("cell_id").agg(F.collect_list(F.when((gaps["a"] != 0) | (gaps["b"] != 0), gaps)).alias("gaps"), *ends)

    def listed(side: str, label: str, problem: str) -> Column:
        def days(m: Column) -> Column:
            there = F.filter(F.sequence(F.lit(0), F.lit(31)), lambda d: F.getbit(m[side], d) == 1)
            return F.transform(there, lambda d: F.struct(F.lit(label).alias("side"), F.when(d > 0, F.date_add(m["month"], d - 1)).alias("date"), F.lit(problem).alias("problem")))

        return F.flatten(F.transform("gaps", days))

    apart = F.lit(False)
    for c in ("lat", "lon"):
        for x in ("low", "high"):  # what two of many differ by most lies between their ends
            for y in ("low", "high"):
                one, two = F.col(f"{c}_a_{x}"), F.col(f"{c}_b_{y}")
                apart |= F.coalesce(F.abs(one - two) > rtol * F.abs(two), F.lit(False))
    moved = F.struct(F.lit("both").alias("side"), F.lit(None).cast("date").alias("date"), F.lit("coordinates differ").alias("problem"))
    rows = F.concat(
        listed("a", "left", "missing on the right"), listed("b", "right", "missing on the left"),
        F.when(F.col("cell_id").isNotNull() & apart, F.array(moved)).otherwise(F.slice(F.array(moved), 1, 0)),
    )
    return found.select("cell_id", F.explode(rows).alias("r")).select("r.side", "cell_id", "r.date", "r.problem")


def merge_daily(a: DataFrame, b: DataFrame, validate: bool = True) -> DataFrame:
    """Full outer join of two daily tables on cell and day, after checking that they line up."""
    if validate and {"lat", "lon"} <= set(a.columns) & set(b.columns):
        found = misaligned(a, b).limit(5).collect()  # a few examples for the message
        if found:
            raise ValueError(f"the tables do not line up: {found}")
    drop = [c for c in b.columns if c in a.columns and c not in ("cell_id", "date")]
    return a.join(b.drop(*drop), ["cell_id", "date"], "full")
