"""Runs of days in one pass against a plain walk over the days."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from isohyet.operators.spells import masks, seasons, spell_statistics


def year_of_days(seed, gaps):
    rng = random.Random(seed)
    out, value = [], True
    for i in range(366 if seed % 4 == 0 else 365):
        if rng.random() < 0.12:
            value = not value
        if rng.random() >= gaps:
            out.append((seed, 2000 if seed % 4 == 0 else 2001, i, None if rng.random() < 0.03 else value))
    return out


def runs(days, wanted):
    """(first day, length) of each run of days that have the wanted value."""
    out, last = [], None
    for _, _, i, v in days:
        if v is wanted:
            if last == i - 1 and out:
                out[-1][1] += 1
            else:
                out.append([i, 1])
            last = i
    return out


def frame(spark, rows):
    epoch = date(2000, 1, 1)
    full = [(c, y, (date(y, 1, 1) - epoch).days + i + 10957, i + 1, v) for c, y, i, v in rows]
    random.Random(1).shuffle(full)
    return spark.createDataFrame(full, "cell_id int, year int, day_no long, doy int, v boolean")


@pytest.mark.parametrize("gaps", [0.0, 0.05])
def test_statistics(spark, gaps):
    by_cell = {s: year_of_days(s, gaps) for s in range(12)} | {50: [(50, 2001, 7, True)], 51: [(51, 2001, 7, None)]}
    days = frame(spark, [r for rows in by_cell.values() for r in rows])
    wanted = {"a": ("v", "longest", 1), "b": ("v", "count", 5), "c": ("v", "total", 5), "d": ("not", "longest", 1), "e": ("not", "count", 1)}
    got = {r["cell_id"]: r for r in spell_statistics(days, wanted, {"v": F.col("v"), "not": ~F.col("v")}).collect()}
    assert got.keys() == by_cell.keys()
    for cell, rows in by_cell.items():
        yes, no = [n for _, n in runs(rows, True)], [n for _, n in runs(rows, False)]
        want = (max(yes, default=0), sum(n >= 5 for n in yes), sum(n for n in yes if n >= 5), max(no, default=0), len(no))
        assert tuple(got[cell][x] for x in "abcde") == want, cell


@pytest.mark.parametrize("mid", [None, "07-01"])
@pytest.mark.parametrize("gaps", [0.0, 0.05])
def test_seasons(spark, gaps, mid):
    by_cell = {s: year_of_days(s, gaps) for s in range(12)} | {50: [(50, 2001, i, False) for i in range(200, 300)], 51: [(51, 2001, i, True) for i in range(365)]}
    got = {r["cell_id"]: (r["start"], r["end"], r["length"]) for r in seasons(frame(spark, [r for rows in by_cell.values() for r in rows]), {"s": (F.col("v"), 6, mid)}).collect()}
    for cell, rows in by_cell.items():
        year = rows[0][1]
        start = min((i + 1 for i, n in runs(rows, True) if n >= 6), default=None)
        least = date(year, 7, 1).timetuple().tm_yday if mid else 1
        stops = [max(i + 1, least) for i, n in runs(rows, False) if i + 1 + n - max(i + 1, least) >= 6]
        end = min((x for x in stops if start is None or x > start), default=None)
        length = 0 if start is None else (end or (date(year, 12, 31) + timedelta(1) - date(year, 1, 1)).days + 1) - start
        assert got[cell] == (start, end, length), cell


def test_rows_do_not_multiply(spark):
    days = frame(spark, year_of_days(1, 0.0))
    shown = masks(days, {"a": F.col("v"), "b": ~F.col("v")})
    assert shown.count() == 1 and len(shown.first()["a"]) == 365
    plan = spell_statistics(days, {"x": ("a", "count", 3)}, {"a": F.col("v")})._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Generate" not in plan and plan.count("Exchange") <= 2
