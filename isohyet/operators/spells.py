"""Runs of days: spells, seasons, rolling sums, day-to-day change.

Spells and seasons read a key's days once, as a string with a character per day,
in which runs are matches of a pattern.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

YEARLY = ("cell_id", "year")


def masks(days: DataFrame, conditions: Mapping[str, Column], keys: Sequence[str] = YEARLY) -> DataFrame:
    """One row per key: the keys, first_doy, and for each condition a string with a character per day.

    ``days`` has the keys, day_no and doy, once per day. A day is ``1`` where the
    condition holds, ``0`` where it does not, and ``-`` where it is unknown or the
    day is missing. Strings begin with the key's first day, which is first_doy.
    Days are gathered and ordered once for all conditions, and do not multiply by
    them; where the table is dealt by cell already, they are not dealt again.
    """
    names = list(conditions)
    code = F.concat(*[F.when(conditions[n], "1").when(~conditions[n], "0").otherwise("-") for n in names])
    held = days.select(*keys, F.struct(F.col("day_no").alias("day"), "doy", code.alias("code")).alias("__d"))
    # A day is asked for twice, so that it is made before it is gathered: what is gathered and ordered is this day, and not all columns that it is made of.
    lists = held.groupBy(*keys).agg(F.min("__d").alias("__first"), F.sort_array(F.collect_list("__d")).alias("__d")).withColumn("first_doy", F.col("__first.doy"))

    def of(i: int) -> Column:
        def shown(d: Column, at: Column) -> Column:
            gap = F.when(at > 0, d["day"] - F.get(F.col("__d"), at - 1)["day"] - 1).otherwise(0)
            mark = F.substring(d["code"], i + 1, 1)
            return F.when(gap > 0, F.concat(F.repeat(F.lit("-"), gap.cast("int")), mark)).otherwise(mark)

        return F.array_join(F.transform("__d", shown), "")

    return lists.select(*keys, "first_doy", *[of(i).alias(n) for i, n in enumerate(names)])


def spell_statistics(days: DataFrame, wanted: Mapping[str, tuple[str, str, int]], conditions: Mapping[str, Column], keys: Sequence[str] = YEARLY) -> DataFrame:
    """One row per key: for each wanted name, a statistic (condition, kind, least run length).

    Kinds: longest (days of the longest run), count (number of runs), total
    (days in runs). A missing day, an unknown condition and the end of the key's
    period end a run.
    """
    shown = masks(days, {f"__m_{n}": c for n, c in conditions.items()}, keys)

    def one(cond: str, kind: str, least: int) -> Column:
        mask, run = F.col(f"__m_{cond}"), f"1{{{least},}}"
        if kind == "count":
            return F.regexp_count(mask, F.lit(run))
        if kind == "total":
            return F.length(mask) - F.length(F.regexp_replace(mask, run, ""))
        return F.coalesce(F.array_max(F.transform(F.regexp_extract_all(mask, F.lit(f"({run})"), F.lit(1)), F.length)), F.lit(0))

    return shown.select(*keys, *[one(*spec).cast("int").alias(name) for name, spec in wanted.items()])


def seasons(days: DataFrame, wanted: Mapping[str, tuple[Column, int, str | None]], keys: Sequence[str] = YEARLY) -> DataFrame:
    """Season start, end and length from sustained runs: keys, name, start, end, length.

    ``wanted`` maps a name to (condition, run length, mid date "MM-dd" or None).
    The season starts on the first day of the first run of true days of at least
    the length, and ends on the first day after it of such a run of false days.
    With a mid date the ending run counts from that date on. Without an end the
    season runs to the last day of its year; without a start the length is 0, and
    the end is that of the first such run of false days. A key whose condition is
    never known for a day has no row.
    """
    shown = masks(days, {f"__m_{n}": c for n, (c, _, _) in wanted.items()}, keys)
    dec31 = F.dayofyear(F.make_date(F.col("year"), F.lit(12), F.lit(31)))

    def one(name: str, least: int, mid: str | None) -> Column:
        mask, first = F.col(f"__m_{name}"), F.col("first_doy")
        begin = F.regexp_instr(mask, F.lit(f"1{{{least},}}"))  # from 1; 0 where there is none
        month, day = map(int, (mid or "01-01").split("-"))
        after = F.greatest(begin + 1, F.dayofyear(F.make_date(F.col("year"), F.lit(month), F.lit(day))) - first + 1, F.lit(1))
        stop = F.regexp_instr(F.substring(mask, after, F.length(mask)), F.lit(f"0{{{least},}}"))
        start = F.when(begin > 0, begin + first - 1)
        end = F.when(stop > 0, stop + after - 1 + first - 1)
        length = F.when(begin == 0, 0).otherwise(F.coalesce(end, dec31 + 1) - start)
        return F.struct(F.lit(name).alias("name"), start.cast("int").alias("start"), end.cast("int").alias("end"), length.cast("int").alias("length"), F.regexp_like(mask, F.lit("[01]")).alias("known"))

    found = shown.select(*keys, F.explode(F.array(*[one(n, least, mid) for n, (_, least, mid) in wanted.items()])).alias("s")).where("s.known")
    return found.select(*keys, "s.name", "s.start", "s.end", "s.length")


def first_to_last(days: DataFrame, cond: Column, keys: Sequence[str] = YEARLY) -> DataFrame:
    """Days from the first to the last true day: keys, length."""
    doy = F.when(cond, F.col("doy"))
    return days.groupBy(*keys).agg(F.coalesce(F.max(doy) - F.min(doy) + 1, F.lit(0)).alias("length"))


def rolling_sum(value: str, n: int, scope: Sequence[str] = YEARLY) -> Column:
    """Sum over the last n days, null unless all are there; ``scope`` is what a window may not leave."""
    w = Window.partitionBy(*scope).orderBy("day_no").rangeBetween(-(n - 1), 0)
    return F.when(F.count(value).over(w) == n, F.sum(value).over(w))


def day_change(value: str, scope: Sequence[str] = YEARLY) -> Column:
    """Absolute change from the day before, null where that day is missing."""
    w = Window.partitionBy(*scope).orderBy("day_no")
    return F.when(F.lag("day_no").over(w) == F.col("day_no") - 1, F.abs(F.col(value) - F.lag(value).over(w)))
