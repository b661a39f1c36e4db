"""Plans for annual, quarterly and monthly indices.

All aggregates of a call share one pass and one shuffle on (cell_id, period);
spells, seasons and rolling extremes are branches on the same keys, joined to it.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.prepare import nan_to_null, with_dates
from ..operators.baseline import with_thresholds
from ..operators.spells import day_change, rolling_sum, seasons, spell_statistics
from .catalog import CATALOG, Index, index_names

log = logging.getLogger(__name__)
_UNIT = {"YS": "YEAR", "QS": "QUARTER", "MS": "MONTH"}
_MONTHS = {"YS": 12, "QS": 3, "MS": 1}


def select_indices(columns: Sequence[str], names: Sequence[str], thresholds: Sequence[str] = (), strict: bool = False) -> list[Index]:
    """The indices whose inputs are there; others are left out with a reason, or raise if ``strict``."""
    chosen = []
    for index in (CATALOG[n] for n in names):
        absent = [v for v in index.inputs if v not in columns] + [t for t in index.thresholds if t not in thresholds]
        if not absent:
            chosen.append(index)
        elif strict:
            raise ValueError(f"{index.name} needs {absent}")
        else:
            log.warning("%s is left out: %s missing", index.name, absent)
    return chosen


def gate(value: Column, inputs: Sequence[str], max_missing: float | None, expected: Column) -> Column:
    """``value``, or null where more than ``max_missing`` of the period's days lack an input. None lets all through."""
    if max_missing is None:
        return value
    full = F.lit(True)
    for v in inputs:
        full &= F.col(f"__n_{v}") >= expected * (1 - max_missing)
    return F.when(full, value)


def compute_indices(
    daily: DataFrame,
    baseline: DataFrame | None = None,
    groups: Sequence[str] | None = None,
    names: Sequence[str] | None = None,
    freq: str = "YS",
    max_missing: float | None = 0.0,
    strict: bool = False,
    preprocess: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Indices per cell and period of ``daily(cell_id, date, [lat], <variables>)``.

    ``freq`` is YS, QS or MS; the result has cell_id and year, or cell_id and
    period (its first day). ``daily`` has one row per cell and day; a day that
    is not there counts as missing. Extra columns are ignored.
    """
    if freq not in _UNIT:
        raise ValueError(f"freq must be one of {sorted(_UNIT)}")
    if preprocess:
        daily = daily.transform(preprocess)
    limits = [x for x in baseline.columns if x not in ("cell_id", "doy")] if baseline is not None else []
    chosen = select_indices(daily.columns, names or index_names(groups), limits, strict)
    if not chosen:
        raise ValueError("no index can be computed from these columns")
    variables = sorted({v for i in chosen for v in i.inputs})
    days = nan_to_null(with_dates(daily.select("cell_id", "date", *variables)))
    used = sorted({t for i in chosen for t in i.thresholds})
    if freq == "YS":
        keys = ["cell_id", "year"]
        expected = F.dayofyear(F.make_date(F.col("year"), F.lit(12), F.lit(31)))
    else:
        keys = ["cell_id", "period"]
        days = days.withColumn("period", F.trunc("date", _UNIT[freq]))
        expected = F.datediff(F.add_months("period", _MONTHS[freq]), "period")
    gated = sorted({v for i in chosen if i.gated for v in i.inputs if v != "lat"}) if max_missing is not None else []
    # Only the branches that compare with thresholds pay for the join to them.
    joined = with_thresholds(days, baseline.select("cell_id", "doy", *used)) if used else days
    plain = joined if any(i.thresholds for i in chosen if i.spell is None) else days
    if any(i.change is not None for i in chosen):
        plain = plain.withColumns({f"__d_{i.name}": i.change() for i in chosen if i.change is not None})
        plain = plain.withColumns({f"__c_{i.name}": day_change(f"__d_{i.name}", keys) for i in chosen if i.change is not None})
    for i in chosen:
        if i.rolling is not None:
            value, n, across = i.rolling
            plain = plain.withColumn(f"__r_{i.name}", rolling_sum(value, n, ["cell_id"] if across else keys))
    aggs = [F.count(v).alias(f"__n_{v}") for v in gated]
    for i in chosen:
        if i.agg is not None:
            aggs.append(i.agg().cast(i.dtype).alias(f"__v_{i.name}"))
        elif i.rolling is not None:
            aggs.append(F.max(f"__r_{i.name}").alias(f"__v_{i.name}"))
        elif i.change is not None:
            aggs.append(F.avg(f"__c_{i.name}").alias(f"__v_{i.name}"))
    out = plain.groupBy(*keys).agg(F.count("*").alias("__n"), *aggs)
    runs = [i for i in chosen if i.spell is not None]
    if runs:
        source = joined if any(i.thresholds for i in runs) else days
        stats = spell_statistics(source, {f"__v_{i.name}": (i.name, *i.spell[1:]) for i in runs}, {i.name: i.spell[0]() for i in runs}, keys)
        out = out.join(stats, keys, "left").fillna(0, [f"__v_{i.name}" for i in runs])
    spans = [i for i in chosen if i.season is not None]
    if spans:
        if freq != "YS":
            raise ValueError("seasons need freq YS")
        # Indices of one season share its runs.
        kinds = {(i.inputs, i.season[1:3]): i for i in spans}
        label = {key: i.name for key, i in kinds.items()}
        found = seasons(days, {i.name: (i.season[0](), i.season[1], i.season[2]) for i in kinds.values()}, keys)
        wide = found.groupBy(*keys).agg(
            *[F.max(F.when(F.col("name") == label[i.inputs, i.season[1:3]], F.col(i.season[3]))).cast("int").alias(f"__v_{i.name}") for i in spans]
        )
        out = out.join(wide, keys, "left").fillna(0, [f"__v_{i.name}" for i in spans if i.season[3] == "length"])
    values = [gate(F.col(f"__v_{i.name}"), [v for v in i.inputs if v != "lat"], max_missing if i.gated else None, expected).alias(i.name) for i in chosen]
    return out.select(*keys, *values)
