"""Partial aggregates in whole tenths.

Sums and counts of integers do not depend on row order, merge exactly from any grain to a coarser one,
and give averages over raw rows rather than averages of averages. Only the last projection divides.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyfold.functions import count_above, element_tenths, month_of, year_of
from skyfold.schema import ELEMENT_COLUMN, RAIN_THRESHOLD, TENTHS_PER_UNIT

_PERIOD: dict[str, Callable[[str], Column]] = {"day": F.col, "month": month_of, "year": year_of}


def _sum(c: str) -> Column:
    return F.sum(c)


def _rain(c: str) -> Column:
    return count_above(c, RAIN_THRESHOLD * TENTHS_PER_UNIT)


# partial -> (measure it reads, aggregate over raw rows, aggregate over partials)
_PARTIALS: dict[str, tuple[str, Callable[[str], Column], Callable[[str], Column]]] = {
    "temp_max_sum": ("temp_max", _sum, _sum),
    "temp_max_n": ("temp_max", F.count, _sum),
    "temp_max_top": ("temp_max", F.max, F.max),
    "temp_min_sum": ("temp_min", _sum, _sum),
    "temp_min_n": ("temp_min", F.count, _sum),
    "temp_min_low": ("temp_min", F.min, F.min),
    "temp_avg_sum": ("temp_avg", _sum, _sum),
    "temp_avg_n": ("temp_avg", F.count, _sum),
    "precipitation_sum": ("precipitation", _sum, _sum),
    "precipitation_n": ("precipitation", F.count, _sum),
    "rain_rows": ("precipitation", _rain, _sum),
}


def _group(df: DataFrame, keys: Sequence[str], aggregates: list[Column], period: str | None) -> DataFrame:
    by = [F.col(k) for k in keys]
    if period is not None:
        by.append(_PERIOD[period]("date").alias("date"))
    return df.groupBy(*by).agg(*aggregates)


def roll_up(observations: DataFrame, keys: Sequence[str], period: str | None = None) -> DataFrame:
    """Partials per ``keys`` and day, month or year (or over all time) from raw observations.

    Partials that the caller does not use are pruned from the plan. Spark combines before the shuffle,
    so a key holding most of the rows still reaches the reducer as one row per map task.
    """
    date = ["date"] if period is not None else []
    wide = observations.select(
        *keys, *date, *[element_tenths(e).alias(c) for e, c in ELEMENT_COLUMN.items()]
    )
    aggregates = [raw(measure).alias(name) for name, (measure, raw, _) in _PARTIALS.items()]
    return _group(wide, keys, aggregates, period)


def merge_partials(partials: DataFrame, keys: Sequence[str], period: str | None = None) -> DataFrame:
    """Partials at a coarser grain, equal to rolling up the raw rows at that grain."""
    aggregates = [merge(name).alias(name) for name, (_, _, merge) in _PARTIALS.items()]
    return _group(partials, keys, aggregates, period)
