"""The five fact tables, each in two variants.

``exact``    unrounded; daily precipitation is the day's sum; countries under ``name``
``rounded``  one decimal; daily precipitation is the mean of the day's rows; countries under ``country_name``
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyfold.functions import rounded, to_units
from skyfold.operators.lookup import BROADCAST_LIMIT_BYTES, Lookup
from skyfold.operators.rollup import merge_partials, roll_up
from skyfold.operators.staging import stage_stations, station_countries
from skyfold.schema import TENTHS_PER_UNIT
from skyfold.sinks.tables import Layout

VARIANTS = ("exact", "rounded")


@dataclass(frozen=True)
class Dimensions:
    """Both lookups of the facts, shared by all five; each is sized once, when first used."""

    staged: DataFrame
    country_names: DataFrame
    limit_bytes: int

    @classmethod
    def of(
        cls, stations: DataFrame, countries: DataFrame, limit_bytes: int = BROADCAST_LIMIT_BYTES
    ) -> Dimensions:
        return cls(stage_stations(stations), countries, limit_bytes)

    @cached_property
    def stations(self) -> Lookup:
        """Station id -> station name and coordinates."""
        described = self.staged.select("id", F.col("name").alias("station_name"), "latitude_longitude")
        return Lookup.of(described, "id", self.limit_bytes)

    @cached_property
    def countries(self) -> Lookup:
        """Station id -> country name."""
        return Lookup.of(station_countries(self.staged, self.country_names), "id", self.limit_bytes)


def _mean(measure: str) -> Column:
    return F.col(f"{measure}_sum") / (F.lit(float(TENTHS_PER_UNIT)) * F.col(f"{measure}_n"))


def _total(measure: str) -> Column:
    return to_units(f"{measure}_sum")


def _daily(variant: str) -> dict[str, Column]:
    precipitation = _total if variant == "exact" else _mean
    return {
        "temp_max": _mean("temp_max"),
        "temp_min": _mean("temp_min"),
        "temp_avg": _mean("temp_avg"),
        "precipitation": precipitation("precipitation"),
    }


def _monthly(variant: str) -> dict[str, Column]:
    return {
        "temp_max_abs": to_units("temp_max_top"),
        "temp_max_avg": _mean("temp_max"),
        "temp_avg_avg": _mean("temp_avg"),
        "temp_min_avg": _mean("temp_min"),
        "temp_min_abs": to_units("temp_min_low"),
        "precipitation_total": _total("precipitation"),
        "precipitation_days": F.col("rain_rows"),
    }


def _yearly(variant: str) -> dict[str, Column]:
    return {"temp_avg": _mean("temp_avg")}


def _historic(variant: str) -> dict[str, Column]:
    measures = {
        "temp_avg": _mean("temp_avg"),
        "temp_max": to_units("temp_max_top"),
        "temp_min": to_units("temp_min_low"),
    }
    order = ("temp_avg", "temp_max", "temp_min") if variant == "exact" else ("temp_max", "temp_avg", "temp_min")
    return {name: measures[name] for name in order}


@dataclass(frozen=True)
class Fact:
    """One fact table: its key, its period, its measures by variant and its place on disk."""

    name: str
    per_country: bool
    period: str | None
    measures: Callable[[str], dict[str, Column]]

    def layout(self, variant: str) -> Layout:
        """Station facts by year; the small country facts in one piece, by date and country."""
        if not self.per_country:
            return Layout(cluster=("id",))
        date = [] if self.period is None else ["date"]
        return Layout(cluster=(*date, country_column(variant)), by_year=False)

    def finish(self, partials: DataFrame, variant: str) -> DataFrame:
        """Measures and final column names from partials at this fact's grain, names attached."""
        if variant not in VARIANTS:
            raise ValueError(f"variant must be one of {VARIANTS}, got {variant!r}")
        counts = {"precipitation_days"}
        measures = [
            (rounded(m) if variant == "rounded" and name not in counts else m).alias(name)
            for name, m in self.measures(variant).items()
        ]
        date = [] if self.period is None else ["date"]
        if self.per_country:
            return partials.select(
                F.col("country_name").alias(country_column(variant)), *date, *measures
            )
        return partials.select("id", *date, *measures, "station_name", "latitude_longitude")


def country_column(variant: str) -> str:
    return "name" if variant == "exact" else "country_name"


FACTS = {
    f.name: f
    for f in [
        Fact("stations_daily", False, "day", _daily),
        Fact("stations_monthly", False, "month", _monthly),
        Fact("stations_yearly", False, "year", _yearly),
        Fact("countries_yearly", True, "year", _yearly),
        Fact("countries_historic", True, None, _historic),
    ]
}


def _with_names(
    fact: Fact,
    rows: DataFrame,
    dimensions: Dimensions,
    aggregate: Callable[..., DataFrame],
    at_grain: bool = False,
) -> DataFrame:
    """Partials at the fact's grain with the names attached, by the plan with the least shuffling."""
    if not fact.per_country:
        per_station = rows if at_grain else aggregate(rows, ["id"], fact.period)
        return dimensions.stations.join(per_station)
    lookup = dimensions.countries
    if lookup.fits_broadcast:
        # The country is attached map-side, so one shuffle of a few rows per task does it all.
        return aggregate(lookup.join(rows), ["country_name"], fact.period)
    # Too large to broadcast: shrink to one row per station and period before the join shuffles.
    # Sums and counts survive the join, whatever the number of matches, so the result is the same.
    per_station = aggregate(rows, ["id"], fact.period)
    return merge_partials(lookup.join(per_station), ["country_name"], fact.period)


def fact_from_observations(
    name: str, observations: DataFrame, dimensions: Dimensions, variant: str = "exact"
) -> DataFrame:
    """One fact straight from raw observations, in one pass."""
    fact = FACTS[name]
    return fact.finish(_with_names(fact, observations, dimensions, roll_up), variant)


def fact_from_partials(
    name: str,
    partials: DataFrame,
    dimensions: Dimensions,
    variant: str = "exact",
    at_grain: bool = False,
) -> DataFrame:
    """One fact from station partials at its grain (``at_grain``) or a finer one."""
    fact = FACTS[name]
    return fact.finish(_with_names(fact, partials, dimensions, merge_partials, at_grain), variant)
