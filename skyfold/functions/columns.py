from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyfold.schema import DATE_FORMAT, NUMERIC, TENTHS_PER_UNIT


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_units(tenths: Column | str) -> Column:
    """Tenths to units, as a double."""
    return _col(tenths) / TENTHS_PER_UNIT


def element_tenths(
    element: str, name: Column | str = "meteorological_element", value: Column | str = "data_value"
) -> Column:
    """The row's value in tenths when it measures ``element``, else NULL."""
    return F.when(_col(name) == element, _col(value))


def element_units(
    element: str, name: Column | str = "meteorological_element", value: Column | str = "data_value"
) -> Column:
    """Like ``element_tenths``, scaled to units as a double."""
    return F.when(_col(name) == element, to_units(value))


def element_numeric(
    element: str, name: Column | str = "meteorological_element", value: Column | str = "data_value"
) -> Column:
    """Like ``element_units``, as decimal(38,9)."""
    return F.when(_col(name) == element, to_units(value).cast(NUMERIC))


def compact_date(text: Column | str) -> Column:
    """Parse ``yyyyMMdd``; malformed text raises under ANSI mode."""
    return F.to_date(_col(text), DATE_FORMAT)


def coordinates(latitude: Column | str = "latitude", longitude: Column | str = "longitude") -> Column:
    """``'lat, long'``; NULL when either is NULL."""
    return F.concat(_col(latitude).cast("string"), F.lit(", "), _col(longitude).cast("string"))


def country_code(station_id: Column | str = "id") -> Column:
    return F.substring(_col(station_id), 1, 2)


def month_of(date: Column | str = "date") -> Column:
    return F.trunc(_col(date), "MM")


def year_of(date: Column | str = "date") -> Column:
    return F.trunc(_col(date), "year")


def rounded(measure: Column | str) -> Column:
    """One decimal, half up."""
    return F.round(_col(measure), 1)


def count_above(measure: Column | str, threshold: float) -> Column:
    """Aggregate: rows strictly above ``threshold``; 0 when there are none."""
    return F.count(F.when(_col(measure) > threshold, 1))
