"""Column builders; every one is a plain JVM-side expression."""

from skyfold.functions.columns import (
    compact_date,
    coordinates,
    count_above,
    country_code,
    element_numeric,
    element_tenths,
    element_units,
    month_of,
    rounded,
    to_units,
    year_of,
)

__all__ = [
    "compact_date",
    "coordinates",
    "count_above",
    "country_code",
    "element_numeric",
    "element_tenths",
    "element_units",
    "month_of",
    "rounded",
    "to_units",
    "year_of",
]
