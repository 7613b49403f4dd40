"""Named lists of checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyfold.operators.quality import Check, column_set, no_rows_where, not_null, unique
from skyfold.schema import MAX_DAYS_PER_MONTH, RAW_HEADER

# --- Fixed values: the declared checks of each table ---

RAW_NOT_NULL = ["ID", "DATE"]

MODEL_CHECKS: dict[str, list[Check]] = {
    "countries": [not_null("code"), unique("code"), not_null("name"), unique("name")],
    "stations": [not_null("id"), unique("id"), not_null("country_code")],
    "observations": [not_null("date"), not_null("id")],
    "countries_historic": [not_null("name"), unique("name")],
    "countries_yearly": [not_null("name"), not_null("date")],
    "stations_daily": [not_null("id"), not_null("date")],
    "stations_monthly": [not_null("id"), not_null("date")],
    "stations_yearly": [not_null("id"), not_null("date")],
}

# --- End of fixed values ---


def monthly_invariants() -> list[Check]:
    """A month's mean of daily extremes lies within its absolute extremes; rain days fit in a month.

    Rain days count rows, so duplicate rows of a day can break the last one. It is reported, not capped.
    """
    return [
        no_rows_where("mean maximum above absolute maximum", F.col("temp_max_avg") > F.col("temp_max_abs")),
        no_rows_where("mean minimum below absolute minimum", F.col("temp_min_avg") < F.col("temp_min_abs")),
        no_rows_where("too many rain days", F.col("precipitation_days") > MAX_DAYS_PER_MONTH),
    ]


def raw_checks(year: Column | None = None, exact: bool = True, ordered: bool = True) -> list[Check]:
    """Checks of a yearly file before typing.

    ``ordered`` matters since the typed read binds names by position. With ``year``, the year a row's
    file is for, rows dated in another one fail: they would land in the wrong year's directory.
    """
    checks = [column_set(RAW_HEADER, exact, ordered), *[not_null(c) for c in RAW_NOT_NULL]]
    if year is not None:
        stray = F.substring("DATE", 1, 4) != F.lpad(year.cast("string"), 4, "0")
        checks.append(no_rows_where("date outside the file's year", year.isNull() | stray))
    return checks


def declared_checks(name: str, variant: str = "exact") -> list[Check]:
    """The checks of a fact's keys, which a build must pass; the country key is named by variant."""
    checks = MODEL_CHECKS[name]
    if variant == "rounded" and name.startswith("countries_"):
        checks = [Check(c.kind, "country_name" if c.target == "name" else c.target) for c in checks]
    return checks


def fact_checks(name: str, variant: str = "exact") -> list[Check]:
    """All checks of a built fact. Invariants are reported; duplicate rows of a day can break one of them."""
    return declared_checks(name, variant) + (monthly_invariants() if name == "stations_monthly" else [])
