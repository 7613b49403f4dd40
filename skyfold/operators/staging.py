from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfold.functions import coordinates, country_code, element_numeric, element_units
from skyfold.schema import ELEMENT_COLUMN, STORED_NAME

_FLAGS = ["flag_m", "flag_q", "flag_s"]


def rename_to_stored(raw: DataFrame) -> DataFrame:
    """Header names to stored names."""
    return raw.withColumnsRenamed(STORED_NAME)


def pivot_elements(observations: DataFrame, numeric: bool = False) -> DataFrame:
    """Add one column per pivoted element, NULL where the row measures something else.

    ``numeric=True`` keeps all columns and yields decimals; otherwise the flags are dropped and the
    measures are doubles. Rows of other elements stay: their groups exist in every fact.
    """
    build = element_numeric if numeric else element_units
    kept = observations if numeric else observations.drop(*_FLAGS)
    return kept.withColumns({column: build(e) for e, column in ELEMENT_COLUMN.items()})


def union_years(years: Sequence[DataFrame]) -> DataFrame:
    """Union by position, duplicates kept. For files on disk prefer ``read_year_files``."""
    return reduce(DataFrame.unionAll, years)


def stage_stations(stations: DataFrame) -> DataFrame:
    return stations.select(
        "*", coordinates().alias("latitude_longitude"), country_code().alias("country_code")
    )


#: What ``stage_stations`` adds, as the SQL of a view.
STAGED_STATION_COLUMNS = {
    "latitude_longitude": "concat(cast(latitude as string), ', ', cast(longitude as string))",
    "country_code": "substring(id, 1, 2)",
}


def stage_countries(countries: DataFrame) -> DataFrame:
    return countries.select("*")


def station_countries(staged_stations: DataFrame, countries: DataFrame) -> DataFrame:
    """Station id -> country name; stations of unknown countries drop out."""
    s, c = staged_stations.alias("s"), countries.alias("c")
    return s.join(c, F.col("s.country_code") == F.col("c.code"), "inner").select(
        F.col("s.id").alias("id"), F.col("c.name").alias("country_name")
    )


def sample(df: DataFrame, rows: int | None = None) -> DataFrame:
    """An arbitrary ``rows`` rows for trial runs; everything unless asked, ``SAMPLE_ROWS`` by custom."""
    return df if rows is None else df.limit(rows)
