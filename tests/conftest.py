from __future__ import annotations

import sys
from datetime import date
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import SparkSession  # noqa: E402

from skyfold.schema import COUNTRY_SCHEMA, OBSERVATION_SCHEMA, STATION_SCHEMA  # noqa: E402

NEW_YORK, ST_JOHNS, UNKNOWN = "USW00094728", "ACW00011604", "ZZX00000001"

STATIONS = [
    (NEW_YORK, 40.7789, -73.9692, 42.7, "NY", "NEW YORK CNTRL PK TWR", "GSN", "HCN", "72506"),
    (ST_JOHNS, 17.1167, -61.7833, 10.1, "", "ST JOHNS COOLIDGE FLD", "", "", ""),
]
COUNTRIES = [("US", "United States"), ("AC", "Antigua and Barbuda")]

READINGS = [
    (NEW_YORK, date(2021, 12, 31), "TMAX", 100),
    (NEW_YORK, date(2021, 12, 31), "TMIN", -20),
    (NEW_YORK, date(2021, 12, 31), "PRCP", 10),  # exactly 1.0: not a rain day
    (NEW_YORK, date(2022, 1, 1), "TMAX", 139),  # the mean of both is a rounding tie
    (NEW_YORK, date(2022, 1, 1), "TMAX", 140),
    (NEW_YORK, date(2022, 1, 1), "PRCP", 15),
    (NEW_YORK, date(2022, 1, 1), "PRCP", 25),
    (NEW_YORK, date(2022, 1, 2), "SNOW", 5),  # not pivoted: the row stays, all measures NULL
    (ST_JOHNS, date(2022, 1, 1), "TAVG", 250),
    (ST_JOHNS, date(2022, 2, 1), "TAVG", 261),
    (ST_JOHNS, date(2022, 2, 1), "TMIN", None),
    (UNKNOWN, date(2022, 1, 1), "TAVG", 999),  # dropped by the inner join
]


def observation(station: str, day: date, element: str, value: int | None) -> tuple:
    return (station, element, value, "", "", "7", None, day)


@pytest.fixture(scope="session")
def spark(tmp_path_factory) -> SparkSession:
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_observations(spark):
    """Frame of observations from (station, day, element, value) rows."""
    return lambda rows: spark.createDataFrame([observation(*r) for r in rows], OBSERVATION_SCHEMA)


@pytest.fixture(scope="session")
def observations(make_observations):
    return make_observations(READINGS)


@pytest.fixture(scope="session")
def stations(spark):
    return spark.createDataFrame(STATIONS, STATION_SCHEMA)


@pytest.fixture(scope="session")
def countries(spark):
    return spark.createDataFrame(COUNTRIES, COUNTRY_SCHEMA)


def rows_of(df) -> list[tuple]:
    """All rows in a stable order; NULL sorts first."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is not None, str(v)) for v in r])
