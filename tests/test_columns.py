from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from skyfold.functions import compact_date, coordinates, count_above, country_code, month_of, rounded, year_of
from skyfold.operators import pivot_elements, rename_to_stored, sample, stage_stations, union_years
from skyfold.schema import RAW_HEADER
from tests.conftest import rows_of


def one(spark, column, sql="select 1"):
    return spark.sql(sql).select(column).first()[0]


def test_pivot_puts_each_element_in_its_column(observations):
    df = pivot_elements(observations)
    assert df.count() == observations.count()
    assert not {"flag_m", "flag_q", "flag_s"} & set(df.columns)
    snow = df.where("meteorological_element = 'SNOW'").first()
    assert (snow.temp_max, snow.temp_min, snow.temp_avg, snow.precipitation) == (None,) * 4
    low = df.where("meteorological_element = 'TMIN' and data_value is not null").first()
    assert (low.temp_max, low.temp_min) == (None, -2.0)


def test_numeric_pivot_keeps_all_columns_and_is_decimal(observations):
    df = pivot_elements(observations, numeric=True)
    assert df.columns == [*observations.columns, "temp_max", "temp_min", "temp_avg", "precipitation"]
    assert dict(df.dtypes)["temp_max"] == "decimal(38,9)"
    assert df.agg(F.max("temp_max")).first()[0] == Decimal("14.000000000")


def test_compact_date(spark):
    assert one(spark, compact_date(F.lit("20220131"))) == date(2022, 1, 31)
    with pytest.raises(Exception, match="(?i)parse|date"):
        one(spark, compact_date(F.lit("2022-01-31")))


def test_dates_truncate_to_dates(spark):
    day = F.lit(date(2022, 11, 30))
    assert one(spark, month_of(day)) == date(2022, 11, 1)
    assert one(spark, year_of(day)) == date(2022, 1, 1)


@pytest.mark.parametrize(("value", "expected"), [(13.95, 14.0), (-13.95, -14.0), (0.25, 0.3), (25.55, 25.6)])
def test_rounding_is_half_up(spark, value, expected):
    assert one(spark, rounded(F.lit(value))) == expected


def test_coordinates_are_null_when_either_is(spark):
    assert one(spark, coordinates(F.lit(25.0), F.lit(-80.5))) == "25.0, -80.5"
    assert one(spark, coordinates(F.lit(25.0), F.lit(None).cast("double"))) is None


def test_country_code_is_the_first_two_characters(spark):
    assert one(spark, country_code(F.lit("USW00094728"))) == "US"


def test_count_above_is_strict_and_never_null(spark):
    df = spark.createDataFrame([(1.0,), (1.1,), (None,)], "p double")
    assert df.agg(count_above("p", 1)).first()[0] == 1
    assert df.where("p is null").agg(count_above("p", 1)).first()[0] == 0


def test_rename_to_stored(spark):
    raw = spark.createDataFrame([("a",) * 8], RAW_HEADER)
    assert rename_to_stored(raw).columns == [
        "id",
        "date",
        "meteorological_element",
        "data_value",
        "flag_m",
        "flag_q",
        "flag_s",
        "observation_time",
    ]


def test_staged_stations_add_two_columns(stations):
    staged = stage_stations(stations)
    assert staged.columns == [*stations.columns, "latitude_longitude", "country_code"]
    assert rows_of(staged.select("country_code", "latitude_longitude")) == [
        ("AC", "17.1167, -61.7833"),
        ("US", "40.7789, -73.9692"),
    ]


def test_union_keeps_duplicates(observations):
    assert union_years([observations, observations]).count() == 2 * observations.count()


def test_sample(observations):
    assert sample(observations, 3).count() == 3
    assert sample(observations, None).count() == observations.count()
