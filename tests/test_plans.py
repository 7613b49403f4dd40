"""The physical plans are the ones meant for large inputs."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from skyfold.operators import roll_up
from skyfold.plans import FACTS, Dimensions, fact_from_observations, fact_from_partials
from skyfold.sinks import replace_years, write_dimension
from skyfold.sources import read_dimension, read_years


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory, observations, stations, countries):
    base = str(tmp_path_factory.mktemp("plans"))
    replace_years(observations, f"{base}/observations")
    write_dimension(stations, f"{base}/stations")
    write_dimension(countries, f"{base}/countries")
    return (
        read_years(spark, f"{base}/observations", 2022, 2022),
        read_dimension(spark, f"{base}/stations"),
        read_dimension(spark, f"{base}/countries"),
    )


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", FACTS)
def test_one_shuffle_and_broadcast_lookups(stored, name):
    observations, stations, countries = stored
    text = plan(fact_from_observations(name, observations, Dimensions.of(stations, countries)))
    assert text.count("Exchange hashpartitioning") == 1
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert "partial_" in text  # combined before the shuffle
    assert "Python" not in text and "ArrowEval" not in text
    assert "CartesianProduct" not in text and "NestedLoop" not in text


@pytest.mark.parametrize("name", [n for n in FACTS if FACTS[n].per_country])
def test_large_country_lookup_joins_aggregated_rows(spark, stored, name):
    observations, stations, countries = stored
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(fact_from_observations(name, observations, Dimensions.of(stations, countries, limit_bytes=0)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" not in text
    # The fact side of the join is an aggregate over the scan, not the scan itself.
    fact_side = text[text.index("SortMergeJoin") :]
    assert fact_side.index("HashAggregate") < fact_side.index("FileScan")


def test_year_range_prunes_directories(stored):
    text = plan(stored[0])
    filters = text[text.index("PartitionFilters") :]
    assert "year" in filters[: filters.index("PushedFilters")]


def test_only_needed_columns_are_read(stored):
    observations, stations, countries = stored
    dimensions = Dimensions.of(stations, countries)
    text = plan(fact_from_observations("countries_historic", observations, dimensions))
    schema = text[text.index("ReadSchema: struct<id") :]
    assert schema.startswith("ReadSchema: struct<id:string,meteorological_element:string,data_value:int>")
    assert "flag_" not in text and "elevation" not in text


def test_unused_partials_are_not_computed(stored):
    observations, stations, countries = stored
    text = plan(fact_from_observations("stations_yearly", observations, Dimensions.of(stations, countries)))
    assert "temp_max" not in text and "precipitation" not in text


def test_facts_at_the_grain_of_their_partials_need_no_shuffle(stored):
    observations, stations, countries = stored
    dimensions = Dimensions.of(stations, countries)
    partials = roll_up(observations, ["id"], "day")
    fact = fact_from_partials("stations_daily", partials, dimensions, at_grain=True)
    assert plan(fact).count("Exchange hashpartitioning") == plan(partials).count("Exchange hashpartitioning") == 1


def test_partials_stay_integers(stored):
    types = dict(roll_up(stored[0], ["id"], "day").dtypes)
    assert {t for c, t in types.items() if c not in ("id", "date")} == {"int", "bigint"}


def test_no_filter_on_elements(stored):
    text = plan(roll_up(stored[0], ["id"], "day").select("id", "date", F.col("temp_avg_n")))
    assert "Filter (" not in text and "PushedFilters: []" in text
