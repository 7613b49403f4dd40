"""Partials bucketed by station: coarser partials and station facts without a shuffle."""

from __future__ import annotations

from datetime import date, timedelta

import pytest

from skyfold.operators.rollup import merge_partials, roll_up
from skyfold.plans import Dimensions, built_tables
from skyfold.plans.facts import fact_from_partials
from skyfold.plans.jobs import BUCKET_BYTES, PARTIALS_LAYOUT, plan_batches, plan_buckets
from skyfold.sinks import bucketed_table
from tests.conftest import rows_of
from tests.test_jobs import built, files  # noqa: F401


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def readings(make_observations):
    """Forty stations over two years; one of them has a third of all rows."""
    days = [date(2021, 12, 1) + timedelta(d) for d in range(60)]
    even = [(f"USW{k:08d}", d, e, k - d.day) for k in range(40) for d in days[::5] for e in ("TMAX", "PRCP")]
    return make_observations(even + [("ACW00000007", d, "TAVG", n) for d in days for n in range(8)])


@pytest.fixture
def daily(spark, tmp_path, readings):
    with bucketed_table(spark, str(tmp_path / "daily"), PARTIALS_LAYOUT, 4) as table:
        table.append(roll_up(readings.where("year(date) = 2021"), ["id"], "day"))
        table.append(roll_up(readings.where("year(date) = 2022"), ["id"], "day"))
        yield table


@pytest.mark.parametrize("period", ["month", "year", None])
def test_coarser_partials_need_no_exchange(daily, readings, period):
    merged = merge_partials(daily.read(), ["id"], period)
    assert "Exchange" not in plan_of(merged)
    assert rows_of(merged) == rows_of(roll_up(readings, ["id"], period))


def test_rows_of_a_bucketed_table_stay_in_their_buckets(spark, tmp_path, daily, readings):
    with bucketed_table(spark, str(tmp_path / "monthly"), PARTIALS_LAYOUT, 4) as months:
        months.append(merge_partials(daily.read(), ["id"], "month"), in_buckets=True)
        yearly = merge_partials(months.read(), ["id"], "year")
        assert "Exchange" not in plan_of(yearly)
        assert rows_of(yearly) == rows_of(roll_up(readings, ["id"], "year"))
        files_of_year = list((tmp_path / "monthly" / "year=2021").glob("*.parquet"))
        assert len(files_of_year) <= 4  # one a bucket: no task met rows of another's


@pytest.mark.parametrize("name, at_grain", [("stations_daily", True), ("stations_monthly", False), ("stations_yearly", False)])
@pytest.mark.parametrize("limit_bytes", [1 << 20, 0])
def test_station_facts_shuffle_no_partials(spark, daily, readings, stations, countries, name, at_grain, limit_bytes):
    dimensions = Dimensions.of(stations, countries, limit_bytes=limit_bytes)
    fact = fact_from_partials(name, daily.read(), dimensions, at_grain=at_grain)
    with_threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(fact_from_partials(name, daily.read(), dimensions, at_grain=at_grain))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", with_threshold)
    # Beyond the broadcast limit the stations are moved to the partials' buckets, and nothing else is.
    assert plan.count("Exchange hashpartitioning") == (0 if limit_bytes else 1)
    partials = roll_up(readings, ["id"], "day")
    assert rows_of(fact) == rows_of(fact_from_partials(name, partials, dimensions, at_grain=at_grain))


def test_the_catalogue_entry_goes_and_the_files_stay(spark, tmp_path, readings):
    path = str(tmp_path / "t")
    with pytest.raises(RuntimeError, match="lost"):
        with bucketed_table(spark, path, PARTIALS_LAYOUT, 4) as table:
            table.append(roll_up(readings, ["id"], "day"))
            raise RuntimeError("lost")
    assert not spark.catalog.tableExists(table.name)
    assert spark.read.parquet(path).count() == roll_up(readings, ["id"], "day").count()


def test_an_empty_table_reads_as_empty(spark, tmp_path, readings):
    with bucketed_table(spark, str(tmp_path / "t"), PARTIALS_LAYOUT, 4) as table:
        table.append(roll_up(readings.where("false"), ["id"], "day"))
        assert merge_partials(table.read(), ["id"], "month").count() == 0


def test_a_build_leaves_no_catalogue_entries(spark, built):  # noqa: F811
    out = built(batch_bytes=1)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("skyfold_")]
    assert built_tables(spark, out).read("partials/daily").count() > 0


def test_buckets_follow_the_largest_batch():
    sizes = {2020: 3 * BUCKET_BYTES, 2021: BUCKET_BYTES, 2022: 1}
    assert plan_buckets(sizes, plan_batches(sizes)) == 5
    assert plan_buckets(sizes, plan_batches(sizes, batch_bytes=1), fewest=2) == 3
    assert plan_buckets({2022: 1}, plan_batches({2022: 1}), fewest=8) == 8
