from __future__ import annotations

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from skyfold.operators import QualityError, column_set, gate, no_rows_where, not_null, run_suite, unique
from skyfold.plans import (
    FACTS,
    MODEL_CHECKS,
    VARIANTS,
    Dimensions,
    check_facts,
    check_sources,
    fact_from_observations,
    monthly_invariants,
    raw_checks,
    store_results,
)
from skyfold.schema import RAW_HEADER
from tests.conftest import NEW_YORK, rows_of

GOOD = ("USW00094728", "20220101", "TMAX", "139", "", "", "W", "")


def raw(spark, rows, header=RAW_HEADER):
    return spark.createDataFrame(rows, ", ".join(f"{h} string" for h in header))


def outcome(results) -> dict:
    return {(r.check_name, r.column_name): (r.row_count, r.violations, r.passed) for r in results.collect()}


def test_good_raw_rows_pass(spark):
    results = run_suite(raw(spark, [GOOD] * 3), raw_checks(F.lit(2022)), "2022")
    assert set(outcome(results).values()) == {(3, 0, True)}
    gate(results)


def test_missing_and_extra_columns_fail(spark):
    missing = outcome(run_suite(raw(spark, [GOOD[:6] + GOOD[7:]], [h for h in RAW_HEADER if h != "S_FLAG"]), raw_checks()))
    assert missing["column_set", "*"] == (1, 1, False)
    extra = raw(spark, [(*GOOD, "x")], [*RAW_HEADER, "MORE"])
    assert outcome(run_suite(extra, raw_checks()))["column_set", "*"] == (1, 1, False)
    assert outcome(run_suite(extra, raw_checks(exact=False)))["column_set", "*"][2]


def test_a_missing_checked_column_fails_instead_of_breaking(spark):
    results = outcome(run_suite(raw(spark, [GOOD[1:]] * 2, RAW_HEADER[1:]), raw_checks()))
    assert results["not_null", "ID"] == (2, 2, False)


def test_swapped_columns_pass_the_set_but_fail_the_order(spark):
    header = ["DATE", "ID", *RAW_HEADER[2:]]
    swapped = raw(spark, [(GOOD[1], GOOD[0], *GOOD[2:])], header)
    assert outcome(run_suite(swapped, raw_checks(ordered=False)))["column_set", "*"] == (1, 0, True)
    assert outcome(run_suite(swapped, raw_checks()))["column_set", "*"] == (1, 2, False)


def test_nulls_are_counted(spark):
    rows = [GOOD, (None, *GOOD[1:]), (None, None, *GOOD[2:])]
    results = run_suite(raw(spark, rows), raw_checks())
    assert outcome(results)["not_null", "ID"] == (3, 2, False)
    assert outcome(results)["not_null", "DATE"] == (3, 1, False)
    with pytest.raises(QualityError, match=r"2 check.*not_null\(ID\): 2"):
        gate(results)


def test_dates_of_another_year_fail(spark):
    rows = [GOOD, (GOOD[0], "20211231", *GOOD[2:])]
    assert outcome(run_suite(raw(spark, rows), raw_checks(F.lit(2022))))[
        "no_rows_where", "date outside the file's year"
    ] == (2, 1, False)


def test_unique_counts_values_and_ignores_nulls(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", None), ("b", None), ("c", "z")], "k string, v string")
    assert outcome(run_suite(df, [unique("k"), unique("v")])) == {
        ("unique", "k"): (5, 2, False),
        ("unique", "v"): (3, 0, True),
    }


def test_unique_of_nothing_passes(spark):
    df = spark.createDataFrame([(None,)], "k string")
    assert outcome(run_suite(df, [unique("k")])) == {("unique", "k"): (0, 0, True)}


def test_two_stations_with_one_id_fail(stations, countries, observations):
    results = check_sources(observations, stations.unionAll(stations), countries)
    failed = {(r.table_name, r.check_name, r.column_name, r.violations) for r in results.where("not passed").collect()}
    assert failed == {("stations", "unique", "id", 2)}


@pytest.mark.parametrize("variant", VARIANTS)
def test_declared_checks_pass_on_the_facts(observations, stations, countries, variant):
    dimensions = Dimensions.of(stations, countries)
    facts = {n: fact_from_observations(n, observations, dimensions, variant) for n in FACTS}
    results = check_facts(facts, variant)
    gate(results)
    assert results.count() == sum(len(MODEL_CHECKS[n]) for n in FACTS) + 3


MONTHLY = (
    "id string, date date, temp_max_avg double, temp_max_abs double, temp_min_avg double, "
    "temp_min_abs double, precipitation_days long"
)


@pytest.mark.parametrize(
    ("row", "failing"),
    [
        ((5.0, 4.0, 1.0, 1.0, 0), "mean maximum above absolute maximum"),
        ((4.0, 5.0, 1.0, 2.0, 0), "mean minimum below absolute minimum"),
        ((4.0, 5.0, 2.0, 1.0, 32), "too many rain days"),
        ((None, None, None, None, 31), None),
    ],
)
def test_monthly_invariants(spark, row, failing):
    df = spark.createDataFrame([("X", date(2022, 1, 1), *row)], MONTHLY)
    failed = [r.column_name for r in run_suite(df, monthly_invariants()).where("not passed").collect()]
    assert failed == ([failing] if failing else [])


def test_duplicate_rain_rows_break_the_day_limit(make_observations, stations, countries):
    wet = make_observations([(NEW_YORK, date(2022, 1, 1) + timedelta(days=i % 31), "PRCP", 20) for i in range(32)])
    monthly = fact_from_observations("stations_monthly", wet, Dimensions.of(stations, countries))
    assert monthly.first().precipitation_days == 32
    assert outcome(run_suite(monthly, monthly_invariants()))["no_rows_where", "too many rain days"] == (1, 1, False)


def test_three_equal_readings_do_not_exceed_their_maximum(make_observations, stations, countries):
    same = make_observations([(NEW_YORK, date(2022, 1, d), "TMAX", 1) for d in (1, 2, 3)])
    monthly = fact_from_observations("stations_monthly", same, Dimensions.of(stations, countries))
    gate(run_suite(monthly, monthly_invariants()))


def test_results_accumulate_by_run(spark, tmp_path):
    path = str(tmp_path / "results")
    results = run_suite(raw(spark, [GOOD]), [column_set(RAW_HEADER), not_null("ID")], "2022")
    for run_id in ("first", "second"):
        assert rows_of(store_results(results, path, run_id)) == rows_of(results)
    assert spark.read.parquet(path).groupBy("run_id").count().count() == 2


def test_row_checks_share_one_pass(spark):
    checks = [not_null("ID"), not_null("DATE"), no_rows_where("x", F.col("ELEMENT") == "x"), column_set(RAW_HEADER)]
    plan = run_suite(raw(spark, [GOOD]), checks)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1
