from __future__ import annotations

import pytest

from skyfold.operators import QualityError, not_null, run_suite, unique
from skyfold.plans import (
    FACTS,
    Dimensions,
    Model,
    Models,
    fact_from_observations,
    fact_models,
    ingest_year,
    last_passed,
    run_bounded,
    store_results,
)
from skyfold.sinks import Layout, write_table
from tests.conftest import rows_of
from tests.test_jobs import lines
from tests.test_sources import write_csv


def test_bounds_come_from_the_last_run_that_passed(spark, tmp_path):
    path = str(tmp_path / "results")
    assert last_passed(spark, path, "t") is None

    def run(run_id: str, rows: int, nulls: int = 0) -> list[tuple]:
        df = spark.range(rows).selectExpr(f"if(id < {nulls}, null, id) as id")
        found = run_bounded(df, [not_null("id"), unique("id")], "t", last_passed(spark, path, "t"), percent=80)
        return rows_of(store_results(found, path, run_id).select("check_name", "row_count", "violations", "passed"))

    assert ("row_count", 10, 0, True) in run("a", 10)
    assert ("row_count", 8, 0, True) in run("b", 8)
    assert ("row_count", 6, 1, False) in run("c", 6)  # 80 % of 8, rounded up, is 7
    assert ("not_null", 20, 1, False) in run("d", 20, nulls=1)
    assert last_passed(spark, path, "t").rows == 8
    assert last_passed(spark, path, "t").violations[("unique", "id")] == 0
    assert last_passed(spark, path, "another") is None
    assert ("row_count", 7, 0, True) in run("e", 7)


def test_a_bound_needs_a_check_that_counts_rows(spark):
    with pytest.raises(ValueError, match="reads all"):
        run_bounded(spark.range(3), [unique("id")], "t", None)


def test_a_bounded_run_reads_its_table_once(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "t"))
    plan = run_bounded(spark.read.parquet(str(tmp_path / "t")), [not_null("id")], "t", None)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_an_ingest_refuses_a_file_that_lost_its_rows(spark, tmp_path):
    root, results = str(tmp_path / "root"), str(tmp_path / "results")
    whole = lines(2022)
    (tmp_path / "a").mkdir()
    ingest_year(spark, write_csv(tmp_path / "a" / "2022.csv", whole), root, 2022, results, least_percent=80)
    (tmp_path / "b").mkdir()
    cut = write_csv(tmp_path / "b" / "2022.csv", whole[:3])
    with pytest.raises(QualityError, match="last passed run"):
        ingest_year(spark, cut, root, 2022, results, least_percent=80)
    assert spark.read.parquet(root).count() == len(whole)
    assert spark.read.parquet(results).where("check_name = 'row_count' and not passed").count() == 1
    with pytest.raises(ValueError, match="results_path"):
        ingest_year(spark, cut, root, 2022, least_percent=80)
    ingest_year(spark, cut, root, 2022, results)
    assert spark.read.parquet(root).count() == 3


def test_declared_facts_equal_those_from_raw_rows(spark, tmp_path, observations, stations, countries):
    models, base = fact_models("rounded"), str(tmp_path / "set")
    sources = {"observations": observations, "stations": stations, "countries": countries}
    built = models.build(spark, base, sources)
    names = Dimensions.of(stations, countries)
    for name in FACTS:
        direct = fact_from_observations(name, observations, names, "rounded")
        assert rows_of(built.read(name).drop("year")) == rows_of(direct)
    changed = observations.where("year(date) = 2022")
    # Only what is made from the monthly partials is built again, from the daily ones as published.
    again = models.build(spark, base, sources | {"observations": changed}, changed=["partials/monthly"])
    assert again.tables["partials/daily"] == built.tables["partials/daily"]
    assert again.tables["stations_daily"] == built.tables["stations_daily"]
    assert again.tables["stations_yearly"] != built.tables["stations_yearly"]
    assert rows_of(again.read("stations_yearly")) == rows_of(built.read("stations_yearly"))


def test_partials_and_station_facts_are_shuffled_once_and_waves_need_nothing_of_each_other(
    spark, tmp_path, monkeypatch, observations, stations, countries
):
    arranged = {}

    def noted(frame, path, layout, arrange):
        arranged[path.split("/set")[1].split("/", 1)[1]] = arrange
        write_table(frame, path, layout, arrange=arrange)

    monkeypatch.setattr("skyfold.plans.models.write_table", noted)
    models = fact_models()
    models.build(spark, str(tmp_path / "set"), {"observations": observations, "stations": stations, "countries": countries})
    assert {n for n, a in arranged.items() if a == "spread"} == {"countries_yearly", "countries_historic"}
    assert {n for n, a in arranged.items() if a == "keep"} == {"partials/daily", "partials/monthly"} | {n for n in FACTS if "stations" in n}
    assert [set(w) for w in models.waves[:2]] == [{"partials/daily"}, {"partials/monthly", "stations_daily"}]
    assert set(models.waves[2]) == set(FACTS) - {"stations_daily"}


def _model(name: str, *inputs: str, **options) -> Model:
    return Model(name, inputs, lambda first, *_: first, **options)


def test_declarations_are_checked():
    with pytest.raises(ValueError, match="each other"):
        Models(["s"], [_model("a", "s", "b"), _model("b", "a")])
    with pytest.raises(ValueError, match="nothing declares"):
        Models(["s"], [_model("a", "t")])
    with pytest.raises(ValueError, match="more than once"):
        Models(["s"], [_model("s", "s")])
    models = Models(["s", "t"], [_model("c", "b", "t"), _model("b", "a"), _model("a", "s"), _model("d", "t")])
    assert models.order.index("a") < models.order.index("b") < models.order.index("c")
    assert models.with_dependents(["b"]) == ["b", "c"]
    assert set(models.with_dependents(["t"])) == {"c", "d"}
    with pytest.raises(ValueError, match="unknown"):
        models.with_dependents(["x"])


def test_views_are_not_stored_and_a_failed_check_publishes_nothing(spark, tmp_path):
    base, layout = str(tmp_path / "set"), Layout(cluster=("id",), by_year=False)
    view = Model("odd", ("s",), lambda s: s.where("id % 2 = 1"))
    table = Model("kept", ("odd",), lambda o: o.selectExpr("id", "nullif(id, 7) as n"), layout, (not_null("n"),))
    models = Models(["s"], [table, view])
    built = models.build(spark, base, {"s": spark.range(6)})
    assert set(built.tables) == {"kept"}
    with pytest.raises(QualityError, match="not_null"):
        models.build(spark, base, {"s": spark.range(9)})
    assert rows_of(models.read(spark, base, "kept").select("id")) == [(1,), (3,), (5,)]
    with pytest.raises(ValueError, match="not built"):
        Models(["s"], [_model("a", "s", layout=layout), _model("b", "a", layout=layout)]).build(
            spark, str(tmp_path / "new"), {"s": spark.range(1)}, changed=["b"]
        )
    assert run_suite(built.read("kept"), [not_null("n")]).first()["passed"]
