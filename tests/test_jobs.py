from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from skyfold.__main__ import _parser, run
from skyfold.operators import QualityError, gate
from skyfold.plans import (
    FACTS,
    VARIANTS,
    Dimensions,
    backfill_years,
    build_facts,
    built_tables,
    check_tables,
    fact_from_observations,
    ingest_dimensions,
    ingest_year,
    read_fact,
)
from skyfold.plans.facts import fact_from_partials
from skyfold.plans.jobs import new_run_id, plan_batches
from skyfold.schema import RAW_HEADER
from skyfold.session import SETTINGS, shuffle_partitions
from skyfold.sinks import replace_years
from skyfold.sources import read_observations_csv
from tests.conftest import COUNTRIES, NEW_YORK, READINGS, STATIONS, rows_of
from tests.test_sources import station_line, write_csv


def lines(year: int) -> list[str]:
    """The micro-fixture's rows of one year as file lines."""
    return [
        f"{station},{day:%Y%m%d},{element},{'' if value is None else value},,,7,"
        for station, day, element, value in READINGS
        if day.year == year
    ]


@pytest.fixture
def files(tmp_path) -> list[str]:
    return [write_csv(tmp_path / f"{year}.csv", lines(year)) for year in (2021, 2022)]


def test_ingest_year_by_year(spark, tmp_path, files, observations):
    root, results = str(tmp_path / "root"), str(tmp_path / "results")
    for _ in range(2):
        for path, year in zip(files, (2021, 2022)):
            ingest_year(spark, path, root, year, results)
            assert spark.read.parquet(root).where(F.col("year") == year).count() > 0
    assert rows_of(spark.read.parquet(root).drop("year")) == rows_of(observations)
    stored = spark.read.parquet(results)
    assert stored.where("not passed").count() == 0
    assert rows_of(stored.groupBy("table_name").agg(F.max("row_count"), F.count("*"))) == [
        ("2021", 3, 8),
        ("2022", 9, 8),
    ]


def test_malformed_cell_passes_the_checks_but_keeps_the_year(spark, tmp_path, files, observations):
    root, results = str(tmp_path / "root"), str(tmp_path / "results")
    backfill_years(spark, files, root)
    (tmp_path / "new").mkdir()
    bad = write_csv(tmp_path / "new" / "2022.csv", [*lines(2022), f"{NEW_YORK},20220101,TMAX,1x,,,,"])
    with pytest.raises(Exception, match="(?i)malformed"):
        ingest_year(spark, bad, root, 2022, results)
    assert rows_of(spark.read.parquet(root).drop("year")) == rows_of(observations)
    assert spark.read.parquet(results).where("not passed").count() == 0


def test_ingest_does_not_shuffle(spark, tmp_path, files):
    typed = read_observations_csv(spark, files, with_file_year=True)
    plan = typed.sortWithinPartitions("year", "id", "date")._jdf.queryExecution().executedPlan().toString()
    assert "Sort [year" in plan and "Exchange" not in plan


def test_backfill_equals_ingest(spark, tmp_path, files, observations):
    root = str(tmp_path / "root")
    for _ in range(2):
        backfill_years(spark, files, root, str(tmp_path / "results"))
    assert rows_of(spark.read.parquet(root).drop("year")) == rows_of(observations)


def test_failed_gate_leaves_the_year_and_stores_the_result(spark, tmp_path, files, observations):
    root, results = str(tmp_path / "root"), str(tmp_path / "results")
    backfill_years(spark, files, root)
    (tmp_path / "new").mkdir()
    bad = write_csv(tmp_path / "new" / "2022.csv", [",20220101,TMAX,1,,,,"])
    with pytest.raises(QualityError, match="not_null"):
        ingest_year(spark, bad, root, 2022, results)
    with pytest.raises(QualityError, match="not_null"):
        backfill_years(spark, [bad], root, results)
    assert rows_of(spark.read.parquet(root).drop("year")) == rows_of(observations)
    assert spark.read.parquet(results).where("not passed and column_name = 'ID'").count() == 2


def test_other_bad_files_are_refused(spark, tmp_path):
    root = str(tmp_path / "root")
    empty = write_csv(tmp_path / "2022.csv", [])
    with pytest.raises(QualityError, match="no rows"):
        ingest_year(spark, empty, root, 2022, str(tmp_path / "results"))
    kept = spark.read.parquet(str(tmp_path / "results"))
    assert kept.where("check_name = 'row_count' and not passed").count() == 1
    stray = write_csv(tmp_path / "2021.csv", lines(2022))
    with pytest.raises(QualityError, match="file's year"):
        ingest_year(spark, stray, root, 2021)
    with pytest.raises(QualityError, match="file's year"):
        backfill_years(spark, [stray], root)
    unnamed = write_csv(tmp_path / "data.csv", lines(2022))
    with pytest.raises(QualityError, match="file's year"):
        backfill_years(spark, [unnamed], root)
    swapped = write_csv(tmp_path / "2020.csv", lines(2022), ["DATE", "ID", *RAW_HEADER[2:]])
    with pytest.raises(QualityError, match="column_set"):
        ingest_year(spark, swapped, root, 2022)
    with pytest.raises(QualityError, match="column_set"):
        backfill_years(spark, [swapped], root)


def test_backfill_refuses_an_empty_year_and_two_files_of_one_year(spark, tmp_path, files, observations):
    root, results = str(tmp_path / "root"), str(tmp_path / "results")
    backfill_years(spark, files, root)
    (tmp_path / "new").mkdir()
    empty = write_csv(tmp_path / "new" / "2022.csv", [])
    with pytest.raises(QualityError, match="2022"):
        backfill_years(spark, [files[0], empty], root, results)
    assert spark.read.parquet(results).where("not passed").count() == 1
    with pytest.raises(QualityError, match="more than one file"):
        backfill_years(spark, [*files, empty], root)
    assert rows_of(spark.read.parquet(root).drop("year")) == rows_of(observations)


def test_every_part_of_a_file_needs_the_header(spark, tmp_path, files, observations):
    root, results = str(tmp_path / "root"), str(tmp_path / "results")
    backfill_years(spark, files, root)
    folder = tmp_path / "parts" / "2022.csv"
    folder.mkdir(parents=True)
    flags = RAW_HEADER.index("M_FLAG")
    other = [*RAW_HEADER[:flags], "Q_FLAG", "M_FLAG", *RAW_HEADER[flags + 2 :]]
    write_csv(folder / "part-0.csv", lines(2022))
    write_csv(folder / "part-1.csv", lines(2022), other)
    for job in (lambda: ingest_year(spark, str(folder), root, 2022, results), lambda: backfill_years(spark, [str(folder)], root, results)):
        with pytest.raises(QualityError, match="column_set"):
            job()
    assert rows_of(spark.read.parquet(root).drop("year")) == rows_of(observations)
    assert spark.read.parquet(results).where("check_name = 'column_set' and not passed").count() == 2


def test_runs_of_one_second_have_ids_of_their_own():
    assert len({new_run_id() for _ in range(50)}) == 50


@pytest.fixture
def built(spark, tmp_path, observations, stations, countries):
    root, out = str(tmp_path / "root"), str(tmp_path / "out")
    replace_years(observations, root)

    def build(first=2021, last=2022, **options):
        build_facts(spark, root, stations, countries, out, first, last, **options)
        return out

    build.root = root
    return build


@pytest.mark.parametrize("variant", VARIANTS)
def test_built_facts_equal_direct_ones(spark, built, observations, stations, countries, variant):
    out = built(variant=variant)
    dimensions = Dimensions.of(stations, countries)
    for name in FACTS:
        direct = fact_from_observations(name, observations, dimensions, variant)
        assert read_fact(spark, out, name, variant).columns == direct.columns
        assert rows_of(read_fact(spark, out, name, variant)) == rows_of(direct), name
    gate(check_tables(spark, out, variant))


def test_built_facts_cover_the_range_only(spark, built):
    built()
    out = built(2022, 2022)
    for name in FACTS:
        if FACTS[name].period is not None:
            assert read_fact(spark, out, name).where("year(date) <> 2022").count() == 0


def test_batches_of_years_give_the_same_facts(spark, built, observations, stations, countries):
    built()
    out = built(batch_bytes=1)
    for name in FACTS:
        direct = fact_from_observations(name, observations, Dimensions.of(stations, countries))
        assert rows_of(read_fact(spark, out, name)) == rows_of(direct), name
    out = built(2022, 2022, batch_bytes=1)
    assert built_tables(spark, out).read("partials/daily").where("year = 2021").count() == 0


def test_refresh_of_one_year_equals_a_full_build(spark, built, observations, stations, countries):
    out = built()
    before = rows_of(read_fact(spark, out, "stations_daily").where("year(date) = 2021"))
    changed = observations.withColumn("data_value", F.col("data_value") + 7)
    replace_years(changed.where("year(date) = 2022"), built.root)
    built(changed_years=[2022])
    now = observations.where("year(date) = 2021").unionAll(changed.where("year(date) = 2022"))
    for name in FACTS:
        expected = rows_of(fact_from_observations(name, now, Dimensions.of(stations, countries)))
        assert rows_of(read_fact(spark, out, name)) == expected, name
    assert rows_of(read_fact(spark, out, "stations_daily").where("year(date) = 2021")) == before


def test_years_must_be_stored_and_in_range(built):
    with pytest.raises(ValueError, match="2023"):
        built(2021, 2023, changed_years=[2023])
    with pytest.raises(ValueError, match="holds"):
        built(2022, 2022, changed_years=[2021])
    with pytest.raises(ValueError, match="holds"):
        built(1763, 2020)


def test_a_long_range_may_start_before_the_data(spark, built, observations, stations, countries):
    out = built(1763, 2030)
    direct = fact_from_observations("stations_daily", observations, Dimensions.of(stations, countries))
    assert rows_of(read_fact(spark, out, "stations_daily")) == rows_of(direct)


def test_trial_build_is_limited(spark, built):
    out = built(sample_rows=2, batch_bytes=1)
    assert all(read_fact(spark, out, name).count() <= 2 for name in FACTS)
    with pytest.raises(ValueError, match="trial"):
        built()


def test_trial_build_leaves_a_full_one_alone(spark, built):
    out = built()
    before = {name: rows_of(read_fact(spark, out, name)) for name in FACTS}
    for variant in VARIANTS:
        with pytest.raises(ValueError, match="full"):
            built(variant=variant, sample_rows=2)
    assert {name: rows_of(read_fact(spark, out, name)) for name in FACTS} == before


def test_variants_lie_apart(spark, built, observations, stations, countries):
    out = built()
    built(variant="rounded")
    built(changed_years=[2022], variant="rounded")
    for variant in VARIANTS:
        direct = fact_from_observations("countries_yearly", observations, Dimensions.of(stations, countries), variant)
        assert rows_of(read_fact(spark, out, "countries_yearly", variant)) == rows_of(direct)


def test_a_refresh_removes_years_of_which_nothing_is_left(spark, built, observations):
    out = built()
    nowhere = observations.where("year(date) = 2022").withColumn("id", F.lit("ZZX00000009"))
    replace_years(nowhere, built.root)
    built(changed_years=[2022])
    for name in ("stations_daily", "stations_monthly", "stations_yearly", "countries_yearly"):
        assert read_fact(spark, out, name).where("year(date) = 2022").count() == 0


@pytest.mark.parametrize("options", [{}, {"changed_years": [2022]}])
def test_a_failed_build_leaves_the_published_tables(spark, built, monkeypatch, options):
    out = built()
    before = {name: rows_of(read_fact(spark, out, name)) for name in FACTS}

    def broken(name, *args):
        if name == "countries_historic":
            raise RuntimeError("lost")
        return fact_from_partials(name, *args)

    replace_years(spark.read.parquet(built.root).where("year = 2022").withColumn("data_value", F.lit(1)), f"{built.root}2")
    monkeypatch.setattr("skyfold.plans.jobs.fact_from_partials", broken)
    with pytest.raises(RuntimeError, match="lost"):
        built(**options)
    assert {name: rows_of(read_fact(spark, out, name)) for name in FACTS} == before


def test_doubled_stations_and_nameless_countries_stop_a_build(spark, tmp_path, built, stations, countries):
    out = built()
    before = rows_of(read_fact(spark, out, "stations_daily"))
    results = str(tmp_path / "results")
    nameless = countries.unionAll(countries.limit(1).withColumn("code", F.lit(None).cast("string")))
    for s, c, found in ((stations.unionAll(stations), countries, "unique"), (stations, nameless, "not_null")):
        with pytest.raises(QualityError, match=found):
            build_facts(spark, built.root, s, c, out, 2021, 2022, results_path=results)
    assert rows_of(read_fact(spark, out, "stations_daily")) == before
    assert spark.read.parquet(results).where("not passed").count() >= 2


def test_a_build_needs_few_jobs(spark, built):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("count", "count")
    built()
    assert len(tracker.getJobIdsForGroup("count")) < 25
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_batches_bound_tasks_times_partitions():
    """260 years of 100 TB: no batch has too many map tasks times reducers, and no reducer more than 1 GB."""
    sizes = {1763 + k: 100 * 10**12 * (k + 1) // (260 * 261 // 2) for k in range(260)}
    batches = plan_batches(sizes)
    assert [y for b in batches for y in b.years] == sorted(sizes)
    for b in batches:
        size = sum(sizes[y] for y in b.years)
        assert size / (256 << 20) * b.partitions < 50e6
        assert size / b.partitions <= 1e9
    assert [b.partitions for b in plan_batches({2021: 100, 2022: 50}, least_partitions=8)] == [8]


def test_command_line_runs_all_jobs(spark, tmp_path, files, observations, stations, countries):
    (tmp_path / "stations.txt").write_text("".join(station_line(r) + "\n" for r in STATIONS))
    (tmp_path / "countries.txt").write_text("".join(f"{c} {n}\n" for c, n in COUNTRIES))
    at = {n: str(tmp_path / n) for n in ("stations.txt", "countries.txt", "s", "c", "root", "out", "results")}

    def skyfold(*argv):
        run(spark, _parser().parse_args([str(a) for a in argv]))

    skyfold("ingest-dimensions", at["stations.txt"], at["countries.txt"], at["s"], at["c"])
    skyfold("backfill", at["root"], *files)
    skyfold("ingest-year", files[1], at["root"], 2022, "--results", at["results"])
    skyfold("build-facts", at["root"], at["s"], at["c"], at["out"], 2021, 2022, "--variant", "rounded")
    skyfold("check-facts", at["out"], "--variant", "rounded", "--results", at["results"])
    skyfold("check-sources", at["root"], at["s"], at["c"], "--results", at["results"])
    dimensions = Dimensions.of(stations, countries)
    for name in FACTS:
        direct = fact_from_observations(name, observations, dimensions, "rounded")
        assert rows_of(read_fact(spark, at["out"], name, "rounded")) == rows_of(direct)


def test_ingested_dimensions_equal_the_text(spark, tmp_path, stations, countries):
    (tmp_path / "s.txt").write_text("".join(station_line(r) + "\n" for r in STATIONS))
    (tmp_path / "c.txt").write_text("".join(f"{c} {n}\n" for c, n in COUNTRIES))
    s, c = str(tmp_path / "s"), str(tmp_path / "c")
    for _ in range(2):
        ingest_dimensions(spark, str(tmp_path / "s.txt"), str(tmp_path / "c.txt"), s, c)
    assert rows_of(spark.read.parquet(s)) == rows_of(stations)
    assert rows_of(spark.read.parquet(c)) == rows_of(countries)


def test_a_failed_dimension_ingest_leaves_both_tables(spark, tmp_path, stations, countries):
    (tmp_path / "s.txt").write_text("".join(station_line(r) + "\n" for r in STATIONS))
    (tmp_path / "bad.txt").write_text(station_line(STATIONS[0]).replace("40.7789", "4O.7789") + "\n")
    (tmp_path / "c.txt").write_text("".join(f"{c} {n}\n" for c, n in COUNTRIES))
    s, c = str(tmp_path / "s"), str(tmp_path / "c")
    ingest_dimensions(spark, str(tmp_path / "s.txt"), str(tmp_path / "c.txt"), s, c)
    with pytest.raises(Exception, match="(?i)cast"):
        ingest_dimensions(spark, str(tmp_path / "bad.txt"), str(tmp_path / "c.txt"), s, c)
    assert rows_of(spark.read.parquet(s)) == rows_of(stations)
    assert rows_of(spark.read.parquet(c)) == rows_of(countries)
    assert not [p for p in tmp_path.iterdir() if "__new" in p.name or "__old" in p.name]


def test_shuffle_partitions_grow_with_the_input():
    assert shuffle_partitions(0) == 200
    assert shuffle_partitions(10**12) == 1863
    assert shuffle_partitions(100 * 10**12) == 20_000
    assert SETTINGS["spark.sql.adaptive.enabled"] == "true"
