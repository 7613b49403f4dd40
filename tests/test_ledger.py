from __future__ import annotations

import os

import pytest

from skyfold.__main__ import _parser, run
from skyfold.operators import QualityError
from skyfold.plans import FACTS, Dimensions, built_tables, catch_up, fact_from_observations, mark_built, pending_years, read_fact
from skyfold.plans import ledger as ledgers
from tests.conftest import NEW_YORK, rows_of
from tests.test_sources import write_csv

YEARS = range(2018, 2023)


@pytest.fixture
def at(tmp_path):
    return {n: str(tmp_path / n) for n in ("root", "ledger", "results", "out", "s", "c")}


@pytest.fixture
def year_file(tmp_path):
    def make(year: int, value: int = 10) -> str:
        return write_csv(tmp_path / f"{year}.csv", [f"{NEW_YORK},{year}0101,TMAX,{value},,,7,", f"{NEW_YORK},{year}0102,TMAX,{year},,,7,"])

    return make


def values(spark, root):
    return {(r["year"], r["data_value"]) for r in spark.read.parquet(root).collect()}


def test_a_lost_run_resumes_where_it_was(spark, at, year_file, monkeypatch):
    files, begun = [year_file(y) for y in YEARS], []
    ingest = ledgers.ingest_year

    def dies_in_the_third(session, path, root, year, *args):
        begun.append(year)
        if len(begun) == 3:
            raise KeyboardInterrupt
        ingest(session, path, root, year, *args)

    monkeypatch.setattr(ledgers, "ingest_year", dies_in_the_third)
    with pytest.raises(KeyboardInterrupt):
        catch_up(spark, files, at["root"], at["ledger"], at["results"])
    assert pending_years(spark, at["ledger"]) == [2018, 2019]
    assert catch_up(spark, reversed(files), at["root"], at["ledger"], at["results"]) == [2020, 2021, 2022]
    assert begun == [2018, 2019, 2020, 2020, 2021, 2022]
    assert values(spark, at["root"]) == {(y, v) for y in YEARS for v in (10, y)}
    assert pending_years(spark, at["ledger"]) == list(YEARS)
    assert catch_up(spark, files, at["root"], at["ledger"]) == [] and len(begun) == 6
    mark_built(spark, at["ledger"], YEARS)
    assert pending_years(spark, at["ledger"]) == []


def test_only_changed_lines_are_taken_up_again(spark, at, year_file, monkeypatch):
    files = [year_file(y) for y in (2021, 2022)]
    catch_up(spark, files, at["root"], at["ledger"])
    mark_built(spark, at["ledger"], [2021, 2022])
    os.utime(files[0], (1, 1))  # touched: read once more, its lines are the same
    assert catch_up(spark, files, at["root"], at["ledger"]) == []
    digest = ledgers.content_digest
    monkeypatch.setattr(ledgers, "content_digest", lambda *a: pytest.fail("read without need"))
    assert catch_up(spark, files, at["root"], at["ledger"]) == []
    monkeypatch.setattr(ledgers, "content_digest", digest)
    year_file(2022, 11)
    os.utime(files[1], (2, 2))
    assert catch_up(spark, files, at["root"], at["ledger"]) == [2022] == pending_years(spark, at["ledger"])
    assert values(spark, at["root"]) == {(2021, 10), (2021, 2021), (2022, 11), (2022, 2022)}
    states = [(r["year"], r["state"]) for r in ledgers.read_ledger(spark, at["ledger"]).orderBy("sequence").collect()]
    assert states == [(2021, "ingested"), (2022, "ingested"), (2021, "built"), (2022, "built"), (2021, "same"), (2022, "ingested")]


def test_a_bad_file_stops_the_run_and_is_taken_up_once_it_is_mended(spark, at, year_file, tmp_path):
    files = [year_file(y) for y in (2020, 2021, 2022)]
    write_csv(tmp_path / "2021.csv", [",20210101,TMAX,1,,,,"])
    for _ in range(2):
        with pytest.raises(QualityError, match="not_null"):
            catch_up(spark, files, at["root"], at["ledger"], at["results"])
    assert pending_years(spark, at["ledger"]) == [2020]
    year_file(2021)
    assert catch_up(spark, files, at["root"], at["ledger"], at["results"]) == [2021, 2022]


def test_names_must_be_years_of_their_own(spark, at, year_file, tmp_path):
    (tmp_path / "more").mkdir()
    again = write_csv(tmp_path / "more" / "2022.csv", [])
    for paths, found in (([year_file(2022), again], "more than one"), ([write_csv(tmp_path / "data.csv", [])], "not named")):
        with pytest.raises(QualityError, match=found):
            catch_up(spark, paths, at["root"], at["ledger"])
    assert ledgers.read_ledger(spark, at["ledger"]).isEmpty() and pending_years(spark, at["ledger"]) == []
    mark_built(spark, at["ledger"], [])


def test_digests_tell_repeated_lines_apart(spark, tmp_path):
    """Order does not count, the number of equal lines does."""
    one, two = (write_csv(tmp_path / n, ["a,1", *["b,2"] * k]) for n, k in (("1.csv", 1), ("2.csv", 3)))
    turned = write_csv(tmp_path / "3.csv", ["b,2", "a,1"])
    digests = [ledgers.content_digest(spark, p) for p in (one, two, turned)]
    assert digests[0] == digests[2] != digests[1]


def test_the_command_line_refreshes_what_was_taken_up(spark, at, year_file, stations, countries):
    stations.write.parquet(at["s"])
    countries.write.parquet(at["c"])

    def skyfold(*argv):
        run(spark, _parser().parse_args([str(a) for a in argv]))

    def build():
        skyfold("build-facts", at["root"], at["s"], at["c"], at["out"], 2000, 2030, "--ledger", at["ledger"])
        return built_tables(spark, at["out"])

    files = [year_file(2021), year_file(2022)]
    skyfold("catch-up", at["root"], at["ledger"], *files)
    first = build()
    assert build().number == first.number == 1  # nothing is pending
    year_file(2022, 30)
    os.utime(files[1], (3, 3))
    skyfold("catch-up", at["root"], at["ledger"], *files, "--results", at["results"])
    second = build()
    assert second.number == 2
    assert [p for p in second.paths("stations_daily") if "2021" in p] == [p for p in first.paths("stations_daily") if "2021" in p]
    stored = spark.read.parquet(at["root"]).drop("year")
    for name in FACTS:
        direct = fact_from_observations(name, stored, Dimensions.of(stations, countries))
        assert rows_of(read_fact(spark, at["out"], name)) == rows_of(direct), name
