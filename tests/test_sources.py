from __future__ import annotations

from datetime import date

import pytest

from skyfold.schema import COUNTRY_SCHEMA, OBSERVATION_SCHEMA, RAW_HEADER, STATION_OFFSETS, STATION_SCHEMA
from skyfold.sinks import replace_years, write_dimension
from skyfold.sources import (
    read_countries_txt,
    read_dimension,
    read_observations_csv,
    read_raw_csv,
    read_stations_txt,
    read_table,
    read_year_files,
    read_years,
    register_external,
)
from tests.conftest import COUNTRIES, STATIONS, rows_of

LINES = [
    "USW00094728,20220101,TMAX,139,,,W,0700",
    "USW00094728,20220101,PRCP,,T,,W,",
    "ACW00011604,20220201,TAVG,-5,,X,,2400",
]


def write_csv(path, lines, header=RAW_HEADER):
    path.write_text("\n".join([",".join(header), *lines]) + "\n")
    return str(path)


def station_line(row) -> str:
    line = [" "] * 85
    for (start, end), value in zip(STATION_OFFSETS.values(), row):
        text = str(value)
        numeric = isinstance(value, float)
        cell = text.rjust(end - start) if numeric else text.ljust(end - start)
        line[start:end] = cell
    return "".join(line)


def test_csv_is_typed_by_position(spark, tmp_path):
    df = read_observations_csv(spark, write_csv(tmp_path / "2022.csv", LINES))
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in OBSERVATION_SCHEMA]
    assert rows_of(df) == [
        ("ACW00011604", "TAVG", -5, "", "X", "", 2400, date(2022, 2, 1)),
        ("USW00094728", "PRCP", None, "T", "", "W", None, date(2022, 1, 1)),
        ("USW00094728", "TMAX", 139, "", "", "W", 700, date(2022, 1, 1)),
    ]


def test_csv_rows_know_their_files_year(spark, tmp_path):
    paths = [write_csv(tmp_path / f"{y}.csv", LINES[:1]) for y in (2021, 2022)]
    years = read_observations_csv(spark, paths, with_file_year=True).select("year")
    assert rows_of(years) == [(2021,), (2022,)]


@pytest.mark.parametrize("bad", ["X,20220101,TMAX,12x,,,,", "X,2022-01-01,TMAX,1,,,,", "X,20220101,TMAX,1,,,,7h"])
def test_malformed_cells_raise_at_the_write(spark, tmp_path, bad):
    df = read_observations_csv(spark, write_csv(tmp_path / "2022.csv", [*LINES, bad]))
    with pytest.raises(Exception, match="(?i)malformed"):
        df.write.parquet(str(tmp_path / "out"))


def test_only_csv_is_accepted(spark, tmp_path):
    with pytest.raises(ValueError, match="csv"):
        read_observations_csv(spark, str(tmp_path / "2022.txt"))
    with pytest.raises(ValueError, match="no input"):
        read_observations_csv(spark, [])


def test_raw_csv_is_text_under_header_names(spark, tmp_path):
    df = read_raw_csv(spark, write_csv(tmp_path / "2022.csv", LINES))
    assert df.columns == RAW_HEADER
    assert set(dict(df.dtypes).values()) == {"string"}


def test_stations_from_fixed_width(spark, tmp_path):
    path = tmp_path / "stations.txt"
    path.write_text("\r\n".join(station_line(r) for r in STATIONS) + "\r\n")
    df = read_stations_txt(spark, str(path))
    assert df.schema == STATION_SCHEMA
    assert rows_of(df) == sorted(STATIONS)


def test_countries_from_fixed_width(spark, tmp_path):
    path = tmp_path / "countries.txt"
    path.write_text("".join(f"{code} {name:<40}\n" for code, name in COUNTRIES))
    df = read_countries_txt(spark, str(path))
    assert df.schema == COUNTRY_SCHEMA
    assert rows_of(df) == sorted(COUNTRIES)


def test_fixed_width_blanks_and_short_lines(spark, tmp_path):
    path = tmp_path / "stations.txt"
    path.write_text("ACW00011604\n")
    row = read_stations_txt(spark, str(path)).first()
    assert (row.id, row.latitude, row.elevation, row.name, row.wmo_id) == ("ACW00011604", None, None, "", "")


def test_fixed_width_malformed_number_raises(spark, tmp_path):
    path = tmp_path / "stations.txt"
    path.write_text("ACW00011604  17.1x67  -61.7833\n")
    with pytest.raises(Exception, match="(?i)cast"):
        read_stations_txt(spark, str(path)).collect()


def test_year_range_is_inclusive(spark, tmp_path, observations):
    root = str(tmp_path / "observations")
    replace_years(observations, root)
    assert read_years(spark, root, 2021, 2022).count() == 12
    assert read_years(spark, root, 2021, 2021).count() == 3
    assert read_years(spark, root, 1763, 2020).count() == 0


def test_year_files_union_in_one_scan(spark, tmp_path, observations):
    root = str(tmp_path / "observations")
    replace_years(observations, root)
    paths = [f"{root}/year=2021", f"{root}/year=2022", f"{root}/year=2022"]
    df = read_year_files(spark, paths)
    assert df.count() == 12 + 9
    assert df._jdf.queryExecution().sparkPlan().toString().count("FileScan") == 1


def test_dimension_table_and_external_table(spark, tmp_path, stations):
    path = str(tmp_path / "stations")
    write_dimension(stations, path)
    assert rows_of(read_dimension(spark, path)) == rows_of(stations)
    for _ in range(2):
        register_external(spark, "ext_stations", path)
    assert rows_of(read_table(spark, "ext_stations")) == rows_of(stations)
    spark.sql("drop table ext_stations")
    assert read_dimension(spark, path).count() == 2


def test_external_table_over_partitions(spark, tmp_path, observations):
    root = str(tmp_path / "observations")
    replace_years(observations, root)
    assert register_external(spark, "ext_observations", root).where("year = 2021").count() == 3
    spark.sql("drop table ext_observations")
