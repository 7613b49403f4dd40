from __future__ import annotations

from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from skyfold.sinks import Layout, clustered, register_view, replace_years, write_table
from skyfold.sources import read_observations_csv
from tests.conftest import NEW_YORK, rows_of
from tests.test_sources import LINES, write_csv


def directories(path) -> list[str]:
    return sorted(p.name for p in Path(path).iterdir() if p.is_dir())


@pytest.mark.parametrize("arrange", ["cluster", "spread", "keep"])
def test_table_by_year_holds_all_rows(spark, tmp_path, observations, arrange):
    path = str(tmp_path / "t")
    write_table(observations, path, Layout(("id", "date")), arrange=arrange)
    assert directories(path) == ["year=2021", "year=2022"]
    back = spark.read.parquet(path)
    assert rows_of(back.drop("year")) == rows_of(observations)
    assert back.where(F.year("date") != F.col("year")).count() == 0


def test_table_without_years(spark, tmp_path, countries):
    path = str(tmp_path / "t")
    write_table(countries, path, Layout(("name",), by_year=False))
    assert directories(path) == []
    assert rows_of(spark.read.parquet(path)) == rows_of(countries)


def test_files_are_sorted_by_the_cluster_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(5000).select(
        F.format_string("S%05d", F.pmod(F.hash("id"), F.lit(700))).alias("id"),
        F.expr("date'2022-01-01' + cast(id % 300 as int)").alias("date"),
    )
    write_table(df, path, Layout(("id",)), partitions=4)
    files = sorted(Path(path).rglob("*.parquet"))
    assert len(files) == 4
    ranges = []
    for file in files:
        ids = [r.id for r in spark.read.parquet(str(file)).collect()]
        assert ids == sorted(ids)
        ranges.append((ids[0], ids[-1]))
    ranges.sort()
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))


def test_overwrite_replaces_all_years(spark, tmp_path, observations):
    path = str(tmp_path / "t")
    write_table(observations, path, Layout(("id",)))
    write_table(observations.where("year(date) = 2022"), path, Layout(("id",)))
    assert directories(path) == ["year=2022"]


def test_replacing_a_year_keeps_the_others_and_repeats(spark, tmp_path, observations):
    root = str(tmp_path / "observations")
    replace_years(observations, root)
    changed = observations.where("year(date) = 2022").withColumn("data_value", F.col("data_value") + 1)
    expected = rows_of(observations.where("year(date) = 2021").unionAll(changed))
    for _ in range(2):
        replace_years(changed, root)
        assert rows_of(spark.read.parquet(root).drop("year")) == expected


def test_failed_replacement_keeps_the_old_year(spark, tmp_path, observations):
    root = str(tmp_path / "observations")
    replace_years(observations, root)
    bad = write_csv(tmp_path / "2022.csv", [*LINES, "X,20220101,TMAX,bad,,,,"])
    with pytest.raises(Exception, match="(?i)malformed"):
        replace_years(read_observations_csv(spark, bad), root, arrange="keep")
    assert rows_of(spark.read.parquet(root).drop("year")) == rows_of(observations)


def test_unknown_arrangement_is_refused(tmp_path, observations):
    with pytest.raises(ValueError, match="arrange"):
        write_table(observations, str(tmp_path / "t"), Layout(("id",)), arrange="other")


def test_a_hot_key_is_spread_over_tasks(spark):
    """Identical rows, more than half of all, must not meet in one partition."""
    copies = spark.range(0, 6000, 1, 12).select(F.lit(NEW_YORK).alias("id"), F.lit(date(2022, 1, 1)).alias("date"))
    others = spark.range(0, 4000, 1, 4).select(
        F.format_string("ST%09d", "id").alias("id"), F.lit(date(2022, 1, 2)).alias("date")
    )
    df = clustered(copies.unionAll(others), "id", "date", partitions=8)
    sizes = [r.n for r in df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(sizes) == 10_000
    assert max(sizes) <= 2_500


def test_a_hot_year_is_cut_into_files(spark, tmp_path):
    """Nearly all rows in one year, of one station and one day, still make many write tasks."""
    path, setting = str(tmp_path / "t"), "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    rows = spark.range(0, 200_000, 1, 16).select(
        F.lit(NEW_YORK).alias("id"),
        F.when(F.col("id") % 100 == 0, date(2021, 1, 1)).otherwise(date(2022, 1, 1)).alias("date"),
        F.xxhash64("id").alias("data_value"),
    )
    spark.conf.set(setting, "256k")
    try:
        replace_years(rows.withColumn("year", F.year("date")), path)
    finally:
        spark.conf.unset(setting)
    assert spark.read.parquet(path).count() == 200_000
    assert len(list(Path(path, "year=2022").glob("*.parquet"))) > 4


def test_view(spark, observations):
    view = register_view(observations, "some_observations")
    assert rows_of(view) == rows_of(observations)
    assert spark.sql("select count(*) from some_observations").first()[0] == observations.count()


def test_the_grid_prunes_days_and_ids(spark, tmp_path):
    """A year in some 140 files: a day and a station each lie in a small share of them, in one table."""
    path = str(tmp_path / "t")
    rows = spark.range(0, 120_000, 1, 8).select(
        F.format_string("ST%09d", F.col("id") % 400).alias("id"),
        F.date_add(F.lit(date(2021, 1, 1)), (F.col("id") / 400).cast("int")).alias("date"),
        F.col("id").alias("data_value"),
    )
    layout = Layout(("id", "date"), stripes=12)
    write_table(rows, path, layout, arrange="grid", partitions=144)
    stored = spark.read.parquet(path)
    assert rows_of(stored.drop("year").agg(F.count("*"), F.sum("data_value"))) == [(120_000, sum(range(120_000)))]
    ranges = stored.groupBy(F.col("_metadata.file_path")).agg(
        F.min("id").alias("low"), F.max("id").alias("high"), F.min("date").alias("first"), F.max("date").alias("last")
    )
    files = ranges.collect()
    assert len(files) > 100
    for day in (date(2021, 1, 1), date(2021, 6, 15), date(2021, 10, 20)):
        assert sum(f["first"] <= day <= f["last"] for f in files) <= len(files) / 6
    for station in ("ST000000000", "ST000000123", "ST000000399"):
        assert sum(f["low"] <= station <= f["high"] for f in files) <= len(files) / 6
    plan = stored.where("year = 2021 and date = date'2021-06-15' and id = 'ST000000123'")
    text = plan._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(date), IsNotNull(id), EqualTo(date" in text and plan.count() == 1


def test_a_grid_needs_years(tmp_path, observations):
    with pytest.raises(ValueError, match="grid"):
        write_table(observations, str(tmp_path / "t"), Layout(("id",), by_year=False), arrange="grid")
