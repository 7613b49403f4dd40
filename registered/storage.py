"""Sources, sinks and jobs: write the whole tables, read them back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registered.facts import fact_sql, long_sql
from registered.registry import query
from registered.tables import (
    COUNTRIES_SQL,
    OBSERVATIONS_SQL,
    STATIONS_SQL,
    countries,
    country_lines,
    dimensions,
    observations,
    scratch,
    station_lines,
    stations,
    with_year,
    write_year_files,
    year_span,
    years_of,
)
from skyfold.operators import union_years as union_frames
from skyfold.operators.staging import STAGED_STATION_COLUMNS
from skyfold.plans import (
    backfill_years,
    build_facts,
    catch_up,
    fact_from_observations,
    fact_models,
    ingest_dimensions,
    ingest_year,
    read_facts,
)
from skyfold.plans.facts import FACTS
from skyfold.schema import OBSERVATION_COLUMNS
from skyfold.sinks import create_view, replace_years, write_dimension, write_table
from skyfold.sources import (
    read_countries_txt,
    read_dimension,
    read_inferred_csv,
    read_observations_csv,
    read_stations_txt,
    read_year_files,
    read_years,
    register_external,
)

CHANGED_YEAR = 1998

_CORRECTED_SQL = f"""
select id, meteorological_element,
       case when year(date) = {CHANGED_YEAR} then data_value + 1 else data_value end as data_value,
       flag_m, flag_q, flag_s, observation_time, date
from ({OBSERVATIONS_SQL}) o
"""


def _stored(spark: SparkSession, sf_dir: str) -> str:
    """The observations as the year-partitioned dataset."""
    root = f"{scratch(spark)}/observations"
    replace_years(with_year(observations(spark, sf_dir)), root)
    return root


def _outdated(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All observations with one year's values off by one, and that year as it should be."""
    obs = with_year(observations(spark, sf_dir))
    changed = F.col("year") == CHANGED_YEAR
    off = F.when(changed, F.col("data_value") - 1).otherwise(F.col("data_value"))
    return obs.withColumn("data_value", off), obs.where(changed)


@query(OBSERVATIONS_SQL)
def scan_observations_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_observations_csv(spark, write_year_files(spark, sf_dir, f"{scratch(spark)}/csv"))


@query(STATIONS_SQL)
def scan_fixed_width(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch(spark)}/stations.txt"
    station_lines(spark, sf_dir).write.text(path)
    return read_stations_txt(spark, path)


@query(COUNTRIES_SQL)
def scan_fixed_width_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch(spark)}/countries.txt"
    country_lines(spark, sf_dir).write.text(path)
    return read_countries_txt(spark, path)


@query(STATIONS_SQL)
def scan_inferred_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stations as CSV in parts, their types found from the values."""
    path = f"{scratch(spark)}/stations.csv"
    stations(spark, sf_dir).repartition(3, "id").write.option("header", True).option("emptyValue", "").csv(path)
    return read_inferred_csv(spark, path)


@query(
    "select *, cast(latitude as varchar) || ', ' || cast(longitude as varchar) as latitude_longitude, substr(id, 1, 2) as country_code"
    f" from ({STATIONS_SQL}) s"
)
def lasting_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A view of the catalogue over stored stations, read by another session of the same catalogue."""
    path = f"{scratch(spark)}/stations"
    write_dimension(stations(spark, sf_dir), path)
    name = f"staged_{uuid.uuid4().hex}"
    create_view(spark, name, path, STAGED_STATION_COLUMNS)
    found = spark.newSession().table(name)
    spark.sql(f"DROP VIEW {name}")  # the entry; the frame reads the files
    return found


@query(f"select * from ({OBSERVATIONS_SQL}) o where year(date) between 1996 and 1999")
def scan_year_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_years(spark, _stored(spark, sf_dir), 1996, 1999).select(OBSERVATION_COLUMNS)


@query(STATIONS_SQL)
def scan_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch(spark)}/stations"
    write_dimension(stations(spark, sf_dir), path)
    return read_dimension(spark, path)


@query(OBSERVATIONS_SQL)
def union_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _stored(spark, sf_dir)
    paths = [f"{root}/year={year}" for year in years_of(spark, sf_dir)]
    return read_year_files(spark, paths).select(OBSERVATION_COLUMNS)


@query(f"select * from ({OBSERVATIONS_SQL}) o union all select * from ({_CORRECTED_SQL}) c")
def union_frames_by_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = observations(spark, sf_dir)
    later = F.when(F.year("date") == CHANGED_YEAR, F.col("data_value") + 1).otherwise(F.col("data_value"))
    return union_frames([obs, obs.withColumn("data_value", later)])


@query(OBSERVATIONS_SQL)
def roundtrip_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch(spark)}/observations"
    observations(spark, sf_dir).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@query(COUNTRIES_SQL)
def roundtrip_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch(spark)}/countries"
    write_dimension(countries(spark, sf_dir), path)
    write_dimension(countries(spark, sf_dir), path)
    return read_dimension(spark, path)


@query(OBSERVATIONS_SQL)
def replace_year_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = f"{scratch(spark)}/observations"
    outdated, correct = _outdated(spark, sf_dir)
    replace_years(outdated, root)
    replace_years(correct, root)
    return spark.read.parquet(root).select(OBSERVATION_COLUMNS)


@query(OBSERVATIONS_SQL)
def external_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch(spark)}/observations"
    observations(spark, sf_dir).write.parquet(path)
    name = f"external_{uuid.uuid4().hex}"
    found = register_external(spark, name, path)
    spark.sql(f"DROP TABLE {name}")  # the entry; the files stay, and the frame reads them
    return found


@query(fact_sql("stations_daily", "exact"))
def write_fact_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, fact = f"{scratch(spark)}/stations_daily", FACTS["stations_daily"]
    df = fact_from_observations(fact.name, observations(spark, sf_dir), dimensions(spark, sf_dir))
    write_table(df, path, fact.layout("exact"))
    return spark.read.parquet(path).drop("year")


@query(fact_sql("countries_yearly", "rounded"))
def write_fact_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch(spark)}/countries_yearly"
    obs, names = observations(spark, sf_dir), dimensions(spark, sf_dir)
    df = fact_from_observations("countries_yearly", obs, names, "rounded")
    write_table(df, path, FACTS["countries_yearly"].layout("rounded"), arrange="spread")
    return spark.read.parquet(path)


@query(OBSERVATIONS_SQL)
def job_backfill_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch(spark)
    backfill_years(spark, write_year_files(spark, sf_dir, f"{base}/csv"), f"{base}/observations")
    return spark.read.parquet(f"{base}/observations").select(OBSERVATION_COLUMNS)


@query(OBSERVATIONS_SQL)
def job_catch_up_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An outdated table, of which the ledger knows nothing, is taken up by two runs: one over three years, one over all."""
    base = scratch(spark)
    root, ledger = f"{base}/observations", f"{base}/ledger"
    files = write_year_files(spark, sf_dir, f"{base}/csv")
    replace_years(_outdated(spark, sf_dir)[0], root)
    catch_up(spark, files[:3], root, ledger)
    catch_up(spark, files, root, ledger)
    return spark.read.parquet(root).select(OBSERVATION_COLUMNS)


@query(
    f"select * from ({OBSERVATIONS_SQL}) o where date between date '1997-03-10' and date '1997-03-12'"
    f" union all select * from ({OBSERVATIONS_SQL}) o where id = (select min(id) from ({OBSERVATIONS_SQL}) x)"
)
def scan_days_and_station(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A filter on days and one on a station, each over a table laid out for both."""
    root = f"{scratch(spark)}/observations"
    replace_years(with_year(observations(spark, sf_dir)), root, arrange="grid")
    stored = spark.read.parquet(root)
    days = stored.where("year = 1997 and date between date'1997-03-10' and date'1997-03-12'")
    station = stored.join(stored.agg(F.min("id").alias("id")), "id", "left_semi")
    return days.unionAll(station).select(OBSERVATION_COLUMNS)


@query(OBSERVATIONS_SQL)
def job_ingest_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored year that is off by one is replaced from its file, twice."""
    base = scratch(spark)
    root, results = f"{base}/observations", f"{base}/results"
    files = write_year_files(spark, sf_dir, f"{base}/csv")
    replace_years(_outdated(spark, sf_dir)[0], root)
    changed = next(f for f in files if f"{CHANGED_YEAR}.csv" in f)
    for _ in range(2):
        ingest_year(spark, changed, root, CHANGED_YEAR, results)
    return spark.read.parquet(root).select(OBSERVATION_COLUMNS)


@query(
    f"""
select 'stations' as table_name, id as key, name, latitude, longitude, elevation, state, gsn_flag, hcn_crn_flag, wmo_id
from ({STATIONS_SQL}) s
union all
select 'countries', code, name, null, null, null, null, null, null, null from ({COUNTRIES_SQL}) c
"""
)
def job_ingest_dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch(spark)
    station_lines(spark, sf_dir).write.text(f"{base}/stations.txt")
    country_lines(spark, sf_dir).write.text(f"{base}/countries.txt")
    ingest_dimensions(
        spark, f"{base}/stations.txt", f"{base}/countries.txt", f"{base}/stations", f"{base}/countries"
    )
    made = read_dimension(spark, f"{base}/stations").withColumnRenamed("id", "key").withColumn("table_name", F.lit("stations"))
    listed = read_dimension(spark, f"{base}/countries").withColumnRenamed("code", "key")
    return made.unionByName(listed.withColumn("table_name", F.lit("countries")), allowMissingColumns=True)


def _long(spark: SparkSession, out: str, variant: str) -> DataFrame:
    """All rows of all five built facts: one row for each measure."""
    return _measures(read_facts(spark, out, variant))


def _measures(facts: dict[str, DataFrame]) -> DataFrame:
    parts = []
    for name, fact in facts.items():
        labels = ("id", "name", "country_name", "date", "station_name", "latitude_longitude")
        key = next(c for c in ("id", "name", "country_name") if c in fact.columns)
        date = F.col("date") if "date" in fact.columns else F.lit(None).cast("date")
        measures = F.array(
            *[
                F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("value"))
                for c in fact.columns
                if c not in labels
            ]
        )
        parts.append(
            fact.select(F.lit(name).alias("fact"), F.col(key).alias("key"), date.alias("date"), F.inline(measures))
        )
    return union_frames(parts)


def _built(spark: SparkSession, sf_dir: str, variant: str) -> str:
    out = f"{scratch(spark)}/facts"
    build_facts(
        spark,
        _stored(spark, sf_dir),
        stations(spark, sf_dir),
        countries(spark, sf_dir),
        out,
        *year_span(spark, sf_dir),
        variant=variant,
    )
    return out


@query(long_sql("rounded"))
def job_build_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _long(spark, _built(spark, sf_dir, "rounded"), "rounded")


def _built_on_outdated(spark: SparkSession, sf_dir: str, root: str, out: str) -> None:
    """Facts of an outdated year, and then that year corrected: what a refresh meets."""
    outdated, correct = _outdated(spark, sf_dir)
    replace_years(outdated, root)
    build_facts(spark, root, stations(spark, sf_dir), countries(spark, sf_dir), out, *year_span(spark, sf_dir))
    replace_years(correct, root)


@query(long_sql("exact"))
def job_refresh_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts built on an outdated year, then refreshed for that year only."""
    base = scratch(spark)
    root, out = f"{base}/observations", f"{base}/facts"
    _built_on_outdated(spark, sf_dir, root, out)
    names = stations(spark, sf_dir), countries(spark, sf_dir)
    build_facts(spark, root, *names, out, *year_span(spark, sf_dir), changed_years=[CHANGED_YEAR])
    return _long(spark, out, "exact")


@query(long_sql("exact"))
def models_by_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared models built without the changed year, then again from the changed source on."""
    models, base = fact_models(), f"{scratch(spark)}/models"
    sources = {"observations": observations(spark, sf_dir), "stations": stations(spark, sf_dir), "countries": countries(spark, sf_dir)}
    models.build(spark, base, sources | {"observations": sources["observations"].where(F.year("date") != CHANGED_YEAR)})
    built = models.build(spark, base, sources, changed=["observations"])
    return _measures({name: built.read(name).drop("year") for name in FACTS})
