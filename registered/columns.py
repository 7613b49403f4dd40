"""Projections, joins, aggregates and unions."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registered.registry import query
from registered.tables import (
    COUNTRIES_SQL,
    OBSERVATIONS_SQL,
    STATIONS_SQL,
    WITH_SQL,
    countries,
    dimensions,
    mean_sql,
    observations,
    raw_text,
    scratch,
    stations,
    total_sql,
)
from skyfold.functions import (
    compact_date,
    coordinates,
    count_above,
    country_code,
    element_units,
    month_of,
    rounded,
    to_units,
    year_of,
)
from skyfold.operators import (
    pivot_elements,
    rename_to_stored,
    roll_up,
    sample,
    stage_countries,
    stage_stations,
)
from skyfold.schema import SAMPLE_ROWS
from skyfold.sinks import register_view
from skyfold.sources import read_table

_PIVOT_SQL = """
select {kept},
       case when meteorological_element = 'TMAX' then {v} end as temp_max,
       case when meteorological_element = 'TMIN' then {v} end as temp_min,
       case when meteorological_element = 'TAVG' then {v} end as temp_avg,
       case when meteorological_element = 'PRCP' then {v} end as precipitation
from ({obs}) o
"""


@query(
    _PIVOT_SQL.format(
        kept="* exclude (flag_m, flag_q, flag_s)", v="cast(data_value as double) / 10", obs=OBSERVATIONS_SQL
    )
)
def pivot_elements_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_elements(observations(spark, sf_dir))


@query(
    _PIVOT_SQL.format(
        kept="*", v="cast(cast(data_value as double) / 10 as decimal(38, 9))", obs=OBSERVATIONS_SQL
    )
)
def pivot_elements_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_elements(observations(spark, sf_dir), numeric=True)


@query(f"select id, date, meteorological_element, data_value from ({OBSERVATIONS_SQL}) o")
def parse_compact_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = rename_to_stored(raw_text(spark, sf_dir))
    return raw.select(
        "id",
        compact_date("date").alias("date"),
        "meteorological_element",
        F.col("data_value").cast("int").alias("data_value"),
    )


@query(
    f"""select id, strftime(date, '%Y%m%d') as date, meteorological_element,
        cast(data_value as varchar) as data_value, flag_m, flag_q, flag_s,
        cast(observation_time as varchar) as observation_time from ({OBSERVATIONS_SQL}) o"""
)
def rename_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rename_to_stored(raw_text(spark, sf_dir))


@query(f"select id, meteorological_element, data_value, observation_time, date from ({OBSERVATIONS_SQL}) o")
def drop_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observations(spark, sf_dir).drop("flag_m", "flag_q", "flag_s")


@query(
    f"""select id, cast(latitude as varchar) || ', ' || cast(longitude as varchar) as latitude_longitude
        from ({STATIONS_SQL}) s"""
)
def concat_lat_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stations(spark, sf_dir).select("id", coordinates().alias("latitude_longitude"))


@query(
    f"""select substr(id, 1, 2) as country_code, count(*) as observations, count(distinct id) as stations
        from ({OBSERVATIONS_SQL}) o group by 1"""
)
def derive_country_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Counting per station first leaves one row per station, whatever share of the rows it holds.
    per_station = observations(spark, sf_dir).groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    return per_station.groupBy(country_code().alias("country_code")).agg(
        F.sum("n").alias("observations"), F.count(F.lit(1)).alias("stations")
    )


@query(
    f"""select id, date, cast(date_trunc('month', date) as date) as month, data_value
        from ({OBSERVATIONS_SQL}) o"""
)
def truncate_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observations(spark, sf_dir).select("id", "date", month_of().alias("month"), "data_value")


@query(
    f"""select id, date, cast(date_trunc('year', date) as date) as year, data_value
        from ({OBSERVATIONS_SQL}) o"""
)
def truncate_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observations(spark, sf_dir).select("id", "date", year_of().alias("year"), "data_value")


@query(
    f"""select id, date, count(*) as readings,
        round(cast(sum(data_value) as double) / (cast(10 as double) * count(data_value)), 1) as mean_value
        from ({OBSERVATIONS_SQL}) o group by id, date"""
)
def round_measure(spark: SparkSession, sf_dir: str) -> DataFrame:
    mean = F.sum("data_value") / (F.lit(10.0) * F.count("data_value"))
    return (
        observations(spark, sf_dir)
        .groupBy("id", "date")
        .agg(F.count(F.lit(1)).alias("readings"), rounded(mean).alias("mean_value"))
    )


@query(f"{WITH_SQL} select * from sta")
def staging_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"staged_stations_{uuid.uuid4().hex}"
    register_view(stage_stations(stations(spark, sf_dir)), name)
    return read_table(spark, name)


@query(COUNTRIES_SQL)
def scan_named_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"staged_countries_{uuid.uuid4().hex}"
    register_view(stage_countries(countries(spark, sf_dir)), name)
    return read_table(spark, name)


@query(
    f"""{WITH_SQL}
    select a.*, s.name as station_name, s.latitude_longitude
    from (select id, count(*) as observations, min(date) as first_date, max(date) as last_date
          from obs group by id) a
    join sta s on a.id = s.id"""
)
def join_station_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_station = (
        observations(spark, sf_dir)
        .groupBy("id")
        .agg(
            F.count(F.lit(1)).alias("observations"),
            F.min("date").alias("first_date"),
            F.max("date").alias("last_date"),
        )
    )
    return dimensions(spark, sf_dir).stations.join(per_station)


@query(
    f"""{WITH_SQL}
    select c.name as country_name, o.meteorological_element, count(*) as observations,
           count(o.data_value) as readings
    from obs o join sta s on o.id = s.id join cou c on s.country_code = c.code
    group by c.name, o.meteorological_element"""
)
def join_station_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    # One row per station and element meets the join, so no station's rows pile up in one task.
    per_station = (
        observations(spark, sf_dir)
        .groupBy("id", "meteorological_element")
        .agg(F.count(F.lit(1)).alias("observations"), F.count("data_value").alias("readings"))
    )
    return (
        dimensions(spark, sf_dir)
        .countries.join(per_station)
        .groupBy("country_name", "meteorological_element")
        .agg(F.sum("observations").alias("observations"), F.sum("readings").alias("readings"))
    )


@query(
    f"""{WITH_SQL}
    select id, cast(date_trunc('month', date) as date) as date, {mean_sql('tx')} as temp_max,
           {mean_sql('tn')} as temp_min, {mean_sql('ta')} as temp_avg, {mean_sql('pr')} as precipitation
    from tenths group by 1, 2"""
)
def agg_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    partials = roll_up(observations(spark, sf_dir), ["id"], "month")
    means = [
        (F.col(f"{c}_sum") / (F.lit(10.0) * F.col(f"{c}_n"))).alias(c)
        for c in ("temp_max", "temp_min", "temp_avg", "precipitation")
    ]
    return partials.select("id", "date", *means)


@query(f"{WITH_SQL} select id, date, {total_sql('pr')} as precipitation from tenths group by id, date")
def agg_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    partials = roll_up(observations(spark, sf_dir), ["id"], "day")
    return partials.select("id", "date", to_units("precipitation_sum").alias("precipitation"))


@query(
    f"""{WITH_SQL}
    select id, cast(date_trunc('year', date) as date) as date, cast(max(tx) as double) / 10 as temp_max,
           cast(min(tn) as double) / 10 as temp_min from tenths group by 1, 2"""
)
def agg_min_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    partials = roll_up(observations(spark, sf_dir), ["id"], "year")
    return partials.select(
        "id", "date", to_units("temp_max_top").alias("temp_max"), to_units("temp_min_low").alias("temp_min")
    )


@query(
    f"""{WITH_SQL}
    select id, cast(date_trunc('month', date) as date) as date,
           count(case when cast(pr as double) / 10 > 1 then 1 end) as precipitation_days
    from tenths group by 1, 2"""
)
def count_if_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = observations(spark, sf_dir).select("id", month_of().alias("date"), element_units("PRCP").alias("p"))
    return df.groupBy("id", "date").agg(count_above("p", 1).alias("precipitation_days"))


@query(
    """
select least(500, count(*)) as sampled, cast(0 as bigint) as absent from lineitem
"""
)
def sample_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows a trial sample holds, and how many of them, counted with repetitions, the whole does not hold."""
    whole = pivot_elements(observations(spark, sf_dir))
    path = f"{scratch(spark)}/sample"
    sample(whole, SAMPLE_ROWS).write.parquet(path)
    sampled = spark.read.parquet(path)
    counted = sampled.select(F.lit(1).alias("held"), F.lit(0).alias("gone")).unionAll(
        sampled.exceptAll(whole).select(F.lit(0), F.lit(1))
    )
    return counted.agg(
        F.coalesce(F.sum("held"), F.lit(0)).alias("sampled"), F.coalesce(F.sum("gone"), F.lit(0)).alias("absent")
    )
