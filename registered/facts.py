"""The ten facts straight from the observations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from registered.registry import ORACLES, QUERIES, Query
from registered.tables import WITH_SQL, dimensions, mean_sql, observations, total_sql
from skyfold.plans import fact_from_observations


# --- Fixed values: what the SQL says about each fact, apart from the library: key and period ---

FACT_SQL = {
    "stations_daily": ("id", "t.date"),
    "stations_monthly": ("id", "cast(date_trunc('month', t.date) as date)"),
    "stations_yearly": ("id", "cast(date_trunc('year', t.date) as date)"),
    "countries_yearly": ("country", "cast(date_trunc('year', t.date) as date)"),
    "countries_historic": ("country", None),
}
COUNTRY_COLUMN = {"exact": "name", "rounded": "country_name"}

# --- End of fixed values ---


def _query(name: str, variant: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fact_from_observations(name, observations(spark, sf_dir), dimensions(spark, sf_dir), variant)

    return run


def _measures(name: str, variant: str) -> dict[str, str]:
    if name == "stations_daily":
        rain = total_sql("pr") if variant == "exact" else mean_sql("pr")
        return {
            "temp_max": mean_sql("tx"),
            "temp_min": mean_sql("tn"),
            "temp_avg": mean_sql("ta"),
            "precipitation": rain,
        }
    if name == "stations_monthly":
        return {
            "temp_max_abs": "cast(max(tx) as double) / 10",
            "temp_max_avg": mean_sql("tx"),
            "temp_avg_avg": mean_sql("ta"),
            "temp_min_avg": mean_sql("tn"),
            "temp_min_abs": "cast(min(tn) as double) / 10",
            "precipitation_total": total_sql("pr"),
        }
    if name == "countries_historic":
        return {
            "temp_avg": mean_sql("ta"),
            "temp_max": "cast(max(tx) as double) / 10",
            "temp_min": "cast(min(tn) as double) / 10",
        }
    return {"temp_avg": mean_sql("ta")}


def fact_sql(name: str, variant: str) -> str:
    key, period = FACT_SQL[name]
    measures = _measures(name, variant)
    if variant == "rounded":
        measures = {k: f"round({v}, 1)" for k, v in measures.items()}
    if name == "stations_monthly":
        measures["precipitation_days"] = "count(case when pr > 10 then 1 end)"
    listed = ", ".join(f"{v} as {k}" for k, v in measures.items())
    date = f"{period} as date, " if period else ""
    by_date = f", {period}" if period else ""
    if key == "country":
        return f"""{WITH_SQL}
select c.name as {COUNTRY_COLUMN[variant]}, {date}{listed}
from tenths t join sta s on t.id = s.id join cou c on s.country_code = c.code
group by c.name{by_date}"""
    return f"""{WITH_SQL}
, agg as (select t.id, {date}{listed} from tenths t group by t.id{by_date})
select a.*, s.name as station_name, s.latitude_longitude from agg a join sta s on a.id = s.id"""


def long_sql(variant: str) -> str:
    """All rows of all five facts: one row for each measure, as ``fact, key, date, measure, value``."""
    parts = []
    for name, (key, period) in FACT_SQL.items():
        column = "id" if key == "id" else COUNTRY_COLUMN[variant]
        measures = [*_measures(name, variant), *(["precipitation_days"] if name == "stations_monthly" else [])]
        for m in measures:
            parts.append(
                f"""select '{name}' as fact, {column} as key, {'date' if period else 'cast(null as date)'} as date,
                '{m}' as measure, cast({m} as double) as value from ({fact_sql(name, variant)}) f"""
            )
    return "\nunion all\n".join(parts)


for _name in FACT_SQL:
    for _variant in COUNTRY_COLUMN:
        QUERIES[f"fact_{_name}_{_variant}"] = _query(_name, _variant)
        ORACLES[f"fact_{_name}_{_variant}"] = fact_sql(_name, _variant)
