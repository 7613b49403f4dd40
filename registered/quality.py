"""Checks, reported as violation counts so that a pass is a non-empty result too."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from registered.facts import FACT_SQL, fact_sql
from registered.registry import query
from registered.tables import (
    COUNTRIES_SQL,
    OBSERVATIONS_SQL,
    WITH_SQL,
    countries,
    dimensions,
    observations,
    raw_text,
    scratch,
    stations,
)
from skyfold.operators import column_set, not_null, roll_up, run_suite, stage_stations, unique
from skyfold.plans import (
    FACTS,
    check_facts,
    check_sources,
    fact_checks,
    fact_from_observations,
    fact_from_partials,
    last_passed,
    monthly_invariants,
    raw_checks,
    run_bounded,
    store_results,
)
from skyfold.plans.suites import MODEL_CHECKS
from skyfold.schema import RAW_HEADER
from skyfold.sources import read_raw_csv

_OBS = f"({OBSERVATIONS_SQL})"
_STA = f"({WITH_SQL} select * from sta)"
_COU = f"({COUNTRIES_SQL})"
_MONTHLY = f"({fact_sql('stations_monthly', 'exact')})"

# --- Fixed values: the declared checks, written out for the SQL apart from the library ---

_INVARIANTS_SQL = {
    "mean maximum above absolute maximum": "temp_max_avg > temp_max_abs",
    "mean minimum below absolute minimum": "temp_min_avg < temp_min_abs",
    "too many rain days": "precipitation_days > 31",
}
_DECLARED_SQL = {
    "observations": [("not_null", "date"), ("not_null", "id")],
    "stations": [("not_null", "id"), ("unique", "id"), ("not_null", "country_code")],
    "countries": [("not_null", "code"), ("unique", "code"), ("not_null", "name"), ("unique", "name")],
    "stations_daily": [("not_null", "id"), ("not_null", "date")],
    "stations_monthly": [
        ("not_null", "id"),
        ("not_null", "date"),
        ("no_rows_where", "mean maximum above absolute maximum"),
        ("no_rows_where", "mean minimum below absolute minimum"),
        ("no_rows_where", "too many rain days"),
    ],
    "stations_yearly": [("not_null", "id"), ("not_null", "date")],
    "countries_yearly": [("not_null", "name"), ("not_null", "date")],
    "countries_historic": [("not_null", "name"), ("unique", "name")],
}
_HEADER_SQL = ["ID", "DATE", "ELEMENT", "DATA_VALUE", "M_FLAG", "Q_FLAG", "S_FLAG", "OBS_TIME"]
_MONTHLY_COLUMNS = [
    "id", "date", "temp_max_abs", "temp_max_avg", "temp_avg_avg", "temp_min_avg", "temp_min_abs",
    "precipitation_total", "precipitation_days", "station_name", "latitude_longitude",
]

# --- End of fixed values ---


def _check_sql(table: str, source: str, kind: str, column: str) -> str:
    head = f"select '{table}' as table_name, '{kind}' as check_name, '{column}' as column_name"
    if kind == "unique":
        return f"""{head}, coalesce(cast(sum(n) as bigint), 0) as row_count,
            count(case when n > 1 then 1 end) as violations,
            count(case when n > 1 then 1 end) = 0 as passed
            from (select count(*) as n from {source} q where {column} is not null group by {column}) g"""
    bad = _INVARIANTS_SQL[column] if kind == "no_rows_where" else f"{column} is null"
    return f"""{head}, count(*) as row_count, count(case when {bad} then 1 end) as violations,
        count(case when {bad} then 1 end) = 0 as passed from {source} q"""


def _suite_sql(suites: list[tuple[str, str, list[tuple[str, str]]]]) -> str:
    return "\nunion all\n".join(_check_sql(t, source, *c) for t, source, checks in suites for c in checks)


def _header_check_sql(table: str, columns: str, rows: str = "cast(null as bigint)") -> str:
    """Missing and extra columns, or with neither the misplaced ones, by the catalogue's description of ``columns``."""
    wanted = ", ".join(f"'{c}'" for c in _HEADER_SQL)
    return f"""
select '{table}' as table_name, 'column_set' as check_name, '*' as column_name,
       {rows} as row_count,
       cast(case when missing + extra > 0 then missing + extra else misplaced end as bigint) as violations,
       missing + extra + misplaced = 0 as passed
from (
    select count(*) filter (where found is null) as missing, count(*) filter (where wanted is null) as extra,
           count(*) filter (where at_found <> at_wanted) as misplaced
    from (select column_name as found, row_number() over () as at_found
          from (describe select {columns} from (select 1 as one) o)) f
    full join (select unnest([{wanted}]) as wanted, unnest(range(1, {len(_HEADER_SQL) + 1})) as at_wanted) w
    on found = wanted
) c
"""


def _year_file_sql(table: str, columns: str, year: int) -> str:
    """The header check of a year's file, and that its values are not NULL."""
    of_year = f"from {_OBS} o where year(date) = {year}"
    return f"""{_header_check_sql(table, columns, f"(select count(*) {of_year})")}
union all
select '{table}', 'not_null', 'DATA_VALUE', count(*), count(*) - count(data_value), count(*) = count(data_value) {of_year}"""


_COLUMNS_SQL = ", ".join(f"one as {c}" for c in _HEADER_SQL)
_HEADERS_SQL = {
    "as expected": _COLUMNS_SQL,
    "one column less": _COLUMNS_SQL.replace(", one as S_FLAG", ""),
    "one column more": _COLUMNS_SQL + ", one as EXTRA",
    "two columns swapped": _COLUMNS_SQL.replace("one as M_FLAG, one as Q_FLAG", "one as Q_FLAG, one as M_FLAG"),
}

# Some stations' means and extremes change places, and rain rows are counted over two years instead of a month.
_FLAWED = f"""(
select m.id, m.date,
       case when k then temp_max_avg else temp_max_abs end as temp_max_abs,
       case when k then temp_max_abs else temp_max_avg end as temp_max_avg,
       case when k then temp_min_avg else temp_min_abs end as temp_min_abs,
       case when k then temp_min_abs else temp_min_avg end as temp_min_avg,
       cast(sum(precipitation_days) over (partition by m.id, year(m.date) // 2) as bigint) as precipitation_days
from (select *, cast(right(id, 1) as int) % 2 = 0 as k from {_MONTHLY} f) m)"""
# Every second station occurs twice, and every third one, once more, without its id.
_FLAWED_STATIONS = """(
with s as {sta}
select id, country_code from s
union all select id, country_code from s where cast(right(id, 1) as int) % 2 = 0
union all select null, country_code from s where cast(right(id, 1) as int) % 3 = 0)""".format(sta=_STA)


def _monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_from_observations("stations_monthly", observations(spark, sf_dir), dimensions(spark, sf_dir))


def _flawed_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    monthly = _monthly(spark, sf_dir)
    k = F.substring("id", -1, 1).cast("int") % 2 == 0
    two_years = Window.partitionBy("id", F.floor(F.year("date") / 2))

    def swapped(a: str, b: str) -> list:
        return [F.when(k, F.col(b)).otherwise(F.col(a)).alias(a), F.when(k, F.col(a)).otherwise(F.col(b)).alias(b)]

    return monthly.select(
        "id",
        "date",
        *swapped("temp_max_abs", "temp_max_avg"),
        *swapped("temp_min_abs", "temp_min_avg"),
        F.sum("precipitation_days").over(two_years).alias("precipitation_days"),
    )


def _flawed_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = stage_stations(stations(spark, sf_dir)).select("id", "country_code")
    digit = F.substring("id", -1, 1).cast("int")
    nameless = staged.where(digit % 3 == 0).select(F.lit(None).cast("string").alias("id"), "country_code")
    return staged.unionAll(staged.where(digit % 2 == 0)).unionAll(nameless)


#: The year whose file gets each header.
_HEADER_YEARS = {label: 1996 + k for k, label in enumerate(_HEADERS_SQL)}


def _with_headers(raw: DataFrame) -> dict[str, DataFrame]:
    names = raw.columns
    i, j = names.index("M_FLAG"), names.index("Q_FLAG")
    other = [names[j] if k == i else names[i] if k == j else c for k, c in enumerate(names)]
    return {
        "as expected": raw,
        "one column less": raw.drop("S_FLAG"),
        "one column more": raw.withColumn("EXTRA", F.lit("1")),
        "two columns swapped": raw.select(other),
    }


@query("\nunion all\n".join(_year_file_sql(t, c, _HEADER_YEARS[t]) for t, c in _HEADERS_SQL.items()))
def dq_column_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly files whose headers are right, lack a column, have one more, and have two swapped."""
    base, found = scratch(spark), []
    for label, rows in _with_headers(raw_text(spark, sf_dir)).items():
        path = f"{base}/{_HEADER_YEARS[label]}.csv"
        of_year = rows.where(F.substring("DATE", 1, 4) == str(_HEADER_YEARS[label]))
        of_year.write.option("header", True).option("emptyValue", "").csv(path)
        checks = [column_set(RAW_HEADER, ordered=True), not_null("DATA_VALUE")]
        found.append(run_suite(read_raw_csv(spark, path), checks, label))
    return reduce(DataFrame.unionAll, found)


@query(_suite_sql([("stations_monthly", _MONTHLY, [("not_null", c) for c in _MONTHLY_COLUMNS])]))
def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    monthly = _monthly(spark, sf_dir)
    return run_suite(monthly, [not_null(c) for c in monthly.columns], "stations_monthly")


_UNIQUE_OBS = [unique("id"), unique("date"), unique("observation_time")]
_UNIQUE_STA = [unique("id"), unique("name"), unique("country_code")]


@query(
    _suite_sql(
        [
            ("observations", _OBS, [("unique", "id"), ("unique", "date"), ("unique", "observation_time")]),
            ("stations", _STA, [("unique", "id"), ("unique", "name"), ("unique", "country_code")]),
        ]
    )
)
def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = stage_stations(stations(spark, sf_dir))
    return run_suite(observations(spark, sf_dir), _UNIQUE_OBS, "observations").unionAll(
        run_suite(staged, _UNIQUE_STA, "stations")
    )


def _invariant(name: str, target: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        checks = [c for c in monthly_invariants() if c.target == target]
        return run_suite(_monthly(spark, sf_dir), checks, "stations_monthly").unionAll(
            run_suite(_flawed_monthly(spark, sf_dir), checks, "flawed")
        )

    run.__name__ = name
    check = [("no_rows_where", target)]
    query(_suite_sql([("stations_monthly", _MONTHLY, check), ("flawed", _FLAWED, check)]))(run)


_invariant("dq_max_invariant", "mean maximum above absolute maximum")
_invariant("dq_min_invariant", "mean minimum below absolute minimum")
_invariant("dq_precip_days", "too many rain days")


@query(
    _suite_sql(
        [
            ("observations", _OBS, _DECLARED_SQL["observations"]),
            ("stations", _STA, _DECLARED_SQL["stations"]),
            ("countries", _COU, _DECLARED_SQL["countries"]),
            *[(n, f"({fact_sql(n, 'exact')})", _DECLARED_SQL[n]) for n in FACT_SQL],
            ("flawed stations", _FLAWED_STATIONS, _DECLARED_SQL["stations"]),
            ("flawed months", _FLAWED, _DECLARED_SQL["stations_monthly"]),
        ]
    )
    + "\nunion all\n"
    + _header_check_sql("one column less", _HEADERS_SQL["one column less"])
)
def dq_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs, names = observations(spark, sf_dir), dimensions(spark, sf_dir)
    # Written once, so that the five facts read daily partials instead of all observations.
    path = f"{scratch(spark)}/partials"
    roll_up(obs, ["id"], "day").write.parquet(path)
    partials = spark.read.parquet(path)
    facts = {n: fact_from_partials(n, partials, names, at_grain=n == "stations_daily") for n in FACTS}
    flawed = [
        run_suite(_flawed_stations(spark, sf_dir), MODEL_CHECKS["stations"], "flawed stations"),
        run_suite(_flawed_monthly(spark, sf_dir), fact_checks("stations_monthly"), "flawed months"),
        run_suite(_with_headers(raw_text(spark, sf_dir))["one column less"], [column_set(RAW_HEADER)], "one column less"),
    ]
    sound = check_sources(obs, stations(spark, sf_dir), countries(spark, sf_dir)).unionAll(check_facts(facts))
    return reduce(DataFrame.unionAll, [sound, *flawed])


_RAW = f"(select id as ID, date as DATE from {_OBS} o)"


@query(
    f"""
select 'observations' as table_name, 'column_set' as check_name, '*' as column_name, count(*) as row_count,
       cast(0 as bigint) as violations, true as passed from {_OBS} q
union all
"""
    + _suite_sql([("observations", _RAW, [("not_null", "ID"), ("not_null", "DATE")])])
)
def dq_stored_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = run_suite(raw_text(spark, sf_dir), raw_checks(), "observations")
    return store_results(results, f"{scratch(spark)}/results", "run")


_LEAST_PERCENT = 90
#: Runs one after the other, each over the observations up to a year; the third lacks rows, so the fourth is held against the second.
_RUNS = [("1", 1996), ("2", 9999), ("3", 1994), ("4", 1997)]


def _runs_sql() -> str:
    counts = ", ".join(
        f"(select count(*) from obs where year(date) <= {y}) as n{i}, (select count(*) - count(date) from obs where year(date) <= {y}) as d{i}"
        for i, y in _RUNS
    )

    def least(rows: str) -> str:
        return f"({rows} * {_LEAST_PERCENT} + 99) // 100"

    # Each run's bound: 0 for the first, else from the run before or, if that failed, from the one before it.
    rows = []
    bounds = {"1": "0", "2": "l2", "3": "l3", "4": "l4"}
    for i, _ in _RUNS:
        rows.append(f"select '{i}' as run, 'not_null' as check_name, 'date' as column_name, n{i} as row_count, d{i} as violations, d{i} = 0 as passed from bounds")
        short = f"greatest({bounds[i]} - n{i}, 0)"
        rows.append(f"select '{i}', 'row_count', 'rows against the last passed run', n{i}, {short}, {short} = 0 from bounds")
    return (
        f"{WITH_SQL}, counts as (select {counts}), first as (select *, {least('n1')} as l2 from counts), "
        f"second as (select *, case when n2 >= l2 then n2 else n1 end as p2 from first), "
        f"third as (select *, {least('p2')} as l3 from second), "
        f"fourth as (select *, case when n3 >= l3 then n3 else p2 end as p3 from third), "
        f"bounds as (select *, {least('p3')} as l4 from fourth)\n" + "\nunion all\n".join(rows)
    )


@query(_runs_sql())
def dq_bounds_from_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four runs over ever other shares of the observations, each held against the last that passed."""
    path, obs = f"{scratch(spark)}/results", observations(spark, sf_dir)
    runs = []
    for run_id, last_year in _RUNS:
        earlier = last_passed(spark, path, "observations")
        found = run_bounded(obs.where(F.year("date") <= last_year), [not_null("date")], "observations", earlier, _LEAST_PERCENT)
        runs.append(store_results(found, path, run_id).drop("table_name").withColumn("run", F.lit(run_id)))
    return reduce(DataFrame.unionByName, runs)
