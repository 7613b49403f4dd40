"""The driver's tables read as station observations.

``lineitem`` rows are observations, ``supplier`` rows stations, ``nation`` rows countries. A station id
is an 11-character text whose first two characters are the country code, computed from the supplier
key alone: a raw observation carries its own id, so reading them is a projection without any join.
Codes run from 00 to 29 and nations from 00 to 24, so the inner joins have stations to drop. Values of
50 become NULL, so every aggregate meets NULLs.

Frames are defined once per session and folder. They are plans, not data: every query reads its tables.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfold.plans import Dimensions

CODES = 30


def _id(key: str) -> Column:
    code = F.lpad((F.col(key) % CODES).cast("string"), 2, "0")
    # Never NULL by type, so joins on it need no null filter, which would compute the text twice.
    digits = F.col(key).cast("string")
    return F.concat_ws("", code, F.lpad(digits, F.greatest(F.length(digits), F.lit(9)), F.lit("0")))


def _id_sql(key: str) -> str:
    return f"lpad(cast({key} % {CODES} as varchar), 2, '0') || lpad(cast({key} as varchar), greatest(length(cast({key} as varchar)), 9)::int, '0')"


@cache
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@cache
def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lineitem rows in the stored observation schema."""
    flag, is_open = F.col("l_returnflag"), F.col("l_linestatus") == "O"
    element = F.when(is_open, F.when(flag == "A", "PRCP").when(flag == "N", "SNOW").otherwise("TMAX")).otherwise(
        F.when(flag == "N", "TMIN").when(flag == "R", "TAVG").otherwise("TMAX")
    )
    value = F.nullif(F.col("l_quantity"), F.lit(50.0)).cast("int")
    return table(spark, sf_dir, "lineitem").select(
        _id("l_suppkey").alias("id"),
        element.alias("meteorological_element"),
        F.when(~is_open & (flag == "N"), -value).otherwise(value).alias("data_value"),
        F.col("l_returnflag").alias("flag_m"),
        F.when(F.col("l_tax") == 0, "").otherwise("X").alias("flag_q"),
        F.col("l_linestatus").alias("flag_s"),
        (F.nullif(F.col("l_linenumber"), F.lit(1)) * 100).alias("observation_time"),
        F.col("l_shipdate").cast("date").alias("date"),
    )


def with_year(df: DataFrame) -> DataFrame:
    return df.withColumn("year", F.year("date"))


@cache
def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All supplier rows in the stored station schema."""
    even = F.col("s_suppkey") % 2 == 0
    return table(spark, sf_dir, "supplier").select(
        _id("s_suppkey").alias("id"),
        (F.floor("s_acctbal") / 100).alias("latitude"),
        (F.col("s_suppkey") % 360 - 180).cast("double").alias("longitude"),
        (F.col("s_suppkey") % 3000).cast("double").alias("elevation"),
        F.when(even, "NY").otherwise("").alias("state"),
        F.col("s_name").alias("name"),
        F.when(even, "GSN").otherwise("").alias("gsn_flag"),
        F.lit("").alias("hcn_crn_flag"),
        F.lpad((F.col("s_suppkey") % 100000).cast("string"), 5, "0").alias("wmo_id"),
    )


@cache
def countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nation rows in the stored country schema."""
    return table(spark, sf_dir, "nation").select(
        F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("code"), F.col("n_name").alias("name")
    )


@cache
def dimensions(spark: SparkSession, sf_dir: str) -> Dimensions:
    return Dimensions.of(stations(spark, sf_dir), countries(spark, sf_dir))


def raw_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The observations as text under the header names of a yearly file."""
    df = observations(spark, sf_dir)
    return df.select(
        F.col("id").alias("ID"),
        F.date_format("date", "yyyyMMdd").alias("DATE"),
        F.col("meteorological_element").alias("ELEMENT"),
        F.col("data_value").cast("string").alias("DATA_VALUE"),
        F.col("flag_m").alias("M_FLAG"),
        F.col("flag_q").alias("Q_FLAG"),
        F.col("flag_s").alias("S_FLAG"),
        F.col("observation_time").cast("string").alias("OBS_TIME"),
    )


def scratch(spark: SparkSession) -> str:
    """A new folder path in the cluster's shared checkpoint folder.

    A local session that names none gets a temporary folder, removed at exit; a cluster is refused, as its executors would each
    write to their own disk.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/skyfold-{uuid.uuid4().hex}"
    master = spark.sparkContext.master
    if not master.startswith("local") or "cluster" in master:
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    folder = tempfile.mkdtemp(prefix="skyfold-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


@cache
def years_of(spark: SparkSession, sf_dir: str) -> list[int]:
    """The years that observations lie in, ascending."""
    found = table(spark, sf_dir, "lineitem").select(F.year("l_shipdate").alias("year")).distinct().collect()
    return sorted(r["year"] for r in found if r["year"] is not None)


def year_span(spark: SparkSession, sf_dir: str) -> tuple[int, int]:
    """First and last year of the observations."""
    years = years_of(spark, sf_dir)
    return years[0], years[-1]


def write_year_files(spark: SparkSession, sf_dir: str, base: str) -> list[str]:
    """Write all observations as yearly CSV input under ``base``; one path per year."""
    named = raw_text(spark, sf_dir).withColumn("file", F.concat(F.substring("DATE", 1, 4), F.lit(".csv")))
    (
        named.hint("rebalance", "file")
        .write.partitionBy("file")
        .option("header", True)
        .option("emptyValue", "")
        .csv(base)
    )
    return [f"{base}/file={year}.csv" for year in years_of(spark, sf_dir)]


def station_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stations as fixed-width text."""
    cells = [
        F.rpad("id", 11, " "),
        F.lpad(F.col("latitude").cast("string"), 8, " "),
        F.lpad(F.col("longitude").cast("string"), 9, " "),
        F.lpad(F.col("elevation").cast("string"), 6, " "),
        F.rpad("state", 2, " "),
        F.rpad("name", 30, " "),
        F.rpad("gsn_flag", 3, " "),
        F.rpad("hcn_crn_flag", 3, " "),
        F.col("wmo_id"),
    ]
    return stations(spark, sf_dir).select(F.concat_ws(" ", *cells).alias("value"))


def country_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All countries as fixed-width text."""
    return countries(spark, sf_dir).select(F.concat_ws(" ", "code", "name").alias("value"))


# The same three tables in SQL.
VALUE_SQL = "cast(nullif(l_quantity, 50) as int)"

OBSERVATIONS_SQL = f"""
    select {_id_sql('l_suppkey')} as id,
           case l_returnflag || l_linestatus
                when 'AF' then 'TMAX' when 'NF' then 'TMIN' when 'RF' then 'TAVG'
                when 'AO' then 'PRCP' when 'NO' then 'SNOW' else 'TMAX' end as meteorological_element,
           case when l_returnflag || l_linestatus = 'NF' then -{VALUE_SQL} else {VALUE_SQL} end as data_value,
           l_returnflag as flag_m,
           case when l_tax = 0 then '' else 'X' end as flag_q,
           l_linestatus as flag_s,
           nullif(l_linenumber, 1) * 100 as observation_time,
           cast(l_shipdate as date) as date
    from lineitem
"""

STATIONS_SQL = f"""
    select {_id_sql('s_suppkey')} as id,
           floor(s_acctbal) / 100 as latitude,
           cast(s_suppkey % 360 - 180 as double) as longitude,
           cast(s_suppkey % 3000 as double) as elevation,
           case when s_suppkey % 2 = 0 then 'NY' else '' end as state,
           s_name as name,
           case when s_suppkey % 2 = 0 then 'GSN' else '' end as gsn_flag,
           '' as hcn_crn_flag,
           lpad(cast(s_suppkey % 100000 as varchar), 5, '0') as wmo_id
    from supplier
"""

COUNTRIES_SQL = "select lpad(cast(n_nationkey as varchar), 2, '0') as code, n_name as name from nation"

# Common table expressions: obs, sta (staged), cou, and wide (obs with the four measures).
WITH_SQL = f"""
with obs as ({OBSERVATIONS_SQL}),
sta as (
    select *, cast(latitude as varchar) || ', ' || cast(longitude as varchar) as latitude_longitude,
           substr(id, 1, 2) as country_code
    from ({STATIONS_SQL}) s
),
cou as ({COUNTRIES_SQL}),
tenths as (
    select id, date,
           case when meteorological_element = 'TMAX' then data_value end as tx,
           case when meteorological_element = 'TMIN' then data_value end as tn,
           case when meteorological_element = 'TAVG' then data_value end as ta,
           case when meteorological_element = 'PRCP' then data_value end as pr
    from obs
)
"""


def mean_sql(measure: str) -> str:
    return f"cast(sum({measure}) as double) / (cast(10 as double) * count({measure}))"


def total_sql(measure: str) -> str:
    return f"cast(sum({measure}) as double) / 10"
