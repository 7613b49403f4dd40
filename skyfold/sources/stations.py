from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyfold.schema import COUNTRY_OFFSETS, COUNTRY_SCHEMA, STATION_OFFSETS, STATION_SCHEMA

_WHITESPACE = " \t\r\n\f\x0b"


def read_fixed_width(
    spark: SparkSession, path: str, offsets: Mapping[str, tuple[int, int]], schema: T.StructType
) -> DataFrame:
    """Slice each line at ``offsets``, trim, and cast to ``schema``.

    Blank text is '', a blank number is NULL, a malformed number raises (ANSI cast).
    """

    def cell(name: str, start: int, end: int):
        text = F.trim(F.substring("value", start + 1, end - start), F.lit(_WHITESPACE))
        dtype = schema[name].dataType
        if not isinstance(dtype, T.StringType):
            text = F.nullif(text, F.lit("")).cast(dtype)
        return text.alias(name)

    return spark.read.text(path).select(*[cell(n, a, b) for n, (a, b) in offsets.items()])


def read_stations_txt(spark: SparkSession, path: str) -> DataFrame:
    return read_fixed_width(spark, path, STATION_OFFSETS, STATION_SCHEMA)


def read_countries_txt(spark: SparkSession, path: str) -> DataFrame:
    return read_fixed_width(spark, path, COUNTRY_OFFSETS, COUNTRY_SCHEMA)
