from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfold.schema import BLANK_TEXT_COLUMNS, DATE_FORMAT, HEADER_SCHEMA, OBSERVATION_COLUMNS, STORED_NAME
from skyfold.sinks.publish import Files


def _csv_paths(paths: str | Iterable[str]) -> list[str]:
    found = [paths] if isinstance(paths, str) else list(paths)
    if not found:
        raise ValueError("no input path given")
    for p in found:
        if not p.rstrip("/").endswith(".csv"):
            raise ValueError(f"only .csv input is accepted, got {p!r}")
    return found


def year_of_path(path: str) -> int | None:
    """The year that a yearly file is named after."""
    found = re.search(r"(\d{4})\.csv/?$", path)
    return int(found.group(1)) if found else None


def file_year() -> Column:
    """The year a row's file is named after (``…/2022.csv`` or ``…/2022.csv/part-…``), else NULL."""
    year = F.regexp_extract(F.col("_metadata.file_path"), r"(\d{4})\.csv(?:/|$)", 1)
    return F.nullif(year, F.lit("")).cast("int")


def read_raw_csv(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    """Every column as text under its header name, for checks that precede typing.

    The header comes from the first file; check further files one at a time.
    """
    return spark.read.option("header", True).csv(_csv_paths(paths))


def read_observations_csv(
    spark: SparkSession, paths: str | Iterable[str], with_file_year: bool = False
) -> DataFrame:
    """Yearly files as typed observations.

    Every part's header must hold the expected names in order, or the read of that part raises. A
    malformed number or date raises when the row is read in full, so at a write of all columns; a ``count()`` or a narrow ``select``
    may not parse the bad cell. Blank text stays '', a blank number is NULL.
    """
    df = (
        spark.read.schema(HEADER_SCHEMA)
        .option("header", True)
        .option("enforceSchema", False)
        .option("dateFormat", DATE_FORMAT)
        .option("mode", "FAILFAST")
        .csv(_csv_paths(paths))
        .withColumnsRenamed(STORED_NAME)
    )
    columns = [
        F.coalesce(c, F.lit("")).alias(c) if c in BLANK_TEXT_COLUMNS else F.col(c)
        for c in OBSERVATION_COLUMNS
    ]
    if with_file_year:
        columns.append(file_year().alias("year"))
    return df.select(*columns)


def read_years(spark: SparkSession, root: str, first: int, last: int) -> DataFrame:
    """Observations of the inclusive year range; the other years' directories are not read."""
    return spark.read.parquet(root).where(F.col("year").between(first, last))


def stored_years(spark: SparkSession, root: str) -> list[int]:
    """Years that have a directory, from the listing of directories alone."""
    return sorted(Files(spark).years(root))


def read_year_files(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """Union of per-year parquet inputs with duplicates kept.

    One scan over all paths: the plan stays the same size however many years there are.
    """
    return spark.read.parquet(*paths)
