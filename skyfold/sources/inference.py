"""Types of text columns, found from all their values: one aggregate over every part of a file."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from skyfold.sources.observations import read_raw_csv

#: Narrowest first: how a value of the type is written.
PATTERNS = {
    "bigint": r"^-?(0|[1-9][0-9]*)$",
    "double": r"^-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][+-]?[0-9]+)?$",
    "boolean": r"^(true|false)$",
    "date": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$",
}


def _fits(value: Column, type_name: str) -> Column:
    return value.rlike(PATTERNS[type_name]) & value.try_cast(type_name).isNotNull()


def inferred_types(df: DataFrame) -> dict[str, str]:
    """For each text column the narrowest of ``PATTERNS`` that all its values fit, else ``string``.

    Blank values fit every type. Digits after a leading zero are a code, so text; a column without values is text too.
    """
    names = [f.name for f in df.schema if isinstance(f.dataType, StringType)]
    if not names:
        return {}
    aggregates = []
    for i, name in enumerate(names):
        value = F.nullif(F.trim(F.col(f"`{name}`")), F.lit(""))
        aggregates.append(F.count(value).alias(f"n{i}"))
        aggregates += [F.count_if(value.isNotNull() & ~_fits(value, t)).alias(f"{t}{i}") for t in PATTERNS]
    found = df.agg(*aggregates).first()
    return {
        name: next((t for t in PATTERNS if found[f"n{i}"] and not found[f"{t}{i}"]), "string") for i, name in enumerate(names)
    }


def read_inferred_csv(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    """CSV files of one header with the types that their values have in all parts. Blank text is '', any other blank value NULL."""
    raw = read_raw_csv(spark, paths)
    columns = []
    for name, type_name in inferred_types(raw).items():
        text = F.col(f"`{name}`")
        blank_aside = F.coalesce(text, F.lit("")) if type_name == "string" else F.nullif(F.trim(text), F.lit("")).cast(type_name)
        columns.append(blank_aside.alias(name))
    return raw.select(*columns)
