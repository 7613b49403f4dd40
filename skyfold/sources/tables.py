from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A table or view by name."""
    return spark.table(name)


def read_dimension(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def register_external(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Replace table ``name`` with one over the parquet files at ``path``; the files stay in place.

    A table whose data the catalogue manages is refused, as dropping it would delete the data.
    """
    if spark.catalog.tableExists(name):
        if spark.catalog.getTable(name).tableType != "EXTERNAL":
            raise ValueError(f"{name} is not an external table")
        spark.sql(f"DROP TABLE {name}")
    spark.catalog.createTable(name, path=path, source="parquet")
    if any(c.isPartition for c in spark.catalog.listColumns(name)):
        spark.catalog.recoverPartitions(name)
    return spark.table(name)
