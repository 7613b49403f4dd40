"""Checks whose bounds come from what an earlier run stored.

A run counts as passed if none of its stored checks of a table failed. Run ids start with their time, so the last passed run has
the greatest id; of runs that began in the same second either may be taken.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfold.operators.quality import RESULT_SCHEMA, Check, run_suite
from skyfold.sinks.publish import Files

ROWS = "rows against the last passed run"
_STORED_SCHEMA = f"{RESULT_SCHEMA}, run_id string"


@dataclass(frozen=True)
class Earlier:
    """Stored metrics of the last passed run of a table: its rows, and the violations of each check by kind and column."""

    run_id: str
    rows: int
    violations: dict[tuple[str, str], int]


def last_passed(spark: SparkSession, results_path: str, table: str) -> Earlier | None:
    """The last passed run of ``table``; none where nothing is stored or every run failed. Reads the rows of one table and run."""
    if not Files(spark).exists(results_path):
        return None
    stored = spark.read.schema(_STORED_SCHEMA).parquet(results_path).where(F.col("table_name") == table)
    passed = stored.groupBy("run_id").agg(F.bool_and("passed").alias("sound")).where("sound")
    last = passed.agg(F.max("run_id")).first()[0]
    if last is None:
        return None
    found = stored.where(F.col("run_id") == last).collect()  # a row for each check
    rows = max((r["row_count"] for r in found if r["row_count"] is not None), default=0)
    return Earlier(last, rows, {(r["check_name"], r["column_name"]): r["violations"] for r in found})


def least_rows(earlier: Earlier | None, percent: int) -> int:
    """``percent`` of the earlier rows, rounded up; 0 without an earlier run."""
    return 0 if earlier is None else -(-earlier.rows * percent // 100)


def rows_result(spark: SparkSession, table: str, rows: int, least: int) -> DataFrame:
    """The result row of the check that a table of ``rows`` has at least ``least``; its violations are the rows that lack."""
    missing = max(0, least - rows)
    return spark.createDataFrame([(table, "row_count", ROWS, rows, missing, missing == 0)], RESULT_SCHEMA)


def run_bounded(df: DataFrame, checks: list[Check], table: str, earlier: Earlier | None, percent: int = 100) -> DataFrame:
    """``run_suite`` and the check that ``df`` has at least ``percent`` of the rows of the earlier run, in the same pass.

    Checks of the header and of uniqueness alone are refused, since they do not count all rows.
    """
    if all(c.kind in ("column_set", "unique") for c in checks):
        raise ValueError("a bound on rows needs a check that reads all of them")
    results, least = run_suite(df, checks, table), least_rows(earlier, percent)
    reading = next(c for c in checks if c.kind not in ("column_set", "unique"))
    # A second row beside that of a check that counted all rows: the table is read once.
    counted = (F.col("check_name") == reading.kind) & (F.col("column_name") == reading.target)
    missing = F.greatest(F.lit(0).cast("long"), F.lit(least).cast("long") - F.col("row_count"))
    own = F.struct(*results.columns)
    added = F.struct(
        "table_name",
        F.lit("row_count").alias("check_name"),
        F.lit(ROWS).alias("column_name"),
        "row_count",
        missing.alias("violations"),
        (missing == 0).alias("passed"),
    )
    return results.select(F.inline(F.when(counted, F.array(own, added)).otherwise(F.array(own))))
