"""Data-quality checks that return counts of violations as a DataFrame.

All row checks of a suite share one pass; uniqueness adds one grouped pass for all its columns.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RESULT_SCHEMA = (
    "table_name string, check_name string, column_name string, row_count long, violations long, passed boolean"
)


class QualityError(ValueError):
    """A gate found failed checks."""


@dataclass(frozen=True)
class Check:
    kind: str
    target: str
    predicate: Column | None = None
    expected: tuple[str, ...] = ()
    exact: bool = True
    ordered: bool = False


def not_null(column: str) -> Check:
    return Check("not_null", column)


def unique(column: str) -> Check:
    """Violations are distinct non-null values that occur more than once."""
    return Check("unique", column)


def no_rows_where(name: str, predicate: Column) -> Check:
    return Check("no_rows_where", name, predicate)


def column_set(expected: Sequence[str], exact: bool = True, ordered: bool = False) -> Check:
    """Columns equal the expected set. ``exact=False`` allows extra ones; ``ordered`` fixes the order."""
    return Check("column_set", "*", expected=tuple(expected), exact=exact, ordered=ordered)


def header_violations(columns: list[str], check: Check) -> int:
    """Missing, extra or misplaced columns; 0 for a check that is not about the header."""
    if check.kind != "column_set":
        return 0
    missing = [c for c in check.expected if c not in columns]
    extra = [c for c in columns if c not in check.expected] if check.exact else []
    wrong = len(missing) + len(extra)
    if check.ordered and not wrong:
        wrong = sum(a != b for a, b in zip(columns, check.expected))
    return wrong


def _rows(one_row: DataFrame, table: str, results: list[tuple[Check, Column, Column, Column]]) -> DataFrame:
    """Turn a one-row aggregate into one result row per check."""
    structs = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(check.kind).alias("check_name"),
            F.lit(check.target).alias("column_name"),
            rows.cast("long").alias("row_count"),
            violations.cast("long").alias("violations"),
            passed.alias("passed"),
        )
        for check, rows, violations, passed in results
    ]
    return one_row.select(F.inline(F.array(*structs)))


def _row_checks(df: DataFrame, table: str, checks: list[Check]) -> DataFrame:
    aggregates, results = [F.count(F.lit(1)).alias("n")], []
    for i, check in enumerate(checks):
        n, name = F.col("n"), f"v{i}"
        if check.kind == "column_set":
            violations = F.lit(header_violations(df.columns, check))
        elif check.kind == "not_null" and check.target not in df.columns:
            results.append((check, n, n, F.lit(False)))
            continue
        else:
            bad = F.isnull(check.target) if check.kind == "not_null" else check.predicate
            aggregates.append(F.count_if(bad).alias(name))
            violations = F.col(name)
        results.append((check, n, violations, violations == 0))
    if all(c.kind == "column_set" for c in checks):
        # The header is known without a row, so none is read and none is counted.
        found = [(table, c.kind, c.target, None, v, v == 0) for c in checks for v in [header_violations(df.columns, c)]]
        return df.sparkSession.createDataFrame(found, RESULT_SCHEMA)
    return _rows(df.agg(*aggregates), table, results)


def _unique_checks(df: DataFrame, table: str, checks: list[Check]) -> DataFrame:
    # (column, value) pairs are counted before the shuffle, so a value held by most rows stays cheap.
    pairs = F.array(
        *[
            F.struct(F.lit(i).alias("i"), F.col(c.target).cast("string").alias("value"))
            for i, c in enumerate(checks)
        ]
    )
    counted = (
        df.select(F.inline(pairs)).where(F.col("value").isNotNull()).groupBy("i", "value").agg(
            F.count(F.lit(1)).alias("n")
        )
    )
    aggregates, results = [], []
    for i, check in enumerate(checks):
        mine = F.col("i") == i
        aggregates.append(F.coalesce(F.sum(F.when(mine, F.col("n"))), F.lit(0)).alias(f"n{i}"))
        aggregates.append(F.count_if(mine & (F.col("n") > 1)).alias(f"v{i}"))
        results.append((check, F.col(f"n{i}"), F.col(f"v{i}"), F.col(f"v{i}") == 0))
    return _rows(counted.agg(*aggregates), table, results)


def run_suite(df: DataFrame, checks: Sequence[Check], table: str = "") -> DataFrame:
    """One row per check: ``table_name, check_name, column_name, row_count, violations, passed``.

    With checks of the header only no row is read, and ``row_count`` is NULL.
    """
    grouped = [c for c in checks if c.kind == "unique"]
    plain = [c for c in checks if c.kind != "unique"]
    parts = []
    if plain:
        parts.append(_row_checks(df, table, plain))
    if grouped:
        parts.append(_unique_checks(df, table, grouped))
    return reduce(DataFrame.unionAll, parts)


def passed_results(spark: SparkSession, checks: Sequence[Check], table: str, rows: int) -> DataFrame:
    """The result rows of checks that are known to hold on ``rows`` rows."""
    return spark.createDataFrame([(table, c.kind, c.target, rows, 0, True) for c in checks], RESULT_SCHEMA)


def gate(results: DataFrame) -> None:
    """Raise when a check failed. Collects one row per failed check."""
    failed = results.where(~F.col("passed")).collect()
    if failed:
        listed = ", ".join(f"{r.check_name}({r.column_name}): {r.violations}" for r in failed)
        raise QualityError(f"{len(failed)} check(s) failed: {listed}")
