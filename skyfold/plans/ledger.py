"""Catch-up: a ledger of the yearly files that were ingested, so that a run takes up only what is missing or has changed.

The ledger is an append-only table with one small file for each entry. A year is ingested by itself and entered once it is published:
a run that dies resumes at the year it was at, and a year ingested but not entered is ingested again, which leaves the same state.
Facts are entered too, so that a refresh covers every year that changed since the last one, whichever run took it up.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfold.operators.quality import QualityError
from skyfold.plans.jobs import ingest_year, new_run_id
from skyfold.sinks.publish import Files
from skyfold.sources.observations import year_of_path

LEDGER_SCHEMA = (
    "sequence long, year int, state string, path string, bytes long, modified long, lines long, digest string, run_id string"
)
#: A file was ingested; a file was touched, but its lines are the same; facts were built over the year.
INGESTED, SAME, BUILT = "ingested", "same", "built"


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    if not Files(spark).exists(ledger):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).parquet(ledger)


def content_digest(spark: SparkSession, path: str) -> tuple[int, str]:
    """How many lines a file has, or a folder of parts, and the sum of their hashes: the same for the same lines in any order."""
    hashes = F.sum(F.xxhash64("value").cast("decimal(38,0)"))
    row = spark.read.text(path).agg(F.count(F.lit(1)).alias("lines"), hashes.alias("digest")).first()
    return row["lines"], str(row["digest"] or 0)


def _enter(spark: SparkSession, ledger: str, entries: list[tuple]) -> None:
    last = read_ledger(spark, ledger).agg(F.max("sequence")).first()[0] or 0
    rows = [(last + 1 + k, *e) for k, e in enumerate(entries)]
    spark.createDataFrame(rows, LEDGER_SCHEMA).coalesce(1).write.mode("append").parquet(ledger)


def catch_up(
    spark: SparkSession,
    csv_paths: Iterable[str],
    root: str,
    ledger: str,
    results_path: str | None = None,
    arrange: str = "grid",
) -> list[int]:
    """Ingest the yearly files that the ledger lacks, or holds with other lines, one year after the other; returns those years.

    A file of the same length and time as entered is not read. One of another time is, and ingested only if its lines differ. The
    first file that fails its checks stops the run; the years before it stay entered, and the next run begins there.
    """
    by_year: dict[int, str] = {}
    for path in csv_paths:
        year = year_of_path(path)
        if year is None or year in by_year:
            raise QualityError(f"{path} is not named after a year" if year is None else f"more than one file for {year}")
        by_year[year] = path
    files, run_id, taken = Files(spark), new_run_id(), []
    entered = read_ledger(spark, ledger).where(F.col("state").isin(INGESTED, SAME) & F.col("year").isin(list(by_year)))
    latest = {r["year"]: r["e"] for r in entered.groupBy("year").agg(F.max(F.struct("sequence", *entered.columns[3:])).alias("e")).collect()}
    for year, path in sorted(by_year.items()):
        size, modified = files.length_and_time(path)
        known = latest.get(year)
        if known and (known["path"], known["bytes"], known["modified"]) == (path, size, modified):
            continue
        lines, digest = content_digest(spark, path)
        same = known is not None and (known["lines"], known["digest"]) == (lines, digest)
        if not same:
            ingest_year(spark, path, root, year, results_path, run_id, arrange)
            taken.append(year)
        _enter(spark, ledger, [(year, SAME if same else INGESTED, path, size, modified, lines, digest, run_id)])
    return taken


def pending_years(spark: SparkSession, ledger: str) -> list[int]:
    """Years ingested since facts were last built over them: the ``changed_years`` of the next build."""
    at = {s: F.max(F.when(F.col("state") == s, F.col("sequence"))).alias(s) for s in (INGESTED, BUILT)}
    found = read_ledger(spark, ledger).groupBy("year").agg(*at.values())
    waiting = found.where(F.col(INGESTED).isNotNull() & (F.col(BUILT).isNull() | (F.col(BUILT) < F.col(INGESTED))))
    return sorted(r["year"] for r in waiting.collect())


def mark_built(spark: SparkSession, ledger: str, years: Iterable[int]) -> None:
    """Enter that facts were built over ``years``."""
    run_id = new_run_id()
    if entries := [(y, BUILT, None, None, None, None, None, run_id) for y in sorted(set(years))]:
        _enter(spark, ledger, entries)
