"""Jobs: ingest a year, backfill years, ingest dimensions, build the facts.

Every step ends in a table on shared storage and starts from one, so a lost executor costs its tasks. What a job makes is
computed aside, checked, and only then moved into place: a lost job leaves the published tables as they were.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import ExitStack, contextmanager
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from skyfold.operators.quality import (
    RESULT_SCHEMA,
    Check,
    QualityError,
    gate,
    header_violations,
    passed_results,
    run_suite,
)
from skyfold.operators.rollup import merge_partials, roll_up
from skyfold.operators.staging import sample, stage_stations
from skyfold.plans.bounds import last_passed, least_rows, rows_result
from skyfold.plans.facts import FACTS, VARIANTS, Dimensions, fact_from_partials
from skyfold.plans.suites import MODEL_CHECKS, declared_checks, fact_checks, raw_checks
from skyfold.schema import RUN_ID_FORMAT
from skyfold.session import shuffle_partitions
from skyfold.sinks.publish import Files, aside, swap, year_moves
from skyfold.sinks.tables import OBSERVATION_LAYOUT, Layout, bucketed_table, write_dimensions, write_table
from skyfold.sinks.versions import Snapshot, Staged, current, publish
from skyfold.sources.observations import file_year, read_observations_csv, read_raw_csv, read_years, year_of_path
from skyfold.sources.stations import read_countries_txt, read_stations_txt

PARTIALS_LAYOUT = Layout(cluster=("id", "date"))
#: Raw bytes of a batch of years: bounds map tasks times shuffle partitions.
BATCH_BYTES = 2 << 40
#: Raw bytes whose partials make a bucket. Few buckets, since every year has a file for each.
BUCKET_BYTES = 2 << 30


def new_run_id() -> str:
    """A second and a suffix of its own, so that runs of one second stay apart."""
    return f"{datetime.now(timezone.utc).strftime(RUN_ID_FORMAT)}-{uuid.uuid4().hex[:8]}"


def store_results(results: DataFrame, path: str, run_id: str) -> DataFrame:
    """Append check results under ``run_id`` and return the stored rows.

    The result set has one row per check, so a single file holds it.
    """
    results.withColumn("run_id", F.lit(run_id)).coalesce(1).write.mode("append").parquet(path)
    return results.sparkSession.read.parquet(path).where(F.col("run_id") == run_id).drop("run_id")


def _failure(spark: SparkSession, label: str, check: str, column: str, rows: int, violations: int) -> DataFrame:
    return spark.createDataFrame([(label, check, column, rows, violations, False)], RESULT_SCHEMA)


def _load(
    raw: DataFrame,
    typed: DataFrame,
    checks: list[Check],
    label: str,
    root: str,
    years: list[int],
    results_path: str | None,
    run_id: str | None,
    arrange: str = "keep",
    least_percent: int | None = None,
) -> None:
    """Replace ``years`` by ``typed`` if all ``checks`` hold on ``raw``, its text form, and every year has rows.

    Good input is read once: the write aside raises on the first row that breaks a check. Only then is the text read again,
    to count the violations. Results are stored before anything is raised or published.
    """
    spark = raw.sparkSession
    run_id = run_id or new_run_id()

    def stored(found: DataFrame) -> DataFrame:
        return found if results_path is None else store_results(found, results_path, run_id)

    sound = F.col("id").isNotNull() & (F.year("date") == F.col("year"))
    guarded_id = F.when(sound, F.col("id")).otherwise(F.raise_error(F.lit("a row breaks the checks")))
    seen = Observation()
    guarded = typed.withColumn("id", guarded_id).observe(seen, F.count(F.lit(1)).alias("rows"))
    new = aside(root)
    try:
        try:
            if any(header_violations(raw.columns, c) for c in checks):
                raise QualityError("unexpected header")
            write_table(guarded, new, OBSERVATION_LAYOUT, only_years=True, arrange=arrange)
        except Exception as cause:
            found = run_suite(raw, checks, label)
            if "CSV header does not conform" in str(cause):
                # The text read above knows the first part's header; some other part has a different one.
                found = found.where("check_name <> 'column_set'").unionAll(_failure(spark, label, "column_set", "*", 0, 1))
            gate(stored(found))
            raise  # the checks hold, so the cause is elsewhere: a malformed cell, say
        rows, held = seen.get["rows"], Files(spark).years(new)
        if empty := [y for y in years if y not in held]:
            found = passed_results(spark, checks, label, rows)
            gate(stored(found.unionAll(_failure(spark, label, "row_count", f"no rows: {empty}", rows, len(empty)))))
        found = passed_results(spark, checks, label, rows)
        if least_percent is not None and results_path is not None:
            least = least_rows(last_passed(spark, results_path, label), least_percent)
            found = found.unionAll(rows_result(spark, label, rows, least))
        gate(stored(found))
        swap(spark, year_moves(spark, new, root, years))
    finally:
        Files(spark).delete(new)


def ingest_year(
    spark: SparkSession,
    csv_path: str,
    root: str,
    year: int,
    results_path: str | None = None,
    run_id: str | None = None,
    arrange: str = "keep",
    least_percent: int | None = None,
) -> None:
    """Check one yearly file, type it, and replace that year. Repeating it leaves the same state.

    With ``least_percent`` a file that has less than that share of the rows which the year's last passed run stored is refused.

    A scan split of the file holds one year only, so rows are sorted where they are read: no shuffle. For a year that will
    be read by day or id for long, ``arrange="grid"`` makes each file cover a stripe of days and a range of ids, at the cost of one.
    """
    raw = read_raw_csv(spark, csv_path)
    typed = read_observations_csv(spark, csv_path).withColumn("year", F.lit(year))
    checks = raw_checks(F.lit(year) if "DATE" in raw.columns else None)
    if least_percent is not None and results_path is None:
        raise ValueError("a bound from stored results needs results_path")
    _load(raw, typed, checks, str(year), root, [year], results_path, run_id, arrange, least_percent)


def backfill_years(
    spark: SparkSession,
    csv_paths: Iterable[str],
    root: str,
    results_path: str | None = None,
    run_id: str | None = None,
    arrange: str = "grid",
) -> None:
    """Ingest many yearly files, named after their year, with one read and one write.

    Past years are laid out for filters on days and on ids: a file covers a stripe of a year's days and a range of ids. Spark compares the header of every part of every
    file during that read. All years are replaced, or none.
    """
    paths = list(csv_paths)
    raw = read_raw_csv(spark, paths)
    years = [year_of_path(p) for p in paths]
    if twice := sorted({y for y in years if y is not None and years.count(y) > 1}):
        raise QualityError(f"more than one file for {twice}")
    typed = read_observations_csv(spark, paths, with_file_year=True)
    checks = raw_checks(file_year() if "DATE" in raw.columns else None)
    _load(raw, typed, checks, "all years", root, [y for y in years if y is not None], results_path, run_id, arrange)


def ingest_dimensions(
    spark: SparkSession, stations_txt: str, countries_txt: str, stations_path: str, countries_path: str
) -> None:
    """Fixed-width station and country files to typed tables; both are replaced, or none."""
    write_dimensions(
        {stations_path: read_stations_txt(spark, stations_txt), countries_path: read_countries_txt(spark, countries_txt)}
    )


def variant_path(out: str, variant: str) -> str:
    return f"{out}/{variant}"


def built_tables(spark: SparkSession, out: str, variant: str = "exact") -> Snapshot:
    """The published version of a variant: the facts and the partials ``partials/daily`` and ``partials/monthly``."""
    return current(spark, variant_path(out, variant))


def read_facts(spark: SparkSession, out: str, variant: str = "exact") -> dict[str, DataFrame]:
    """All five facts of one version, without their directory column."""
    tables = built_tables(spark, out, variant)
    return {name: tables.read(name).drop("year") for name in FACTS}


def read_fact(spark: SparkSession, out: str, name: str, variant: str = "exact") -> DataFrame:
    """A built fact without its directory column. To read several that belong together, use ``read_facts``."""
    return built_tables(spark, out, variant).read(name).drop("year")


@dataclass(frozen=True)
class Batch:
    years: list[int]
    partitions: int


def plan_batches(bytes_per_year: dict[int, int], least_partitions: int = 1, batch_bytes: int = BATCH_BYTES) -> list[Batch]:
    """Consecutive years of at most ``batch_bytes`` together, or one larger year, and the shuffle partitions that they need.

    No group spans two years, so batches change no result.
    """
    batches: list[tuple[list[int], int]] = []
    for year in sorted(bytes_per_year):
        if batches and batches[-1][1] + bytes_per_year[year] <= batch_bytes:
            batches[-1] = ([*batches[-1][0], year], batches[-1][1] + bytes_per_year[year])
        else:
            batches.append(([year], bytes_per_year[year]))
    return [Batch(years, max(least_partitions, shuffle_partitions(size, fewest=1))) for years, size in batches]


def plan_buckets(bytes_per_year: dict[int, int], batches: list[Batch], fewest: int = 1) -> int:
    """Buckets of the partials: enough for the largest batch, the same for all, so that a station's share of any year is found alike."""
    largest = max(sum(bytes_per_year[y] for y in b.years) for b in batches)
    return max(fewest, -(-largest // BUCKET_BYTES))


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def build_facts(
    spark: SparkSession,
    root: str,
    stations: DataFrame,
    countries: DataFrame,
    out: str,
    first_year: int,
    last_year: int,
    variant: str = "exact",
    changed_years: Iterable[int] | None = None,
    sample_rows: int | None = None,
    results_path: str | None = None,
    batch_bytes: int = BATCH_BYTES,
) -> None:
    """Build all five facts of the inclusive year range under ``out/variant`` and publish them in one step.

    A reader sees either all tables as they were or all as they are now; see ``skyfold.sinks.versions``. Of two builds that run side
    by side the second to end is refused.

    Dimensions are checked first: a doubled station would double its rows. Raw rows are read once, into daily partials, in
    batches of years by their stored bytes; monthly partials come from those, and every fact from one of the two. Both are bucketed
    by station, so months and years are merged, and stations joined, where the partials lie. Everything is written aside, the declared checks of the facts must hold, and then the next version is published.

    With ``changed_years``, after a full build, only those years are read; tables by year get those years replaced, or removed
    where nothing is left of them, and the small country tables are redone from the monthly partials of all years. Build fully
    when the dimensions have changed.

    ``sample_rows`` limits the raw rows of a trial build, which needs an ``out`` of its own.
    """
    if variant not in VARIANTS:
        raise ValueError(f"variant must be one of {VARIANTS}, got {variant!r}")
    files, base, trial = Files(spark), variant_path(out, variant), f"{out}/_trial"
    is_trial, is_full = files.exists(trial), any(files.exists(variant_path(out, v)) for v in VARIANTS)
    if (sample_rows is not None) != is_trial and (is_trial or is_full):
        raise ValueError(f"{out} holds a {'trial' if is_trial else 'full'} build; choose another folder")
    if sample_rows is not None:
        if changed_years is not None:
            raise ValueError("a trial build is a full one")
        files.make(trial)
    stored = {y: n for y, n in files.years(root).items() if first_year <= y <= last_year}
    partial = changed_years is not None
    years = sorted(set(changed_years)) if partial else sorted(stored)
    if not years or not set(years) <= set(stored):
        raise ValueError(f"asked for {years or 'all'}, but {first_year}..{last_year} holds {sorted(stored)}")
    found = check_dimensions(stations, countries)
    # Checks end in a few counts: one job without adaptive stages each, instead of a job for every stage.
    with _setting(spark, "spark.sql.adaptive.enabled", "false"):
        gate(found if results_path is None else store_results(found, results_path, new_run_id()))
    dimensions = Dimensions.of(stations, countries)
    _ = dimensions.stations, dimensions.countries  # sized here, before the writes run side by side
    new, began = aside(base), current(spark, base)

    def of_years(df: DataFrame, wanted: list[int]) -> DataFrame:
        return df.where(F.col("year").isin(wanted))

    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sizes = {y: stored[y] for y in years}
    batches = plan_batches(sizes, least, batch_bytes if sample_rows is None else sum(sizes.values()))
    daily_path, monthly_path = f"{new}/partials/daily", f"{new}/partials/monthly"
    buckets = plan_buckets(sizes, batches, min(least, spark.sparkContext.defaultParallelism))
    tables_of_build = ExitStack()
    try:
        days = tables_of_build.enter_context(bucketed_table(spark, daily_path, PARTIALS_LAYOUT, buckets))
        months = tables_of_build.enter_context(bucketed_table(spark, monthly_path, PARTIALS_LAYOUT, buckets))
        for batch in batches:
            with _setting(spark, "spark.sql.shuffle.partitions", str(batch.partitions)):
                raw = sample(of_years(read_years(spark, root, first_year, last_year), batch.years), sample_rows)
                days.append(roll_up(raw, ["id"], "day"))
                months.append(merge_partials(of_years(days.read(), batch.years), ["id"], "month"), in_buckets=True)

        daily, monthly = days.read(), months.read()
        all_months = monthly
        if partial:
            old = began.read("partials/monthly")
            unchanged = F.col("year").between(first_year, last_year) & ~F.col("year").isin(years)
            all_months = monthly.unionByName(old.where(unchanged))

        # fact -> (partials it reads, whether they are at its grain already)
        inputs = {
            "stations_daily": (daily, True),
            "stations_monthly": (monthly, True),
            "stations_yearly": (monthly, False),
            "countries_yearly": (all_months, False),
            "countries_historic": (all_months, False),
        }

        written: dict[str, StructType] = {}

        def write(name: str) -> None:
            partials, at_grain = inputs[name]
            fact = fact_from_partials(name, partials, dimensions, variant, at_grain)
            written[name] = fact.schema
            # Without a shuffle since the scan, rows still lie as in the partials: by year, in this order. Only files
            # depend on this, never rows.
            unmoved = at_grain and dimensions.stations.fits_broadcast
            write_table(fact, f"{new}/{name}", FACTS[name].layout(variant), arrange="keep" if unmoved else "spread")

        with _setting(spark, "spark.sql.shuffle.partitions", str(max(b.partitions for b in batches))):
            # The small facts run beside the daily one instead of queueing behind its last tasks.
            with ThreadPoolExecutor(max_workers=len(inputs)) as pool:
                list(pool.map(write, inputs))
            # Under the schema that was written: a refresh can leave a fact without a row, so without a file.
            built = {name: spark.read.schema(schema).parquet(f"{new}/{name}") for name, schema in written.items()}
            parts = [run_suite(f, declared_checks(n, variant), n) for n, f in built.items()]
            with _setting(spark, "spark.sql.adaptive.enabled", "false"):
                gate(reduce(DataFrame.unionAll, parts))

        def staged(name: str, schema: StructType, by_year: bool) -> Staged:
            return Staged(f"{new}/{name}", schema, by_year, years if partial else None)

        tables = {n: staged(n, frame.schema, True) for n, frame in (("partials/daily", daily), ("partials/monthly", monthly))}
        for name, schema in written.items():
            by_year = FACTS[name].layout(variant).by_year
            with_year = schema if not by_year or "year" in schema.names else StructType([*schema, StructField("year", IntegerType())])
            tables[name] = staged(name, with_year, by_year)
        publish(began, tables)
    finally:
        tables_of_build.close()
        files.delete(new)


def check_dimensions(stations: DataFrame, countries: DataFrame) -> DataFrame:
    """Declared checks of both lookups: keys are unique and not NULL."""
    return run_suite(stage_stations(stations), MODEL_CHECKS["stations"], "stations").unionAll(
        run_suite(countries, MODEL_CHECKS["countries"], "countries")
    )


def check_sources(observations: DataFrame, stations: DataFrame, countries: DataFrame) -> DataFrame:
    """Declared checks of the three inputs of the facts."""
    return run_suite(observations, MODEL_CHECKS["observations"], "observations").unionAll(
        check_dimensions(stations, countries)
    )


def check_facts(facts: dict[str, DataFrame], variant: str = "exact") -> DataFrame:
    """Declared checks and invariants of fact frames."""
    return reduce(
        DataFrame.unionAll, [run_suite(f, fact_checks(n, variant), n) for n, f in facts.items()]
    )


def check_tables(spark: SparkSession, out: str, variant: str = "exact") -> DataFrame:
    """``check_facts`` over the built tables."""
    return check_facts(read_facts(spark, out, variant), variant)
