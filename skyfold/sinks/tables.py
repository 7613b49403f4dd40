from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfold.sinks.publish import Files, aside, swap

_ORIGIN = "_origin_partition"
_STRIPE = "_stripe"


@dataclass(frozen=True)
class Layout:
    """How a table lies on disk: one directory per year of ``date`` or none, rows ordered by ``cluster``."""

    cluster: tuple[str, ...]
    by_year: bool = True
    #: Stretches of days that ``arrange="grid"`` cuts a year into.
    stripes: int = 24

    @property
    def order(self) -> tuple[str, ...]:
        return ("year", *self.cluster) if self.by_year else self.cluster


def clustered(df: DataFrame, *columns: str, partitions: int | None = None) -> DataFrame:
    """Range-partition and sort by ``columns`` so that each file covers a narrow key range.

    Rows that tie on every column are cut apart by the input partition they came from. A key that
    holds a third of all rows is then spread over many tasks, and a re-run task cuts the same way.
    Without ``partitions`` AQE merges small ranges, up to ``spark.sql.shuffle.partitions`` of them.
    """
    count = [] if partitions is None else [partitions]
    return (
        df.withColumn(_ORIGIN, F.spark_partition_id())
        .repartitionByRange(*count, *columns, _ORIGIN)
        .sortWithinPartitions(*columns)
        .drop(_ORIGIN)
    )


def _with_year(df: DataFrame) -> DataFrame:
    return df if "year" in df.columns else df.withColumn("year", F.year("date"))


def write_table(
    df: DataFrame,
    path: str,
    layout: Layout,
    only_years: bool = False,
    arrange: str = "cluster",
    partitions: int | None = None,
) -> None:
    """Overwrite the table at ``path``, with rows in layout order inside each file.

    ``only_years`` replaces just the year directories that ``df`` holds and keeps the others.

    ``arrange`` says how rows reach their files:

    ``cluster``  range-partitioned on the layout's order, so each file covers a narrow range. Computes
                 ``df`` twice from its last shuffle on, as ranges are found by sampling.
    ``grid``     like ``cluster``, but inside a year by stripes of days first: a file covers a stripe and a range of the cluster
                 columns, so that statistics of files prune filters on days and filters on ids alike. With n files a year a
                 day opens one in ``stripes``, an id ``stripes`` in n.
    ``spread``   gathered by year in one pass; AQE cuts years that are large and merges small ones.
    ``keep``     left in their partitions, without a shuffle: for a scan of yearly files, or of a table
                 with this layout, where a partition holds about one year already.
    """
    frame = _with_year(df) if layout.by_year else df
    if arrange == "cluster":
        frame = clustered(frame, *layout.order, partitions=partitions)
    elif arrange == "grid" and layout.by_year:
        day = F.floor((F.dayofyear("date") - 1) * layout.stripes / 366)
        frame = clustered(frame.withColumn(_STRIPE, day), "year", _STRIPE, *layout.cluster, partitions=partitions).drop(_STRIPE)
    elif arrange == "spread":
        frame = frame.hint("rebalance", *(["year"] if layout.by_year else [])).sortWithinPartitions(*layout.order)
    elif arrange == "keep":
        frame = frame.sortWithinPartitions(*layout.order)
    else:
        raise ValueError(f"arrange must be cluster, spread or keep, or grid for a table by year, got {arrange!r}")
    writer = frame.write.mode("overwrite")
    if layout.by_year:
        writer = writer.partitionBy("year").option(
            "partitionOverwriteMode", "dynamic" if only_years else "static"
        )
    writer.parquet(path)


@dataclass(frozen=True)
class BucketedTable:
    """A table by year whose files each hold one of ``buckets`` shares of the keys, so groups of a key merge where they are read."""

    spark: SparkSession
    name: str
    path: str
    layout: Layout
    buckets: int

    @property
    def key(self) -> str:
        return self.layout.cluster[0]

    def append(self, df: DataFrame, in_buckets: bool = False) -> None:
        """Add rows. ``in_buckets``: they come from a table bucketed alike, through nothing that moves them, so none is shuffled."""
        frame = _with_year(df)
        if not in_buckets:
            frame = frame.repartition(self.buckets, self.key)
        writer = frame.write.mode("append").format("parquet").option("path", self.path).partitionBy("year")
        writer.bucketBy(self.buckets, self.key).sortBy(*self.layout.cluster).saveAsTable(self.name)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)


@contextmanager
def bucketed_table(spark: SparkSession, path: str, layout: Layout, buckets: int) -> Iterator[BucketedTable]:
    """A new table at ``path``, bucketed and sorted by the layout's cluster columns.

    The catalogue knows it under a name of its own while the block runs, since Spark keeps the buckets of a table there and not in
    its files; afterwards the entry is gone and the files remain, a plain table by year.
    """
    name = f"skyfold_{uuid.uuid4().hex}"
    try:
        yield BucketedTable(spark, name, path, layout, buckets)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


OBSERVATION_LAYOUT = Layout(cluster=("id", "date"))


def replace_years(observations: DataFrame, root: str, arrange: str = "spread") -> None:
    """Replace the stored observations of exactly the years present in ``observations``.

    The new files are staged and swapped in when the job commits, so a failed run keeps the old year
    and a repeated one leaves the same state.
    """
    write_table(observations, root, OBSERVATION_LAYOUT, only_years=True, arrange=arrange)


def write_dimension(df: DataFrame, path: str) -> None:
    """Replace an unpartitioned dimension table, once the new one is complete."""
    write_dimensions({path: df})


def write_dimensions(frames: dict[str, DataFrame]) -> None:
    """Replace several tables by path; none is touched before all are written."""
    spark = next(iter(frames.values())).sparkSession
    new = {path: aside(path) for path in frames}
    try:
        for path, df in frames.items():
            df.write.parquet(new[path])
        swap(spark, [(new[path], path) for path in frames])
    finally:
        for path in new.values():
            Files(spark).delete(path)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Name a lazy frame so that SQL and ``read_table`` can use it."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def create_view(spark: SparkSession, name: str, path: str, computed: dict[str, str] | None = None) -> DataFrame:
    """Put a view over the parquet table at ``path`` into the catalogue: all its columns and ``computed`` ones, as SQL by name.

    It outlives the session, as far as the catalogue does, and reads the table as it is when it is queried.
    """
    columns = "".join(f", {expression} AS `{column}`" for column, expression in (computed or {}).items())
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT *{columns} FROM parquet.`{path}`")
    return spark.table(name)
