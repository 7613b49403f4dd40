"""What the operators share: words, tables, shared scratch folders and tables written in them."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and carriage return.
WORD_BREAK = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: Column) -> Column:
    """Array of the words of a text; null and blank texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_BREAK), lambda w: w != F.lit(""))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, also where lambdas inside use it again and again."""
    return F.transform(F.array(value), body)[0]


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def in_written_order(frame: DataFrame, name: str) -> DataFrame:
    """``frame`` with a column ``name``: the place of each row, from 0, in the order in which its table was written.

    Spark reads files in any order, so the place comes from the number in a file's name and the row's index in the file. A frame
    that is not read from files has its partitions in order; there places have gaps.
    """
    file, number = F.col("_metadata.file_name"), F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1)
    try:
        placed = frame.withColumns({"__file": file, "__number": F.try_to_number(number, F.lit("9" * 18)), name: F.col("_metadata.row_index")})
    except AnalysisException:
        return frame.withColumn(name, F.monotonically_increasing_id())
    starts = (
        placed.groupBy("__file", "__number")
        .agg(F.count(F.lit(1)).alias("__n"))
        .withColumn("__before", F.sum("__n").over(Window.orderBy("__number", "__file")) - F.col("__n"))
        .select("__file", "__before")
    )
    return (
        placed.join(F.broadcast(starts), "__file").withColumn(name, F.col(name) + F.col("__before")).drop("__file", "__number", "__before")
    )


def ship_code(spark: SparkSession) -> None:
    """Give the executors this package, once for each application."""
    context = spark.sparkContext
    if getattr(context, "_skyfold_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="skyfold-code-")) / "skyfold.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._skyfold_shipped = True


class Scratch:
    """A folder of its own under ``spark.checkpoint.dir``, for tables that cut lineage; also gives executors the code.

    Without that setting a local session uses a temporary folder; a cluster refuses, as its executors share none.
    """

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark = spark
        ship_code(spark)
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared:
            if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
                raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
            shared = tempfile.mkdtemp(prefix="skyfold-llm-")
        self.root = f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def keep(self, frame: DataFrame, name: str, by: str | None = None) -> DataFrame:
        """Write ``frame`` once and go on from the written table, in folders by the values of column ``by``.

        The shuffle files of the write go with its end: the table replaces them, whatever executor is lost later.
        """
        cleanup = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
        before = self.spark.conf.get(cleanup)
        self.spark.conf.set(cleanup, "true")
        try:
            (frame.write.partitionBy(by) if by else frame.write).parquet(self.path(name))
        finally:
            self.spark.conf.set(cleanup, before)
        return self.spark.read.schema(frame.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        """Remove tables that nothing reads any more."""
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
