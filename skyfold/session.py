"""Session settings for large inputs."""

from __future__ import annotations

from pyspark.sql import SparkSession

_MIB = 1024 * 1024
_BYTES_PER_SHUFFLE_PARTITION = 512 * _MIB
_FEWEST, _MOST = 200, 20_000

SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Merge shuffle partitions to the advised size rather than to as many as there are cores.
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * _MIB),
    "spark.sql.files.maxPartitionBytes": str(256 * _MIB),
    "spark.sql.parquet.compression.codec": "zstd",
}


def shuffle_partitions(input_bytes: int, fewest: int = _FEWEST) -> int:
    """Shuffle partitions for an input of this size; AQE merges those that turn out small.

    Bounded, since every map task keeps an entry per partition. Jobs over long histories go in batches of years.
    """
    return min(_MOST, max(fewest, -(-input_bytes // _BYTES_PER_SHUFFLE_PARTITION)))


def open_session(app: str, input_bytes: int = 0, settings: dict[str, str] | None = None) -> SparkSession:
    """A session with ``SETTINGS``; the master and resources come from the submit command."""
    chosen = {"spark.sql.shuffle.partitions": str(shuffle_partitions(input_bytes)), **SETTINGS}
    builder = SparkSession.builder.appName(app)
    for key, value in {**chosen, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
