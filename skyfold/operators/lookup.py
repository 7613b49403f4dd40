from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_LIMIT_BYTES = 128 * 1024 * 1024
_FIXED_WIDTH = 8
_ROW_OVERHEAD = 16


def measured_bytes(df: DataFrame) -> int:
    """Bytes of ``df`` when held as rows, from one aggregate over its text lengths and row count."""
    text = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    per_row = _ROW_OVERHEAD + _FIXED_WIDTH * len(df.columns)
    width = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in text), F.lit(per_row))
    return df.agg(F.sum(width.cast("long"))).first()[0] or 0


@dataclass(frozen=True)
class Lookup:
    """A dimension keyed by ``key``, with its size measured so that it is broadcast only when small.

    Beyond the limit the join is a plain one, left to sort-merge and AQE. Join aggregated facts, not
    raw rows, in that case: a station then has at most one row per period, so no join key is hot.
    """

    frame: DataFrame
    key: str
    fits_broadcast: bool

    @classmethod
    def of(cls, frame: DataFrame, key: str, limit_bytes: int = BROADCAST_LIMIT_BYTES) -> Lookup:
        return cls(frame, key, measured_bytes(frame) <= limit_bytes)

    def join(self, facts: DataFrame) -> DataFrame:
        """Inner join; rows without a match drop out."""
        side = F.broadcast(self.frame) if self.fits_broadcast else self.frame
        return facts.join(side, self.key, "inner")
