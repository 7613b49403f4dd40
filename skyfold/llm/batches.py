"""Slices of Arrow batches that hold a bounded number of text bytes, so that a task's memory does not follow the length of a batch."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text bytes after which a slice ends; a longer text is a slice of its own.
SLICE_BYTES = 4 << 20


def text_slices(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends, begun = np.cumsum(sizes, dtype=np.int64), 0
        while begun < batch.num_rows:
            before = int(ends[begun - 1]) if begun else 0
            end = max(begun + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(begun, end - begun)
            begun = end


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The texts' UTF-8 bytes; null is empty."""
    return [t or b"" for t in batch.column(column).cast(pa.binary()).to_pylist()]
