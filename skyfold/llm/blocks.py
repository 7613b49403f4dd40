"""Blocks of documents, and binary columns of arrays.

Operators that look at every byte or word of a corpus work on blocks of documents of bounded size: one row with the texts
compressed, written once. What blocks have to agree on travels in arrays, one row for each block and hash bucket, so a thing that
very many documents share costs each block one entry.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Text bytes after which a block ends; a longer document is a block of its own.
BLOCK_BYTES = 5 << 20

NO_ID = np.iinfo(np.int64).max


def runs(ordered: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Runs of equal values in a sorted array."""
    if len(ordered):
        cuts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])).tolist()
        for a, b in zip(cuts, [*cuts[1:], len(ordered)], strict=True):
            yield int(ordered[a]), slice(a, b)


def packed(*arrays: np.ndarray) -> bytes:
    """One-dimensional arrays of plain types, compressed into bytes."""
    head = ";".join(f"{a.dtype.str},{len(a)}" for a in arrays).encode()
    body = b"".join([len(head).to_bytes(4, "little"), head, *[np.ascontiguousarray(a).tobytes() for a in arrays]])
    return zstandard.ZstdCompressor(level=3).compress(body)


def unpacked(raw: bytes) -> list[np.ndarray]:
    body = zstandard.ZstdDecompressor().decompress(raw)
    at = 4 + int.from_bytes(body[:4], "little")
    out = []
    for item in body[4:at].decode().split(";"):
        kind, n = item.split(",")
        out.append(np.frombuffer(body, kind, int(n), at))
        at += out[-1].nbytes
    return out


def packed_keys(keys: np.ndarray) -> np.ndarray:
    """Ascending unsigned keys as differences, byte by byte position, which leaves little to store of the high bytes."""
    steps = np.diff(keys.astype("<u8"), prepend=np.uint64(0))
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).reshape(-1)


def planes(values: np.ndarray) -> np.ndarray:
    """Signed 64-bit values byte by byte position."""
    return np.ascontiguousarray(values.astype("<i8").view(np.uint8).reshape(-1, 8).T).reshape(-1)


def from_planes(raw: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(raw.reshape(8, -1).T).view("<i8").reshape(-1)


def unpacked_keys(raw: np.ndarray) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(raw.reshape(8, -1).T).view("<u8").reshape(-1), dtype=np.uint64)


class Block:
    """Documents of a block: ``ids`` (``NO_ID`` for null), ``bounds`` of their bytes in ``text``, other columns in ``rest``."""

    def __init__(self, ids: np.ndarray, bounds: np.ndarray, text: np.ndarray, rest: bytes) -> None:
        self.ids, self.bounds, self.text, self.rest = ids, bounds, text, rest

    def to_bytes(self) -> bytes:
        return packed(self.ids, self.bounds, self.text, np.frombuffer(self.rest, np.uint8))

    @classmethod
    def from_bytes(cls, raw: bytes) -> Block:
        ids, bounds, text, rest = unpacked(raw)
        return cls(ids, bounds, text, rest.tobytes())

    def rows(self) -> pa.Table:
        with pa.ipc.open_stream(self.rest) as stream:
            return stream.read_all()


def block_of(ids: list, texts: list[bytes], rest: pa.Table) -> Block:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rest.schema) as stream:
        stream.write_table(rest)
    return Block(
        np.asarray([NO_ID if i is None else i for i in ids], np.int64),
        np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64),
        np.frombuffer(b"".join(texts), np.uint8),
        sink.getvalue().to_pybytes(),
    )


def as_blocks(documents: DataFrame, block_bytes: int = BLOCK_BYTES, keep_rest: bool = True) -> DataFrame:
    """``block long, payload binary`` of all documents. Block numbers hold once the frame is written.

    With ``keep_rest`` a block also carries the documents' other columns.
    """
    rest = [c for c in documents.columns if c not in ("doc_id", "text")] if keep_rest else []
    chosen = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"), *[F.col(f"`{c}`") for c in rest]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids: list = []
        texts: list[bytes] = []
        parts: list[pa.Table] = []
        size = 0

        def block() -> pa.RecordBatch:
            found = block_of(ids, texts, pa.concat_tables(parts))
            return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([found.to_bytes()], pa.binary())], names=["block", "payload"])

        for batch in batches:
            table = pa.Table.from_batches([batch])
            others, begun = table.drop_columns(["doc_id", "text"]), 0
            for i, (doc_id, text) in enumerate(zip(batch.column(0), batch.column(1), strict=True)):
                ids.append(doc_id.as_py())
                texts.append(text.as_py() or b"")
                size += len(texts[-1])
                if size >= block_bytes:
                    parts.append(others.slice(begun, i + 1 - begun))
                    yield block()
                    number += 1
                    ids, texts, parts, size, begun = [], [], [], 0, i + 1
            parts.append(others.slice(begun))
        if ids:
            yield block()

    return chosen.mapInArrow(run, "block long, payload binary")
