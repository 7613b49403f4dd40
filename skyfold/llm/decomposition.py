"""Packing by decomposition into powers of two: no sequence holds tokens of two documents, and none is padded.

A document of n tokens is cut into as many pieces of the longest length as fit, and then into one piece for each binary digit of
what is left, longest first. Every piece is a sequence of its own. Equal lengths lie together, in one folder for each power of two,
so that a training step takes sequences of one bucket and needs neither padding nor a mask between documents.

Pieces are made where documents are read. One shuffle gathers them by length, in parts of bounded size: the bucket of the longest
pieces, which may hold most tokens, becomes many files, and the short buckets few. A sequence's number is its place in the written
buckets, longest first; only one row for each file is ordered for it.

Nulls and odd cases: a null or empty text is the end id alone, a sequence of length 1. Null and repeated ids are documents like
others; their pieces stay apart by sequence number. An empty table gives no sequence. Other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyfold.llm.batches import text_slices, texts_of
from skyfold.llm.common import Scratch, ship_code
from skyfold.llm.token_files import encoder_of

LONGEST = 2048
END_ID = 1

PIECE_SCHEMA = "doc_id long, start long, length long, doc_tokens long, ids binary"


def binary_pieces(tokens: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Document and length of each piece of documents of so many tokens, in the order of documents and of their tokens."""
    documents = np.arange(len(tokens))
    digits = np.arange(longest.bit_length() - 2, -1, -1)
    of_digit, digit = np.nonzero((tokens[:, None] % longest >> digits) & 1)
    document = np.concatenate([np.repeat(documents, tokens // longest), of_digit])
    length = np.concatenate([np.full(len(document) - len(of_digit), longest), 1 << digits[digit]])
    order = np.argsort(document, kind="stable")  # the longest pieces stand first in both arrays
    return document[order], length[order].astype(np.int64)


def decompose(documents: DataFrame, definition: str, longest: int = LONGEST, end_id: int = END_ID) -> DataFrame:
    """``doc_id, start, length, doc_tokens, ids``: the pieces of all documents, ids as little-endian unsigned 32-bit integers.

    ``definition`` is the JSON text of a tokenizer; ``end_id`` closes each document.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError(f"the longest sequence must be a power of two, got {longest}")
    spark = documents.sparkSession
    ship_code(spark)
    shared = spark.sparkContext.broadcast(definition)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(shared.value)
        end = np.asarray([end_id], encoder.type).tobytes()
        for batch in text_slices(batches):
            raw = encoder.encode(texts_of(batch))
            tokens = np.asarray([len(r) // encoder.width + 1 for r in raw], np.int64)
            ids = np.frombuffer(end.join([*raw, b""]), encoder.type).astype("<u4")
            document, length = binary_pieces(tokens, longest)
            ends = np.cumsum(length)
            first = np.cumsum(tokens) - tokens
            offsets = np.concatenate([[0], 4 * ends]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(document)),
                    pa.array(ends - length - first[document]),
                    pa.array(length),
                    pa.array(tokens[document]),
                    pa.Array.from_buffers(pa.binary(), len(length), [None, pa.py_buffer(offsets), pa.py_buffer(ids)]),
                ],
                names=["doc_id", "start", "length", "doc_tokens", "ids"],
            )

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECE_SCHEMA)


def write_buckets(documents: DataFrame, path: str, definition: str, longest: int = LONGEST, end_id: int = END_ID) -> None:
    """Write the pieces of all documents to ``path``, one folder for each length."""
    pieces = decompose(documents, definition, longest, end_id)
    pieces.hint("rebalance", "length").write.partitionBy("length").option("compression", "zstd").parquet(path)


def read_buckets(documents: DataFrame, path: str) -> DataFrame:
    """``sequence_id, offset`` and the columns of the pieces written to ``path``: each piece is its sequence from offset 0."""
    pieces = documents.sparkSession.read.schema(PIECE_SCHEMA).parquet(path)
    placed = pieces.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    files = placed.groupBy("length", "file").agg(F.count(F.lit(1)).alias("rows"))
    before = F.sum("rows").over(Window.orderBy(F.desc("length"), "file")) - F.col("rows")
    numbered = placed.join(F.broadcast(files.select("file", before.alias("before"))), "file")
    return numbered.select(
        (F.col("before") + F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"), *pieces.columns
    )


def pack_by_length(
    documents: DataFrame, scratch: Scratch, vocabulary: str, longest: int = LONGEST, end_id: int = END_ID
) -> DataFrame:
    """Pack all documents by the tokenizer at ``vocabulary``: the sequences, read back from their buckets."""
    with open(vocabulary, encoding="utf-8") as f:
        definition = f.read()
    write_buckets(documents, scratch.path("buckets"), definition, longest, end_id)
    return read_buckets(documents, scratch.path("buckets"))
