"""Importance resampling towards a target: draw the documents whose hashed word runs are likelier in a target than in the corpus.

A feature is a run of words, its bucket the CRC-32 of its bytes modulo a number of buckets. Counts over all documents and all target
texts give each bucket a gain, the logarithm of its share in the target over its share in the corpus, smoothed by one and kept as
whole thousandths. A document's weight is the mean gain of its features; noise from a hash of its id, Gumbel distributed, turns the
highest scores into a draw without replacement in proportion to the weights.

CRCs are taken in matrices: the distinct features of a slice are grouped by length into two-dimensional arrays of bytes, one row
each, all rows of a matrix take in one column after the other, and the results go back to the features' places. Features longer
than ``BLOCK`` bytes become several rows, which are joined by shifting a state over a block, so a column loop never is long.

Counting sends one row for each bucket that a task met. The gains, one number for each bucket, are the only thing broadcast. The draw
takes the limit from a histogram of scores, whole numbers whose range the logarithms bound, then sorts the drawn rows alone; ranks
come from their places in the written order.

Nulls and odd cases: null and blank texts have no features, weight 0 and are never drawn. A null id is hashed as an empty string and
comes after all others where scores tie. Rows that share an id share their noise; those that tie in score and id are ordered by their
number of features. Without target texts or documents the smoothed shares still are defined; an empty table gives no row. Other
columns are left out.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfold.llm.batches import text_slices, texts_of
from skyfold.llm.common import Scratch, in_written_order, ship_code

#: Bytes of a row; a longer feature is several.
BLOCK = 256
#: Fixed value: the reversed polynomial of CRC-32.
POLYNOMIAL = 0xEDB88320
_ONES = np.uint32(0xFFFFFFFF)


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, table >> 1 ^ np.uint32(POLYNOMIAL), table >> 1).astype(np.uint32)
    return table


TABLE = _byte_table()


def take_in(states: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The CRC states after each row of a matrix of bytes, all rows together, column by column."""
    for column in np.ascontiguousarray(rows.T):
        states = TABLE[(states ^ column) & 0xFF] ^ states >> 8
    return states


#: What a state becomes over a block of zeros, for each value of each of its four bytes.
_SHIFTS = take_in((np.arange(256, dtype=np.uint32) << np.arange(0, 32, 8, dtype=np.uint32)[:, None]).reshape(-1), np.zeros((1024, BLOCK), np.uint8))
_SHIFTS = _SHIFTS.reshape(4, 256)


def _over_a_block(states: np.ndarray) -> np.ndarray:
    return _SHIFTS[0, states & 255] ^ _SHIFTS[1, states >> 8 & 255] ^ _SHIFTS[2, states >> 16 & 255] ^ _SHIFTS[3, states >> 24]


def crc32s(features: list[bytes]) -> np.ndarray:
    """The unsigned CRC-32 of each feature."""
    out = np.zeros(len(features), np.uint32)
    lengths = np.fromiter(map(len, features), np.int64, len(features))
    order = np.argsort(lengths, kind="stable")
    cuts = np.flatnonzero(np.diff(lengths[order], prepend=-1, append=-1))
    for a, z in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        places, length = order[a:z], int(lengths[order[a]])
        matrix = np.frombuffer(b"".join([features[i] for i in places.tolist()]), np.uint8).reshape(len(places), length)
        states = np.full(len(places), _ONES)
        blocks = length // BLOCK
        if blocks:
            # A state is linear in what came before: blocks are taken in from 0, together, and then strung.
            alone = take_in(np.zeros(len(places) * blocks, np.uint32), matrix[:, : blocks * BLOCK].reshape(-1, BLOCK)).reshape(-1, blocks)
            for k in range(blocks):
                states = _over_a_block(states) ^ alone[:, k]
        out[places] = take_in(states, matrix[:, blocks * BLOCK :]) ^ _ONES
    return out


#: Words are runs of ASCII letters and digits and of anything beyond ASCII; all other bytes become spaces, A-Z a-z.
_TO_WORDS = bytes(
    b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256)
)


class Features:
    """The features of some texts: their number in each text, and the bucket of each in order."""

    def __init__(self, texts: list[bytes], least_run: int, longest_run: int, buckets: int) -> None:
        words = [t.translate(_TO_WORDS).split() for t in texts]
        self.words = np.fromiter(map(len, words), np.int64, len(words))
        runs = words
        if longest_run > 1 or least_run > 1:
            lengths = range(least_run, longest_run + 1)
            runs = [[b" ".join(ws[i : i + n]) for n in lengths for i in range(len(ws) - n + 1)] for ws in words]
        self.counts = np.fromiter(map(len, runs), np.int64, len(runs))
        place = {f: i for i, f in enumerate(dict.fromkeys(chain.from_iterable(runs)))}
        which = np.fromiter(map(place.__getitem__, chain.from_iterable(runs)), np.int64, int(self.counts.sum()))
        self.buckets = (crc32s(list(place)) % np.uint32(buckets)).astype(np.int64)[which]


def bucket_counts(texts: DataFrame, least_run: int, longest_run: int, buckets: int) -> np.ndarray:
    """How many features of all ``texts`` fall into each bucket."""
    ship_code(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in text_slices(batches):
            total += np.bincount(Features(texts_of(batch), least_run, longest_run, buckets).buckets, minlength=buckets)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], names=["bucket", "n"])

    found = texts.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros(buckets, np.int64)
    for r in found.collect():  # at most one row for each bucket
        counts[r["bucket"]] = r["n"]
    return counts


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of each bucket's share in the target over that in the corpus, rounded down."""
    n, s, t = len(corpus), int(corpus.sum()), int(target.sum())
    return np.asarray(
        [math.floor(1000 * math.log((b + 1) * (s + n) / ((a + 1) * (t + n)))) for a, b in zip(corpus.tolist(), target.tolist())], np.int64
    )


def noise(seed: str, doc_id: int | None) -> int:
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weighted(documents: DataFrame, gain: np.ndarray, seed: str, least_run: int, longest_run: int) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score`` of every document."""
    spark = documents.sparkSession
    ship_code(spark)
    shared = spark.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for batch in text_slices(batches):
            found = Features(texts_of(batch), least_run, longest_run, len(gain))
            sums = np.concatenate([[0], np.cumsum(gain[found.buckets])])
            ends = np.cumsum(found.counts)
            weight = (sums[ends] - sums[ends - found.counts]) // np.maximum(found.counts, 1)
            ids = batch.column("doc_id")
            score = weight + np.asarray([noise(seed, i) for i in ids.to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(found.words), pa.array(found.counts), pa.array(weight), pa.array(score)],
                names=["doc_id", "n_words", "n_features", "weight", "score"],
            )

    schema = "doc_id long, n_words long, n_features long, weight long, score long"
    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def resample(
    documents: DataFrame,
    target: DataFrame,
    scratch: Scratch,
    percent: int = 10,
    least_words: int = 20,
    least_run: int = 1,
    longest_run: int = 1,
    buckets: int = 10_000,
    seed: str = "2024",
) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every document; ``rank`` is null where a document isn't drawn.

    Of the documents with at least ``least_words`` words, ``percent`` of a hundred are drawn, rounded down.
    """
    if not (1 <= least_run <= longest_run and 0 <= percent <= 100 and buckets >= 1):
        raise ValueError("need 1 <= least_run <= longest_run, a percentage and a bucket")
    gain = gains(*(bucket_counts(t, least_run, longest_run, buckets) for t in (documents, target)))
    scored = scratch.keep(weighted(documents, gain, seed, least_run, longest_run), "scores")
    fit = F.col("n_words") >= least_words
    # Scores are whole thousandths of logarithms of bounded numbers: some ten thousand values, however many documents.
    histogram = scored.where(fit).groupBy("score").agg(F.count(F.lit(1)).alias("n")).collect()
    wanted = sum(r["n"] for r in histogram) * percent // 100
    limit, above = None, 0
    for r in sorted(histogram, key=lambda r: -r["score"]):
        if above >= wanted:
            break
        limit, above = r["score"], above + r["n"]
    drawable = (fit & (F.col("score") >= limit)) if limit is not None else F.lit(False)
    columns = ["doc_id", "n_features", "weight", "score"]
    # Rows that tie on everything are cut apart by the partition they came from, so that no range is one task's alone.
    ordered = scored.where(drawable).select(*columns, F.spark_partition_id().alias("origin"))
    ordered = ordered.orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "n_features", "origin").drop("origin")
    ranked = in_written_order(scratch.keep(ordered, "drawn"), "place").withColumn("rank", F.col("place") + 1)
    rank = F.when(F.col("rank") <= wanted, F.col("rank"))
    rest = scored.where(~drawable).select(*columns, F.lit(None).cast("long").alias("rank"))
    return ranked.select(*columns, rank.alias("rank")).unionByName(rest)
