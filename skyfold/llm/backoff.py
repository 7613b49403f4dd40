"""Language-model scores by stupid backoff, from counts over all documents.

Texts become blocks of bounded size. A block explodes its 1- to 3-word n-grams, combines equal ones, and sends hash and count to
hash buckets, which hold the count table: the shuffle partitions the table by hash. There the table is joined with what each block
asked for, and the totals go back to the blocks, which sum the scores of each document. A frequent n-gram costs each block one
entry, so no key is hot.

Each document is scored by the counts of all others: its own are subtracted. A word's score is the relative frequency of its
trigram after its bigram, if the trigram occurs elsewhere; else 0.4 times that of its bigram after its word; else 0.16 times its
own share of all words, where a word that occurs nowhere else counts as half a word. Words at the start of a text begin with the
order that they have, without a factor.

Nulls and odd cases: a null or blank text has no words, the sum 0 and no mean. Rows that share an id, or have none, are scored each
by itself, as different documents. A document alone in the corpus is scored against one word elsewhere. Hashes of n-grams keep 48 bits
in a bucket. Other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfold.llm.blocks import NO_ID, Block, as_blocks, packed, packed_keys, runs, unpacked, unpacked_keys
from skyfold.llm.common import Scratch, shuffle_partitions
from skyfold.llm.minhash import mix, word_hashes

ORDER = 3
BACKOFF = 0.4
UNSEEN = 0.5
SLICE_BYTES = 1 << 20
#: Text bytes of a block; larger ones combine more n-grams and take about 50 times as much memory in a task.
BLOCK_BYTES = 4 << 20
#: N-grams that a bucket counts, at most about, repeated ones included.
BUCKET_NGRAMS = 8 << 20

U64 = np.uint64
_ROW = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("kind", pa.string()), ("payload", pa.binary())])
_ROW_SQL = "bucket long, block long, kind string, payload binary"


def block_words(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a block and each word's document in it."""
    words, owner = [], []
    bounds = block.bounds.tolist()
    first = 0
    for last in range(1, len(bounds)):
        if bounds[last] - bounds[first] >= SLICE_BYTES or last == len(bounds) - 1:
            texts = [block.text[a:b].tobytes() for a, b in zip(bounds[first:last], bounds[first + 1 : last + 1], strict=True)]
            w, t = word_hashes(texts)
            words.append(w)
            owner.append(t + first)
            first = last
    return (np.concatenate(words), np.concatenate(owner)) if words else (np.zeros(0, U64), np.zeros(0, np.int64))


def ngrams(words: np.ndarray, owner: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each order the positions of the last words of its n-grams, and the n-grams' hashes."""
    out = []
    h = words
    for order in range(1, ORDER + 1):
        if order > 1:
            h = mix(h[:-1] * U64(0x9E3779B97F4A7C15) + words[order - 1 :]) if len(h) else h
        last = np.arange(order - 1, order - 1 + len(h))
        same = owner[last] == owner[last - order + 1]
        out.append((last[same], mix(h[same] + U64(order))))
    return out


class Asked:
    """The distinct n-grams of a block: by bucket, and which of them each occurrence is."""

    def __init__(self, block: Block, buckets: int) -> None:
        self.words, self.owner = block_words(block)
        self.grams = ngrams(self.words, self.owner)
        # Order by order, which bounds the memory of sorting.
        parts = [np.unique(h, return_inverse=True, return_counts=True) for _, h in self.grams]
        first = np.cumsum([0] + [len(f) for f, _, _ in parts])
        self.which = np.concatenate([w.astype(np.int32) + np.int32(a) for (_, w, _), a in zip(parts, first, strict=False)])
        self.counts = np.concatenate([c.astype(np.uint32) for _, _, c in parts])
        found = np.concatenate([f for f, _, _ in parts])
        del parts
        bucket = ((found * U64(0xFF51AFD7ED558CCD)) >> U64(24)) % U64(buckets)
        self.order = np.argsort(bucket.astype(np.uint32), kind="stable")
        self.keys = found[self.order] >> U64(16)
        bucket = bucket[self.order].astype(np.int64)
        self.parts = dict(runs(bucket))


def _table(rows: list[tuple]) -> pa.Table:
    return pa.Table.from_arrays([pa.array([r[i] for r in rows], _ROW.field(i).type) for i in range(len(_ROW))], schema=_ROW)


def _ask(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, raw in zip(batch.column("block").to_pylist(), batch.column("payload"), strict=True):
                asked = Asked(Block.from_bytes(raw.as_py()), buckets)
                counts = asked.counts[asked.order]
                for b, s in asked.parts.items():
                    # Within a bucket the n-grams of one order ascend, and then those of the next.
                    key, count = asked.keys[s], counts[s]
                    order = np.argsort(key, kind="stable")
                    yield from _table([(b, number, "ask", packed(packed_keys(key[order]), count[order]))]).to_batches()
                del asked, counts

    return run


def _count(table: pa.Table) -> pa.Table:
    """The count table of a bucket, joined with what each block asked for, in the order it asked."""
    parts = [unpacked(p.as_py()) for p in table.column("payload")]
    keys = np.concatenate([unpacked_keys(k) for k, _ in parts])
    _, which = np.unique(keys, return_inverse=True)
    totals = np.bincount(which, weights=np.concatenate([c for _, c in parts]))
    bucket, at, rows = table.column("bucket")[0].as_py(), 0, []
    for block, (_, counts) in zip(table.column("block").to_pylist(), parts, strict=True):
        mine = totals[which[at : at + len(counts)]]
        rows.append((bucket, block, "totals", packed(mine.astype(np.uint32 if mine.max() < 1 << 32 else np.uint64))))
        at += len(counts)
    return _table(rows)


def _score(buckets: int, corpus_words: int):
    def run(table: pa.Table) -> pa.Table:
        kinds = table.column("kind").to_pylist()
        block = Block.from_bytes(table.column("payload")[kinds.index("block")].as_py())
        asked = Asked(block, buckets)
        totals = np.zeros(len(asked.order))
        for kind, bucket, raw in zip(kinds, table.column("bucket").to_pylist(), table.column("payload"), strict=True):
            if kind == "totals":
                mine = asked.parts[bucket]
                order = np.argsort(asked.keys[mine], kind="stable")
                totals[asked.order[mine][order]] = unpacked(raw.as_py())[0]
        n, owner = len(asked.words), asked.owner
        others, at = [], 0
        for last, h in asked.grams:
            _, which, own = np.unique(mix(h + owner[last].astype(U64) * U64(0xC2B2AE3D27D4EB4F)), return_inverse=True, return_counts=True)
            rest = np.zeros(n)
            rest[last] = totals[asked.which[at : at + len(last)]] - own[which]
            others.append(rest)
            at += len(last)
        place = np.arange(n)
        start = np.searchsorted(owner, np.arange(len(block.ids) + 1))
        words = np.diff(start)
        place = place - np.repeat(start[:-1], words)
        elsewhere = np.maximum(corpus_words - np.repeat(words, words), 1)
        score = np.maximum(others[0], UNSEEN) / elsewhere
        before = [np.concatenate([[0.0], o[:-1]]) if n else o for o in others]
        with np.errstate(divide="ignore", invalid="ignore"):
            for order in range(2, ORDER + 1):
                backed = BACKOFF * score
                direct = others[order - 1] / before[order - 2]
                score = np.where(place < order - 1, score, np.where(others[order - 1] > 0, direct, backed))
        sums = np.zeros(len(block.ids))
        full = np.flatnonzero(words)
        if n:
            sums[full] = np.add.reduceat(np.log(score), start[:-1][full])
        return pa.table(
            {
                "doc_id": pa.array(block.ids, mask=block.ids == NO_ID),
                "n_words": words.astype(np.int64),
                "log_score": sums,
                "mean_log_score": pa.array(sums / np.maximum(words, 1), mask=words == 0),
            }
        )

    return run


def backoff_scores(documents: DataFrame, scratch: Scratch, bucket_ngrams: int = BUCKET_NGRAMS) -> DataFrame:
    """``doc_id, n_words, log_score, mean_log_score``: the sum of the natural logarithms of a document's word scores, and their mean.

    The count table has a bucket for every ``bucket_ngrams`` n-grams of the corpus, so a bucket stays as large as the corpus grows.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [len(block_words(Block.from_bytes(p.as_py()))[0]) for p in batch.column("payload")]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(words, pa.int64())], names=["block", "payload", "words"])

    blocks = scratch.keep(
        as_blocks(documents, BLOCK_BYTES, keep_rest=False).mapInArrow(counted, "block long, payload binary, words long"), "blocks"
    )
    corpus_words = blocks.agg(F.sum("words")).first()[0] or 0
    buckets = max(shuffle_partitions(documents.sparkSession), ceil(ORDER * corpus_words / bucket_ngrams))
    totals = scratch.keep(
        blocks.select("block", "payload").mapInArrow(_ask(buckets), _ROW_SQL).groupBy("bucket").applyInArrow(_count, _ROW_SQL), "totals"
    )
    texts = blocks.select(F.lit(-1).cast("long").alias("bucket"), "block", F.lit("block").alias("kind"), "payload")
    return (
        texts.union(totals)
        .groupBy("block")
        .applyInArrow(_score(buckets, corpus_words), "doc_id long, n_words long, log_score double, mean_log_score double")
    )
