from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from skyfold.llm import suffix_dedup
from skyfold.llm.blocks import block_of, packed, unpacked
from skyfold.llm.bwt import least_by_class
from skyfold.llm.common import Scratch
from skyfold.llm.suffix_dedup import repeated_bytes, without_repeats
from tests.llm.conftest import prose


@pytest.mark.parametrize("seed", range(60))
def test_classes_equal_brute_force(seed):
    r = np.random.default_rng(seed)
    length = int(r.integers(2, 12))
    width, count = length + int(r.integers(1, 8)), int(r.integers(1, 40))
    rows = r.integers(0, int(r.integers(1, 5)), (count, width)).astype(np.uint8)
    if seed % 3 == 0:
        rows = rows[r.integers(0, max(1, count // 4), count)]
    sizes, values = r.integers(length, width + 1, count), r.permutation(count) * 10
    least = {}
    for row, n, v in zip(rows, sizes, values):
        for i in range(n - length + 1):
            key = row[i : i + length].tobytes()
            least[key] = min(least.get(key, 1 << 62), v)
    got = least_by_class(rows, sizes, values, length)
    for row, n, found in zip(rows, sizes, got):
        for i in range(width - length + 1):
            inside = i + length <= n
            assert found[i] == (least[row[i : i + length].tobytes()] if inside else np.iinfo(np.int64).max)


def brute(rows):
    """Digest columns and kept bytes of each row."""
    texts = [(i, (t or "").encode()) for i, t, *_ in rows]
    least = {}
    for i, b in texts:
        for k in range(len(b) - 49):
            if i is not None:
                least[b[k : k + 50]] = min(least.get(b[k : k + 50], i), i)
    out = []
    for i, b in texts:
        gone = bytearray(len(b))
        for k in range(len(b) - 49):
            if i is not None and least[b[k : k + 50]] < i:
                gone[k : k + 50] = b"\1" * 50
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus():
    r = random.Random(5)
    rows = [(i, prose(i, r.randint(0, 120))) for i in range(60)]
    passages = [prose(1000 + i, 30) for i in range(6)]
    for i in range(60, 200):
        text = prose(i, r.randint(5, 60))
        for _ in range(r.randint(0, 3)):
            p = r.choice(passages)
            a = r.randrange(len(p) // 2)
            at = r.randrange(len(text))
            text = text[:at] + p[a : a + r.randint(20, 160)] + text[at:]
        rows.append((i, text))
    rows += [(300 + i, prose(3, 90)) for i in range(20)]
    edited = prose(7, 100)
    rows += [(400 + i, edited[: i * 9] + "X" + edited[i * 9 + 1 :]) for i in range(40)]
    rows += [(500, "a" * 49), (501, "a" * 49), (502, "a" * 50), (503, "a" * 50), (504, "a" * 500), (505, "ab" * 300)]
    rows += [(506, "\x00" * 80), (507, "\x00" * 60), (508, "é" * 40), (509, "x" + "é" * 40), (510, None), (511, "")]
    rows += [(None, prose(3, 90)), (None, edited), (300, prose(3, 90)), (-5, prose(12, 80))]
    return rows


@pytest.mark.parametrize("partitions", [1, 7])
def test_removed_bytes_equal_brute_force(documents, scratch, partitions):
    rows = corpus()
    got = repeated_bytes(documents(rows, partitions), scratch).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


def test_buckets_grow_with_the_corpus_and_rows_stay(spark, documents):
    rows, scratch = corpus(), Scratch(spark, "many")
    got = repeated_bytes(documents(rows), scratch, bucket_anchors=20).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)
    anchors = spark.read.parquet(scratch.path("blocks")).groupBy().sum("n_anchors").first()[0]
    asked = spark.read.parquet(scratch.path("classes")).select("bucket").distinct().count()
    assert 16 < asked <= -(-anchors // 20)


def test_texts_longer_than_a_slice_and_many_blocks(documents, scratch, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SLICE", 400)
    block = block_of([1], [prose(9, 3000).encode()], documents([(1, "")]).select("lang").limit(0).toArrow())
    split = suffix_dedup.anchors_of(block)
    monkeypatch.undo()
    assert (split == suffix_dedup.anchors_of(block)).all() and (np.diff(split) > 0).all()
    long = prose(9, 60_000)
    rows = [(1, long), (2, prose(1, 50) + long[100_000:300_000]), (3, long[:-1] + "!")]
    got = {r["doc_id"]: r for r in repeated_bytes(documents(rows, 3), scratch).collect()}
    assert got[1]["n_removed"] == 0
    assert got[2]["n_removed"] == len(long[100_000:300_000].encode()) and got[2]["n_spans"] == 1
    assert got[3]["n_removed"] == got[3]["n_bytes"] - 1


def test_cleaned_documents_keep_their_columns(documents, scratch):
    passage = "é" * 30 + prose(1, 20)
    docs = documents([(1, "a " + passage + " b", "s1"), (2, "c " + passage + " d", "s2"), (3, None, None)]).withColumnRenamed("lang", "payload")
    got = {r["doc_id"]: r for r in without_repeats(docs, scratch).collect()}
    assert without_repeats(docs, type(scratch)(scratch.spark, "again")).columns == docs.columns
    assert got[1]["text"] == "a " + passage + " b" and got[2]["text"] == "cd" and got[2]["n_chars"] == 2
    assert got[2]["source"] == "s2" and got[2]["payload"] == "en" and got[3]["text"] == "" and got[3]["source"] is None


def test_empty_tables(documents, scratch):
    assert repeated_bytes(documents([(1, "")]).limit(0), scratch).isEmpty()


def test_arrays_travel_unchanged():
    arrays = [np.arange(5, dtype=np.uint32), np.zeros(0, np.int64), np.array([True, False])]
    assert all((a == b).all() and a.dtype == b.dtype for a, b in zip(arrays, unpacked(packed(*arrays))))
