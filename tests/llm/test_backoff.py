from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest

from skyfold.llm import backoff
from skyfold.llm.backoff import backoff_scores
from skyfold.llm.blocks import packed_keys, unpacked_keys
from skyfold.llm.common import Scratch
from tests.llm.conftest import prose


def words_of(text):
    for c in "\t\n\x0b\x0c\r":
        text = (text or "").replace(c, " ")
    return [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text).split(" ") if w]


def grams(words):
    return Counter(tuple(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1))


def brute(texts):
    split = [words_of(t) for t in texts]
    total = sum(map(grams, split), Counter())
    size = sum(map(len, split))
    out = []
    for w in split:
        own = grams(w)
        score = 0.0
        for i in range(len(w)):
            factor, s = 1.0, None
            for n in range(min(3, i + 1), 1, -1):
                g = tuple(w[i - n + 1 : i + 1])
                if total[g] - own[g] > 0:
                    s = factor * (total[g] - own[g]) / (total[g[:-1]] - own[g[:-1]])
                    break
                factor *= 0.4
            if s is None:
                s = factor * max(total[(w[i],)] - own[(w[i],)], 0.5) / max(size - len(w), 1)
            score += math.log(s)
        out.append((len(w), score))
    return out


@pytest.mark.parametrize("block_bytes", [1, 3000, 1 << 22])
def test_scores_equal_brute_force(documents, scratch, monkeypatch, block_bytes):
    monkeypatch.setattr(backoff, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(backoff, "SLICE_BYTES", 500)
    texts = [prose(i % 25, i * 5 % 90, 60).swapcase() if i % 3 else prose(i, 40, 60) for i in range(60)]
    texts += [None, "", " \n", "once", "a a a a", "a b", "the quick\x0bfox", "x" * 100_000, "w1 " * 3000]
    rows = {r["doc_id"]: r for r in backoff_scores(documents(list(enumerate(texts))), scratch).collect()}
    for i, (n, score) in enumerate(brute(texts)):
        assert rows[i]["n_words"] == n and rows[i]["log_score"] == pytest.approx(score, abs=1e-6)
        mean = rows[i]["mean_log_score"]
        assert mean is None if n == 0 else mean == pytest.approx(score / n, abs=1e-9)


def test_nulls_repeats_one_document_and_empty_tables(spark, documents, scratch):
    docs = documents([(None, "a b"), (1, "a b"), (1, "a b")]).withColumnRenamed("lang", "n_words")
    rows = backoff_scores(docs, scratch).collect()
    assert sorted(((r["doc_id"], r["n_words"]) for r in rows), key=str) == [(1, 2), (1, 2), (None, 2)]
    assert len({round(r["log_score"], 9) for r in rows}) == 1
    (alone,) = backoff_scores(documents([(1, "a b")]), type(scratch)(spark, "one")).collect()
    assert alone["log_score"] == pytest.approx(math.log(0.5) + math.log(0.4 * 0.5))
    assert backoff_scores(docs.limit(0), type(scratch)(spark, "none")).isEmpty()


def test_keys_travel_unchanged():
    keys = np.sort(np.random.default_rng(0).integers(0, 1 << 48, 1000, dtype=np.uint64))
    assert (unpacked_keys(packed_keys(keys)) == keys).all() and len(unpacked_keys(packed_keys(keys[:0]))) == 0


def test_buckets_grow_with_the_corpus_and_scores_stay(spark, documents):
    texts = [prose(i % 40, 150, 300) for i in range(80)]
    docs = documents(list(enumerate(texts)))
    few, many = Scratch(spark, "few"), Scratch(spark, "many")
    expected = {tuple(r) for r in backoff_scores(docs, few).collect()}
    found = {tuple(r) for r in backoff_scores(docs, many, bucket_ngrams=300).collect()}
    assert {(r[0], r[1], round(r[2], 6)) for r in found} == {(r[0], r[1], round(r[2], 6)) for r in expected}
    count = {s: spark.read.parquet(s.path("totals")).select("bucket").distinct().count() for s in (few, many)}
    assert count[few] <= 8 and 3 * 80 * 150 // 300 * 0.9 < count[many] <= 3 * 80 * 150 // 300
