from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from skyfold.llm import resampling
from skyfold.llm.resampling import BLOCK, crc32s, resample
from tests.llm.conftest import prose


def features(text, least=1, most=1):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    return words, [" ".join(words[i : i + n]) for n in range(least, most + 1) for i in range(len(words) - n + 1)]


def brute(rows, target, percent=10, least_words=20, least=1, most=1, buckets=10_000):
    """(doc_id, n_features, weight, score, rank) by the definition, one document after the other."""

    def bucket(f):
        return zlib.crc32(f.encode()) % buckets

    s = Counter(bucket(f) for _, text, *_ in rows for f in features(text, least, most)[1])
    t = Counter(bucket(f) for text in target for f in features(text, least, most)[1])
    total_s, total_t = sum(s.values()), sum(t.values())
    scored, fit = [], []
    for doc_id, text, *_ in rows:
        words, found = features(text, least, most)
        gain = [math.floor(1000 * math.log((t[bucket(f)] + 1) * (total_s + buckets) / ((s[bucket(f)] + 1) * (total_t + buckets)))) for f in found]
        weight = sum(gain) // len(gain) if gain else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        scored.append([doc_id, len(found), weight, score, None])
        if len(words) >= least_words:
            fit.append(scored[-1])
    fit.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for k, r in enumerate(fit[: len(fit) * percent // 100]):
        r[4] = k + 1
    return sorted(map(tuple, scored), key=repr)


def got(frame):
    assert frame.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    return sorted((tuple(r) for r in frame.collect()), key=repr)


@pytest.fixture
def texts(spark):
    return lambda rows: spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "item_id long, text string")


def test_crcs_of_all_lengths():
    r = random.Random(3)
    lengths = [*range(70), BLOCK - 1, BLOCK, BLOCK + 1, 2 * BLOCK, 7 * BLOCK + 5, 300_001]
    found = [r.randbytes(n) for n in lengths * 2] + [b"same", b"same"]
    r.shuffle(found)
    assert crc32s(found).tolist() == [zlib.crc32(f) for f in found]
    assert crc32s([]).tolist() == []


def test_equals_the_definition(documents, texts, scratch, monkeypatch):
    monkeypatch.setattr("skyfold.llm.batches.SLICE_BYTES", 3000)
    rows = [(i * 7 - 100, prose(i, 5 + i * 3 % 90, 300)) for i in range(400)]
    target = [prose(1000 + i, 30, 60) for i in range(20)]
    found = got(resample(documents(rows), texts(target), scratch))
    assert found == brute(rows, target)
    drawn = sorted(r for r in found if r[4])
    assert len(drawn) == len([t for _, t in rows if len(features(t)[0]) >= 20]) // 10


def test_longer_runs_and_other_parameters(documents, texts, scratch):
    rows = [(i, prose(i, 40, 50)) for i in range(60)]
    target = [prose(500, 200, 50)]
    found = got(resample(documents(rows), texts(target), scratch, percent=35, least_words=30, least_run=1, longest_run=3, buckets=97))
    assert found == brute(rows, target, 35, 30, 1, 3, 97)
    with pytest.raises(ValueError):
        resample(documents(rows), texts(target), scratch, least_run=2, longest_run=1)


ODD = [
    (None, None),
    (None, prose(1, 30)),
    (None, prose(1, 30)),
    (1, ""),
    (2, " \t\n.,;"),
    (3, "ÀÉ ß İ 漢字▁x " * 10),
    (4, "A.B-C_d'E\x00f\x7fg 12"),
    (5, prose(2, 60)),
    (5, prose(2, 60)),
    (5, prose(3, 25)),
    (6, "x" * 200_000 + " " + "y " * 50_000),
]


@pytest.mark.parametrize("percent", [0, 40, 100])
def test_nulls_repeats_and_long_texts(documents, texts, spark, percent):
    from skyfold.llm.common import Scratch

    clashing = documents(ODD).withColumnsRenamed({"lang": "rank", "source": "score", "n_chars": "place"})
    found = got(resample(clashing, texts([None, "", "y x 漢字"]), Scratch(spark, "odd"), percent=percent))
    assert found == brute(ODD, [None, "", "y x 漢字"], percent)


def test_ties_go_to_the_smaller_id(documents, texts, scratch, monkeypatch):
    monkeypatch.setattr(resampling, "noise", lambda seed, doc_id: 0)
    rows = [(i, "a b c " * 10) for i in (9, 3, None, 7, -2, 5)] + [(1, "a b")]
    found = got(resample(documents(rows), texts(["a"]), scratch, percent=70))
    assert sorted((r[4], r[0]) for r in found if r[4]) == [(1, -2), (2, 3), (3, 5), (4, 7)]


def test_empty_tables(documents, texts, spark):
    from skyfold.llm.common import Scratch

    some = documents([(1, "w " * 30)])
    none = texts(["x"]).limit(0)
    assert resample(some.limit(0), none, Scratch(spark, "empty")).isEmpty()
    assert got(resample(some, none, Scratch(spark, "empty"), percent=100)) == brute([(1, "w " * 30)], [], 100)
