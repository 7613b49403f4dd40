from __future__ import annotations

import random

import numpy as np
import pytest

from skyfold.llm.common import Scratch
from skyfold.llm.components import components
from skyfold.llm.minhash import BANDS, ROWS, band_keys, near_duplicates, shingle_sets, sketch, without_near_duplicates
from tests.llm.conftest import prose

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k):
    for c in "\t\n\x0b\x0c\r":
        text = (text or "").replace(c, " ")
    words = [w for w in text.translate(LOWER).split(" ") if w]
    if not words:
        return set()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} or {tuple(words)}


def brute(rows, k):
    sets = {i: shingles(t, k) for i, t in rows if i is not None}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((root(a), root(b)))
                    parent[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}


def corpus(seed):
    r = random.Random(seed)
    rows = [(i, prose(seed * 1000 + i, r.randint(0, 60))) for i in range(80)]
    for base in range(6):
        words = prose(base + 5000, r.choice([8, 40, 90])).split()
        for copy in range(30):
            w = list(words)
            for _ in range(r.randint(0, 4)):
                w[r.randrange(len(w))] = f"x{r.randrange(50)}"
            rows.append((1000 + base * 100 + copy, " ".join(w)))
    rows += [(2000 + i, prose(seed * 1000 + 3, 50).upper()) for i in range(10)]
    rows += [(3000, None), (3001, ""), (3002, " \t"), (3003, "one"), (3004, "ONE"), (3005, "One\x0bTwo"), (3006, "one two")]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("k", [2, 5])
def test_components_equal_brute_force(documents, scratch, k):
    rows = corpus(k)
    expected = brute(rows, k)
    got = near_duplicates(documents(rows), scratch, k).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r["n_shingles"], r["component_id"]) == expected[r["doc_id"]]
        assert r["kept"] == (r["doc_id"] == r["component_id"])


def test_nulls_repeats_very_long_words_and_empty_tables(documents, scratch):
    text = prose(1, 30)
    rows = [(None, text), (5, text), (5, text), (9, text), (7, "y" * 300_000), (8, "y" * 300_000), (6, None)]
    docs = documents(rows).withColumnRenamed("lang", "label")
    got = sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in near_duplicates(docs, scratch, 2).collect()), key=str)
    assert got == sorted(
        [(None, None, True), (5, 5, True), (5, 5, True), (9, 5, False), (7, 7, True), (8, 7, False), (6, 6, True)], key=str
    )
    again = type(scratch)(scratch.spark, "again")
    kept = without_near_duplicates(docs, again, 2)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted([None, 5, 5, 7, 6], key=str)
    assert near_duplicates(docs.limit(0), type(scratch)(scratch.spark, "none")).isEmpty()


def test_sketches_fill_and_agree_with_the_similarity():
    r = np.random.default_rng(1)
    everything = r.integers(0, 1 << 64, 3000, dtype=np.uint64)
    sets = [everything[:1], everything[:7], everything[:1000], everything[200:1200], everything]
    found = sketch(sets, 400)
    assert (found != np.uint64(0xFFFFFFFFFFFFFFFF)).all()
    assert abs((found[2] == found[3]).mean() - 800 / 1200) < 0.1
    assert abs((found[2] == found[4]).mean() - 1000 / 3000) < 0.1
    assert (sketch(sets[2:3], 400)[0] == found[2]).all()


def test_pairs_at_the_threshold_share_a_band():
    r = np.random.default_rng(2)
    missed = 0
    for _ in range(300):
        x = r.integers(0, 1 << 64, 180, dtype=np.uint64)
        keys = band_keys(sketch([x[:160], x[20:]], BANDS * ROWS), BANDS, ROWS)
        missed += not (keys[0] == keys[1]).any()
    assert missed <= 2  # 140 / 180 = 0.78


def test_words_are_told_apart_across_texts():
    sets = shingle_sets([b"A b\tc", b"", b"  ", b"a b c", b"c", b"a\nb", "a b".encode()], 2)
    assert [len(s) for s in sets] == [2, 0, 0, 2, 1, 1, 1]
    assert (sets[0] == sets[3]).all() and sets[5][0] != sets[6][0]


def test_components_of_chains_stars_and_rings(spark, scratch):
    links = [(i, i + 1) for i in range(200)] + [(500, 501 + i) for i in range(50)] + [(900 + i, 900 + (i + 1) % 20) for i in range(20)]
    frame = spark.createDataFrame(links, "a long, b long").repartition(4)
    labels = {r["id"]: r["label"] for r in components(frame, scratch, "c").collect()}
    assert all(labels[i] == 0 for i in range(201)) and all(labels[i] == 500 for i in range(500, 551))
    assert all(labels[i] == 900 for i in range(900, 920))
    assert components(frame.limit(0), scratch, "none").isEmpty()


def test_no_text_is_lost_where_ids_repeat(documents, scratch):
    """Id 2 holds the texts of 1 and of 3; 4 and 5 are copies, 4 twice."""
    texts = [prose(k, 80) for k in range(3)]
    rows = [(1, texts[0]), (2, texts[0]), (2, texts[1]), (3, texts[1]), (4, texts[2]), (4, texts[2]), (5, texts[2])]
    found = sorted((r["doc_id"], r["component_id"], r["kept"]) for r in near_duplicates(documents(rows), scratch).collect())
    assert found == [(1, 1, True), (2, 2, True), (2, 2, True), (3, 3, True), (4, 4, True), (4, 4, True), (5, 4, False)]
    left = without_near_duplicates(documents(rows), Scratch(scratch.spark, "left")).collect()
    assert {r["text"] for r in left} == set(texts) and sorted(r["doc_id"] for r in left) == [1, 2, 2, 3, 4, 4]
