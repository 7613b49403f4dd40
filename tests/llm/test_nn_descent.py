from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyfold.llm import nn_descent
from skyfold.llm.nn_descent import nearest

SCHEMA = "vec_id long, embedding array<float>, label int"


def exact(vectors: dict[int, np.ndarray], queries: list[int], k: int) -> dict[int, list[tuple[int, float]]]:
    out = {}
    for q in queries:
        a = vectors[q].astype(np.float64)
        scored = []
        for i, v in vectors.items():
            if i != q:
                b = v.astype(np.float64)
                scored.append((-(a @ b) / (np.sqrt(a @ a) * np.sqrt(b @ b)), i))
        out[q] = [(i, -s) for s, i in sorted(scored)[:k]]
    return out


def frame(spark, vectors):
    return spark.createDataFrame([(i, [float(x) for x in v], 0) for i, v in vectors.items()], SCHEMA).repartition(4)


def test_recall_of_hard_vectors(spark, scratch):
    r = np.random.default_rng(1)
    centers = r.normal(size=(10, 32))
    vectors = {i: (centers[i % 10] + 2 * r.normal(size=32)).astype(np.float32) for i in range(3000)}
    got = nearest(frame(spark, vectors), F.col("vec_id") % 50 == 0, scratch).collect()
    queries = list(range(0, 3000, 50))
    expected = exact(vectors, queries, 5)
    found = {q: {} for q in queries}
    for row in got:
        found[row["query_id"]][row["rank"]] = (row["vec_id"], row["score"])
    hits = sum(len({i for i, _ in expected[q]} & {i for i, _ in found[q].values()}) for q in queries)
    assert hits >= 0.95 * 5 * len(queries)
    for q in queries:
        assert sorted(found[q]) == [1, 2, 3, 4, 5]
        scores = [found[q][k][1] for k in range(1, 6)]
        assert scores == sorted(scores, reverse=True)
        for i, s in found[q].values():
            a, b = vectors[q].astype(np.float64), vectors[i].astype(np.float64)
            assert s == pytest.approx(a @ b / np.sqrt((a @ a) * (b @ b)), abs=1e-12)


def test_few_and_equal_vectors_are_found_exactly(spark, scratch):
    r = np.random.default_rng(2)
    vectors = {i: r.normal(size=8).astype(np.float32) for i in range(40)}
    vectors |= {100 + i: np.arange(1, 9, dtype=np.float32) for i in range(30)}
    vectors |= {200 + i: vectors[i] * np.float32(2) for i in range(3)}
    got = nearest(frame(spark, vectors), F.col("vec_id") % 50 == 0, scratch).orderBy("query_id", "rank").collect()
    expected = exact(vectors, [0, 100, 200], 5)
    for q in (0, 100, 200):
        mine = [(row["vec_id"], row["score"]) for row in got if row["query_id"] == q]
        assert [i for i, _ in mine] == [i for i, _ in expected[q]]
        assert [s for _, s in mine] == pytest.approx([s for _, s in expected[q]], abs=1e-12)


def test_unusable_vectors_take_no_part(spark, scratch):
    rows = [
        (0, [1.0, 0.0], 0),
        (0, [1.0, 0.0], 0),
        (1, [1.0, 1.0], 0),
        (2, None, 0),
        (3, [0.0, 0.0], 0),
        (4, [float("nan"), 1.0], 0),
        (5, [float("inf"), 1.0], 0),
        (6, [None, 1.0], 0),
        (7, [], 0),
        (None, [1.0, 1.0], 0),
        (50, None, 0),
        (100, [0.0, 3.0], 0),
    ]
    odd = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("label", "id")
    got = nearest(odd, F.col("vec_id") % 50 == 0, scratch).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in got] == [(0, 1, 1), (0, 2, 100), (100, 1, 1), (100, 2, 0)]
    again = type(scratch)(spark, "again")
    assert nearest(odd.limit(0), F.col("vec_id") % 50 == 0, again).isEmpty()
    alone = nearest(odd.where("vec_id = 100"), F.col("vec_id") % 50 == 0, type(scratch)(spark, "alone"))
    assert alone.isEmpty()


def test_a_large_leaf_is_dealt_out(spark, scratch, monkeypatch):
    monkeypatch.setattr(nn_descent, "LEAF", 50)
    monkeypatch.setattr(nn_descent, "PIVOTS", 2)
    r = np.random.default_rng(3)
    vectors = {i: (np.ones(16) + 0.2 * r.normal(size=16)).astype(np.float32) for i in range(600)}
    got = nearest(frame(spark, vectors), F.col("vec_id") % 50 == 0, scratch).collect()
    expected = exact(vectors, list(range(0, 600, 50)), 5)
    hits = sum((row["vec_id"] in {i for i, _ in expected[row["query_id"]]}) for row in got)
    assert len(got) == 60 and hits >= 54


def test_very_large_and_very_small_components_are_scored_as_others(spark, scratch):
    base = {0: [1.0, 0.2], 1: [1.0, 0.1], 2: [0.5, 0.9], 3: [-1.0, 0.3], 4: [0.2, 1.0]}
    factor = {0: 1e200, 1: 1e199, 2: 1e-170, 3: 1.0, 4: 5e-310}
    rows = [(i, [x * factor[i] for x in v], 0) for i, v in base.items()]
    doubles = SCHEMA.replace("float", "double")
    got = nearest(spark.createDataFrame(rows, doubles), F.col("vec_id") % 50 == 0, scratch).orderBy("rank").collect()
    expected = sorted(((float(np.dot(base[0], v) / np.linalg.norm(base[0]) / np.linalg.norm(v)), i) for i, v in base.items() if i), reverse=True)
    assert [r["vec_id"] for r in got] == [i for _, i in expected]
    assert [r["score"] for r in got] == pytest.approx([s for s, _ in expected], abs=1e-9)


def test_scaling_changes_no_bit_of_an_ordinary_score():
    r = np.random.default_rng(4)
    a, b = r.normal(size=(200, 64)) * 3, r.normal(size=(200, 64))

    def cosine(a, b):
        return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))

    assert np.array_equal(cosine(a, b), cosine(nn_descent.scaled(a), nn_descent.scaled(b)))


def test_vectors_of_another_length_take_no_part(spark, scratch):
    rows = [(0, [1.0, 0.0], 0), (1, [1.0, 1.0], 0), (2, [1.0, 2.0, 3.0], 0), (3, [1.0], 0), (50, [1.0], 0), (4, [0.0, 1.0], 0)]
    rows += [(k, None, 0) for k in range(100, 110)]
    got = nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0, scratch).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["vec_id"]) for r in got] == [(0, 1), (0, 4)]
    even = [(0, [1.0, 0.0], 0), (1, [1.0], 0), (2, [2.0, 1.0, 0.0], 0), (3, [1.0, 2.0, 0.0], 0), (4, [2.0, 1.0], 0)]
    got = nearest(spark.createDataFrame(even, SCHEMA), F.col("vec_id") % 50 == 0, type(scratch)(spark, "even"))
    assert [(r["query_id"], r["vec_id"]) for r in got.collect()] == [(0, 4)]


def test_equal_scores_of_different_vectors_go_to_the_smaller_id(spark, scratch):
    rows = [(0, [1.0, 0.0], 0), (9, [1.0, 1.0], 0), (7, [1.0, -1.0], 0), (8, [2.0, 2.0], 0), (5, [0.0, 1.0], 0)]
    got = nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0, scratch).orderBy("rank").collect()
    assert [r["vec_id"] for r in got] == [7, 8, 9, 5]
