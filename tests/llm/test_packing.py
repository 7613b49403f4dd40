from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from skyfold.llm.common import Scratch, in_written_order
from skyfold.llm.mixing import mixed_order
from skyfold.llm.packing import GROUP_PIECES, pack, pack_group
from tests.llm.conftest import prose


def brute(lengths, sources, clusters, capacity):
    """Best fit by looking at every bin."""
    bins, out = [], []
    for n, s, c in zip(lengths, sources, clusters):
        fits = [
            (b["rest"], i)
            for i, b in enumerate(bins)
            if b["rest"] >= n and (s is None or s not in b["sources"]) and (c is None or c not in b["clusters"])
        ]
        if fits:
            i = min(fits)[1]
        else:
            i = len(bins)
            bins.append({"rest": capacity, "sources": set(), "clusters": set()})
        bins[i]["rest"] -= n
        bins[i]["sources"].add(s)
        bins[i]["clusters"].add(c)
        out.append(i)
    return out


@pytest.mark.parametrize("seed", range(40))
def test_groups_are_packed_best_fit(seed):
    r = random.Random(seed)
    n, capacity = r.randint(1, 120), r.choice([5, 20, 100])
    lengths = sorted((r.randint(0, capacity) for _ in range(n)), reverse=True)
    sources = [r.choice([None, "hot", "hot", *"abcdefgh"]) for _ in range(n)]
    clusters = [r.choice([None, *range(n // 3 + 1)]) for _ in range(n)]
    assert pack_group(lengths, sources, clusters, capacity) == brute(lengths, sources, clusters, capacity)


def test_every_word_is_packed_without_conflict(documents, scratch):
    rows = [(i, prose(i % 150, 5 + i * 7 % 300), "hot" if i % 3 == 0 else f"s{i % 11}") for i in range(400)]
    docs = documents(rows)
    got = pack(docs, scratch, capacity=100, group_pieces=60).collect()
    source = {i: s for i, _, s in rows}
    text = {i: t for i, t, _ in rows}
    whole = {}
    bins = {}
    for r in got:
        whole[r["doc_id"]] = whole.get(r["doc_id"], 0) + r["length"]
        bins.setdefault(r["bin_id"], []).append(r)
    assert whole == {i: len(t.split()) for i, t, _ in rows}
    for members in bins.values():
        assert sum(r["length"] for r in members) <= 100
        assert len({source[r["doc_id"]] for r in members}) == len(members)
        assert len({text[r["doc_id"]] for r in members}) == len(members)
        assert sorted(r["place"] for r in members) == list(range(len(members)))


def test_nulls_repeats_long_texts_and_empty_tables(spark, documents, scratch):
    docs = documents([(None, None, None), (1, "", "x"), (2, "a b", None), (2, "a b", None), (3, "w " * 5000, "x")])
    got = pack(docs.withColumnRenamed("lang", "piece"), scratch, capacity=1000).collect()
    assert sorted((r["doc_id"] or 0, r["piece"], r["length"]) for r in got) == sorted(
        [(0, 0, 0), (1, 0, 0), (2, 0, 2), (2, 0, 2), *[(3, k, 1000) for k in range(5)]]
    )
    assert len({r["bin_id"] for r in got if r["doc_id"] == 2}) == 2
    scratch.drop("pieces")
    assert pack(docs.limit(0), scratch).isEmpty()


def test_groups_are_stretches_of_the_positions(documents, scratch):
    docs = documents([(i, "w " * (1 + i * 7 % 250), f"s{i % 9}") for i in range(300)])
    got = pack(docs, scratch, capacity=100, group_pieces=40, position=-F.col("doc_id") + 1000).collect()
    order = sorted(got, key=lambda r: (-r["doc_id"], r["piece"]))
    groups = [r["bin_id"] >> 32 for r in order]
    assert groups == [k // 40 for k in range(len(got))] and len(got) > 400


def test_the_mixture_decides_what_is_packed_together(spark, documents):
    docs = documents([(i, f"w{i} " * 300, f"s{i % 3}") for i in range(240)])

    def together(weights):
        scratch = Scratch(spark, "mixture")
        mixed = in_written_order(scratch.keep(mixed_order(docs, weights), "mixed"), "at")
        bins = {}
        for r in pack(mixed, scratch, group_pieces=30, position=F.col("at")).collect():
            bins.setdefault(r["bin_id"], set()).add(r["doc_id"])
        return {frozenset(b) for b in bins.values()}

    early, even = {"s0": 0.8, "s1": 0.1, "s2": 0.1}, {"s0": 0.4, "s1": 0.3, "s2": 0.3}
    assert together(early) == together(early) != together(even)


def test_the_pipeline_packs_stretches_of_the_mixture(spark, documents, scratch):
    docs = documents([(i, "a", f"s{i % 4}") for i in range(GROUP_PIECES + 1000)])
    mixed = scratch.keep(corpus_pipeline.mix_sources(spark, docs, ""), "mixed")
    order = [r["doc_id"] for r in mixed_order(docs).select("doc_id").collect()]
    group = {r["doc_id"]: r["bin_id"] >> 32 for r in corpus_pipeline.pack_documents(spark, mixed, "").collect()}
    assert [group[i] for i in order] == [0] * GROUP_PIECES + [1] * 1000


def test_places_are_those_of_the_written_table(spark, scratch):
    kept = scratch.keep(spark.range(5000, 0, -1, 7).selectExpr("id", "5000 - id as wanted"), "numbers")
    found = in_written_order(kept, "place")
    assert found.columns == ["id", "wanted", "place"] and found.count() == 5000
    assert found.where("place <> wanted").isEmpty()
    held = in_written_order(spark.createDataFrame([(1,), (2,)], "id long"), "place")
    assert [r["id"] for r in held.orderBy("place").collect()] == [1, 2]
