from __future__ import annotations

import random
from fractions import Fraction
from math import ceil

import pytest
from pyspark.sql import functions as F

from skyfold.llm.mixing import mix, mixed_order, phases, round_parts, schedule, temperature_weights


def naive(blocks, weights):
    """The source of every slot: a look at all released blocks, slot by slot, in exact fractions."""
    left, out = {s: n for s, n in blocks.items() if n}, []
    while left:
        total, done, slot = sum(Fraction(weights[s]) for s in left), dict.fromkeys(left, 0), 0
        while all(done[s] < n for s, n in left.items()):
            share = {s: Fraction(weights[s]) / total for s in left}
            released = [s for s in left if done[s] / share[s] // 1 <= slot]
            s = min(released, key=lambda s: (ceil((done[s] + 1) / share[s]), s))
            out.append(s)
            done[s] += 1
            slot += 1
        left = {s: n - done[s] for s, n in left.items() if n > done[s]}
    return out


def owners(blocks, weights, round_slots):
    """The same from rounds of ``round_slots``, each scheduled by itself; also checks that a source's blocks ascend."""
    out, seen = {}, dict.fromkeys(blocks, 0)
    for phase in phases(blocks, weights):
        shares = phase.shares(weights)
        for first in range(0, phase.slots, round_slots):
            for s, part, block, slots in round_parts(phase, shares, first, min(phase.slots, first + round_slots), 7):
                assert block == seen[s] and part == block // 7 and (block + len(slots) - 1) // 7 == part
                seen[s] += len(slots)
                out.update(dict.fromkeys(slots, s))
    assert seen == blocks and sorted(out) == list(range(sum(blocks.values())))
    return [out[t] for t in range(len(out))]


@pytest.mark.parametrize("seed", range(60))
def test_rounds_give_the_schedule_of_one_pass(seed):
    r = random.Random(seed)
    power = r.choice([0, 1, 3, 6])
    weights = {f"s{i}": r.random() ** power + r.choice([1e-4, 0.01]) for i in range(r.randint(1, 12))}
    if seed % 4 == 0:
        weights = {s: Fraction(r.randint(1, 5)) for s in weights}
    blocks = {s: r.choice([0, 1, r.randint(0, 60)]) for s in weights}
    expected = naive(blocks, weights)
    for round_slots in (1, r.randint(2, 20), 50, 10_000):
        assert owners(blocks, weights, round_slots) == expected


@pytest.mark.parametrize(
    "weights",
    [
        {"hot": 60_000**0.5, **{f"s{i}": (100 + 7 * i) ** 0.5 for i in range(19)}},
        {"a": Fraction(1), "b": Fraction(1, 100_000), "c": Fraction(3, 10)},
        {f"s{i}": Fraction(1, (i + 1) ** 2) for i in range(40)},
    ],
)
def test_every_source_is_less_than_one_block_off_its_share(weights):
    length, total = 30_000, sum(Fraction(w) for w in weights.values())
    phase = next(phases(dict.fromkeys(weights, length), weights))
    owner = {}
    for first in range(0, length, 700):
        for s, _, _, slots in round_parts(phase, phase.shares(weights), first, first + 700, 1000):
            owner.update(dict.fromkeys(slots, s))
    share = {s: Fraction(w) / total for s, w in weights.items()}
    done, bound = dict.fromkeys(weights, 0), {s: (q.numerator, q.denominator) for s, q in share.items()}
    for t in range(1, length + 1):
        done[owner[t - 1]] += 1
        assert all(abs(done[s] * d - t * n) < d for s, (n, d) in bound.items())


def test_rounds_on_executors_give_every_block_its_slot(spark):
    blocks, weights = {"a": 700, "b": 90, "c": 1, "d": 0}, {"a": Fraction(3, 10), "b": Fraction(1, 5), "c": Fraction(1, 100), "d": 1.0}
    found = {(r["source"], r["part"]): r["slots"] for r in schedule(spark, blocks, weights, 50, 120).collect()}
    got = {slot: s for (s, _), slots in found.items() for slot in slots}
    assert [got[t] for t in range(791)] == naive(blocks, weights)
    assert all(found[s, p] == sorted(found[s, p]) for s, p in found) and set(found) >= {("a", 13), ("b", 1), ("c", 0)}
    assert len(found["a", 13]) == 50 and len(found["b", 1]) == 40


def rows(n):
    return [(i, f"t{i}", "hot" if i % 3 else f"s{i % 7}") for i in range(n)]


def test_mixture_is_whole_and_near_its_weights(documents):
    docs = documents(rows(1200))
    found = mix(docs, {"hot": 0.25, **{f"s{i}": 0.75 / 7 for i in range(7)}}, block_documents=1, chunk_documents=50)
    got = sorted(found.collect(), key=lambda r: r["position"])
    assert sorted(r["doc_id"] for r in got) == list(range(1200))
    assert [r["position"] for r in got] == list(range(1200))
    first = min(max(k for k, r in enumerate(got) if r["source"] == f"s{i}") for i in range(7))
    for k in range(1, first):
        assert abs(sum(r["source"] == "hot" for r in got[:k]) - k * 0.25) < 1


@pytest.mark.parametrize("block_documents", [1, 3])
def test_positions_equal_a_naive_mixture(documents, block_documents):
    docs = documents(rows(400) + [(None, "n", None), (7, "t7", "hot"), (7, "t7", "hot")])
    ranked = sorted(
        (r["source"] or "", (r["h"] >> 20) % ceil(403 / 50), r["h"], -1 if r["doc_id"] is None else r["doc_id"])
        for r in docs.select("source", "doc_id", F.xxhash64("doc_id").alias("h")).collect()
    )
    queues = {s: [r[3] for r in ranked if r[0] == s] for s in {r[0] for r in ranked}}
    weights = temperature_weights({s: len(q) for s, q in queues.items()})
    expected = []
    for s in naive({s: ceil(len(q) / block_documents) for s, q in queues.items()}, weights):
        expected += queues[s][:block_documents]
        del queues[s][:block_documents]
    got = sorted(mix(docs, block_documents=block_documents, part_blocks=9, chunk_documents=50).collect(), key=lambda r: r["position"])
    assert [-1 if r["doc_id"] is None else r["doc_id"] for r in got] == expected


def test_blocks_stay_together_and_orders_repeat(documents):
    docs = documents(rows(500))
    a, b = (sorted(mix(docs.repartition(n), block_documents=4).collect(), key=lambda r: r["position"]) for n in (2, 5))
    assert a == b
    slots = {}
    for r in a:
        slots.setdefault(r["slot"], []).append(r)
    assert all(len({r["source"] for r in s}) == 1 and len(s) <= 4 for s in slots.values())
    assert len(slots) == sum(ceil(sum(r[2] == s for r in rows(500)) / 4) for s in {r[2] for r in rows(500)})


def test_a_schedule_too_large_for_a_broadcast_gives_the_same_places(documents, monkeypatch):
    docs = documents(rows(500))
    small = sorted(mix(docs, part_blocks=7).collect(), key=lambda r: r["position"])
    monkeypatch.setattr("skyfold.llm.mixing.BROADCAST_BLOCKS", 0)
    assert small == sorted(mix(docs, part_blocks=11).collect(), key=lambda r: r["position"])


def test_nulls_repeats_clashes_and_empty_tables(spark, documents):
    docs = documents([(None, None, None), (1, "a", "x"), (1, "a", "x"), (2, "", None), (3, "b", "")])
    odd = docs.withColumnsRenamed({"lang": "chunk", "n_chars": "block_"})
    got = mixed_order(odd)
    assert got.columns == odd.columns and got.exceptAll(odd).isEmpty() and got.count() == 5
    assert mix(docs.limit(0)).isEmpty()
    with pytest.raises(ValueError, match="no weight"):
        mix(docs, {"x": 1.0})
