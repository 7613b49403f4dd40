"""Mixing sources to target weights by proportionate-fair scheduling.

Each source's documents are shuffled by hash and cut into blocks of equally many documents. With a share w of the total weight,
an exact fraction, the source's i-th block (from 0) has the release time floor(i / w) and the deadline ceil((i + 1) / w); the
released block with the earliest deadline takes the next slot, the smaller name on ties. At every slot of a phase each source is
then less than one block off its share, however long the phase. A phase ends when a source has no more blocks; the rest share its
weight from there on.

The slots of a phase are cut into rounds that executors schedule independently, and all rounds together are the schedule that one
pass over all slots would give. A round starts 1 / w slots early, for the least w, from any state that deadlines allow: each source
has floor(t w) blocks behind it or one more, and those with the earliest deadlines have the one more. What is done by a later slot T
is the set of blocks that is first in the order of deadlines among all that fit into the slots since their releases, and a
block under way at T was released less than 1 / w slots before it. So nothing before T - 1 / w bears on it, and every start leads to the
same blocks. The driver goes slot by slot only near the end of each phase, some 2 / w slots, to find where it ends.

Nulls and odd cases: a null source counts as the empty one. Documents with null or repeated ids are kept; equal rows share
the places that follow each other. Nothing is dropped or repeated. A weight of a source without documents is ignored; a
source without a weight, or more than ``MAX_SOURCES`` sources, is refused. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction
from itertools import accumulate
from math import ceil, lcm

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyfold.llm.common import ship_code

MAX_SOURCES = 1000
#: Documents in a block, blocks in a part of the schedule, blocks that are broadcast, documents that rank in one window.
BLOCK_DOCUMENTS = 4
PART_BLOCKS = 1000
BROADCAST_BLOCKS = 1_000_000
#: Slots of a round, more where a source's share is below one in so many.
ROUND_SLOTS = 200_000
CHUNK_DOCUMENTS = 20_000
#: Target weights are the sources' document counts to this power.
TEMPERATURE = 0.5


def whole_shares(weights: dict[str, float]) -> dict[str, int]:
    """Whole numbers in the proportions of ``weights``.

    A float that some fraction of a small denominator rounds to stands for it, so 0.1 is a tenth; others, and all if that would
    give numbers of over 256 bits, are what their bits say.
    """

    def simple(w: float) -> Fraction:
        near = Fraction(w).limit_denominator(10_000)
        return near if float(near) == w else Fraction(w)

    exact = {s: simple(w) for s, w in weights.items()}
    if lcm(*(w.denominator for w in exact.values())).bit_length() > 256:
        exact = {s: Fraction(w) for s, w in weights.items()}
    unit = lcm(*(w.denominator for w in exact.values()))
    return {s: int(w * unit) for s, w in exact.items()}


class Interleaving:
    """Earliest deadline first over endless sources, from a slot on. ``done`` counts the blocks of each source before the next slot."""

    def __init__(self, shares: dict[str, int], slot: int) -> None:
        self.shares, self.total = shares, sum(shares.values())
        self.slot = max(0, slot - ceil(Fraction(self.total, min(shares.values()))))
        self.done = {s: self.slot * q // self.total for s, q in shares.items()}
        under_way = sorted((self._deadline(s), s) for s, q in shares.items() if self.slot * q % self.total)
        for _, s in under_way[: self.slot - sum(self.done.values())]:
            self.done[s] += 1
        self.ready: list[tuple[int, str]] = []
        self.waiting = [(self._release(s), s) for s in shares]
        heapq.heapify(self.waiting)
        while self.slot < slot:
            self.take()

    def _release(self, s: str) -> int:
        return self.done[s] * self.total // self.shares[s]

    def _deadline(self, s: str) -> int:
        return -(-(self.done[s] + 1) * self.total // self.shares[s])

    def take(self) -> str:
        """The source of the next slot."""
        while self.waiting and self.waiting[0][0] <= self.slot:
            s = heapq.heappop(self.waiting)[1]
            heapq.heappush(self.ready, (self._deadline(s), s))
        s = heapq.heappop(self.ready)[1]
        self.done[s] += 1
        self.slot += 1
        heapq.heappush(self.waiting, (self._release(s), s))
        return s


@dataclass(frozen=True)
class Phase:
    """Slots from ``start`` on for the sources in ``before``, which had so many blocks in earlier phases."""

    start: int
    slots: int
    before: dict[str, int]

    def shares(self, weights: dict[str, float]) -> dict[str, int]:
        return whole_shares({s: weights[s] for s in self.before})


def phases(blocks: dict[str, int], weights: dict[str, float]) -> Iterator[Phase]:
    """One after the other; with each ends a source."""
    left, start = {s: n for s, n in blocks.items() if n > 0}, 0
    while left:
        before = {s: blocks[s] - n for s, n in left.items()}
        shares = whole_shares({s: weights[s] for s in left})
        total = sum(shares.values())
        run = Interleaving(shares, min((n - 1) * total // shares[s] for s, n in left.items()))
        while run.done[s := run.take()] < left[s]:
            pass
        yield Phase(start, run.slot, before)
        start += run.slot
        left = {s: n - run.done[s] for s, n in left.items() if n > run.done[s]}


def round_parts(phase: Phase, shares: dict[str, int], first: int, end: int, part_blocks: int) -> Iterator[tuple[str, int, int, list[int]]]:
    """What a phase's slots ``first`` to ``end`` (excluded) give: source, part, first block, and the slots of the blocks from it on."""
    run = Interleaving(shares, first)
    begun, taken = dict(run.done), {s: [] for s in shares}
    for slot in range(phase.start + first, phase.start + end):
        taken[run.take()].append(slot)
    for s, slots in taken.items():
        block, at = phase.before[s] + begun[s], 0
        while at < len(slots):
            more = slots[at : at + part_blocks - block % part_blocks]
            yield s, block // part_blocks, block, more
            block, at = block + len(more), at + len(more)


def schedule(
    spark: SparkSession, blocks: dict[str, int], weights: dict[str, float], part_blocks: int = PART_BLOCKS, round_slots: int = ROUND_SLOTS
) -> DataFrame:
    """``source, part, slots``: the slots of a source's blocks, ``part_blocks`` to a part."""
    ship_code(spark)
    plan = list(phases(blocks, weights))
    shares = [p.shares(weights) for p in plan]
    lengths = [max(round_slots, sum(q.values()) // min(q.values())) for q in shares]
    ends = list(accumulate(ceil(p.slots / n) for p, n in zip(plan, lengths, strict=True)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for number in batch["id"].tolist():
                k = bisect_right(ends, number)
                first = (number - (ends[k - 1] if k else 0)) * lengths[k]
                rows = round_parts(plan[k], shares[k], first, min(plan[k].slots, first + lengths[k]), part_blocks)
                yield pd.DataFrame(rows, columns=["source", "part", "first", "slots"])

    rounds = ends[-1] if ends else 0
    pieces = spark.range(0, rounds, 1, max(1, min(rounds, 10_000))).mapInPandas(run, "source string, part long, first long, slots array<long>")
    ordered = F.sort_array(F.collect_list(F.struct("first", "slots")))
    return pieces.groupBy("source", "part").agg(F.flatten(F.transform(ordered, lambda p: p["slots"])).alias("slots"))


def temperature_weights(counts: dict[str, int], power: float = TEMPERATURE) -> dict[str, float]:
    return {s: n**power for s, n in counts.items()}


def mix(
    documents: DataFrame,
    weights: dict[str, float] | None = None,
    block_documents: int = BLOCK_DOCUMENTS,
    part_blocks: int = PART_BLOCKS,
    chunk_documents: int = CHUNK_DOCUMENTS,
) -> DataFrame:
    """``documents`` with the columns ``block``, ``slot`` and ``position`` added; ordering by ``position`` gives the mixture.

    ``weights`` default to the sources' document counts to the power ``TEMPERATURE``. A source's documents are ranked in
    chunks of hash ranges of about ``chunk_documents`` rows, so that no source needs one task.
    """
    spark = documents.sparkSession
    row = documents.select(
        F.struct("*").alias("row"),
        F.coalesce("source", F.lit("")).alias("source"),
        F.xxhash64("doc_id").alias("hash"),
        F.col("doc_id").alias("doc_id"),
    )
    sizes = row.groupBy("source").count().limit(MAX_SOURCES + 1).collect()
    counts = {r["source"]: r["count"] for r in sizes}
    if len(counts) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    weights = weights or temperature_weights(counts)
    if missing := [s for s in counts if not weights.get(s, 0) > 0]:
        raise ValueError(f"no weight for {missing[:5]}")
    blocks = {s: ceil(n / block_documents) for s, n in counts.items()}
    plan = schedule(spark, blocks, weights, part_blocks)
    if sum(blocks.values()) <= BROADCAST_BLOCKS:
        plan = F.broadcast(plan)

    chunks = max(1, ceil(sum(counts.values()) / chunk_documents))
    row = row.withColumn("chunk", F.pmod(F.shiftright("hash", 20), F.lit(chunks)))
    starts = (
        row.groupBy("source", "chunk")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("before", F.sum("n").over(Window.partitionBy("source").orderBy("chunk")) - F.col("n"))
        .drop("n")
    )
    place = F.row_number().over(Window.partitionBy("source", "chunk").orderBy("hash", "doc_id")) - 1
    ranked = (
        row.withColumn("place", place)
        .join(starts, ["source", "chunk"])
        .withColumn("place", F.col("before") + F.col("place"))
        .withColumn("block", F.floor(F.col("place") / block_documents))
        .withColumn("part", F.floor(F.col("block") / part_blocks))
        .join(plan, ["source", "part"])
    )
    slot = F.get("slots", F.pmod("block", F.lit(part_blocks)).cast("int"))
    return (
        ranked.withColumn("slot", slot)
        .select(
            "row.*",
            "block",
            "slot",
            (F.col("slot") * block_documents + F.pmod("place", F.lit(block_documents))).alias("position"),
        )
    )


def mixed_order(documents: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """``documents``, unchanged but for their order: the mixture's."""
    whole = mix(documents.select(F.struct("*").alias("kept"), "doc_id", "source"), weights)
    return whole.orderBy("position").select("kept.*")


def mixed_places(documents: DataFrame) -> DataFrame:
    """``doc_id, source, block, slot, position`` of each document under the default weights."""
    return mix(documents.select("doc_id", "source"))
