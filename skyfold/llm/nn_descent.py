"""Approximate nearest neighbours: a graph by NN-descent, searched greedily. Nearness is cosine.

The index is a table of directed edges, ``DEGREE`` a vector. It starts from neighbours inside small leaves (the vectors nearest to
one of a bounded number of pivots) and is improved by joins: every vector's neighbours, and those that have it as a neighbour, meet
at it with their vectors, and each pair of them that is closer than the farthest neighbour of one becomes a candidate edge. The
best edges of each vector stay, until few change. A search begins at a query's nearest pivots, and at its own node if it is
indexed, joins the best unvisited of what it has found with the graph, and ends when nothing better turns up. What it finds is scored exactly on the original vectors.

Only the pivots are a sample, of at most ``PIVOTS`` vectors, which bounds what is broadcast; every vector is indexed. A leaf
that is too large is dealt out by hash, and of a vector's neighbours, and of those that have it as one, a choice by hash meets in
each round, another one each time, so a vector near very many others stays one small group.

Nulls and odd cases: vectors that are null, empty, zero or hold null or non-finite components take no part, nor do rows without
id. Rows that share an id are one vector, the least. Equal vectors are one node with its smallest ids, as many as an answer can
hold. Of vectors of several lengths those of the most frequent length take part, the shorter one if two are as frequent. With fewer candidates than asked for, all are returned; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyfold.llm.common import Scratch, shuffle_partitions

NEIGHBOURS = 5
DEGREE = 40
PIVOTS = 512
#: Vectors for each pivot, as far as ``PIVOTS`` allows; leaves that a vector is in, one for each of its nearest pivots; vectors of a leaf.
PER_PIVOT = 200
LEAVES = 4
LEAF = 400
#: Rounds of descent at most, and the share of edges under which a round changes too little to go on.
ROUNDS = 10
STABLE = 0.01
#: Of a vector's neighbours, and of those that have it as one, how many meet at it in a round; another choice each round.
MEET = 24
#: Candidates that a vector gets from the vectors met together in one step of a task.
OFFERS = 10
#: Vectors that a search keeps, expands in a round, and starts from; rounds at most.
BEAM = 128
EXPAND = 24
ENTRIES = 8
SEARCH_ROUNDS = 12
GROUPS_AT_ONCE = 256


def usable(vector: Column) -> Column:
    """The vector has components, all finite, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def of_one_length(vectors: DataFrame) -> DataFrame:
    """The rows whose vectors have the length that most usable vectors have."""
    sizes = vectors.where(F.col("vec_id").isNotNull() & usable(F.col("embedding").cast("array<double>"))).groupBy(
        F.size("embedding").alias("length")
    )
    most = sizes.count().orderBy(F.desc("count"), "length").first()
    return vectors.where(F.size("embedding") == (most["length"] if most else 0))


def scaled(v: np.ndarray) -> np.ndarray:
    """Each row times the power of two that brings its largest component to between 1/2 and 1: exact, and safe to square."""
    return np.ldexp(v, -np.frexp(np.abs(v).max(axis=1, keepdims=True))[1])


def _matrix(column: pa.Array, kind: str = "<f4") -> np.ndarray:
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, kind).reshape(len(column), -1).astype(np.float32) if len(column) else np.zeros((0, 0), np.float32)


def _batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def nodes_of(vectors: DataFrame, keep_ids: int) -> DataFrame:
    """``id, ids, unit``: one row for each distinct usable vector, with its smallest ids and its unit vector as float32 bytes."""
    single = (
        vectors.select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("v"))
        .where(F.col("id").isNotNull() & usable(F.col("v")))
        .groupBy("id")
        .agg(F.min("v").alias("v"))
    )
    rank = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    merged = (
        single.withColumn("nth", rank)
        .where(F.col("nth") <= keep_ids)
        .groupBy("v")
        .agg(F.min("id").alias("id"), F.sort_array(F.collect_list("id")).alias("ids"))
    )
    schema = pa.schema([("id", pa.int64()), ("ids", pa.list_(pa.int64())), ("unit", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            v = np.asarray(batch.column("v").to_pylist(), np.float64)
            v = scaled(v)
            unit = (v / np.linalg.norm(v, axis=1, keepdims=True)).astype("<f4")
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("ids").cast(pa.list_(pa.int64())), pa.array([r.tobytes() for r in unit], pa.binary())],
                schema=schema,
            )

    return merged.select("id", "ids", "v").mapInArrow(run, "id long, ids array<long>, unit binary")


class Pivots:
    """A node for every ``PER_PIVOT`` and at most ``PIVOTS``, least by hash, with their unit vectors."""

    def __init__(self, nodes: DataFrame) -> None:
        wanted = min(PIVOTS, ceil(nodes.count() / PER_PIVOT))
        rows = nodes.select("id", "unit").orderBy(F.xxhash64("id"), "id").limit(wanted).collect()
        self.ids = np.asarray([r["id"] for r in rows], np.int64)
        self.units = np.stack([np.frombuffer(bytes(r["unit"]), "<f4") for r in rows]) if rows else np.zeros((0, 0), np.float32)


def _top(owner: np.ndarray, other: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Indices of the ``k`` best rows of each owner, each other once; ties to the smaller other."""
    order = np.lexsort((other, -score, owner))
    o, x = owner[order], other[order]
    twice = np.zeros(len(order), bool)
    pair = np.lexsort((np.arange(len(order)), x, o))
    twice[pair[1:]] = (o[pair[1:]] == o[pair[:-1]]) & (x[pair[1:]] == x[pair[:-1]])
    order, o = order[~twice], o[~twice]
    start = np.flatnonzero(np.concatenate([[True], o[1:] != o[:-1]])) if len(o) else np.zeros(0, int)
    rank = np.arange(len(o)) - np.repeat(start, np.diff(np.concatenate([start, [len(o)]])))
    return order[rank < k]


_EDGE = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("score", pa.float32())])
_EDGE_SQL = "u long, v long, score float"


def _leaf_edges(table: pa.Table) -> pa.Table:
    """The nearest of each vector inside its leaf."""
    ids, unit = table.column("id").to_numpy(), _matrix(table.column("unit").combine_chunks())
    score = unit @ unit.T
    np.fill_diagonal(score, -2)
    k = min(DEGREE, len(ids) - 1)
    if k < 1:
        return _EDGE.empty_table()
    best = np.argpartition(-score, k - 1, axis=1)[:, :k]
    u = np.repeat(np.arange(len(ids)), k)
    return pa.Table.from_batches([_batch(_EDGE, ids[u], ids[best.ravel()], score[u, best.ravel()])])


def first_edges(nodes: DataFrame, pivots: Pivots) -> DataFrame:
    """Edges inside leaves of at most about ``LEAF`` vectors that have a pivot among their ``LEAVES`` nearest."""
    units = nodes.sparkSession.sparkContext.broadcast(pivots.units)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = _matrix(batch.column("unit")) @ units.value.T
            near = np.argsort(-score, axis=1, kind="stable")[:, :LEAVES]
            for j in range(near.shape[1]):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), batch.column("unit"), pa.array(near[:, j], pa.int64())], names=["id", "unit", "cell"]
                )

    in_cells = nodes.select("id", "unit").mapInArrow(run, "id long, unit binary, cell long")
    sizes = {r["cell"]: r["count"] for r in in_cells.groupBy("cell").count().collect()}
    parts = nodes.sparkSession.createDataFrame([(c, ceil(n / LEAF)) for c, n in sizes.items()] or [(0, 1)], "cell long, parts int")
    leaf = F.pmod(F.xxhash64("id", "cell"), "parts")
    return (
        in_cells.join(F.broadcast(parts), "cell")
        .withColumn("leaf", leaf)
        .groupBy("cell", "leaf")
        .applyInArrow(_leaf_edges, _EDGE_SQL)
    )


def best_edges(edges: DataFrame) -> DataFrame:
    """The ``DEGREE`` best distinct edges of each vector."""
    rank = F.row_number().over(Window.partitionBy("u").orderBy(F.desc("score"), "v"))
    return (
        edges.groupBy("u", "v").agg(F.max("score").alias("score")).withColumn("nth", rank).where(F.col("nth") <= DEGREE).drop("nth")
    )


def _meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidate edges between those that meet at one vector; rows come ordered by it."""

    def flush(table: pa.Table) -> Iterator[pa.RecordBatch]:
        at = table.column("at").to_numpy()
        ids, worst = table.column("id").to_numpy(), table.column("worst").to_numpy()
        unit = _matrix(table.column("unit").combine_chunks(), "<f2")
        start = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        size = np.diff(np.concatenate([start, [len(at)]]))
        for g in range(0, len(start), GROUPS_AT_ONCE):
            s, n = start[g : g + GROUPS_AT_ONCE], size[g : g + GROUPS_AT_ONCE]
            width = int(n.max())
            index = np.minimum(s[:, None] + np.arange(width), len(at) - 1)
            real = np.arange(width)[None, :] < n[:, None]
            vectors = unit[index]
            score = vectors @ vectors.transpose(0, 2, 1)
            good = real[:, :, None] & real[:, None, :] & (score > worst[index][:, :, None])
            good &= ids[index][:, :, None] != ids[index][:, None, :]
            group, a, b = np.nonzero(good)
            u, v, found = ids[index[group, a]], ids[index[group, b]], score[group, a, b]
            keep = _top(u, v, found, OFFERS)
            yield _batch(_EDGE, u[keep], v[keep], found[keep])

    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        at = held.column("at").to_numpy()
        cut = int(np.searchsorted(at, at[-1])) if len(at) else 0
        if cut:
            yield from flush(held.slice(0, cut))
            held = held.slice(cut)
    if held is not None and held.num_rows:
        yield from flush(held)


def descend(edges: DataFrame, nodes: DataFrame, step: int) -> DataFrame:
    """One round: the edges with the candidates that its meetings give, best ones only."""
    spark = edges.sparkSession
    both = edges.select(F.col("u").alias("at"), F.col("v").alias("id"), F.lit(0).alias("side")).union(
        edges.select("v", "u", F.lit(1))
    )
    nth = F.row_number().over(Window.partitionBy("at", "side").orderBy(F.xxhash64("at", "id", F.lit(step)), "id"))
    meet = both.withColumn("nth", nth).where(F.col("nth") <= MEET).select("at", "id").distinct()
    worst = edges.groupBy(F.col("u").alias("id")).agg(
        F.when(F.count(F.lit(1)) < DEGREE, F.lit(-2.0)).otherwise(F.min("score")).cast("float").alias("worst")
    )

    def halves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit = _matrix(batch.column("unit")).astype("<f2")
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([r.tobytes() for r in unit], pa.binary()), batch.column("worst")], names=["id", "unit", "worst"]
            )

    members = (
        nodes.select("id", "unit")
        .join(worst, "id", "left")
        .withColumn("worst", F.coalesce("worst", F.lit(-2.0).cast("float")))
        .mapInArrow(halves, "id long, unit binary, worst float")
    )
    candidates = (
        meet.join(members, "id")
        .select("at", "id", "unit", "worst")
        .repartition(shuffle_partitions(spark), "at")
        .sortWithinPartitions("at")
        .mapInArrow(_meetings, _EDGE_SQL)
    )
    return best_edges(edges.union(candidates))


def build_graph(nodes: DataFrame, pivots: Pivots, scratch: Scratch) -> DataFrame:
    """The edge table ``u, v, score`` of all nodes."""
    edges = scratch.keep(best_edges(first_edges(nodes, pivots)), "graph-0")
    total = edges.count()
    for step in range(1, ROUNDS + 1):
        new = scratch.keep(descend(edges, nodes, step), f"graph-{step}")
        count = new.count()
        same = new.join(edges, ["u", "v"], "left_semi").count()
        scratch.drop(f"graph-{step - 1}")
        edges = new
        if count - same <= STABLE * total:
            break
        total = count
    return edges


_FOUND = pa.schema([("query", pa.int64()), ("id", pa.int64()), ("score", pa.float32()), ("visited", pa.bool_())])
_FOUND_SQL = "query long, id long, score float, visited boolean"


def _scored(pairs: DataFrame, queries: DataFrame, nodes: DataFrame) -> DataFrame:
    """Scores of ``query, id`` pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = np.einsum("ij,ij->i", _matrix(batch.column("q")), _matrix(batch.column("unit")))
            yield _batch(_FOUND, batch.column("query"), batch.column("id"), score.astype(np.float32), np.zeros(len(score), bool))

    return (
        pairs.join(nodes.select("id", "unit"), "id")
        .join(queries.select("query", F.col("unit").alias("q")), "query")
        .select("query", "id", "q", "unit")
        .mapInArrow(run, _FOUND_SQL)
    )


def search(
    queries: DataFrame,
    edges: DataFrame,
    nodes: DataFrame,
    pivots: Pivots,
    scratch: Scratch,
    indexed: DataFrame | None = None,
) -> DataFrame:
    """``query, id, score`` of at most ``BEAM`` nodes found for each row ``query, unit`` of ``queries``.

    A search starts from the nearest pivots, and from the query's own node where ``indexed`` has it as ``query, id``.
    """
    shared = queries.sparkSession.sparkContext.broadcast(pivots)

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = _matrix(batch.column("unit")) @ shared.value.units.T
            k = min(ENTRIES, score.shape[1])
            best = np.argsort(-score, axis=1, kind="stable")[:, :k]
            rows = np.repeat(np.arange(batch.num_rows), k)
            query = batch.column("query").to_numpy()[rows]
            yield _batch(_FOUND, query, shared.value.ids[best.ravel()], score[rows, best.ravel()], np.zeros(len(rows), bool))

    begin = queries.select("query", "unit").mapInArrow(enter, _FOUND_SQL)
    if indexed is not None:
        own = queries.select("query").join(indexed, "query").select("query", "id", F.lit(1.0).cast("float"), F.lit(False))
        begin = begin.union(own).groupBy("query", "id", "visited").agg(F.max("score").alias("score")).select(*_FOUND.names)
    beam = scratch.keep(begin, "beam-0")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id"))
    turn = F.row_number().over(Window.partitionBy("query", "visited").orderBy(F.desc("score"), "id"))
    for step in range(1, SEARCH_ROUNDS + 1):
        open_ = beam.withColumn("turn", turn).where(~F.col("visited") & (F.col("turn") <= EXPAND)).select("query", "id")
        reached = (
            open_.join(edges.select(F.col("u").alias("id"), F.col("v").alias("next")), "id")
            .select("query", F.col("next").alias("id"))
            .distinct()
            .join(beam.select("query", "id"), ["query", "id"], "left_anti")
        )
        seen = beam.withColumn("turn", turn).withColumn("visited", F.col("visited") | (F.col("turn") <= EXPAND)).drop("turn")
        new = seen.union(_scored(reached, queries, nodes)).withColumn("nth", rank).where(F.col("nth") <= BEAM).drop("nth")
        beam_next = scratch.keep(new, f"beam-{step}")
        scratch.drop(f"beam-{step - 1}")
        beam = beam_next
        if beam.where("not visited").isEmpty():
            break
    return beam.select("query", "id", "score")


def nearest(vectors: DataFrame, queries: Column, scratch: Scratch, k: int = NEIGHBOURS) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of each row of ``vectors`` that ``queries`` holds for.

    Every other row is a candidate. Scores are cosines of the original vectors in double precision.
    """
    vectors = of_one_length(vectors)
    nodes = scratch.keep(nodes_of(vectors, k + 1), "nodes")
    pivots = Pivots(nodes)
    if not len(pivots.ids):
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    edges = build_graph(nodes, pivots, scratch)
    originals = (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
        .where(F.col("vec_id").isNotNull() & usable(F.col("v")))
        .groupBy("vec_id")
        .agg(F.min("v").alias("v"))
    )
    asked = originals.where(queries).select(F.col("vec_id").alias("query"), F.col("v").alias("q"))

    def unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            v = np.asarray(batch.column("q").to_pylist(), np.float64)
            v = scaled(v)
            v = (v / np.linalg.norm(v, axis=1, keepdims=True)).astype("<f4")
            yield pa.RecordBatch.from_arrays([batch.column("query"), pa.array([r.tobytes() for r in v], pa.binary())], names=["query", "unit"])

    units = scratch.keep(asked.mapInArrow(unit, "query long, unit binary"), "queries")
    found = search(units, edges, nodes, pivots, scratch, nodes.select(F.explode("ids").alias("query"), "id"))
    pairs = (
        found.join(nodes.select("id", "ids"), "id")
        .select("query", F.explode("ids").alias("vec_id"))
        .where("query != vec_id")
        .join(originals, "vec_id")
        .join(asked, "query")
    )

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (scaled(np.asarray(batch.column(c).to_pylist(), np.float64)) for c in ("q", "v"))
            score = (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))
            yield pa.RecordBatch.from_arrays([batch.column("query"), batch.column("vec_id"), pa.array(score)], names=["query_id", "vec_id", "score"])

    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return (
        pairs.select("query", "vec_id", "q", "v")
        .mapInArrow(exact, "query_id long, vec_id long, score double")
        .withColumn("rank", rank)
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
