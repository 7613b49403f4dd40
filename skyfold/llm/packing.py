"""Best-fit packing of documents into bins of fixed length, without conflicts inside a bin.

A document longer than a bin is cut into full pieces and a rest. Pieces are dealt into groups of bounded size, by hash or, if
documents have positions, as consecutive stretches of these; each group is packed by itself, largest piece first. Its open bins are ordered by what they have left; every bin carries a bitmap
of the sources and one of the duplicate clusters it holds. A piece takes the bin with the least sufficient rest; when its
source or cluster is there already, the search goes on to the successor until the tightest compatible bin is found, or a new
bin is opened.

Nulls and odd cases: a null or blank text has length 0 and takes a place in some bin all the same. A null source or cluster
conflicts with nothing. Repeated documents are clusters of their own text, so they go to different bins. Nothing is dropped
or cut off. An empty table gives no bin. Other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterable
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyfold.llm.common import Scratch, words_of

CAPACITY = 2048
#: Pieces that one task packs together; a bin never holds pieces of two groups.
GROUP_PIECES = 8_000

PACKED = "doc_id long, piece int, length int, bin_id long, place int"


class OpenBins:
    """Bins by what they have left, under each rest by their source bitmap.

    ``rests`` has a bit for each rest at which some bin is open, so the successor of a rest is one step.
    """

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.rests = 0
        self.at: dict[int, dict[int, list[list[int]]]] = {}

    def add(self, rest: int, sources: int, clusters: int, number: int) -> None:
        self.at.setdefault(rest, {}).setdefault(sources, []).append([clusters, number])
        self.rests |= 1 << rest

    def take(self, need: int, source: int, cluster: int) -> tuple[int, int, int, int] | None:
        """Remove and return (rest, sources, clusters, number) of the tightest compatible bin.

        Of equally tight ones it is the bin opened first.
        """
        ahead = self.rests >> need
        rest = need
        while ahead:
            step = (ahead & -ahead).bit_length() - 1
            rest += step
            found = None
            for sources, bins in self.at[rest].items():
                if sources & source:
                    continue
                for k, (clusters, number) in enumerate(bins):
                    if not clusters & cluster and (found is None or number < found[3]):
                        found = k, sources, clusters, number
            if found:
                k, sources, clusters, number = found
                bins = self.at[rest][sources]
                del bins[k]
                if not bins:
                    del self.at[rest][sources]
                    if not self.at[rest]:
                        del self.at[rest]
                        self.rests &= ~(1 << rest)
                return rest, sources, clusters, number
            ahead >>= step + 1
            rest += 1
        return None


def _bits(keys: Iterable) -> list[int]:
    """A bit of its own for each key that occurs twice or more; others and nulls conflict with nothing and have none."""
    codes, _ = pd.factorize(pd.Series(keys))
    counts = np.bincount(codes[codes >= 0]) if (codes >= 0).any() else np.zeros(0, int)
    number = np.cumsum(counts > 1) - 1
    return [1 << int(number[c]) if c >= 0 and counts[c] > 1 else 0 for c in codes]


def pack_group(lengths: list[int], sources: list, clusters: list, capacity: int) -> list[int]:
    """The bin of each piece; pieces come in packing order, largest first."""
    bins, opened, out = OpenBins(capacity), 0, []
    for length, source, cluster in zip(lengths, _bits(sources), _bits(clusters), strict=True):
        found = bins.take(length, source, cluster)
        if found is None:
            found, opened = (capacity, 0, 0, opened), opened + 1
        rest, held_sources, held_clusters, number = found
        bins.add(rest - length, held_sources | source, held_clusters | cluster, number)
        out.append(number)
    return out


def _by_hash(pieces: DataFrame, group_pieces: int) -> DataFrame:
    """``pieces`` with ``group`` and ``order``: groups of about ``group_pieces``."""
    groups = max(1, ceil(pieces.count() / group_pieces))
    order = F.xxhash64("doc_id", "piece")
    return pieces.withColumn("order", order).withColumn("group", F.pmod(order, F.lit(groups)).cast("int"))


def _by_position(pieces: DataFrame, group_pieces: int) -> DataFrame:
    """``pieces`` with ``group`` and ``order``: each ``group_pieces`` that follow each other by position are a group.

    Pieces are numbered inside stretches of positions, so none of the sorts sees more than one stretch.
    """
    pieces = pieces.withColumn("stretch", F.floor(F.col("position") / group_pieces))
    starts = (
        pieces.groupBy("stretch")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("before", F.sum("n").over(Window.orderBy("stretch")) - F.col("n"))
        .drop("n")
    )
    nth = F.row_number().over(Window.partitionBy("stretch").orderBy("position", "piece")) - 1
    numbered = pieces.withColumn("nth", nth).join(starts, "stretch").withColumn("nth", F.col("before") + F.col("nth"))
    return numbered.withColumn("order", F.col("position")).withColumn("group", F.floor(F.col("nth") / group_pieces).cast("int"))


def pack(
    documents: DataFrame,
    scratch: Scratch,
    length: Column | None = None,
    cluster: Column | None = None,
    capacity: int = CAPACITY,
    group_pieces: int = GROUP_PIECES,
    position: Column | None = None,
) -> DataFrame:
    """``doc_id, piece, length, bin_id, place`` for every piece; ``place`` counts the pieces of a bin.

    ``length`` defaults to the number of words, ``cluster`` to the text itself, by its hash. With a ``position`` of each
    document only pieces that follow each other in that order share bins, and ``bin_id`` ascends with it from group to group.
    """
    length = F.size(words_of(F.col("text"))) if length is None else length
    cluster = F.when(F.length("text") > 0, F.xxhash64("text")) if cluster is None else cluster
    at = F.lit(None) if position is None else position
    items = documents.select(
        "doc_id", "source", length.cast("long").alias("whole"), cluster.alias("cluster"), at.cast("long").alias("position")
    )
    pieces = items.withColumn(
        "piece", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.col("whole") / capacity).cast("int") - 1)))
    ).select(
        "doc_id",
        "source",
        "cluster",
        "position",
        "piece",
        F.least(F.lit(capacity), F.col("whole") - F.col("piece") * capacity).cast("int").alias("length"),
    )
    pieces = scratch.keep(pieces, "pieces")
    def packed(rows: pd.DataFrame) -> pd.DataFrame:
        group = int(rows["group"].iloc[0])
        rows = rows.sort_values(["length", "order", "doc_id", "piece"], ascending=[False, True, True, True], kind="stable")
        rows = rows.reset_index(drop=True)
        number = pack_group(rows["length"].tolist(), rows["source"].tolist(), rows["cluster"].tolist(), capacity)
        out = rows[["doc_id", "piece", "length"]].copy()
        out["bin_id"] = np.asarray(number, dtype=np.int64) + (group << 32)
        out["place"] = out.groupby("bin_id").cumcount()
        return out

    dealt = _by_hash(pieces, group_pieces) if position is None else _by_position(pieces, group_pieces)
    return dealt.groupBy("group").applyInPandas(packed, PACKED)
