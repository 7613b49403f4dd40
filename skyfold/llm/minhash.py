"""Near-duplicates by fast similarity sketching, banding and exact verification.

A document's set holds the hashes of its distinct word shingles. Rounds of hashing place every element in a bin of the
sketch, and the first round that reaches a bin decides it by its least value; the second half of the rounds is tied to one bin
each, so that every coordinate fills. Coordinates of two sketches agree with the Jaccard similarity of the sets, with the
concentration of independent samples. With 40 bands of 5 coordinates a pair at similarity 0.8 shares no band with
probability 1e-7.

Equal sets first become one class, represented by its smallest id. In each band bucket the smallest representative is compared
with the others: a star, not all pairs. Links give components. Members of a bucket that are in different components still are
compared too; in a bucket of more than a few, only those that share one of their rarest shingles early enough to be similar, which
no similar pair fails to do. Pairs are confirmed on the full sets, rebuilt from whole texts in the task that compares them.
So documents of one component of a bucket need no comparison, and no link between components is lost.

Nulls and odd cases: a null or blank text has an empty set and is linked with nothing. A document without id takes no part: its
component is null and it is kept. Rows that share an id and its set are one document; an id whose rows hold different sets takes no
part: all its rows are kept, as a component of their own, so that no text goes for another's sake. A document with fewer words than a shingle has its word
sequence as the only element. Other columns are left out.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyfold.llm.common import Scratch
from skyfold.llm.components import components

#: Contract of the query, and what holds where no contract says otherwise.
QUERY_SHINGLE_WORDS = 2
SHINGLE_WORDS = 5
PERCENT = 80
BANDS, ROWS = 40, 5

#: Members of a bucket up to which those of different components are compared at once; larger ones are filtered first.
SMALL_BUCKET = 32

#: Texts hashed together, in bytes.
SLICE_BYTES = 1 << 20

U64 = np.uint64
_RANDOM = np.random.default_rng(20240607)
_BYTE = _RANDOM.integers(0, 1 << 64, 256, dtype=U64)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_IN_WORD = np.asarray([b not in b" \t\n\x0b\x0c\r" for b in range(256)])


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of lower-cased UTF-8 texts, in order, and each word's text number."""
    joined = np.frombuffer(b" " + b" ".join(t.translate(_LOWER) for t in texts) + b" ", np.uint8)
    inside = _IN_WORD[joined]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts, ends = edges[::2], edges[1::2]
    powers = np.full(len(joined) + 1, _BASE, U64)
    powers[0] = 1
    np.multiply.accumulate(powers, out=powers)
    sums = np.zeros(len(joined) + 1, U64)
    np.cumsum(_BYTE[joined] * powers[:-1], out=sums[1:])
    back = np.full(len(joined) + 1, _INVERSE, U64)
    back[0] = 1
    np.multiply.accumulate(back, out=back)
    words = mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(U64))
    first = np.cumsum([1] + [len(t) + 1 for t in texts])
    return words, np.searchsorted(first, starts, side="right") - 1


def shingle_sets(texts: list[bytes], k: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words, text = word_hashes(texts)
    bounds = np.searchsorted(text, np.arange(len(texts) + 1))
    n = len(words)
    shingles = words[: max(0, n - k + 1)].copy()
    for j in range(1, k):
        shingles = mix(shingles * U64(0x9E3779B97F4A7C15) + words[j : j + len(shingles)])
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= k:
            out.append(np.unique(shingles[a : b - k + 1]))
        elif b > a:
            h = words[a : a + 1].copy()
            for j in range(a + 1, b):
                h = mix(h * U64(0x9E3779B97F4A7C15) + words[j : j + 1])
            out.append(mix(h + U64(b - a)))
        else:
            out.append(np.zeros(0, U64))
    return out


def sketch(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """Fast similarity sketches of non-empty sets, one row each."""
    t = coordinates
    sizes = np.asarray([len(s) for s in sets])
    values, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    empty = U64(0xFFFFFFFFFFFFFFFF)
    out = np.full((len(sets), t), empty)
    flat = out.reshape(-1)
    for i in range(2 * t):
        h = mix(values + U64((i + 1) * 0xD1B54A32D192ED03 & 0xFFFFFFFFFFFFFFFF))
        value = U64(i << 32) | (h & U64(0xFFFFFFFF))
        if i < t:
            place = ((h >> U64(32)) * U64(t)) >> U64(32)
            np.minimum.at(flat, owner * t + place.astype(np.int64), value)
        else:
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            least = np.minimum.reduceat(value, starts)
            out[owner[starts], i - t] = np.minimum(out[owner[starts], i - t], least)
        todo = (out == empty).any(axis=1)
        if not todo.any():
            break
        left = todo[owner]
        values, owner = values[left], owner[left]
    return out


def band_keys(sketches: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts = sketches.reshape(len(sketches), bands, rows)
    keys = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=U64)), parts.shape[:2]).copy()
    for r in range(rows):
        keys = mix(keys * U64(0x9E3779B97F4A7C15) + parts[:, :, r])
    return keys.view(np.int64)


def _slices(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, list[bytes]]]:
    """The rows of a batch in runs of bounded bytes: first row and texts."""
    start, size, texts = 0, 0, []
    for i, value in enumerate(batch.column(column).cast(pa.binary())):
        text = value.as_py() or b""
        if texts and size + len(text) > SLICE_BYTES:
            yield start, texts
            start, size, texts = i, 0, []
        texts.append(text)
        size += len(text)
    if texts:
        yield start, texts


def sketched(documents: DataFrame, k: int) -> DataFrame:
    """``doc_id, n_shingles, set_a, set_b, bands``: the set's size, its 128-bit digest and its band keys (null if empty)."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_a", pa.int64()), ("set_b", pa.int64()), ("bands", pa.list_(pa.int64()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for start, texts in _slices(batch, 1):
                sets = shingle_sets(texts, k)
                full = [s for s in sets if len(s)]
                keys = iter(band_keys(sketch(full, BANDS * ROWS), BANDS, ROWS) if full else [])
                with np.errstate(over="ignore"):
                    a = [int(np.sum(mix(s)).astype(np.int64)) if len(s) else 0 for s in sets]
                    b = [int(np.sum(mix(s ^ U64(0xA5A5A5A55A5A5A5A))).astype(np.int64)) if len(s) else 0 for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(start, len(texts)),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(a, pa.int64()),
                        pa.array(b, pa.int64()),
                        pa.array([next(keys) if len(s) else None for s in sets], pa.list_(pa.int64())),
                    ],
                    schema=schema,
                )

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>"
    )


def _may_link(n: str, m: str) -> Column:
    """Sets of these sizes can reach the similarity."""
    return 100 * F.least(n, m) >= PERCENT * F.greatest(n, m)


def compressed_texts(documents: DataFrame, ids: DataFrame) -> DataFrame:
    """``doc_id, packed`` of the documents in ``ids``: whole texts, compressed for the joins that bring pairs together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                packed = [writer.compress(t or b"") for t in part.column(1).cast(pa.binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(packed, pa.binary())], names=["doc_id", "packed"])

    texts = documents.select(F.col("doc_id").cast("long"), "text").join(ids, "doc_id", "left_semi")
    return texts.dropDuplicates(["doc_id"]).mapInArrow(run, "doc_id long, packed binary")


def confirmed(pairs: DataFrame, texts: DataFrame, k: int) -> DataFrame:
    """Of the pairs ``a, b`` those whose full sets reach the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = zstandard.ZstdDecompressor()
        recent: OrderedDict[int, np.ndarray] = OrderedDict()

        def set_of(doc_id: int, packed: pa.Scalar) -> np.ndarray:
            if doc_id not in recent:
                recent[doc_id] = shingle_sets([reader.decompress(packed.as_py())], k)[0]
                if len(recent) > 32:
                    recent.popitem(last=False)
            recent.move_to_end(doc_id)
            return recent[doc_id]

        for batch in batches:
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            linked = []
            for x, y, p, q in zip(a, b, batch.column("packed_a"), batch.column("packed_b"), strict=True):
                s, t = set_of(x, p), set_of(y, q)
                both = len(np.intersect1d(s, t, assume_unique=True))
                linked.append(100 * both >= PERCENT * (len(s) + len(t) - both))
            keep = pa.array(linked, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(keep)

    return (
        pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("packed").alias("packed_a")), "a")
        .join(texts.select(F.col("doc_id").alias("b"), F.col("packed").alias("packed_b")), "b")
        .select("a", "b", "packed_a", "packed_b")
        .mapInArrow(run, "a long, b long")
    )


def _across(rows: DataFrame) -> DataFrame:
    """Pairs ``a, b`` of different labels that meet under a ``key`` and can still be similar.

    ``place`` counts the shingles of a set that come before the key in an order common to all sets, so at most ``n - place`` are
    shared. Only rows outside a key's most frequent label look for partners: those inside are linked already.
    """
    main = (
        rows.groupBy("key", "label")
        .agg(F.count(F.lit(1)).alias("members"))
        .groupBy("key")
        .agg(F.max_by("label", F.struct("members", "label")).alias("main"), F.count(F.lit(1)).alias("labels"))
        .where("labels > 1")
        .select("key", "main")
    )
    met = rows.join(main, "key")
    others = met.where("label != main").select("key", *[F.col(c).alias(f"x_{c}") for c in ("rep", "n", "label", "place")])
    most = F.least(F.col("n") - F.col("place"), F.col("x_n") - F.col("x_place"))
    return (
        met.join(others, "key")
        .where("x_label != label and (label = main or x_rep < rep)")
        .where((100 + PERCENT) * most >= PERCENT * (F.col("n") + F.col("x_n")))
        .select(F.least("rep", "x_rep").alias("a"), F.greatest("rep", "x_rep").alias("b"))
        .distinct()
    )


def _first_shingles(reps: DataFrame, texts: DataFrame, k: int) -> DataFrame:
    """Of each set in ``reps`` the shingles of which a similar set must share one: the rarest, with their places.

    Shingles are ordered by how many of these sets hold them. The first common shingle of two similar sets comes early in both,
    or what is left is too little. A copy with many edits of its own starts with those and so meets no other.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = zstandard.ZstdDecompressor()
        for batch in batches:
            for rep, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                held = shingle_sets([reader.decompress(text.as_py())], k)[0]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(held), rep)), pa.array(held.view(np.int64))], names=["rep", "key"])

    held = (
        texts.select(F.col("doc_id").alias("rep"), "packed").join(reps.select("rep"), "rep", "left_semi").mapInArrow(run, "rep long, key long")
    )
    order = Window.partitionBy("rep").orderBy("sets", "key")
    return (
        held.join(held.groupBy("key").agg(F.count(F.lit(1)).alias("sets")), "key")
        .withColumn("place", F.row_number().over(order) - 1)
        .where("sets > 1")
        .join(reps, "rep")
        .where(100 * F.col("place") <= (100 - PERCENT) * F.col("n"))
        .select("key", "rep", "n", "label", "place")
    )


def near_duplicates(documents: DataFrame, scratch: Scratch, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of each document; a component keeps its smallest id."""
    k = shingle_words
    sketches = scratch.keep(sketched(documents, k), "sketches")
    digest = ["n_shingles", "set_a", "set_b"]
    torn = scratch.keep(
        sketches.where("doc_id is not null")
        .groupBy("doc_id")
        .agg(*[f(F.struct(*digest)).alias(n) for n, f in (("least", F.min), ("most", F.max))])
        .where("least != most")
        .select("doc_id"),
        "torn",
    )
    filled = sketches.where("n_shingles > 0 and doc_id is not null").join(torn, "doc_id", "left_anti")
    classes = scratch.keep(
        filled.groupBy(*digest).agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands")), "classes"
    )
    in_bands = classes.select(F.explode("bands").alias("key"), "rep", F.col("n_shingles").alias("n"))
    centers = (
        in_bands.groupBy("key")
        .agg(F.min(F.struct("rep", "n")).alias("center"), F.count(F.lit(1)).alias("members"))
        .where("members > 1")
        .select("key", F.col("center.rep").alias("center"), F.col("center.n").alias("center_n"))
    )
    buckets = scratch.keep(in_bands.join(centers, "key"), "buckets")

    star = (
        buckets.where(F.col("rep") != F.col("center"))
        .where(_may_link("n", "center_n"))
        .select(F.col("center").alias("a"), F.col("rep").alias("b"))
        .distinct()
    )
    star = scratch.keep(star, "star")
    ids = buckets.select(F.col("rep").alias("doc_id")).distinct()
    texts = scratch.keep(compressed_texts(documents, ids), "texts")
    links = scratch.keep(confirmed(star, texts, k), "star-links")
    labels = components(links, scratch, "first")

    labelled = scratch.keep(
        buckets.join(labels.withColumnRenamed("id", "rep"), "rep", "left").withColumn("label", F.coalesce("label", "rep")),
        "labelled",
    )
    sizes = (
        labelled.groupBy("key")
        .agg(F.count(F.lit(1)).alias("members"), F.min("label").alias("least"), F.max("label").alias("most"))
        .where("least < most")
        .select("key", "members")
    )
    mixed = scratch.keep(labelled.join(sizes, "key").select("key", "rep", "n", "label", "members"), "mixed")
    small = mixed.where(F.col("members") <= SMALL_BUCKET).withColumn("place", F.lit(0)).drop("members")
    large = mixed.where(F.col("members") > SMALL_BUCKET).select("rep", "n", "label").distinct()
    across = _across(small).union(_across(_first_shingles(large, texts, k))).distinct()
    across = scratch.keep(across, "across")
    if not across.isEmpty():
        links = links.union(scratch.keep(confirmed(across, texts, k), "across-links"))
        labels = components(links, scratch, "second")

    placed = (
        sketches.drop("bands")
        .join(classes.select(*digest, "rep"), digest, "left")
        .join(labels.withColumnRenamed("id", "rep"), "rep", "left")
        .join(torn.withColumn("torn", F.lit(True)), "doc_id", "left")
    )
    component = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(
        F.when((F.col("n_shingles") == 0) | F.col("torn"), F.col("doc_id")).otherwise(F.coalesce("label", "rep"))
    )
    return placed.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def without_near_duplicates(documents: DataFrame, scratch: Scratch, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``documents`` without those that their component's smallest id stands for; columns as they were."""
    gone = near_duplicates(documents, scratch, shingle_words).where(~F.col("kept")).select("doc_id")
    return documents.join(gone, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in documents.columns])
