"""Exact removal of long repeated passages, by interval expansion on a Burrows-Wheeler transform.

Every byte that a window of 50 bytes covers is removed if the window also starts in a document with a smaller id. Windows
are compared where they can be equal: each window has an anchor, the 32-byte string in it with the least hash, so equal
windows have equal anchors at equal places. The windows of an anchor's occurrence make a passage of at most 68 bytes. The steps,
each ending in a written table or a shuffle of compressed arrays:

1. Documents become blocks of bounded size; each block notes its anchors.
2. Blocks send each distinct passage once: its anchor's hash, its digest and its least id go to a hash bucket. Where an anchor
   has one form only, in two documents or more, that passage is a class of windows of its own, and the bucket answers with its
   least id. Where it has several, the bucket asks for the passages themselves. All else is unique and gets no answer.
3. Blocks mark what the first kind of answer removes, and cut out the distinct passages asked for.
4. A bucket joins those passages of all blocks: their suffixes are sorted, and the interval expansion in ``bwt`` finds the classes of
   windows that share 50 bytes. Each window gets its class's least id.
5. The classes go back to the blocks, which mark, join and cut the bytes.

A passage that a third of all documents share costs each block one entry. A bucket holds what its anchors occur in, as
distinct passages: with anchors of 32 bytes, that is little unless one such string has very many different surroundings.

Nulls and odd cases: a null text is empty. A document without id is never cut and never the reason for a cut. Documents that
share an id do not cut each other. Texts under 50 bytes stay. In cleaned text, a character that a cut splits goes with it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from skyfold.llm.blocks import NO_ID, Block, as_blocks, from_planes, packed, packed_keys, planes, runs, unpacked, unpacked_keys
from skyfold.llm.bwt import least_by_class
from skyfold.llm.common import Scratch, shuffle_partitions

#: Fixed value of the contract.
MIN_BYTES = 50
ANCHOR_BYTES = 32
WINDOWS = MIN_BYTES - ANCHOR_BYTES + 1
PASSAGE_BYTES = MIN_BYTES + WINDOWS - 1
#: Bytes hashed at once, and passage bytes that one transform takes unless a single anchor has more.
SLICE = 1 << 18
TRANSFORM_BYTES = 1 << 20
#: Occurrences of anchors that a bucket takes, at most about, before blocks combine equal passages.
BUCKET_ANCHORS = 1 << 20

U64 = np.uint64
_MULTIPLIERS = [U64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def anchor_hashes(text: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ``ANCHOR_BYTES`` bytes from each position on."""
    n = len(text) - ANCHOR_BYTES + 1
    if n <= 0:
        return np.zeros(0, U64)
    words = np.ndarray(len(text) - 7, "<u8", np.ascontiguousarray(text), strides=(1,))
    h = np.zeros(n, U64)
    for j, m in enumerate(_MULTIPLIERS):
        h = (h ^ words[8 * j : 8 * j + n]) * m
        h ^= h >> U64(29)
    return h


def _extreme(values: np.ndarray, width: int, of: np.ufunc) -> np.ndarray:
    """The least or largest of each ``width`` neighbours."""
    covered = 1
    while covered < width:
        step = min(covered, width - covered)
        values = of(values[:-step], values[step:])
        covered += step
    return values


def anchors_of(block: Block) -> np.ndarray:
    """Positions that are the anchor of some window of their document, ascending."""
    found = []
    for start, end in _document_slices(block):
        text = block.text[start:end]
        h = (anchor_hashes(text) >> U64(32)).astype(np.uint32)
        if len(h) < WINDOWS:
            continue
        least = _extreme(h, WINDOWS, np.minimum)
        wide = np.concatenate([np.zeros(WINDOWS - 1, np.uint32), least, np.zeros(WINDOWS - 1, np.uint32)])
        found.append(start + np.flatnonzero(_extreme(wide, WINDOWS, np.maximum) == h))
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)


def _document_slices(block: Block) -> Iterator[tuple[int, int]]:
    """Stretches of bounded length that together hold every window of every document; longer documents are overlapped."""
    for start, end in zip(block.bounds[:-1].tolist(), block.bounds[1:].tolist(), strict=True):
        at = start
        while end - at >= MIN_BYTES:
            yield at, min(end, at + SLICE)
            if at + SLICE >= end:
                break
            at += SLICE - (MIN_BYTES - 1)


def hashes_at(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """``anchor_hashes`` at some positions only."""
    if not len(at):
        return np.zeros(0, U64)
    words = np.ndarray(len(text) - 7, "<u8", np.ascontiguousarray(text), strides=(1,))
    h = np.zeros(len(at), U64)
    for j, m in enumerate(_MULTIPLIERS):
        h = (h ^ words[at + 8 * j]) * m
        h ^= h >> U64(29)
    return h


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    return ((h * U64(0xFF51AFD7ED558CCD) >> U64(24)) % U64(buckets)).astype(np.int64)


def _key(h: np.ndarray) -> np.ndarray:
    return (h & U64(0xFFFFFFFF)).astype(np.uint32)


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_arrays([pa.array([r[i] for r in rows], schema.field(i).type) for i in range(len(schema))], schema=schema)


_ROW = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("kind", pa.string()), ("payload", pa.binary())])
_ROW_SQL = "bucket long, block long, kind string, payload binary"


class Forms:
    """The distinct passages of a block: by bucket, anchor key and digest."""

    def __init__(self, block: Block, at: np.ndarray, buckets: int) -> None:
        h = hashes_at(block.text, at)
        self.first, self.count = _passages(block, at, h)
        some = self.count > 0
        self.first, self.count, self.h = self.first[some], self.count[some], h[some]
        self.sizes = self.count + MIN_BYTES - 1
        self.ids = block.ids[np.searchsorted(block.bounds, self.first, side="right") - 1]
        self.bucket, key = _bucket(self.h, buckets), _key(self.h)
        digest = np.empty(len(key), U64)
        for i in range(0, len(key), 1 << 16):
            part = slice(i, i + (1 << 16))
            digest[part] = _digest(_rows_at(block.text, self.first[part], self.sizes[part]), self.sizes[part]) >> U64(16)
        self.order = np.lexsort((digest, key, self.bucket))
        fresh = _fresh(self.bucket[self.order], key[self.order], digest[self.order])
        self.form = np.empty(len(key), np.int64)
        self.form[self.order] = np.cumsum(fresh) - 1
        starts = np.flatnonzero(fresh)
        chosen = self.order[starts]
        self.key, self.digest = key[chosen], digest[chosen]
        ordered = self.ids[self.order]
        self.least = np.minimum.reduceat(ordered, starts) if len(starts) else ordered
        self.several = (np.maximum.reduceat(ordered, starts) if len(starts) else ordered) != self.least
        self.parts = dict(runs(self.bucket[chosen]))


def _announce(buckets: int):
    """Step 2, from a block: its distinct passages for each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, raw, at in zip(batch.column("block").to_pylist(), batch.column("payload"), batch.column("anchors"), strict=True):
                forms = Forms(Block.from_bytes(raw.as_py()), np.cumsum(unpacked(at.as_py())[0], dtype=np.int64), buckets)
                for b, s in forms.parts.items():
                    digest = forms.digest[s]
                    payload = packed(
                        packed_keys(forms.key[s]),
                        (digest & U64(0xFFFFFFFF)).astype(np.uint32),
                        (digest >> U64(32)).astype(np.uint16),
                        planes(forms.least[s]),
                        forms.several[s],
                    )
                    yield from _table([(b, number, "ask", payload)], _ROW).to_batches()
                del forms

    return run


def _answer(table: pa.Table) -> pa.Table:
    """Step 2, in a bucket: to each block, which of its passages are repeated as they are, with their least ids, and which are
    wanted because their anchors have other forms."""
    parts = [unpacked(p.as_py()) for p in table.column("payload")]
    key = np.concatenate([unpacked_keys(p[0]) for p in parts])
    digest = np.concatenate([p[1].astype(U64) | (p[2].astype(U64) << U64(32)) for p in parts])
    least = np.concatenate([from_planes(p[3]) for p in parts])
    several = np.concatenate([p[4] for p in parts])
    order = np.lexsort((digest, key))
    key, digest = key[order], digest[order]
    new_key, new_form = _fresh(key), _fresh(key, digest)
    starts, group = np.flatnonzero(new_key), np.cumsum(new_key) - 1
    forms, entries = np.bincount(group, weights=new_form), np.bincount(group)
    repeated = (forms == 1) & ((entries > 1) | np.logical_or.reduceat(several[order], starts))
    kind = np.empty(len(order), np.int8)
    kind[order] = np.where(forms > 1, 2, repeated)[group]
    smallest = np.empty(len(order), np.int64)
    smallest[order] = np.minimum.reduceat(least[order], starts)[group]
    bucket, rows, at = table.column("bucket")[0].as_py(), [], 0
    for block, p in zip(table.column("block").to_pylist(), parts, strict=True):
        mine = slice(at, at + len(p[4]))
        at += len(p[4])
        alone, wanted = np.flatnonzero(kind[mine] == 1), np.flatnonzero(kind[mine] == 2)
        if len(alone) or len(wanted):
            payload = packed(packed_keys(alone), planes(smallest[mine][alone]), packed_keys(wanted))
            rows.append((bucket, block, "answer", payload))
    return _table(rows, _ROW)


def _passages(block: Block, at: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First window and number of windows of each anchor."""
    document = np.searchsorted(block.bounds, at, side="right") - 1
    begin, end = block.bounds[document], block.bounds[document + 1]
    small = h >> U64(32)
    low = np.maximum(begin, at - (WINDOWS - 1))
    high = np.minimum(end - MIN_BYTES, at)
    for sign in (-1, 1):
        todo = np.arange(len(at))
        for step in range(1, WINDOWS + 1):
            other = todo + sign * step
            inside = (other >= 0) & (other < len(at))
            todo, other = todo[inside], other[inside]
            near = np.abs(at[other] - at[todo]) < WINDOWS
            todo, other = todo[near], other[near]
            if not len(todo):
                break
            less = (small[other] < small[todo]) & (document[other] == document[todo])
            if sign < 0:
                low[todo[less]] = np.maximum(low[todo[less]], at[other[less]] + 1)
            else:
                high[todo[less]] = np.minimum(high[todo[less]], at[other[less]] - WINDOWS)
            todo = todo[~less]
    return low, high - low + 1


def _cut_out(buckets: int):
    """Step 3: what the answers remove already, a block's distinct passages for each bucket, and where those occur."""

    def run(table: pa.Table) -> pa.Table:
        number = table.column("block")[0].as_py()
        kinds = table.column("kind").to_pylist()
        if "answer" not in kinds:
            return _table([], _ROW)
        payload = table.column("payload")
        block = Block.from_bytes(payload[kinds.index("block")].as_py())
        forms = Forms(block, np.cumsum(unpacked(payload[kinds.index("anchors")].as_py())[0], dtype=np.int64), buckets)
        least = np.full(len(forms.key), NO_ID)
        wanted = np.zeros(len(forms.key), bool)
        for kind, bucket, raw in zip(kinds, table.column("bucket").to_pylist(), payload, strict=True):
            if kind == "answer":
                alone, smallest, asked = unpacked(raw.as_py())
                begin = forms.parts[bucket].start
                least[begin + unpacked_keys(alone).astype(np.int64)] = from_planes(smallest)
                wanted[begin + unpacked_keys(asked).astype(np.int64)] = True
        gone = (least[forms.form] < forms.ids) & (forms.ids != NO_ID)
        spans = _spans(_covered(len(block.text), forms.first[gone], forms.sizes[gone]))
        here = wanted[forms.form]
        first, count, sizes, h, to, ids = (
            a[here] for a in (forms.first, forms.count, forms.sizes, forms.h, forms.bucket, forms.ids)
        )
        del forms
        rows = _rows_at(block.text, first, sizes)
        order = np.lexsort((_digest(rows, sizes), h, to))
        fresh = _fresh(to[order], h[order], sizes[order], rows[order])
        starts = np.flatnonzero(fresh)
        ordinal = np.cumsum(fresh) - 1
        smallest = np.minimum.reduceat(ids[order], starts) if len(starts) else ids
        keep = order[starts]
        out = []
        bucket_first = np.zeros(len(starts), np.int64)
        for b, s in runs(to[keep]):
            mine = keep[s]
            out.append((b, number, "passages", packed(h[mine], sizes[mine].astype(np.uint8), rows[mine].reshape(-1), planes(smallest[s]))))
            bucket_first[s] = s.start
        occurs = packed(
            *(x.astype(np.uint32) for x in spans),
            first[order].astype(np.uint32),
            count[order].astype(np.uint8),
            to[order].astype(np.uint32),
            (ordinal - bucket_first[ordinal]).astype(np.uint32),
        )
        out.append((-1, number, "occurs", occurs))
        return _table(out, _ROW)

    return run


def _covered(n: int, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Which of ``n`` bytes lie in one of the stretches."""
    change = np.zeros(n + 1, np.int32)
    np.add.at(change, first, 1)
    np.add.at(change, first + sizes, -1)
    return np.cumsum(change[:-1]) > 0


def _spans(covered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], covered, [False]]).astype(np.int8)))
    return edges[::2], edges[1::2] - edges[::2]


def _rows_at(text: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Passages as rows of fixed width, zeros behind their ends."""
    padded = np.concatenate([text, np.zeros(PASSAGE_BYTES, np.uint8)])
    rows = np.lib.stride_tricks.sliding_window_view(padded, PASSAGE_BYTES)[first]
    rows[np.arange(PASSAGE_BYTES)[None, :] >= sizes[:, None]] = 0
    return rows


def _digest(rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A hash of each passage that brings equal ones together; what is equal is decided on the bytes."""
    wide = np.zeros((len(rows), 72), np.uint8)
    wide[:, :PASSAGE_BYTES] = rows
    wide[:, 71] = sizes
    h = np.zeros(len(rows), U64)
    for column in wide.view("<u8").T:
        h = (h ^ column) * _MULTIPLIERS[0]
        h ^= h >> U64(29)
    return h


def _fresh(*columns: np.ndarray) -> np.ndarray:
    """True where a sorted row differs from the one before."""
    n = len(columns[0])
    fresh = np.zeros(n, bool)
    fresh[:1] = True
    for c in columns:
        differs = c[1:] != c[:-1]
        fresh[1:] |= differs.any(axis=1) if differs.ndim > 1 else differs
    return fresh


def _classify(table: pa.Table) -> pa.Table:
    """Step 4: for each block its passages' windows with the least id of their class."""
    bucket = table.column("bucket")[0].as_py()
    blocks = table.column("block").to_pylist()
    parts = [unpacked(p.as_py()) for p in table.column("payload")]
    lengths = [len(p[0]) for p in parts]
    h = np.concatenate([p[0] for p in parts])
    sizes = np.concatenate([p[1] for p in parts]).astype(np.int64)
    rows = np.concatenate([p[2] for p in parts]).reshape(-1, PASSAGE_BYTES)
    ids = np.concatenate([from_planes(p[3]) for p in parts])
    order = np.lexsort((_digest(rows, sizes), h))
    fresh = _fresh(h[order], sizes[order], rows[order])
    starts = np.flatnonzero(fresh)
    form = np.empty(len(order), np.int64)
    form[order] = np.cumsum(fresh) - 1
    forms = order[starts]
    least = np.minimum.reduceat(ids[order], starts)
    windows = np.repeat(least[:, None], WINDOWS, axis=1)
    anchor = h[forms]
    alone = np.ones(len(forms), bool)
    alone[1:] &= anchor[1:] != anchor[:-1]
    alone[:-1] &= anchor[1:] != anchor[:-1]
    together = np.flatnonzero(~alone)
    for part in _runs_of_anchors(anchor[together], sizes[forms[together]]):
        chosen = together[part]
        windows[chosen] = least_by_class(rows[forms[chosen]], sizes[forms[chosen]], least[chosen], MIN_BYTES)
    valid = np.arange(WINDOWS)[None, :] + MIN_BYTES <= sizes[forms][:, None]
    uneven = ((windows != windows[:, :1]) & valid).any(axis=1)
    out, start = [], 0
    for block, n in zip(blocks, lengths, strict=True):
        mine = form[start : start + n]
        start += n
        odd = np.flatnonzero(uneven[mine])
        out.append((bucket, block, "classes", packed(planes(windows[mine, 0]), odd.astype(np.uint32), windows[mine[odd]].reshape(-1))))
    return _table(out, _ROW)


def _runs_of_anchors(anchor: np.ndarray, sizes: np.ndarray) -> Iterator[slice]:
    """Whole anchors, taken together up to ``TRANSFORM_BYTES``."""
    begin, total = 0, 0
    for _, run in runs(anchor):
        more = int(sizes[run].sum())
        if total and total + more > TRANSFORM_BYTES:
            yield slice(begin, run.start)
            begin, total = run.start, 0
        total += more
    if total:
        yield slice(begin, len(anchor))


def _removed(block: Block, kinds: list, buckets: list, payloads: pa.ChunkedArray) -> np.ndarray:
    """Step 5: which bytes of a block go."""
    if "occurs" not in kinds:
        return np.zeros(len(block.text), bool)
    span, length, first, count, to, ordinal = unpacked(payloads[kinds.index("occurs")].as_py())
    starts, sizes = [span.astype(np.int64)], [length.astype(np.int64)]
    owner = block.ids[np.searchsorted(block.bounds, first, side="right") - 1]
    owner = np.where(owner == NO_ID, np.iinfo(np.int64).min, owner)
    where = dict(runs(to))
    for kind, bucket, raw in zip(kinds, buckets, payloads, strict=True):
        if kind != "classes":
            continue
        even, odd, windows = unpacked(raw.as_py())
        even, windows = from_planes(even), windows.reshape(-1, WINDOWS)
        mine = where[bucket]
        of = ordinal[mine].astype(np.int64)
        at, n, own = first[mine].astype(np.int64), count[mine].astype(np.int64), owner[mine]
        index = np.full(len(even), -1)
        index[odd] = np.arange(len(odd))
        whole = (index[of] < 0) & (even[of] < own)
        starts.append(at[whole])
        sizes.append(n[whole] + MIN_BYTES - 1)
        mixed = np.flatnonzero(index[of] >= 0)
        hit = (windows[index[of[mixed]]] < own[mixed, None]) & (np.arange(WINDOWS)[None, :] < n[mixed, None])
        j, window = np.nonzero(hit)
        starts.append(at[mixed[j]] + window)
        sizes.append(np.full(len(j), MIN_BYTES))
    return _covered(len(block.text), np.concatenate(starts), np.concatenate(sizes))


def _block_of(table: pa.Table) -> tuple[Block, np.ndarray]:
    kinds = table.column("kind").to_pylist()
    payloads = table.column("payload")
    block = Block.from_bytes(payloads[kinds.index("block")].as_py())
    return block, _removed(block, kinds, table.column("bucket").to_pylist(), payloads)


def _digests(table: pa.Table) -> pa.Table:
    block, gone = _block_of(table)
    total = np.concatenate([[0], np.cumsum(gone)])
    n_removed = total[block.bounds[1:]] - total[block.bounds[:-1]]
    begins = gone.copy()
    begins[1:] &= ~gone[:-1]
    inner = block.bounds[:-1][block.bounds[:-1] < len(gone)]
    begins[inner] = gone[inner]
    runs = np.concatenate([[0], np.cumsum(begins)])
    kept = []
    for a, b, n in zip(block.bounds[:-1].tolist(), block.bounds[1:].tolist(), n_removed.tolist(), strict=True):
        text = block.text[a:b]
        kept.append(hashlib.sha256(text[~gone[a:b]] if n else text).hexdigest())
    return pa.table(
        {
            "doc_id": pa.array(block.ids, mask=block.ids == NO_ID),
            "n_bytes": np.diff(block.bounds),
            "n_removed": n_removed.astype(np.int64),
            "n_spans": (runs[block.bounds[1:]] - runs[block.bounds[:-1]]).astype(np.int64),
            "kept_sha256": kept,
        }
    )


def _cleaner(columns: list[str], target: pa.Schema):
    def run(table: pa.Table) -> pa.Table:
        block, gone = _block_of(table)
        texts = []
        for a, b in zip(block.bounds[:-1].tolist(), block.bounds[1:].tolist(), strict=True):
            texts.append(block.text[a:b][~gone[a:b]].tobytes().decode("utf-8", "ignore"))
        rest = block.rows()
        made = {"doc_id": pa.array(block.ids, mask=block.ids == NO_ID), "text": pa.array(texts, pa.string())}
        if "n_chars" in rest.column_names:
            made["n_chars"] = pa.array([len(t) for t in texts])
        return pa.table([(made[c] if c in made else rest.column(c)).cast(target.field(c).type) for c in columns], names=columns)

    return run


def _marked(documents: DataFrame, scratch: Scratch, keep_rest: bool, bucket_anchors: int = BUCKET_ANCHORS) -> DataFrame:
    """Rows of blocks, of where their passages occur, and of the passages' classes: what step 5 needs of each block.

    There is a bucket for every ``bucket_anchors`` anchors of the corpus, so a bucket stays as large as the corpus grows.
    """

    def with_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            noted, counts = [], []
            for p in batch.column("payload"):
                at = anchors_of(Block.from_bytes(p.as_py()))
                noted.append(packed(np.diff(at, prepend=0).astype(np.uint32)))
                counts.append(len(at))
            columns = [*batch.columns, pa.array(noted, pa.binary()), pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["block", "payload", "anchors", "n_anchors"])

    blocks = scratch.keep(
        as_blocks(documents, keep_rest=keep_rest).mapInArrow(with_anchors, "block long, payload binary, anchors binary, n_anchors long"),
        "blocks",
    )
    n_anchors = blocks.agg(F.sum("n_anchors")).first()[0] or 0
    blocks = blocks.drop("n_anchors")
    buckets = max(2 * shuffle_partitions(documents.sparkSession), ceil(n_anchors / bucket_anchors))
    nowhere = F.lit(-1).cast("long").alias("bucket")
    texts = blocks.select(nowhere, "block", F.lit("block").alias("kind"), "payload")
    anchors = blocks.select(nowhere, "block", F.lit("anchors").alias("kind"), F.col("anchors").alias("payload"))
    answers = scratch.keep(
        blocks.mapInArrow(_announce(buckets), _ROW_SQL).groupBy("bucket").applyInArrow(_answer, _ROW_SQL), "answers"
    )
    passages = scratch.keep(
        texts.union(anchors).union(answers).groupBy("block").applyInArrow(_cut_out(buckets), _ROW_SQL), "passages", by="kind"
    )
    scratch.drop("answers")
    classes = scratch.keep(
        passages.where("kind = 'passages'").groupBy("bucket").applyInArrow(_classify, _ROW_SQL), "classes"
    )
    scratch.drop("passages/kind=passages")
    occurs = passages.where("kind = 'occurs'").select(*_ROW.names)
    return texts.union(occurs).union(classes)


def repeated_bytes(documents: DataFrame, scratch: Scratch, bucket_anchors: int = BUCKET_ANCHORS) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of each document."""
    return (
        _marked(documents, scratch, keep_rest=False, bucket_anchors=bucket_anchors)
        .groupBy("block")
        .applyInArrow(_digests, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    )


def without_repeats(documents: DataFrame, scratch: Scratch) -> DataFrame:
    """``documents`` with the repeated passages cut out of ``text``; ``n_chars``, if there, counts what is left."""
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in documents.schema])
    run = _cleaner(documents.columns, to_arrow_schema(schema))
    return _marked(documents, scratch, keep_rest=True).groupBy("block").applyInArrow(run, schema)
