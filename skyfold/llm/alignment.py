"""Alignment of two tokenizers over a corpus: which tokens of one cover which of the other, and how usual each such pair is.

Both encode every text, A with a space put before it. Wherever a token of A and one of B end at the same byte, a group ends; two
tokens are linked where their bytes overlap. A pair of ids counts the documents that hold it linked.

Pairs are counted through minimal perfect hashes. Texts lie in blocks of bounded size, written once. A first pass aligns them and
sends each block's distinct pairs and their documents to buckets by A's id. A bucket makes a perfect hash of its distinct pairs; of
up to ``LEAF_BLOCKS`` blocks together, counts are added into one dense vector under the pairs' hash numbers, and the vectors are
summed up a tree, ``FAN`` at a time. The second pass aligns the blocks again and looks their pairs up: the numbers that the hash gives
hold the pairs themselves, so a foreign pair is refused, and the counts beside them. All pairs of an id of A lie in one bucket, which
therefore knows the highest of them too.

What a task holds is bounded: a bucket by the two vocabularies, divided by ``BUCKETS``, whatever the corpus; a leaf by its blocks; the
remembered stretches by ``STRETCHES``. Nothing is collected or broadcast but the two vocabularies.

Texts are cut at single spaces between visible characters, where neither tokenizer joins (a vocabulary with a token across such a
place is not cut), and every distinct stretch is encoded and aligned once by a worker.

Nulls and odd cases: a null or empty text has no tokens, nor has one whose tokens' bytes, joined, are not the space and the text;
their numbers are 0 and their digest is empty. Null and repeated ids are documents of their own. Strings of special tokens inside
texts are plain text. Empty tables give no row. Other columns are left out.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from skyfold.llm.blocks import NO_ID, Block, as_blocks, packed, runs, unpacked
from skyfold.llm.common import Scratch
from skyfold.llm.perfect_hash import PerfectHash
from skyfold.llm.token_files import values_of

#: Buckets of pairs; one holds at most the product of the vocabularies' sizes divided by this.
BUCKETS = 256
BLOCK_BYTES = 4 << 20
#: Blocks whose counts of a bucket become one vector, and vectors that are summed at a time above that.
LEAF_BLOCKS = 1024
FAN = 32
#: Distinct stretches of text that a worker remembers.
STRETCHES = 500_000

#: Fixed value: the split of byte-level tokenizers that keep white space.
BYTE_LEVEL_SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
VISIBLE = re.compile(r"[\w!-~]")
#: A token like this, or one that begins inside a character, could span a cut.
ACROSS = re.compile("[\\w!-~\ufffd] ")

_PAIRS = "bucket long, block long, payload binary"
_VECTORS = "bucket long, branch long, payload binary"
DIGEST = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _byte_of_character() -> dict[str, int]:
    """How byte-level vocabularies spell bytes: visible Latin-1 as itself, the others by characters from 256 on, in order."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(seen)]
    return {chr(b): b for b in seen} | {chr(256 + k): b for k, b in enumerate(other)}


class ByteLevel:
    """Tokenizer A: ids of texts, and the bytes of each id, by a tokenizer definition's JSON text."""

    def __init__(self, definition: str) -> None:
        described = json.loads(definition)
        vocabulary, spelled = described["model"]["vocab"], _byte_of_character()
        size = max([*vocabulary.values(), *[t["id"] for t in described.get("added_tokens", [])]]) + 1
        special = {t["id"] for t in described.get("added_tokens", []) if t.get("special")}
        self.bytes_of = [b""] * size
        for token, i in vocabulary.items():
            self.bytes_of[i] = token.encode() if i in special else bytes(spelled[c] for c in token)
        # With a merge's place as its token's rank, byte pairs are merged alike by a faster encoder.
        pairs = [m.split(" ") if isinstance(m, str) else m for m in described["model"]["merges"]]
        first = len(vocabulary) - len(special & set(vocabulary.values())) - len(pairs)
        ordered = all(vocabulary.get(a + b) == first + k for k, (a, b) in enumerate(pairs))
        split = described.get("pre_tokenizer") or {}
        known = {"ByteLevel": split.get("use_regex", True) and not split.get("add_prefix_space")}.get(split.get("type"))
        if ordered and known and first == 256 and not described.get("normalizer"):
            ranks = {b: i for i, b in enumerate(self.bytes_of) if i < first + len(pairs)}
            plain = tiktoken.Encoding("ranked", pat_str=BYTE_LEVEL_SPLIT, mergeable_ranks=ranks, special_tokens={})
            self.encode = lambda texts: [plain.encode_ordinary(t) for t in texts]
        else:
            whole = Tokenizer.from_str(definition)
            whole.encode_special_tokens = True
            self.encode = lambda texts: [e.ids for e in whole.encode_batch_fast(texts, add_special_tokens=False)]


class Pieces:
    """Tokenizer B: ids of texts, which it puts a space before, and the bytes of each id, by a sentencepiece model."""

    def __init__(self, model: bytes) -> None:
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        spelled = [self.processor.id_to_piece(i) for i in range(self.processor.get_piece_size())]
        self.bytes_of = [
            bytes([int(p[3:5], 16)]) if self.processor.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(spelled)
        ]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.processor.encode(texts, num_threads=1)


def _distinct(values: np.ndarray) -> np.ndarray:
    """Distinct values, ascending; the stable sort makes use of runs that ascend already."""
    values = np.sort(values, kind="stable")
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


@cache
def _visible() -> np.ndarray:
    """Whether each character of the basic plane may stand beside a cut; beyond that plane nothing is cut."""
    return np.asarray([bool(VISIBLE.match(chr(c))) for c in range(1 << 16)])


def _beside(raw: np.ndarray, spaces: np.ndarray, before: bool) -> np.ndarray:
    """Whether the characters right before or after these places of UTF-8 bytes are visible; the bytes end with three of padding on both sides."""
    at = spaces - 1 if before else spaces + 1
    out = (raw[at] > 32) & (raw[at] < 127)
    other = np.flatnonzero(raw[at] >= 128)
    first = at[other]
    if before:  # back to the first byte of a character of two or three
        first = first - np.where(raw[first - 1] >= 0xC0, 1, 2)
    lead, second, third = (raw[first + k].astype(np.int64) for k in range(3))
    two = (lead & 0x1F) << 6 | second & 0x3F
    three = (lead & 0x0F) << 12 | (second & 0x3F) << 6 | third & 0x3F
    out[other] = np.where(lead < 0xE0, _visible()[two], _visible()[three & 0xFFFF]) & (lead >= 0xC0) & (lead < 0xF0)
    return out


class Stretches:
    """Aligned stretches of text: for each its tokens, groups and links, the links as pairs ``a * width + b``."""

    def __init__(self, aligner: Aligner, texts: list[str]) -> None:
        a, b = aligner.a, aligner.b
        raw = [b" " + t.encode() for t in texts]
        ids_a, ids_b = a.encode([" " + t for t in texts]), b.encode(texts)
        bytes_a, bytes_b = a.bytes_of.__getitem__, b.bytes_of.__getitem__
        self.sound = np.ones(len(texts), bool)
        whole = b"".join(raw)
        if b"".join(map(bytes_a, chain.from_iterable(ids_a))) != whole or b"".join(map(bytes_b, chain.from_iterable(ids_b))) != whole:
            for k, r in enumerate(raw):
                if b"".join(map(bytes_a, ids_a[k])) != r or b"".join(map(bytes_b, ids_b[k])) != r:
                    self.sound[k], ids_a[k], ids_b[k], raw[k] = False, [], [], b""
        self.n_a = np.fromiter(map(len, ids_a), np.int64, len(texts))
        self.n_b = np.fromiter(map(len, ids_b), np.int64, len(texts))
        flat_a = np.fromiter(chain.from_iterable(ids_a), np.int64, int(self.n_a.sum()))
        flat_b = np.fromiter(chain.from_iterable(ids_b), np.int64, int(self.n_b.sum()))
        end_a, end_b = np.cumsum(aligner.sizes_a[flat_a]), np.cumsum(aligner.sizes_b[flat_b])
        # Between neighbouring ends of either, exactly one token of each lies: every such span is one link.
        ends = _distinct(np.concatenate([end_a, end_b]))
        of_a, of_b = np.searchsorted(end_a, ends), np.searchsorted(end_b, ends)
        self.pairs = flat_a[of_a] * aligner.width + flat_b[of_b]
        last = np.cumsum([len(r) for r in raw]) if raw else np.zeros(0, np.int64)
        self.n_links = np.diff(np.searchsorted(ends, last, "right"), prepend=0)
        common = ends[(end_a[of_a] == ends) & (end_b[of_b] == ends)]
        self.n_groups = np.diff(np.searchsorted(common, last, "right"), prepend=0)
        self.cuts = (np.searchsorted(end_a, common, "right"), np.searchsorted(end_b, common, "right"))
        self.ids = (flat_a, flat_b)

    def spelled(self) -> list[str]:
        """The groups of each stretch as ``a1,a2|b1;a3|b2,b3``."""
        a, b = (list(map(str, i.tolist())) for i in self.ids)
        groups, p, r = [], 0, 0
        for q, s in zip(*(c.tolist() for c in self.cuts), strict=True):
            groups.append(f"{a[p] if q == p + 1 else ','.join(a[p:q])}|{b[r] if s == r + 1 else ','.join(b[r:s])}")
            p, r = q, s
        ends = np.cumsum(self.n_groups).tolist()
        return [";".join(groups[x:y]) for x, y in zip([0, *ends], ends, strict=False)]


class Aligner:
    """Aligns documents stretch by stretch, and remembers the stretches."""

    def __init__(self, definition: str, model: bytes) -> None:
        self.a, self.b = ByteLevel(definition), Pieces(model)
        self.sizes_a, self.sizes_b = (np.asarray([len(x) for x in t.bytes_of], np.int64) for t in (self.a, self.b))
        self.width = len(self.b.bytes_of)
        self.cuts = not any(ACROSS.search(x.decode(errors="replace")) for t in (self.a, self.b) for x in t.bytes_of)
        self.forget()

    def forget(self) -> None:
        self.place: dict[bytes, int] = {}
        self.parts: list[Stretches] = []
        self.spelled: list[str] = []

    def _learn(self, texts: list[bytes], spell: bool) -> None:
        for i in range(0, len(texts), 50_000):
            part = Stretches(self, [t.decode() for t in texts[i : i + 50_000]])
            self.place |= zip(texts[i : i + 50_000], range(len(self.place), len(self.place) + 50_000), strict=False)
            self.parts.append(part)
            if spell:
                self.spelled += part.spelled()
        if len(self.parts) > 1:
            self.parts = [_joined(self.parts)]

    def _cut(self, texts: list[bytes]) -> tuple[pa.DictionaryArray, np.ndarray]:
        """The stretches of texts, one after the other, by their distinct values; and how many each text has."""
        raw = np.frombuffer(b"\n\n\n" + b"\n".join(texts) + b"\n\n\n", np.uint8)
        ends = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64) + 2
        begins = ends - [len(t) for t in texts]
        cuts = np.flatnonzero(raw == 32) if self.cuts else np.zeros(0, np.int64)
        for before in (True, False):
            cuts = cuts[_beside(raw, cuts, before)]
        starts, stops = np.sort(np.concatenate([begins, cuts + 1])), np.sort(np.concatenate([ends, cuts]))
        inside = np.ones(len(raw), bool)
        inside[:3] = inside[-3:] = inside[ends] = inside[cuts] = False
        starts, stops = starts[stops > starts], stops[stops > starts]  # without empty texts
        offsets = np.concatenate([[0], np.cumsum(stops - starts)])
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(raw[inside])]
        found = pa.Array.from_buffers(pa.large_binary(), len(starts), buffers).dictionary_encode()
        return found, np.searchsorted(starts, ends) - np.searchsorted(starts, begins)

    def of(self, texts: list[bytes], spell: bool) -> Documents:
        """``texts`` aligned; ``spell`` must not change while an aligner remembers."""
        if len(self.place) > STRETCHES:
            self.forget()
        cut, counts = self._cut(texts)
        distinct = values_of(cut.dictionary)
        places = list(map(self.place.get, distinct))
        self._learn([s for s, p in zip(distinct, places, strict=True) if p is None], spell)
        places = np.fromiter(map(self.place.__getitem__, distinct), np.int64, len(distinct)) if None in places else np.asarray(places, np.int64)
        found = Documents(self, places[cut.indices.to_numpy()], counts)
        unsound = _distinct(found.owner[~self.parts[0].sound[found.which]]) if self.parts else []
        if len(unsound):  # seldom: decided on the whole text, as the definition says
            whole = [texts[d] for d in unsound.tolist()]
            self._learn([t for t in dict.fromkeys(whole) if t not in self.place], spell)
            which = np.asarray([self.place[t] for t in whole])
            sound, kept = self.parts[0].sound[which], ~np.isin(found.owner, unsound)
            owner = np.concatenate([found.owner[kept], unsound[sound]])
            order = np.argsort(owner, kind="stable")
            which = np.concatenate([found.which[kept], which[sound]])[order]
            found = Documents(self, which, np.bincount(owner, minlength=len(texts)))
        return found


def _joined(parts: list[Stretches]) -> Stretches:
    """Numbers and pairs of several parts as of one; their tokens are no longer needed."""
    out = object.__new__(Stretches)
    for name in ("sound", "n_a", "n_b", "n_groups", "n_links", "pairs"):
        setattr(out, name, np.concatenate([getattr(p, name) for p in parts]))
    return out


class Documents:
    """Documents of a block as stretches: ``which`` stretch each is, and its document in ``owner``."""

    def __init__(self, aligner: Aligner, which: np.ndarray, counts: np.ndarray) -> None:
        self.aligner, self.which, self.counts = aligner, which, counts
        self.owner = np.repeat(np.arange(len(counts)), counts)

    def _numbered(self) -> tuple[np.ndarray, np.ndarray]:
        """The distinct stretches, ascending, and which of them each is."""
        met = np.zeros(len(self.aligner.place), bool)
        met[self.which] = True
        return np.flatnonzero(met), (np.cumsum(met) - 1)[self.which]

    def _pairs_of(self, stretches: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All links of these stretches, one after the other, and how many each has."""
        known = self.aligner.parts[0]
        ends, n = np.cumsum(known.n_links), known.n_links[stretches]
        first = np.repeat((ends - known.n_links)[stretches] - (np.cumsum(n) - n), n)
        return known.pairs[first + np.arange(len(first))], n

    def documents_of_pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct pairs of the block, ascending, and how many of its documents hold each."""
        if not len(self.which):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        stretches, at = self._numbered()
        pairs, n = self._pairs_of(stretches)
        distinct, number = np.unique(pairs, return_inverse=True)
        held = _distinct(self.owner * len(stretches) + at)  # a document and a stretch, once
        owner, stretch = held // len(stretches), held % len(stretches)
        first, many = (np.cumsum(n) - n)[stretch], n[stretch]
        links = np.repeat(first - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
        once = _distinct(np.repeat(owner, many) * len(distinct) + number[links])
        return distinct, np.bincount(once % len(distinct), minlength=len(distinct))

    def summed(self, of_stretch: np.ndarray) -> np.ndarray:
        """Sums over each document's stretches of a whole number for each remembered stretch."""
        sums = np.concatenate([[0], np.cumsum(of_stretch[self.which])])
        ends = np.cumsum(self.counts)
        return sums[ends] - sums[ends - self.counts]

    def digest(self, pairs: np.ndarray, counts: np.ndarray, best: np.ndarray) -> dict[str, np.ndarray | list]:
        """The result columns, by the block's distinct pairs, ascending, with their counts and whether those are their A id's highest."""
        aligner = self.aligner
        if not aligner.parts:
            zero = np.zeros(len(self.counts), np.int64)
            numbers = dict.fromkeys(("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"), zero)
            return numbers | {"groups_sha256": [""] * len(zero)}
        known = aligner.parts[0]
        stretches, _ = self._numbered()
        links, n = self._pairs_of(stretches)
        at = np.searchsorted(pairs, links)
        if len(links) and (at.max() >= len(pairs) or (pairs[at] != links).any()):
            raise ValueError("a pair was not counted")
        ends = np.cumsum(n)

        def by_stretch(of_pair: np.ndarray) -> np.ndarray:
            sums = np.concatenate([[0], np.cumsum(of_pair[at])])
            out = np.zeros(len(known.n_links), np.int64)
            out[stretches] = sums[ends] - sums[ends - n]
            return out

        found = {name: self.summed(getattr(known, name)) for name in ("n_a", "n_b", "n_groups", "n_links")}
        found |= {"n_best": self.summed(by_stretch(best.astype(np.int64))), "count_sum": self.summed(by_stretch(counts))}
        bounds, which = [0, *np.cumsum(self.counts).tolist()], self.which.tolist()
        spelled = aligner.spelled.__getitem__
        texts = [";".join(map(spelled, which[x:y])) for x, y in zip(bounds, bounds[1:], strict=False)]
        return found | {"groups_sha256": [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in texts]}


_ALIGNERS: dict[tuple[str, bool], Aligner] = {}


def aligner_of(definition: str, model: bytes, spell: bool) -> Aligner:
    """One aligner for each pair of tokenizers and worker process, so that tasks share what it remembers."""
    key = (hashlib.sha256(definition.encode() + model).hexdigest(), spell)
    if key not in _ALIGNERS:
        _ALIGNERS.clear()
        _ALIGNERS[key] = Aligner(definition, model)
    return _ALIGNERS[key]


def _texts(block: Block) -> list[bytes]:
    bounds = block.bounds.tolist()
    return [block.text[x:y].tobytes() for x, y in zip(bounds, bounds[1:], strict=False)]


def bucket_of(a: np.ndarray) -> np.ndarray:
    return (a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)).astype(np.int64) % BUCKETS


def _rows(names: str, *columns: list | np.ndarray) -> pa.Table:
    fields = [f.strip().split(" ") for f in names.split(",")]
    types = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    return pa.table([pa.array(c, types[t]) for c, (_, t) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


def _first_pass(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = aligner_of(*shared.value, spell=False)
        for batch in batches:
            for number, raw in zip(batch.column("block").to_pylist(), batch.column("payload"), strict=True):
                pairs, documents = aligner.of(_texts(Block.from_bytes(raw.as_py())), spell=False).documents_of_pairs()
                bucket = bucket_of(pairs // aligner.width)
                order = np.argsort(bucket, kind="stable")  # pairs ascend in each bucket
                rows = [(b, packed(pairs[order[s]], documents[order[s]])) for b, s in runs(bucket[order])]
                yield from _rows(_PAIRS, [b for b, _ in rows], [number] * len(rows), [p for _, p in rows]).to_batches()

    return run


def _union(table: pa.Table) -> pa.Table:
    """The distinct pairs of some blocks' rows of a bucket."""
    keys = np.unique(np.concatenate([unpacked(p.as_py())[0] for p in table.column("payload")]))
    return _rows(_VECTORS, table.column("bucket")[:1].to_pylist(), table.column("branch")[:1].to_pylist(), [packed(keys)])


def _hash(table: pa.Table) -> pa.Table:
    return _rows("bucket long, hash binary", table.column("bucket").to_pylist(), [_hash_of(p) for p in table.column("payload")])


def _hash_of(payload: pa.BinaryScalar) -> bytes:
    return PerfectHash.of(unpacked(payload.as_py())[0]).to_bytes()


def _vector(rows: pa.Table, hashes: pa.Table) -> pa.Table:
    """Counts of some blocks' pairs of a bucket, added up under the pairs' numbers."""
    if not rows.num_rows:  # blocks that hold nothing of this bucket
        return _rows(_VECTORS, [], [], [])
    numbered = PerfectHash.from_bytes(hashes.column("hash")[0].as_py())
    vector, pairs = np.zeros(len(numbered), np.int64), np.zeros(len(numbered), np.int64)
    for p in rows.column("payload"):
        keys, counts = unpacked(p.as_py())
        at = numbered.numbers(keys)
        vector[at] += counts
        pairs[at] = keys
    return _rows(_VECTORS, rows.column("bucket")[:1].to_pylist(), rows.column("branch")[:1].to_pylist(), [packed(pairs, vector)])


def _added(table: pa.Table) -> pa.Table:
    """The sum of vectors; of the pairs at their places each vector knows those that it has counted."""
    total = pairs = None
    for p in table.column("payload"):
        mine, vector = unpacked(p.as_py())
        total, pairs = (vector.copy(), mine.copy()) if total is None else (total + vector, np.where(vector > 0, mine, pairs))
    return _rows(_VECTORS, table.column("bucket")[:1].to_pylist(), table.column("branch")[:1].to_pylist(), [packed(pairs, total)])


def _look_up(width: int):
    def run(rows: pa.Table, counted: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return _rows(_PAIRS, [], [], [])
        numbered = PerfectHash.from_bytes(counted.column("hash")[0].as_py())
        held, counts = unpacked(counted.column("payload")[0].as_py())
        _, of_a = np.unique(held // width, return_inverse=True)
        highest = np.zeros(of_a.max() + 1, np.int64)
        np.maximum.at(highest, of_a, counts)
        best = counts == highest[of_a]
        answers = []
        for p in rows.column("payload"):
            keys, _ = unpacked(p.as_py())
            at = numbered.numbers(keys)
            if (held[at] != keys).any():
                raise ValueError("a pair was not counted")
            answers.append(packed(keys, counts[at], best[at].astype(np.uint8)))
        return _rows(_PAIRS, rows.column("bucket").to_pylist(), rows.column("block").to_pylist(), answers)

    return run


def _second_pass(shared):
    def run(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        aligner = aligner_of(*shared.value, spell=True)
        parts = [unpacked(p.as_py()) for p in answers.column("payload")]
        pairs, counts, best = (np.concatenate(c) for c in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int64),) * 3
        order = np.argsort(pairs)
        tables = []
        for raw in blocks.column("payload"):
            block = Block.from_bytes(raw.as_py())
            found = aligner.of(_texts(block), spell=True).digest(pairs[order], counts[order], best[order])
            tables.append(_rows(DIGEST, pa.array(block.ids, mask=block.ids == NO_ID), *found.values()))
        return pa.concat_tables(tables) if tables else _rows(DIGEST, *[[]] * 8)

    return run


def _broadcast(documents: DataFrame, definition_path: str, model_path: str):
    with open(definition_path, encoding="utf-8") as f, open(model_path, "rb") as g:
        value = (f.read(), g.read())
    return documents.sparkSession.sparkContext.broadcast(value), len(Pieces(value[1]).bytes_of)


def _count_pairs(documents: DataFrame, scratch: Scratch, shared) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """The written blocks, their pairs by bucket, and each bucket's hash with its summed vector."""
    blocks = scratch.keep(as_blocks(documents, BLOCK_BYTES, keep_rest=False), "blocks")
    rows = scratch.keep(blocks.mapInArrow(_first_pass(shared), _PAIRS), "pairs")
    leaves = max(1, -(-blocks.count() // LEAF_BLOCKS))
    branch = F.pmod(F.xxhash64("block"), F.lit(leaves)).alias("branch")
    dealt = rows.select("bucket", branch, "block", "payload")

    def up(frame: DataFrame, combine) -> DataFrame:
        """Combine the branches of each bucket, ``FAN`` at a time, until one is left."""
        many = leaves
        while many > 1:
            many = -(-many // FAN)
            frame = frame.withColumn("branch", F.floor(F.col("branch") / FAN)).groupBy("bucket", "branch").applyInArrow(combine, _VECTORS)
        return frame

    distinct = up(dealt.groupBy("bucket", "branch").applyInArrow(_union, _VECTORS), _union)
    as_hashes = distinct.groupBy("bucket").applyInArrow(_hash, "bucket long, hash binary")
    hashes = scratch.keep(as_hashes, "hashes")
    spread = hashes.withColumn("branch", F.explode(F.sequence(F.lit(0), F.lit(leaves - 1)).cast("array<long>")))
    vectors = dealt.groupBy("bucket", "branch").cogroup(spread.groupBy("bucket", "branch")).applyInArrow(_vector, _VECTORS)
    counted = scratch.keep(up(vectors, _added).join(hashes, "bucket").select("bucket", "payload", "hash"), "counts")
    return blocks, dealt, counted, leaves


def pair_counts(documents: DataFrame, scratch: Scratch, definition_path: str, model_path: str) -> DataFrame:
    """``a, b, documents``: each linked pair of ids and how many documents hold it."""
    shared, width = _broadcast(documents, definition_path, model_path)
    _, _, counted, _ = _count_pairs(documents, scratch, shared)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in batch.column("payload"):
                pairs, counts = unpacked(p.as_py())
                yield from _rows("a long, b long, documents long", pairs // width, pairs % width, counts).to_batches()

    return counted.select("payload").mapInArrow(run, "a long, b long, documents long")


def align(documents: DataFrame, scratch: Scratch, definition_path: str, model_path: str) -> DataFrame:
    """For every document its tokens, groups and links, how many links are their A id's most usual, and the links' counts in total.

    A is the byte-level tokenizer whose definition (JSON) lies at ``definition_path``, B the sentencepiece model at ``model_path``.
    """
    shared, width = _broadcast(documents, definition_path, model_path)
    blocks, dealt, counted, leaves = _count_pairs(documents, scratch, shared)
    spread = counted.withColumn("branch", F.explode(F.sequence(F.lit(0), F.lit(leaves - 1)).cast("array<long>")))
    answers = dealt.groupBy("bucket", "branch").cogroup(spread.groupBy("bucket", "branch")).applyInArrow(_look_up(width), _PAIRS)
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_second_pass(shared), DIGEST)
