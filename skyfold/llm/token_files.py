"""Token files: each document's ids compressed by itself with a shared dictionary, behind an index of offsets.

Documents are dealt by ranges of ascending id, encoded once and written as shards of bounded size, each a file image of its own:

    magic          8 bytes  b"SKTOKEN1"
    dictionary    32 bytes  SHA-256 of the zstandard dictionary that the frames need
    width, end     u32, u32 bytes of an id; id at the end of each document
    count          u64      documents
    present        count x u8    0 where the document's id is null
    doc_ids        count x i64   ascending, nulls first
    offsets  (count + 1) x u64   of the frames, from the first frame
    tokens         count x u32
    frames         one zstandard frame for each document: little-endian ids

Spark writes the images as a binary column, so they can lie in any store that Spark reaches; a document is found by its range of
ids, the index and one frame. The dictionary is trained on serialised ids of a bounded sample and stored beside the shards.

Nulls and odd cases: a null or empty text is the end id alone; null ids come first; repeated documents are stored as often as they
occur; an empty table gives no shard. Other columns are left out. Text that spells a special token is encoded as the tokenizer
does by default, as that token.
"""

from __future__ import annotations

import hashlib
import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from skyfold.llm.common import Scratch, ship_code, shuffle_partitions

MAGIC = b"SKTOKEN1"
HEAD = struct.Struct("<8s32sIIQ")
END_ID = 2
#: Bounds of the sample that the dictionary is trained on, and its size.
SAMPLE_DOCUMENTS = 1000
SAMPLE_CHARACTERS = 20_000
DICTIONARY_BYTES = 64 << 10
SHARD_BYTES = 2 << 20
SHARD_DOCUMENTS = 20_000
#: Words that a worker remembers the ids of, and text bytes whose distinct words are looked up together.
CACHE_WORDS = 1_000_000
PART_BYTES = 1 << 20

#: Fixed value: the split of tokenizers that drop white space and end words with a suffix.
WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

SHARD_SCHEMA = (
    "part int, shard int, first_doc long, last_doc long, documents long, tokens long, before long, dictionary string, image binary"
)


def parts_of(texts: list[bytes]) -> Iterator[list[bytes]]:
    """Stretches of ``texts`` that end once they hold ``PART_BYTES``."""
    ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
    begun = 0
    while begun < len(texts):
        before = int(ends[begun - 1]) if begun else 0
        end = int(np.searchsorted(ends, before + PART_BYTES)) + 1
        yield texts[begun:end]
        begun = end


def values_of(words: pa.LargeBinaryArray) -> list[bytes]:
    """An array without nulls as a list: one copy of its bytes, cut, is several times faster than value by value."""
    _, offsets, data = words.buffers()
    raw, at = data.to_pybytes(), np.frombuffer(offsets, np.int64)[words.offset : words.offset + len(words) + 1].tolist()
    return [raw[x:y] for x, y in zip(at, at[1:], strict=False)]


class Encoder:
    """Encodes whole texts; for tokenizers that split at words, each distinct word only once.

    Such a tokenizer drops white space and never joins what it separates, nor a letter with a punctuation mark other than the
    apostrophe. Texts are therefore cut there, lower-cased where the tokenizer does so too, and the pieces' ids are remembered.
    """

    def __init__(self, definition: str) -> None:
        self.tokenizer = Tokenizer.from_str(definition)
        described = json.loads(definition)
        self.special = [t["content"].encode() for t in described.get("added_tokens", [])]
        suffix = described["model"].get("end_of_word_suffix")
        splits = [p.get("pattern", {}).get("Regex") for p in (described.get("pre_tokenizer") or {}).get("pretokenizers", [])]
        normalizers = [n["type"] for n in (described.get("normalizer") or {}).get("normalizers", [])]
        self.by_word = bool(suffix) and WORD_SPLIT in splits and normalizers == ["NFC", "Replace", "Lowercase"]
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.width = 2 if size <= 1 << 16 else 4
        self.type = np.dtype(f"<u{self.width}")
        if not self.by_word:
            return
        self.ends = np.zeros(size, dtype=bool)
        for token, i in described["model"]["vocab"].items():
            self.ends[i] = token.endswith(suffix)
        to = bytearray(range(256))
        for b in b"\t\n\x0b\x0c\r":
            to[b] = 32
        for b in range(65, 91):
            to[b] = b + 32
        self.table = bytes(to)
        self.kind = np.zeros(256, np.uint8)
        self.kind[97:123] = 1
        for b in range(33, 127):
            if not chr(b).isalnum() and chr(b) != "'":
                self.kind[b] = 2
        self.known: dict[bytes, bytes] = {b"": b""}

    def _whole(self, texts: list[bytes]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)
        return [np.asarray(e.ids, dtype=self.type).tobytes() for e in found]

    def _pieces(self, texts: list[bytes]) -> tuple[pa.DictionaryArray, np.ndarray]:
        """The pieces of texts, one after the other, by their distinct values; and how many lie before the end of each text."""
        raw = np.frombuffer(b" ".join(texts).translate(self.table), np.uint8)
        ends = np.cumsum([len(t) + 1 for t in texts]) - 1
        kinds = self.kind[raw]
        cuts = np.flatnonzero(kinds[1:] * kinds[:-1] == 2) + 1
        if len(cuts):
            raw = np.insert(raw, cuts, 32)
            ends += np.searchsorted(cuts, ends)
        visible = raw != 32
        edges = np.flatnonzero(np.diff(visible, prepend=False, append=False))
        starts, stops = edges[::2], edges[1::2]
        offsets = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(stops - starts, out=offsets[1:])
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(raw[visible])]
        pieces = pa.Array.from_buffers(pa.large_binary(), len(starts), buffers)
        return pieces.dictionary_encode(), np.searchsorted(starts, ends)

    def _learn(self, words: list[bytes]) -> None:
        if len(self.known) + len(words) > CACHE_WORDS:
            self.known = {b"": b""}
        plain, other = [], []
        for w in words:
            s = w.decode()
            near = s.isascii() or (max(s) < "ɐ" and "İ" not in s)
            (plain if near and s.isalpha() else other).append((w, s))
        for i in range(0, len(plain), 2000):
            part = plain[i : i + 2000]
            ids = np.asarray(
                self.tokenizer.encode_batch_fast([" ".join(s for _, s in part)], add_special_tokens=False)[0].ids, dtype=self.type
            )
            ends = (np.flatnonzero(self.ends[ids]) + 1) * self.width
            if len(ends) != len(part):
                other += part
                continue
            raw, start = ids.tobytes(), 0
            for (w, _), end in zip(part, ends.tolist(), strict=True):
                self.known[w] = raw[start:end]
                start = end
        if other:
            self.known.update(zip([w for w, _ in other], self._whole([w for w, _ in other]), strict=True))

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each UTF-8 text, serialised in ``width`` bytes each."""
        if not self.by_word:
            return self._whole(texts)
        out: list[bytes] = []
        for part in parts_of(texts):
            lowered = [t.lower() for t in part]
            odd = [any(s in t for s in self.special) for t in lowered]
            pieces, ends = self._pieces([b"" if o else t for o, t in zip(odd, part, strict=True)])
            words = values_of(pieces.dictionary)
            found = list(map(self.known.get, words))
            new = [w for w, f in zip(words, found, strict=True) if f is None]
            if new:
                full = len(self.known) + len(new) > CACHE_WORDS
                self._learn(sorted(words) if full else new)
                found = list(map(self.known.__getitem__, words))
            bounds = np.zeros(len(words) + 1, np.int64)
            np.cumsum([len(f) for f in found], out=bounds[1:])
            bounds //= self.width
            which = pieces.indices.to_numpy()
            counts = np.diff(bounds)[which]
            before = np.zeros(len(which) + 1, np.int64)
            np.cumsum(counts, out=before[1:])
            at = np.repeat(bounds[which] - before[:-1], counts) + np.arange(before[-1])
            ids = np.frombuffer(b"".join(found), self.type)[at].tobytes()
            stops = (before[ends] * self.width).tolist()
            whole = iter(self._whole([t for o, t in zip(odd, part, strict=True) if o]))
            out += [next(whole) if o else ids[x:y] for o, x, y in zip(odd, [0, *stops], stops, strict=False)]
        return out


_ENCODERS: dict[str, Encoder] = {}


def encoder_of(definition: str) -> Encoder:
    """One encoder for each definition and worker process, so that tasks share what it remembers."""
    key = hashlib.sha256(definition.encode()).hexdigest()
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(definition)
    return _ENCODERS[key]


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A zstandard dictionary; of too few samples to train on, their own bytes."""
    samples = [s for s in samples if s]
    try:
        return zstandard.train_dictionary(min(size, max(256, sum(map(len, samples)) // 8)), samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:size]


def dictionary_of(raw: bytes) -> zstandard.ZstdCompressionDict:
    return zstandard.ZstdCompressionDict(raw)


def shard_image(ids: list, frames: list[bytes], tokens: list[int], digest: bytes, width: int, end_id: int) -> bytes:
    count = len(ids)
    offsets = np.zeros(count + 1, "<u8")
    np.cumsum([len(f) for f in frames], out=offsets[1:])
    return b"".join(
        [
            HEAD.pack(MAGIC, digest, width, end_id, count),
            np.asarray([i is not None for i in ids], "u1").tobytes(),
            np.asarray([i or 0 for i in ids], "<i8").tobytes(),
            offsets.tobytes(),
            np.asarray(tokens, "<u4").tobytes(),
            *frames,
        ]
    )


class Shard:
    """A parsed image. ``ids(k)`` reads one document and no other."""

    def __init__(self, image: bytes, dictionary: bytes) -> None:
        magic, digest, self.width, self.end_id, self.count = HEAD.unpack_from(image)
        if magic != MAGIC or digest != hashlib.sha256(dictionary).digest():
            raise ValueError("not a token file, or of another dictionary")
        at = HEAD.size
        self.present = np.frombuffer(image, "u1", self.count, at).astype(bool)
        self.doc_ids = np.frombuffer(image, "<i8", self.count, at := at + self.count)
        self.offsets = np.frombuffer(image, "<u8", self.count + 1, at := at + 8 * self.count).tolist()
        self.tokens = np.frombuffer(image, "<u4", self.count, at := at + 8 * (self.count + 1))
        self.frames = memoryview(image)[at + 4 * self.count :]
        self.reader = zstandard.ZstdDecompressor(dict_data=dictionary_of(dictionary) if dictionary else None)

    def ids(self, k: int) -> np.ndarray:
        raw = self.reader.decompress(self.frames[self.offsets[k] : self.offsets[k + 1]])
        return np.frombuffer(raw, f"<u{self.width}")


def write_token_files(documents: DataFrame, path: str, definition: str, end_id: int = END_ID) -> None:
    """Write ``path/dictionary`` and ``path/shards`` for all documents, by the tokenizer of this definition (its JSON text)."""
    spark = documents.sparkSession
    ship_code(spark)
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # Hashes first: of each task the driver gets so many numbers, not so many texts.
    hashes = texts.select(F.xxhash64("doc_id").alias("hash")).orderBy("hash").limit(SAMPLE_DOCUMENTS).collect()
    chosen = texts.where(F.xxhash64("doc_id") <= (hashes[-1]["hash"] if hashes else 0)).limit(SAMPLE_DOCUMENTS)
    sample = chosen.select(F.substring("text", 1, SAMPLE_CHARACTERS).alias("text")).collect()
    encoder = encoder_of(definition)
    dictionary = train_dictionary(encoder.encode([r["text"].encode() for r in sample])) if sample else b""
    digest = hashlib.sha256(dictionary)
    width = encoder.width
    spark.createDataFrame([(digest.hexdigest(), bytearray(dictionary))], "hash string, dictionary binary").coalesce(
        1
    ).write.parquet(f"{path}/dictionary")
    shared = spark.sparkContext.broadcast((definition, dictionary))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        definition, dictionary = shared.value
        encoder = encoder_of(definition)
        digest = hashlib.sha256(dictionary).digest()
        writer = zstandard.ZstdCompressor(level=3, dict_data=dictionary_of(dictionary) if dictionary else None)
        end = np.asarray([end_id], encoder.type).tobytes()
        part, number, size, before = TaskContext.get().partitionId(), 0, 0, 0
        ids: list = []
        frames: list[bytes] = []
        tokens: list[int] = []

        def shard() -> pa.RecordBatch:
            some = [i for i in ids if i is not None]
            row = {
                "part": part,
                "shard": number,
                "first_doc": min(some, default=None),
                "last_doc": max(some, default=None),
                "documents": len(ids),
                "tokens": sum(tokens),
                "before": before,
                "dictionary": digest.hex(),
                "image": shard_image(ids, frames, tokens, digest, encoder.width, end_id),
            }
            return pa.RecordBatch.from_pylist([row], schema=arrow)

        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                rows = batch.slice(i, 256)
                raw = encoder.encode(rows.column(1).cast(pa.binary()).to_pylist())
                for doc_id, r in zip(rows.column(0).to_pylist(), raw, strict=True):
                    frame = writer.compress(r + end)
                    ids.append(doc_id)
                    frames.append(frame)
                    tokens.append(len(r) // encoder.width + 1)
                    size += len(frame)
                    if size >= SHARD_BYTES or len(ids) >= SHARD_DOCUMENTS:
                        yield shard()
                        before += sum(tokens)
                        number, size = number + 1, 0
                        ids, frames, tokens = [], [], []
        if ids:
            yield shard()

    arrow = pa.schema(
        [
            ("part", pa.int32()),
            ("shard", pa.int32()),
            ("first_doc", pa.int64()),
            ("last_doc", pa.int64()),
            ("documents", pa.int64()),
            ("tokens", pa.int64()),
            ("before", pa.int64()),
            ("dictionary", pa.string()),
            ("image", pa.binary()),
        ]
    )
    assert width in (2, 4)
    (
        texts.repartitionByRange(shuffle_partitions(spark), "doc_id")
        .sortWithinPartitions("doc_id")
        .mapInArrow(encode, SHARD_SCHEMA)
        .write.option("parquet.block.size", 16 << 20)
        .parquet(f"{path}/shards")
    )


def stored_dictionary(spark: SparkSession, path: str) -> bytes:
    row = spark.read.parquet(f"{path}/dictionary").first()
    raw = bytes(row["dictionary"])
    if hashlib.sha256(raw).hexdigest() != row["hash"]:
        raise ValueError("the stored dictionary is damaged")
    return raw


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every stored document, from its decompressed ids.

    ``start`` counts the ids of all documents before it: those of earlier parts, of which the driver gets one sum each, those
    of earlier shards of its part, which each shard notes, and those before it in its shard.
    """
    ship_code(spark)
    shared = spark.sparkContext.broadcast(stored_dictionary(spark, path))
    shards = spark.read.schema(SHARD_SCHEMA).parquet(f"{path}/shards")
    totals = shards.groupBy("part").agg(F.sum("tokens").alias("tokens")).collect()
    before, total = [], 0
    for r in sorted(totals, key=lambda r: r["part"]):
        before.append((r["part"], total))
        total += r["tokens"]
    parts = spark.createDataFrame(before, "part int, part_start long")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, image in zip(batch.column("start").to_pylist(), batch.column("image"), strict=True):
                shard = Shard(image.as_py(), shared.value)
                tokens, crcs = [], []
                for k in range(shard.count):
                    ids = shard.ids(k)
                    tokens.append(len(ids))
                    crcs.append(zlib.crc32(ids.astype("<u4").tobytes()))
                n = np.asarray(tokens, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(shard.doc_ids, mask=~shard.present),
                        pa.array(start + np.cumsum(n) - n),
                        pa.array(n),
                        pa.array(crcs, pa.int64()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return (
        shards.select("part", "before", "image")
        .join(F.broadcast(parts), "part")
        .select((F.col("part_start") + F.col("before")).alias("start"), "image")
        .mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long")
    )


def read_document(spark: SparkSession, path: str, doc_id: int) -> list[np.ndarray]:
    """The ids of the documents of one id, from its shards and frames alone."""
    dictionary = stored_dictionary(spark, path)
    rows = spark.read.parquet(f"{path}/shards").where((F.col("first_doc") <= doc_id) & (F.col("last_doc") >= doc_id))
    found = []
    for row in rows.orderBy("part", "shard").select("image").toLocalIterator():
        shard = Shard(bytes(row["image"]), dictionary)
        found += [shard.ids(k) for k in np.flatnonzero(shard.present & (shard.doc_ids == doc_id))]
    return found


def token_digest(documents: DataFrame, scratch: Scratch, vocabulary: str, end_id: int = END_ID) -> DataFrame:
    """Write the token files of all documents by the tokenizer at ``vocabulary``, and read them back."""
    with open(vocabulary, encoding="utf-8") as f:
        definition = f.read()
    write_token_files(documents, scratch.path("tokens"), definition, end_id)
    return read_token_files(documents.sparkSession, scratch.path("tokens"))
