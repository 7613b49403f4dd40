from __future__ import annotations

import hashlib
import json
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from skyfold.llm import alignment
from skyfold.llm.alignment import ByteLevel, align, pair_counts
from skyfold.llm.common import Scratch
from skyfold.llm.perfect_hash import PerfectHash
from tests.llm.conftest import prose

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def plain():
    """Both tokenizers, and the bytes of their ids, by the plainest use of their libraries."""
    a = Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    keep = [n for n in range(256) if 33 <= n <= 126 or 161 <= n <= 172 or 174 <= n <= 255]
    spelling = {chr(n): n for n in keep}
    for n in range(256):
        if n not in keep:
            spelling[chr(256 + len(spelling) - len(keep))] = n
    bytes_a = {i: bytes(spelling[c] for c in t) for t, i in a.get_vocab(with_added_tokens=False).items()}

    def bytes_b(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:-1], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(text):
        """(id, start, end) of both, or nothing."""
        if not text:
            return [], []
        out = []
        for ids, spelled in ((a.encode(" " + text, add_special_tokens=False).ids, bytes_a.__getitem__), (b.encode(text), bytes_b)):
            tokens, at = [], 0
            for i in ids:
                tokens.append((i, at, at + len(spelled(i))))
                at = tokens[-1][2]
            if b"".join(map(spelled, ids)) != (" " + text).encode():
                return [], []
            out.append(tokens)
        return out

    return encode


def brute(rows, encode):
    """The result by the definition: every pair of tokens whose bytes overlap, one document after the other."""
    found = []
    for doc_id, text, *_ in rows:
        ta, tb = encode(text)
        links, j = [], 0
        for a, s, e in ta:
            while j < len(tb) and tb[j][2] <= s:
                j += 1
            k = j
            while k < len(tb) and tb[k][1] < e:
                links.append((a, tb[k][0]))
                k += 1
        groups, a_left, b_left = [], list(ta), list(tb)
        for end in sorted({t[2] for t in ta} & {t[2] for t in tb}):
            ga, gb = [t for t in a_left if t[2] <= end], [t for t in b_left if t[2] <= end]
            a_left, b_left = a_left[len(ga) :], b_left[len(gb) :]
            groups.append("|".join(",".join(str(t[0]) for t in g) for g in (ga, gb)))
        found.append((doc_id, len(ta), len(tb), groups, links))
    counts = {}
    for *_, links in found:
        for pair in set(links):
            counts[pair] = counts.get(pair, 0) + 1
    highest = {}
    for (a, _), n in counts.items():
        highest[a] = max(n, highest.get(a, 0))
    rows = [
        (
            doc_id,
            n_a,
            n_b,
            len(groups),
            len(links),
            sum(counts[p] == highest[p[0]] for p in links),
            sum(counts[p] for p in links),
            hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "",
        )
        for doc_id, n_a, n_b, groups, links in found
    ]
    return sorted(rows, key=repr), counts


ODD = [
    (None, None),
    (1, ""),
    (2, " "),
    (3, "  leading, trailing  and   many \n\n\t spaces  　  x "),
    (4, "<|endoftext|> <s> </s> <unk> <0x41> [INST]"),
    (5, "a▁b is no text that both spell"),
    (6, "fine words ▁ around it, fine words"),
    (7, "漢字かな 한국어 हिन्दी 😀😀🏳️‍🌈 \U0001f9ff ÀÉ ﬁ ß İ é"),
    (8, "\x00\x01\x1c\x85\x7f control\x00"),
    (9, "x" * 3000 + " " + "1234567890" * 50),
    (10, "don't we'll I'VE they're 'tis"),
    (None, "twice twice"),
    (11, "twice twice"),
    (11, "twice twice"),
    (12, "퟿￿﻿"),
    (13, prose(7, 4000)),
]


def got(frame):
    assert frame.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def test_equals_the_definition(documents, spark, plain):
    rows = ODD + [(100 + i, prose(i, 1 + i * 11 % 90)) for i in range(60)]
    clashing = documents(rows, 4).withColumnsRenamed({"lang": "block", "source": "payload", "n_chars": "bucket"})
    expected, _ = brute(rows, plain)
    assert got(align(clashing, Scratch(spark, "align"), A_PATH, B_PATH)) == expected


def test_small_blocks_leaves_and_memory_give_the_same(documents, spark, plain, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 400)
    monkeypatch.setattr(alignment, "LEAF_BLOCKS", 3)
    monkeypatch.setattr(alignment, "FAN", 2)
    monkeypatch.setattr(alignment, "BUCKETS", 5)
    rows = ODD + [(100 + i, prose(i % 50, 1 + i * 11 % 90)) for i in range(120)]
    expected, counts = brute(rows, plain)
    assert got(align(documents(rows, 2), Scratch(spark, "align"), A_PATH, B_PATH)) == expected
    found = pair_counts(documents(rows, 3), Scratch(spark, "pairs"), A_PATH, B_PATH).collect()
    assert {(r["a"], r["b"]): r["documents"] for r in found} == counts and len(found) == len(counts)


def test_a_worker_that_forgets_gives_the_same(plain, monkeypatch):
    monkeypatch.setattr(alignment, "STRETCHES", 40)
    with open(A_PATH, encoding="utf-8") as f, open(B_PATH, "rb") as g:
        aligner = alignment.Aligner(f.read(), g.read())
    assert aligner.cuts
    for seed in range(12):
        texts = [prose(seed, 60), prose(seed + 1, 60), "a▁b", "", " "]
        found = aligner.of([t.encode() for t in texts], spell=True)
        pairs, documents = found.documents_of_pairs()
        expected, counts = brute(list(enumerate(texts)), plain)
        assert dict(zip([divmod(p, aligner.width) for p in pairs.tolist()], documents.tolist())) == counts
        sums = found.digest(pairs, documents, np.ones(len(pairs), np.uint8))
        assert list(zip(range(5), sums["n_links"].tolist(), sums["count_sum"].tolist(), sums["groups_sha256"])) == [
            (r[0], r[4], r[6], r[7]) for r in expected
        ]


def test_a_stretch_is_looked_up_once_a_block_and_cut_between_visible_characters():
    class Counted(dict):
        asked = 0

        def get(self, key):
            Counted.asked += 1
            return dict.get(self, key)

        def __getitem__(self, key):
            Counted.asked += 1
            return dict.__getitem__(self, key)

    with open(A_PATH, encoding="utf-8") as f, open(B_PATH, "rb") as g:
        aligner = alignment.Aligner(f.read(), g.read())
    texts = ["one two  three", "", " ", " é à", "中 x\u3000y ’ z"]
    aligner.of([t.encode() for t in texts * 50], spell=False)
    assert sorted(aligner.place) == sorted(s.encode() for s in ("one", "two  three", " ", " é", "à", "中", "x\u3000y ’ z"))
    aligner.place = Counted(aligner.place)
    assert aligner.of([t.encode() for t in texts * 50], spell=False).counts.tolist() == [2, 0, 1, 2, 2] * 50
    assert Counted.asked == len(aligner.place)


def test_empty_tables(documents, spark):
    none = documents([(1, "x")]).limit(0)
    assert align(none, Scratch(spark, "align"), A_PATH, B_PATH).isEmpty()
    assert pair_counts(none, Scratch(spark, "pairs"), A_PATH, B_PATH).isEmpty()
    blank = align(documents([(1, None), (2, "")]), Scratch(spark, "align"), A_PATH, B_PATH)
    assert got(blank) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_the_byte_level_encoder_equals_its_library():
    with open(A_PATH, encoding="utf-8") as f:
        definition = f.read()
    fast = ByteLevel(definition)
    plain = Tokenizer.from_file(A_PATH)
    plain.encode_special_tokens = True
    characters = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f" a{c}b {c}{c} 1" for c in characters[i : i + 400]) for i in range(0, len(characters), 400)]
    expected = [e.ids for e in plain.encode_batch_fast(texts, add_special_tokens=False)]
    assert fast.encode(texts) == expected
    slow = json.loads(definition)
    slow["model"]["merges"] = slow["model"]["merges"][1:]
    other = ByteLevel(json.dumps(slow))
    assert other.encode(["<|endoftext|> a"]) == fast.encode(["<|endoftext|> a"])


@pytest.mark.parametrize("n", [0, 1, 2, 63, 1000, 20_000])
def test_perfect_hashes_are_minimal(n):
    r = random.Random(n)
    keys = np.asarray(sorted({r.randrange(1 << 40) for _ in range(n)}), np.int64)
    made = PerfectHash.of(keys)
    again = PerfectHash.from_bytes(made.to_bytes())
    assert sorted(made.numbers(keys).tolist()) == list(range(len(keys))) and len(again) == len(keys)
    assert (again.numbers(keys[::-1]) == made.numbers(keys)[::-1]).all()
    foreign = again.numbers(keys + (1 << 41))
    assert ((foreign >= -1) & (foreign < len(keys))).all()
