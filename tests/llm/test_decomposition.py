from __future__ import annotations

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from skyfold.llm.common import Scratch
from skyfold.llm.decomposition import binary_pieces, decompose, pack_by_length
from tests.llm.conftest import prose

PATH = public_tokenizers.path("word_bpe_49k.json")


def brute(n, longest):
    """Lengths of the pieces of n tokens, longest first."""
    out = []
    while n:
        p = min(longest, 1 << (n.bit_length() - 1))
        out.append(p)
        n -= p
    return out


@pytest.mark.parametrize("longest", [1, 2, 8, 2048])
def test_lengths_are_the_binary_digits(longest):
    tokens = np.asarray([1, 5, 0, 2047, 2048, 2049, 4096, 7000, 3])
    document, length = binary_pieces(tokens, longest)
    assert [length[document == d].tolist() for d in range(len(tokens))] == [brute(n, longest) for n in tokens.tolist()]
    assert binary_pieces(tokens[:0], longest)[0].tolist() == []


ROWS = [
    (None, None),
    (1, ""),
    (1, "twice the id"),
    (1, "twice the id"),
    (2, "<|endoftext|> ÉCOLE 漢字 😀 don't"),
    (3, prose(1, 9000)),
    (None, prose(2, 700)),
    *[(10 + i, prose(i, 1 + i * 13 % 400)) for i in range(150)],
]


@pytest.mark.parametrize("longest", [64, 2048])
def test_every_token_lies_in_one_piece_of_its_document(documents, spark, longest, monkeypatch):
    monkeypatch.setattr("skyfold.llm.batches.SLICE_BYTES", 20_000)
    clashing = documents(ROWS, 4).withColumnsRenamed({"lang": "length", "source": "file", "n_chars": "row"})
    found = pack_by_length(clashing, Scratch(spark, "pieces"), PATH, longest).collect()
    plain = Tokenizer.from_file(PATH)
    expected = []
    for doc_id, text in ROWS:
        ids = [*plain.encode(text or "", add_special_tokens=False).ids, 1]
        at = 0
        for n in brute(len(ids), longest):
            expected.append((doc_id, at, n, len(ids), np.asarray(ids[at : at + n], "<u4").tobytes()))
            at += n
    got = [(r["doc_id"], r["start"], r["length"], r["doc_tokens"], bytes(r["ids"])) for r in found]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert sorted(r["sequence_id"] for r in found) == list(range(len(found))) and {r["offset"] for r in found} == {0}
    by_number = sorted(found, key=lambda r: r["sequence_id"])
    assert [r["length"] for r in by_number] == sorted((r["length"] for r in found), reverse=True)


def test_buckets_are_folders(documents, spark):
    scratch = Scratch(spark, "folders")
    pack_by_length(documents([(1, prose(1, 300))]), scratch, PATH)
    part = spark.read.parquet(scratch.path("buckets")).where("length >= 256")
    assert part.count() >= 1 and "PartitionFilters: [isnotnull(length" in part._jdf.queryExecution().toString()


def test_an_empty_table_and_a_bad_length(documents, scratch):
    with open(PATH, encoding="utf-8") as f:
        definition = f.read()
    assert pack_by_length(documents([(1, "")]).limit(0), scratch, PATH).isEmpty()
    with pytest.raises(ValueError, match="power of two"):
        decompose(documents([(1, "")]), definition, 1000)
