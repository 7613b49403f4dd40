from __future__ import annotations

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from skyfold.llm.quality_rules import (
    BASE,
    Condition,
    _repeat_words,
    judged,
    learn_rules,
    quality_filter,
    verdict,
    with_statistics,
)
from tests.llm.conftest import prose

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if times[w] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
    )


TEXTS = [
    None,
    "",
    " \t\n\x0b\x0c\r",
    "one",
    "a a a a a a",
    "a b c a b c a b",
    "x y z\nx y z\n\n \nx y z ",
    "§ é 😀 # * $ % & | < >\u00a0b",
    "\n\n\n",
    prose(1, 3000, 30),
    "ab " * 20000,
    prose(2, 60),
]


def test_statistics_equal_brute_force(spark, documents):
    found = {r["doc_id"]: r for r in with_statistics(documents(list(enumerate(TEXTS)))).collect()}
    for i, text in enumerate(TEXTS):
        assert tuple(found[i][c] for c in BASE) == brute(text), text and text[:50]


@pytest.fixture(scope="module")
def labelled(spark):
    """Clean prose, and bad texts of two kinds: full of symbols, or shouted."""
    rows, labels = [], []
    for i in range(900):
        bad = i % 3 == 0
        text = prose(i, 80 + i % 70)
        if bad:
            text = text.replace(" ", " ### ") if i % 2 else text.upper().replace(" ", "!! ")
        rows.append((i, text, "en", "s", len(text)))
        labels.append((i, 0 if bad else 1, 0))
    make = "doc_id long, text string, lang string, source string, n_chars long"
    return spark.createDataFrame(rows, make), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("hash_bits", [1, 3, 8, 64])
def test_windows_that_share_a_hash_are_told_apart_by_their_words(spark, documents, hash_bits):
    texts = [t for t in TEXTS if t and len(t) < 20000] + [prose(k, 40 * k, 4 * k) for k in range(1, 12)]
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    found = {r["doc_id"]: r["n"] for r in documents(list(enumerate(texts))).select("doc_id", _repeat_words(words, hash_bits).alias("n")).collect()}
    assert [found[i] for i in range(len(texts))] == [brute(t)[4] for t in texts]


def test_a_text_of_many_words_is_counted_exactly(spark, documents):
    text = prose(5, 300_000, 400)
    row = with_statistics(documents([(1, text)])).first()
    assert tuple(row[c] for c in BASE) == brute(text)


def test_rules_learned_on_half_judge_the_other_half(spark, labelled, scratch):
    docs, labels = labelled
    statistics = with_statistics(docs)
    rules = learn_rules(statistics, labels.where("doc_id < 450"), scratch)
    assert 1 <= len(rules) <= 8
    held_out = judged(statistics.where("doc_id >= 450"), rules).join(labels, "doc_id")
    assert held_out.where("kept = (quality = 1)").count() >= 0.97 * held_out.count()


def test_filter_keeps_columns_and_rows_as_they_were(spark, labelled, scratch):
    docs, labels = labelled
    odd = docs.withColumnsRenamed({"lang": "n_words"}).unionAll(docs.where("doc_id < 10"))
    kept = quality_filter(odd, labels, scratch)
    assert kept.columns == odd.columns
    assert kept.exceptAll(odd).isEmpty()
    assert kept.where("doc_id % 3 = 0").count() <= 12
    assert kept.where("doc_id % 3 > 0").count() >= 594 and kept.where("doc_id = 1").count() == 2


def test_labels_that_teach_nothing(spark, documents, scratch):
    docs = documents([(1, prose(1, 80)), (2, None), (None, prose(3, 90)), (3, "short")])
    labels = spark.createDataFrame(
        [(1, 1, 0), (2, None, None), (None, 0, 0), (99, 0, 1)], "doc_id long, quality int, toxic int"
    )
    for some in (labels, labels.limit(0)):
        rules = learn_rules(with_statistics(docs), some, scratch)
        assert rules == []
        rows = {(r["doc_id"], r["base_failed"], r["kept"]) for r in judged(with_statistics(docs), rules).collect()}
        assert rows == {(1, False, True), (2, True, False), (None, False, True), (3, True, False)}
        scratch.drop("labelled", "binned")
    assert judged(with_statistics(docs.limit(0)), []).isEmpty()


def test_the_list_is_one_ordered_expression():
    rule = (Condition("words", False, 10.0), Condition("upper_share", True, 0.5))
    text = str(verdict([rule, (Condition("words", True, 99.0),)]))
    assert text.count("CASE") == 1 and text.count("WHEN") == 2
