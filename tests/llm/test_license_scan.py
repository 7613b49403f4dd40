from __future__ import annotations

import random
import re
from math import ceil
from pathlib import Path

import pytest

from skyfold.llm.license_scan import TEMPLATES, scan_licenses


def grams(text):
    words = re.sub(r"[^\w\n]|_", " ", text.lower()).split()
    return set(zip(words, words[1:])) if len(words) > 1 else set(words)


def words_of(text):
    return re.sub(r"[^\w]|_", " ", (text or "").lower()).split()


def indexed(templates):
    """The bigrams by which windows are found: of each template its rarer ones, one more than a match can lack."""
    sets = {name: {g for g in grams(t) if len(g) == 2 and isinstance(g, tuple)} for name, t in templates.items()}
    out = set()
    for held in sets.values():
        ranked = sorted(held, key=lambda g: (sum(g in o for o in sets.values()), -len(" ".join(g)), " ".join(g)))
        out |= set(ranked[: len(held) - ceil(len(held) * 0.8 / 1.2 - 1e-9) + 1])
    return out


def brute_windows(text, templates, index):
    """Every template over every place where the text has an indexed bigram of it; the best template of each place."""
    words, found = words_of(text), {}
    for p, g in enumerate(zip(words, words[1:])):
        best = None
        for name, t in templates.items() if g in index else ():
            laid = words_of(t)
            for q, h in enumerate(zip(laid, laid[1:])):
                if g == h:
                    part = words[max(0, p - q) : p - q + len(laid)]
                    held, wanted = set(zip(part, part[1:])), set(zip(laid, laid[1:]))
                    dice = 2 * len(held & wanted) / (len(held) + len(wanted))
                    if dice >= 0.8:
                        best = min(best or (0,), (-dice, name, p - q))
        if best:
            key = best[1:]
            found[key] = max(found.get(key, 0), -best[0])
    names = {name for name, _ in found}
    return {("window", n, sum(k[0] == n for k in found), round(max(d for k, d in found.items() if k[0] == n), 9)) for n in names}


def brute(text):
    text = text or ""
    paragraphs = re.split(r"\n *\n[ \n]*", re.sub(r"[^\w\n]+|_", " ", text))
    units = [("line", x) for x in text.split("\n")] + [("paragraph", p) for p in paragraphs if "\n" in p.strip(" \n")]
    if len(paragraphs) > 1:
        units.append(("text", text))
    found = {}
    for kind, unit in units:
        held = grams(unit)
        best = max(
            ((2 * len(held & grams(t)) / (len(held) + len(grams(t))), name) for name, t in TEMPLATES.items()),
            key=lambda x: (x[0], [-ord(c) for c in x[1]]),
        )
        if held and best[0] >= 0.8:
            n, d = found.get((kind, best[1]), (0, 0))
            found[kind, best[1]] = n + 1, max(d, best[0])
    return {(k, name, n, round(d, 9)) for (k, name), (n, d) in found.items()}


TEXTS = [
    None,
    "",
    "\n \n",
    "one",
    "Released under the MIT License.",
    "released UNDER the   (mit) license",
    "some words\nLicensed under CC BY-NC 4.0.\nmore words\nLicensed under CC BY-NC 4.0.",
    "This work is licensed under the GNU General Public License, version 2.",
    TEMPLATES["MIT-text"].replace(", to ", ",\nto ").replace("without fee", ""),
    "Intro\n\n" + TEMPLATES["ISC"].replace(" for any", "\nfor any") + "\n \n\nOutro",
    "the same\n\n" + "x y " * 30000,
    "licensed under the law",
    "Copyright 2024 Acme. Released under the MIT License.",
    "This file is part of Foo and is Licensed under the Apache License, Version 2.0.",
    "a b License. Released under the MIT",
    "x " + TEMPLATES["LGPL-3.0"] + " y " + TEMPLATES["GPL-2.0"] + " z\n" + TEMPLATES["GPL-2.0"] + TEMPLATES["CC-BY-SA-4.0"],
    "one " * 500 + TEMPLATES["MIT-full"].replace("the rights to", "all of the rights to").replace("\"AS IS\",", "") + " two" * 500,
    "words " + TEMPLATES["BSD-3-Clause-text"].replace(" are ", "\nare ") + " words " + TEMPLATES["GPL-3.0-notice"].replace(";", ","),
]


def test_matches_equal_brute_force(documents):
    rows = scan_licenses(documents(list(enumerate(TEXTS)))).collect()
    index = indexed(TEMPLATES)
    for i, text in enumerate(TEXTS):
        got = {(r["kind"], r["license"], r["passages"], round(r["dice"], 9)) for r in rows if r["doc_id"] == i}
        assert got == brute(text) | brute_windows(text, TEMPLATES, index), text and text[:60]
    inside = {(r["doc_id"], r["license"]) for r in rows if r["kind"] == "window"}
    assert {(12, "MIT"), (13, "Apache-2.0"), (15, "LGPL-3.0"), (15, "GPL-2.0"), (15, "CC-BY-SA-4.0"), (16, "MIT-full")} <= inside
    assert {(17, "BSD-3-Clause-text"), (17, "GPL-3.0-notice")} <= inside


@pytest.mark.parametrize("seed", range(4))
def test_windows_of_random_templates_equal_brute_force(spark, documents, seed):
    r = random.Random(seed)

    def some(n, kinds):
        return " ".join(f"w{r.randrange(kinds)}" for _ in range(n))

    templates = {f"t{i}": some(r.randint(1, 12), 4 + 6 * (seed % 2)) for i in range(8)}
    texts = []
    for _ in range(60):
        t = r.choice(list(templates.values())).split()
        if len(t) > 3 and r.random() < 0.6:
            t.insert(r.randrange(len(t)), "new")
        texts.append(" ".join([some(r.randint(0, 8), 10), *t, some(r.randint(0, 8), 10), r.choice(list(templates.values()))]))
    table = spark.createDataFrame(list(templates.items()), "license string, template string")
    rows = scan_licenses(documents(list(enumerate(texts))), table).where("kind = 'window'").collect()
    index = indexed(templates)
    for i, text in enumerate(texts):
        got = {("window", r["license"], r["passages"], round(r["dice"], 9)) for r in rows if r["doc_id"] == i}
        assert got == brute_windows(text, templates, index)


def test_any_window_that_matches_holds_an_indexed_bigram():
    index, r = indexed(TEMPLATES), random.Random(3)
    for t in TEMPLATES.values():
        wanted = grams(t)
        for _ in range(30):
            words = words_of(t)
            for _ in range(r.randint(0, 3)):
                words[r.randrange(len(words))] = "other"
            a, b = sorted(r.sample(range(len(words) + 1), 2))
            held = set(zip(words[a:b], words[a + 1 : b]))
            if held and 2 * len(held & wanted) / (len(held) + len(wanted)) >= 0.8:
                assert held & wanted & index


@pytest.mark.skipif(not Path("/usr/share/common-licenses/GPL-3").is_file(), reason="no licence texts on this machine")
def test_whole_licence_texts_are_found_inside_others(spark, documents):
    full = {name: Path(f"/usr/share/common-licenses/{name}").read_text() for name in ("GPL-2", "GPL-3", "Apache-2.0")}
    docs = [
        (1, "before " * 40 + full["GPL-3"].replace("\n", " ") + " after" * 40),
        (2, full["Apache-2.0"] + "\n\nCopyright 2024 Acme"),
        (3, full["GPL-2"][: len(full["GPL-2"]) // 3]),
        (4, "some words " + full["GPL-3"][5000:] + full["GPL-2"].replace("distribute", "copy")),
    ]
    table = spark.createDataFrame([*TEMPLATES.items(), *full.items()], "license string, template string")
    rows = scan_licenses(documents(docs), table).where("kind = 'window'").collect()
    whole = {(r["doc_id"], r["license"]) for r in rows if r["license"] in full}
    assert whole == {(1, "GPL-3"), (2, "Apache-2.0"), (4, "GPL-3"), (4, "GPL-2")}


def test_other_templates_repeats_and_empty_tables(documents):
    docs = documents([(None, "a b c"), (1, "a b c"), (1, "a b c")])
    rows = scan_licenses(docs.withColumnRenamed("lang", "license"), {"z": "a b c", "y": "a b c"}).collect()
    assert {(r["doc_id"], r["license"], r["passages"]) for r in rows} == {(None, "y", 1), (1, "y", 2)}
    assert scan_licenses(docs.limit(0)).isEmpty() and scan_licenses(docs, {}).isEmpty()
    with pytest.raises(ValueError, match="at most"):
        scan_licenses(docs, {"long": "w " * 20_000})
