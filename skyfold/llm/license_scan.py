"""Licence scan: normalised passages of a text compared to licence templates by the Dice coefficient of their word bigrams.

Passages are the lines of a text, its paragraphs of several lines (blank lines end them), the whole text if it has several
paragraphs, and windows. Normalising lower-cases letters and turns everything but letters and digits into single spaces. With A
and B the sets of word bigrams of passage and template, Dice = 2 |A and B| / (|A| + |B|) reaches a threshold t only if the larger
set holds at most (2 - t) / t as many bigrams as the smaller. Templates are therefore joined on the size classes that they can
match, and only templates within the bounds are compared. A passage of one word has that word as its only element.

Windows find a licence that shares its line or paragraph with other words. A passage that reaches t holds at least t / (2 - t) of a
template's bigrams, so it holds one of any set that is larger than the rest; of each template such a set, of its rarer bigrams, is
indexed. Rarer are those in fewer templates, then those of more characters, then the smaller ones. Wherever the text holds an indexed bigram, every template with
that bigram is laid over the text so that both meet, as many words long as the template, cut off where the text ends, and
compared. The best template of each place counts; windows of a licence at the same place are one. Templates of one word have no windows.

Nulls and odd cases: null and empty texts have no passage and give no row; null ids are carried; repeated rows give repeated
results. Of templates with an equal coefficient the smallest name is returned. Templates are a parameter, at most
``MAX_TEMPLATES`` of at most ``MAX_TEMPLATE_WORDS`` words; each is broadcast at most four times, which bounds that. A template without
a word matches nothing. Other columns are left out.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyfold.llm.common import let

THRESHOLD = 0.8
MAX_TEMPLATES = 500
MAX_TEMPLATE_WORDS = 10_000

#: Short notices and short texts of public licences. Long texts come from a table.
TEMPLATES = {
    "AGPL-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation; either version 3 of the License, or (at your option) any later version.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "BSD-2-Clause": "Licensed under the BSD 2-Clause License.",
    "BSD-2-Clause-text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    "BSD-3-Clause": "Licensed under the BSD 3-Clause License.",
    "BSD-3-Clause-text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "Released under CC0 1.0 Universal.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-2.0-notice": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 3 of the License, or (at your option) any later version.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "LGPL-2.1-notice": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MIT-full": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}


def normalised(text: Column) -> Column:
    """Letters in lower case and digits, single spaces between; line feeds stay."""
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}\n]+", " ")


def pair_hashes(words: Column) -> Column:
    """Hashes of the word bigrams, in order."""
    pairs = F.transform(F.sequence(F.lit(0), F.size(words) - 2), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1)))
    return F.when(F.size(words) < 2, F.array().cast("array<long>")).otherwise(pairs)


def pair_sequence(passage: Column) -> Column:
    """Hashes of all word bigrams of a normalised passage, in order."""
    return let(F.filter(F.split(passage, r"[ \n]+"), lambda w: w != ""), pair_hashes)


def bigrams(passage: Column) -> Column:
    """Distinct word bigrams of a normalised passage, as hashes."""

    def of(words: Column) -> Column:
        pairs = F.transform(F.sequence(F.lit(0), F.size(words) - 2), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1)))
        return F.when(F.size(words) < 2, F.transform(words, lambda w: F.xxhash64(w))).otherwise(F.array_distinct(pairs))

    return let(F.filter(F.split(passage, r"[ \n]+"), lambda w: w != ""), of)


def passages(text: Column) -> Column:
    """Lines, paragraphs of several lines, and a whole text of several paragraphs, normalised, without blank ones.

    Each is a struct of ``kind`` and ``passage``.
    """

    def of(norm: Column) -> Column:
        lines = F.transform(F.split(norm, "\n"), lambda x: F.struct(F.lit("line").alias("kind"), F.trim(x).alias("passage")))

        def further(blocks: Column) -> Column:
            several = F.filter(blocks, lambda b: F.contains(F.trim(b, F.lit(" \n")), F.lit("\n")))
            whole = F.when(F.size(blocks) > 1, F.array(norm)).otherwise(F.array().cast("array<string>"))
            return F.concat(
                F.transform(several, lambda b: F.struct(F.lit("paragraph").alias("kind"), b.alias("passage"))),
                F.transform(whole, lambda b: F.struct(F.lit("text").alias("kind"), b.alias("passage"))),
            )

        return F.filter(
            F.concat(lines, let(F.split(norm, r"\n *\n[ \n]*"), further)),
            lambda p: F.length(F.translate(p["passage"], " \n", "")) > 0,
        )

    return let(normalised(text), of)


def _sized(templates: DataFrame) -> DataFrame:
    """``license, pairs, wanted``: the bigrams of each template in their order, and the distinct ones."""
    norm = normalised(F.col("template"))
    return templates.select("license", pair_sequence(norm).alias("pairs"), bigrams(norm).alias("wanted")).where(F.size("wanted") > 0)


def _index(templates: DataFrame, threshold: float) -> DataFrame:
    """``pair, at``: the indexed bigrams, each with all its places in templates, as structs of ``license`` and ``place``."""
    words = F.filter(F.split(normalised(F.col("template")), r"[ \n]+"), lambda w: w != "")
    placed = (
        templates.select("license", words.alias("words"))
        .select("license", "words", F.posexplode(pair_hashes(F.col("words"))).alias("place", "pair"))
        .withColumn("spelt", F.concat_ws(" ", F.get("words", "place"), F.get("words", F.col("place") + 1)))
        .drop("words")
    )
    rarity = placed.groupBy("pair").agg(F.count_distinct("license").alias("held"), F.min("spelt").alias("spelt"))
    by_template = Window.partitionBy("license")
    chosen = (
        placed.select("license", "pair")
        .distinct()
        .join(rarity, "pair")
        .withColumn("n", F.count(F.lit(1)).over(by_template))
        .withColumn("nth", F.row_number().over(by_template.orderBy("held", F.desc(F.length("spelt")), "spelt")))
        .where(F.col("nth") <= F.col("n") - F.ceil(F.col("n") * (threshold / (2 - threshold)) - 1e-9) + 1)
        .select("pair")
        .distinct()
    )
    return placed.join(chosen, "pair").groupBy("pair").agg(F.collect_list(F.struct("license", "place")).alias("at"))


def _windows(documents: DataFrame, index: DataFrame, sized: DataFrame, threshold: float) -> DataFrame:
    """``doc_id, kind, license, passages, dice`` of windows; ``passages`` counts different places."""
    held = F.array_distinct(F.slice("text_pairs", F.greatest(F.col("start"), F.lit(0)) + 1, F.greatest(F.col("length"), F.lit(0))))
    end = F.least(F.col("start") + F.size("pairs"), F.size("text_pairs"))

    def dice(held: Column) -> Column:
        return 2 * F.size(F.array_intersect(held, F.col("wanted"))) / (F.size(held) + F.size("wanted"))

    met = (
        documents.select(F.monotonically_increasing_id().alias("row"), "doc_id", pair_sequence(normalised(F.col("text"))).alias("text_pairs"))
        .select("row", "doc_id", "text_pairs", F.posexplode("text_pairs").alias("met", "pair"))
        .join(F.broadcast(index), "pair")
        .select("row", "doc_id", "text_pairs", "met", F.inline("at"))
        .join(F.broadcast(sized), "license")
        .withColumn("start", F.col("met") - F.col("place"))
        .withColumn("length", end - F.greatest(F.col("start"), F.lit(0)))
        .select("row", "doc_id", "met", "start", "license", let(held, dice).alias("dice"))
        .where(F.col("dice") >= threshold)
    )
    return (
        met.groupBy("row", "doc_id", "met")
        .agg(F.min(F.struct((-F.col("dice")).alias("distance"), "license", "start")).alias("best"))
        .groupBy("row", "doc_id", F.lit("window").alias("kind"), "best.license", "best.start")
        .agg(F.max(-F.col("best.distance")).alias("dice"))
        .groupBy("doc_id", "kind", "license")
        .agg(F.count(F.lit(1)).alias("passages"), F.max("dice").alias("dice"))
    )


def scan_licenses(documents: DataFrame, templates: dict[str, str] | DataFrame | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, kind, license, passages, dice``: how many passages of a kind match a licence best, and the best coefficient.

    ``templates`` is a table of ``license`` and ``template``, or a dictionary. Documents without a match have no row.
    """
    spark = documents.sparkSession
    templates = TEMPLATES if templates is None else templates
    if isinstance(templates, dict):
        templates = spark.createDataFrame(sorted(templates.items()), "license string, template string")
    names = templates.select("license", "template")
    words = F.size(F.filter(F.split(normalised(F.col("template")), r"[ \n]+"), lambda w: w != ""))
    number, longest = names.agg(F.count(F.lit(1)), F.max(words)).first()
    if number > MAX_TEMPLATES or (longest or 0) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"at most {MAX_TEMPLATES} templates of {MAX_TEMPLATE_WORDS} words")
    sized = _sized(names)
    ratio = (2 - threshold) / threshold

    def size_class(n: Column) -> Column:
        return F.floor(F.log(n) / log(ratio)).cast("int")

    low, high = F.ceil(F.size("wanted") / F.lit(ratio) - 1e-9), F.floor(F.size("wanted") * F.lit(ratio) + 1e-9)
    by_size = (
        sized.withColumns({"low": low, "high": high})
        .withColumn("class", F.explode(F.sequence(size_class(F.greatest("low", F.lit(1))), size_class(F.col("high")))))
        .groupBy("class")
        .agg(F.collect_list(F.struct("license", "wanted", "low", "high")).alias("candidates"))
    )

    def dice(t: Column) -> Column:
        coefficient = 2 * F.size(F.array_intersect(F.col("held"), t["wanted"])) / (F.col("n") + F.size(t["wanted"]))
        return F.struct((-coefficient).alias("distance"), t["license"].alias("license"))

    fitting = F.filter("candidates", lambda t: F.col("n").between(t["low"], t["high"]))
    whole = (
        documents.select("doc_id", F.explode(passages(F.col("text"))).alias("p"))
        .select("doc_id", "p.kind", bigrams(F.col("p.passage")).alias("held"))
        .withColumn("n", F.size("held"))
        .withColumn("class", size_class(F.col("n")))
        .join(F.broadcast(by_size), "class")
        .withColumn("best", F.array_min(F.transform(fitting, dice)))
        .where(-F.col("best.distance") >= threshold)
        .groupBy("doc_id", "kind", F.col("best.license").alias("license"))
        .agg(F.count(F.lit(1)).alias("passages"), F.max(-F.col("best.distance")).alias("dice"))
    )
    return whole.unionByName(_windows(documents, _index(names, threshold), sized, threshold))
