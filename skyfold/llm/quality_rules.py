"""Quality rules: a decision list learned by sequential covering, applied as one conditional expression.

Each rule is a conjunction of thresholds on text statistics. It is grown on two thirds of the labelled rows, condition by
condition, by the gain of information about bad texts; pruned on the last third to the prefix that separates best; then the
rows that it covers are set aside and the next rule is learned from the rest. Every step is one aggregate over the labelled
rows that returns a count for each statistic and threshold, so no row reaches the driver.

Nulls and odd cases: a null or blank text has no words and all its statistics are 0. Labels that are null, or whose document
is missing, teach nothing; with no bad or no good label the list is empty and keeps everything. Repeated documents are
judged one by one; repeated labels count as often as they occur. Other columns are left alone.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyfold.llm.common import Scratch, let, words_of

#: Fixed values of the contract.
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

#: Statistics that rules may test: the quotients of two counts.
FEATURES = {
    "words": ("n_words", None),
    "mean_word_chars": ("word_chars", "n_words"),
    "symbols_per_word": ("n_symbols", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "upper_share": ("n_upper", "word_chars"),
    "digit_share": ("n_digits", "word_chars"),
    "shouts_per_word": ("n_shouts", "n_words"),
    "words_per_line": ("n_words", "n_lines"),
}
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
EXTRA = ("n_lines", "n_upper", "n_digits", "n_shouts")


def _count_of(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def _covered(starts: Column) -> Column:
    """Words covered by three-word windows that start at these positions."""
    three = F.lit(3).cast("long")

    def total(s: Column) -> Column:
        widths = F.transform(s, lambda v, j: F.least(three, F.coalesce(F.get(s, j + 1) - v, three)))
        return F.aggregate(widths, F.lit(0).cast("long"), lambda sum_, x: sum_ + x)

    return let(F.sort_array(starts), total)


def _repeat_words(words: Column, hash_bits: int = 64) -> Column:
    """Words inside three-word windows that the text holds twice or more.

    A window's key is its hash with the low bits replaced by its position. Sorted, equal windows are neighbours. Neighbours with equal
    hashes are compared word by word; a text where two of them differ is counted again by its windows as strings. ``hash_bits``
    keeps fewer bits of the hash.
    """
    n = F.size(words)

    def window(i: Column) -> list[Column]:
        return [F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)]

    def by_strings() -> Column:
        # Words hold no blanks, so windows joined by one are equal only if their words are.
        windows = F.transform(
            F.sequence(F.lit(0), n - 3), lambda i: F.struct(F.concat_ws(" ", *window(i)).alias("w"), i.cast("long").alias("i"))
        )

        def repeated(found: Column) -> Column:
            def same(x: Column, j: Column) -> Column:
                near = [F.coalesce(F.get(found, k)["w"] == x["w"], F.lit(False)) for k in (j - 1, j + 1)]
                return near[0] | near[1]

            return _covered(F.transform(F.filter(found, same), lambda x: x["i"]))

        return let(F.sort_array(windows), repeated)

    def over(bits: Column) -> Column:
        high = F.call_function("shiftleft", F.lit(-1).cast("long"), F.greatest(bits, F.lit(64 - hash_bits)))
        at = F.call_function("shiftleft", F.lit(-1).cast("long"), bits)

        def key(i: Column) -> Column:
            return F.xxhash64(*window(i)).bitwiseAND(high).bitwiseOR(i.cast("long"))

        def position(k: Column) -> Column:
            return k.bitwiseAND(F.bitwise_not(at))

        def repeated(sorted_keys: Column) -> Column:
            def same(k: Column, j: Column) -> Column:
                before, after = F.get(sorted_keys, j - 1), F.get(sorted_keys, j + 1)
                return F.coalesce(before.bitwiseAND(high) == k.bitwiseAND(high), F.lit(False)) | F.coalesce(
                    after.bitwiseAND(high) == k.bitwiseAND(high), F.lit(False)
                )

            def confirmed(kept: Column) -> Column:
                def differs(k: Column, j: Column) -> Column:
                    before = F.get(kept, j - 1)
                    here, there = window(position(k).cast("int")), window(position(before).cast("int"))
                    other = (here[0] != there[0]) | (here[1] != there[1]) | (here[2] != there[2])
                    return F.coalesce((before.bitwiseAND(high) == k.bitwiseAND(high)) & other, F.lit(False))

                clash = F.exists(F.transform(kept, differs), lambda x: x)
                return F.when(clash, by_strings()).otherwise(_covered(F.transform(kept, position)))

            return let(F.filter(sorted_keys, same), confirmed)

        return let(F.sort_array(F.transform(F.sequence(F.lit(0), n - 3), key)), repeated)

    return F.when(n < 3, F.lit(0).cast("long")).otherwise(let(F.length(F.bin(n)), over))


def text_statistics(text: Column) -> Column:
    """Struct of the base counts and of the further counts that the learned rules use, all long."""
    text = F.coalesce(text, F.lit(""))

    def counts(words: Column) -> Column:
        def of_lines(lines: Column) -> Column:
            return F.struct(
                F.size(words).cast("long").alias("n_words"),
                (F.length(text) - _count_of(text, BLANKS)).cast("long").alias("word_chars"),
                _count_of(text, SYMBOLS).cast("long").alias("n_symbols"),
                (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
                _repeat_words(words).alias("n_repeat_words"),
                F.size(lines).cast("long").alias("n_lines"),
                _count_of(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ").cast("long").alias("n_upper"),
                _count_of(text, "0123456789").cast("long").alias("n_digits"),
                _count_of(text, "!?").cast("long").alias("n_shouts"),
            )

        return let(F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, BLANKS, "")) > 0), of_lines)

    return let(words_of(text), counts)


def with_statistics(documents: DataFrame) -> DataFrame:
    """``doc_id`` and the statistics of ``text``."""
    return documents.select("doc_id", text_statistics(F.col("text")).alias("s")).select("doc_id", "s.*")


def feature(name: str) -> Column:
    """The statistic's value; 0 where there is nothing to divide by."""
    count, by = FEATURES[name]
    return F.coalesce(F.try_divide(F.col(count), F.col(by)) if by else F.col(count).cast("double"), F.lit(0.0))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    threshold: float

    def column(self) -> Column:
        value = feature(self.feature)
        return value >= self.threshold if self.at_least else value < self.threshold


Rule = tuple[Condition, ...]


def _holds(rule: Rule) -> Column:
    return reduce(lambda a, b: a & b, (c.column() for c in rule), F.lit(True))


def verdict(rules: list[Rule]) -> Column:
    """The ordered list as one expression: the first rule that holds rejects, what none covers is kept."""
    out = F
    for rule in rules:
        out = out.when(_holds(rule), F.lit(False))
    return out.otherwise(F.lit(True)) if rules else F.lit(True)


def _gain(bad: float, good: float, all_bad: float, all_good: float) -> float:
    if not bad:
        return float("-inf")
    return bad * (log2(bad / (bad + good)) - log2(all_bad / (all_bad + all_good)))


def learn_rules(
    statistics: DataFrame,
    labels: DataFrame,
    scratch: Scratch,
    max_rules: int = 8,
    max_conditions: int = 4,
    bins: int = 48,
    min_precision: float = 0.95,
    min_covered: int = 5,
) -> list[Rule]:
    """Learn an ordered list of rules for ``quality = 0`` from all labelled rows.

    Returns at most ``max_rules`` rules. A rule must cover ``min_covered`` bad rows of those kept back for pruning (a third) with
    ``min_precision`` there. Thresholds are at most ``bins`` quantiles of each statistic over all labelled rows.
    """
    names = list(FEATURES)
    teach = labels.where("quality in (0, 1)").select("doc_id", (F.col("quality") == 0).alias("bad"))
    rows = scratch.keep(
        statistics.join(teach, "doc_id").select(
            "bad",
            (F.pmod(F.xxhash64("doc_id", F.lit("prune")), F.lit(3)) > 0).alias("grow"),
            *BASE,
            *EXTRA,
        ),
        "labelled",
    )
    values = [feature(f) for f in names]
    shares = [i / (bins + 1) for i in range(1, bins + 1)]
    cut = rows.agg(*[F.percentile_approx(v, shares, 10_000).alias(f) for f, v in zip(names, values, strict=True)]).first()
    cuts = {f: sorted({*(cut[f] or []), *([1e-9] if 0.0 in (cut[f] or []) else [])}) for f in names}

    def bin_of(f: str, value: Column) -> Column:
        return F.size(F.filter(F.array(*[F.lit(float(t)) for t in cuts[f]]), lambda t: value >= t)) if cuts[f] else F.lit(0)

    rows = scratch.keep(
        rows.withColumn("bins", F.array(*[bin_of(f, v) for f, v in zip(names, values, strict=True)])), "binned"
    )

    rules: list[Rule] = []
    left = rows
    while len(rules) < max_rules:
        rule: Rule = ()
        for _ in range(max_conditions):
            counted = (
                left.where(F.col("grow") & _holds(rule))
                .select("bad", F.posexplode("bins").alias("feature", "bin"))
                .groupBy("feature", "bin")
                .agg(F.sum(F.col("bad").cast("long")).alias("bad"), F.sum((~F.col("bad")).cast("long")).alias("good"))
                .collect()
            )
            found = _best_condition(counted, names, cuts)
            if found is None:
                break
            rule = (*rule, found)
        if not rule:
            break
        prefixes = [rule[: k + 1] for k in range(len(rule))]
        sums = left.where(~F.col("grow")).agg(
            *[F.sum((_holds(p) & F.col("bad")).cast("long")).alias(f"bad_{k}") for k, p in enumerate(prefixes)],
            *[F.sum((_holds(p) & ~F.col("bad")).cast("long")).alias(f"good_{k}") for k, p in enumerate(prefixes)],
        ).first()
        held = [(sums[f"bad_{k}"] or 0, sums[f"good_{k}"] or 0) for k in range(len(prefixes))]
        worth = [(b - g) / (b + g) if b + g else -1.0 for b, g in held]
        k = max(range(len(prefixes)), key=lambda i: (worth[i], -i))
        bad, good = held[k]
        if bad < min_covered or bad < min_precision * (bad + good):
            break
        rules.append(prefixes[k])
        left = left.where(~_holds(prefixes[k]))
    return rules


def _best_condition(counted: list, names: list[str], cuts: dict[str, list[float]]) -> Condition | None:
    """The threshold with the largest gain, from the counts of bad and good rows for each statistic and bin."""
    by = {(r["feature"], r["bin"]): (r["bad"], r["good"]) for r in counted}
    best: tuple[float, Condition] | None = None
    for i, f in enumerate(names):
        cells = [by.get((i, k), (0, 0)) for k in range(len(cuts[f]) + 1)]
        all_bad, all_good = sum(c[0] for c in cells), sum(c[1] for c in cells)
        if not all_bad or not all_good:
            return None
        bad = good = 0
        for k, threshold in enumerate(cuts[f]):
            bad, good = bad + cells[k][0], good + cells[k][1]
            for at_least, b, g in ((False, bad, good), (True, all_bad - bad, all_good - good)):
                gain = _gain(b, g, all_bad, all_good)
                if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                    best = gain, Condition(f, at_least, float(threshold))
    return best and best[1]


def judged(statistics: DataFrame, rules: list[Rule]) -> DataFrame:
    """The contract's columns: counts, ``base_failed`` and ``kept``."""
    return statistics.select(
        "doc_id", *BASE, base_failed().alias("base_failed"), (~base_failed() & verdict(rules)).alias("kept")
    )


def quality_filter(documents: DataFrame, labels: DataFrame, scratch: Scratch) -> DataFrame:
    """The documents that neither the base rules nor the learned list reject, with their columns as they were.

    Only labelled documents are read for learning.
    """
    taught = documents.join(labels.select("doc_id").distinct(), "doc_id", "left_semi")
    rules = learn_rules(with_statistics(taught), labels, scratch)
    judged_rows = documents.select(F.struct("*").alias("__row"), text_statistics(F.col("text")).alias("__s"))
    return judged_rows.select("__row", "__s.*").where(~base_failed() & verdict(rules)).select("__row.*")
