"""URL filters: pattern rules, each indexed by its rarest literal token.

A rule lists the whole tokens that any URL it fits must hold. Of these the one that fewest URLs of the table hold becomes its
entry in the index. The tokens of a URL fetch its candidate rules from the index, and only those run their regular
expression. A rule without tokens is a candidate for every URL. Rules are a parameter of at most ``MAX_RULES``, which is what
bounds the broadcast index.

Nulls and odd cases: a null URL, or one without ``://``, has an empty host and path, fits no rule and is allowed. Repeated
pages are judged alike, page by page. Of rules that fit, those on hosts and paths go before patterns, the longest text
first, then the smallest text. Other columns are left out.
"""

from __future__ import annotations

import re
import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

MAX_RULES = 20_000

#: Fixed values of the contract: action and host with path.
HOST_PATH_RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]
#: Words that block a host when one of its labels or hyphenated parts is such a word.
BLOCKED_WORDS = ["ads", "adult", "casino", "cheap", "escort", "hentai", "pills", "poker", "porn", "spam", "torrent", "track", "tracker", "viagra", "warez", "xxx"]


@dataclass(frozen=True)
class UrlRule:
    text: str
    pattern: str
    action: str
    tokens: tuple[str, ...]
    on_host_path: bool


def host_path_rule(action: str, text: str) -> UrlRule:
    """A rule for a host, its subdomains, and the paths that start with the rule's.

    Its tokens are the words of the host and those of the path that a delimiter ends; a last word may go on in the URL.
    """
    host, _, rest = text.partition("/")
    lowered = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
    tokens = [
        *re.findall("[a-z0-9]+", host.translate(lowered)),
        *re.findall("[a-z0-9]+(?=[^a-z0-9])", f"/{rest}".translate(lowered)),
    ]
    return UrlRule(text, rf"^(?:[^/]*\.)?{re.escape(host)}/{re.escape(rest)}", action, tuple(dict.fromkeys(tokens)), True)


def blocked_word_rule(word: str) -> UrlRule:
    return UrlRule(word, rf"^(?:[^/]*[^a-z0-9/])?{re.escape(word)}(?:[^a-z0-9/][^/]*)?(?:/|$)", "block", (word,), False)


DEFAULT_RULES = [*(host_path_rule(*r) for r in HOST_PATH_RULES), *(blocked_word_rule(w) for w in BLOCKED_WORDS)]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A to Z in lower case."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*([^?#]*)", 1)


def _rules_frame(spark: SparkSession, rules: list[UrlRule]) -> DataFrame:
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; the index is broadcast, so at most {MAX_RULES} are taken")
    rows = [(i, r.text, r.pattern, r.action, list(r.tokens) or [""], r.on_host_path) for i, r in enumerate(rules)]
    return spark.createDataFrame(
        rows, "rule_no int, text string, pattern string, action string, tokens array<string>, on_host_path boolean"
    )


def url_tokens(address: Column) -> Column:
    """Distinct lower-case tokens of host and path, and the empty token that every URL holds."""
    lowered = F.translate(address, string.ascii_uppercase, string.ascii_lowercase)
    return F.array_distinct(F.split(F.concat(lowered, F.lit("/")), "[^a-z0-9]+"))


def rarest_token_index(addresses: DataFrame, rules: DataFrame) -> DataFrame:
    """One row per rule with the ``token`` that fewest rows of ``addresses`` hold, and the rule itself."""
    by_token = rules.withColumn("token", F.explode("tokens")).drop("tokens")
    wanted = by_token.select("token").distinct()
    counts = (
        addresses.select(F.explode(url_tokens(F.col("address"))).alias("token"))
        .join(F.broadcast(wanted), "token")
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("held"))
    )
    rarest = Window.partitionBy("rule_no").orderBy("held", F.desc(F.length("token")), "token")
    return (
        by_token.join(counts, "token", "left")
        .withColumn("held", F.coalesce("held", F.lit(0)))
        .withColumn("nth", F.row_number().over(rarest))
        .where("nth = 1")
        .drop("nth", "held")
    )


def filter_urls(pages: DataFrame, rules: list[UrlRule] | None = None) -> DataFrame:
    """``page_id, host, path, rule, verdict, pattern`` of each page; ``pattern`` names the pattern that blocked it, else null."""
    spark = pages.sparkSession
    listed = _rules_frame(spark, DEFAULT_RULES if rules is None else rules)
    parsed = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")).withColumn(
        "address", F.concat("host", "path")
    )
    addresses = parsed.select("address").where("address != ''")
    index = rarest_token_index(addresses, listed)
    fits = (
        addresses.distinct()
        .withColumn("token", F.explode(url_tokens(F.col("address"))))
        .join(F.broadcast(index), "token")
        .where(F.expr("rlike(address, pattern)"))
        .groupBy("address")
        .agg(
            F.min(
                F.struct(
                    (~F.col("on_host_path")).alias("late"),
                    (-F.length("text")).alias("shortness"),
                    "text",
                    "action",
                )
            ).alias("best")
        )
    )
    return parsed.join(fits, "address", "left").select(
        "page_id",
        "host",
        "path",
        F.when(~F.col("best.late"), F.col("best.text")).alias("rule"),
        F.coalesce("best.action", F.lit("allow")).alias("verdict"),
        F.when(F.col("best.late"), F.col("best.text")).alias("pattern"),
    )
