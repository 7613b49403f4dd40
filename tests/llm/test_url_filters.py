from __future__ import annotations

from skyfold.llm.url_filters import (
    DEFAULT_RULES,
    MAX_RULES,
    _rules_frame,
    blocked_word_rule,
    filter_urls,
    host_path_rule,
    rarest_token_index,
)

import pytest

URLS = {
    "https://www.Example.org/es/1": ("www.example.org", "/es/1", "example.org/es/", "block"),
    "http://example.org/en/123?x=/es/": ("example.org", "/en/123", "example.org/en/1", "block"),
    "http://example.org/EN/123": ("example.org", "/EN/123", "org/", "allow"),
    "http://badexample.org/es/1": ("badexample.org", "/es/1", "org/", "allow"),
    "http://a.b.com/fr/#x": ("a.b.com", "/fr/", "com/fr/", "allow"),
    "http://a.b.com/fr": ("a.b.com", "/fr", None, "allow"),
    "http://a.b.com/de/": ("a.b.com", "/de/", "com/de/", "block"),
    "http://spam-farm.net/a": ("spam-farm.net", "/a", None, "block"),
    "http://www.spam-farm.org/a": ("www.spam-farm.org", "/a", "org/", "allow"),
    "http://spamfarm.net/spam": ("spamfarm.net", "/spam", None, "allow"),
    "http://example.org": ("example.org", "", None, "allow"),
    "http://example.org?x": ("example.org", "", None, "allow"),
    "http://ads\u0130foo.net/": ("ads\u0130foo.net", "/", None, "block"),
    "http://\u212aelvin-spam.net/": ("\u212aelvin-spam.net", "/", None, "block"),
    "no scheme": ("", "", None, "allow"),
    "://": ("", "", None, "allow"),
    "": ("", "", None, "allow"),
    "x://h://i/p": ("h:", "//i/p", None, "allow"),
    "http://org/" + "a" * 50_000: ("org", "/" + "a" * 50_000, "org/", "allow"),
    None: ("", "", None, "allow"),
}


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "h", "x") for i, u in enumerate(urls)], "page_id long, url string, html string, host string")


def test_urls_get_the_rule_and_verdict(spark):
    twice = [*URLS, *URLS]
    rows = filter_urls(pages(spark, twice)).collect()
    assert len(rows) == len(twice)
    for r in rows:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == URLS[twice[r["page_id"]]]


def test_rules_are_indexed_by_the_token_that_fewest_urls_hold(spark):
    addresses = spark.createDataFrame([("a.example.org/en/1",)] * 5 + [("b.example.com/x/",)], "address string")
    rules = [host_path_rule("block", "example.org/en/1"), blocked_word_rule("x"), host_path_rule("allow", "com/fr/")]
    index = {r["text"]: r["token"] for r in rarest_token_index(addresses, _rules_frame(spark, rules)).collect()}
    assert index["example.org/en/1"] in ("org", "en") and index["com/fr/"] == "fr" and index["x"] == "x"


def test_empty_tables_and_rule_lists(spark):
    none = pages(spark, ["http://example.org/es/"])
    assert filter_urls(none.limit(0)).isEmpty()
    assert filter_urls(none, []).first()["verdict"] == "allow"
    with pytest.raises(ValueError, match="at most"):
        filter_urls(none, [DEFAULT_RULES[0]] * (MAX_RULES + 1))


def test_a_rule_without_tokens_is_tried_on_every_url(spark):
    rule = host_path_rule("block", "example.org/es/")
    bare = type(rule)(rule.text, rule.pattern, rule.action, (), True)
    verdicts = [r["verdict"] for r in filter_urls(pages(spark, ["http://example.org/es/", "http://a.b/"]), [bare]).orderBy("page_id").collect()]
    assert verdicts == ["block", "allow"]


def test_no_python_on_the_main_path(spark):
    plan = filter_urls(pages(spark, list(URLS)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
