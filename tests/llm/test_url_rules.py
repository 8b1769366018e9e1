from __future__ import annotations

import random
import re

from quaestor.llm.url_rules import PATTERN_RULES, PatternRule, judge_urls, rarest_tokens, split_url
from pyspark.sql import functions as F


def plain(url, rules):
    text = (url or "").lower()
    hits = {r.verdict for r in rules if re.search(r.pattern, text)}
    return "allow" if "allow" in hits or not hits else "block"


def test_rules_hold_their_literals():
    rnd = random.Random(5)
    pool = sorted({t for r in PATTERN_RULES for t in r.literals}) + ["x", "news"]
    for _ in range(3000):
        url = rnd.choice(["", "http://"]) + "".join(rnd.choice(pool) + rnd.choice("-_./?=") for _ in range(rnd.randrange(1, 6)))
        tokens = set(re.findall("[a-z0-9]+", url))
        for rule in PATTERN_RULES:
            if re.search(rule.pattern, url):
                assert set(rule.literals) <= tokens, (url, rule)


def test_index_changes_no_verdict(spark):
    rnd = random.Random(6)
    pool = sorted({t for r in PATTERN_RULES for t in r.literals}) + ["Casino", "news"]
    urls = ["net://h." + "".join(rnd.choice(pool) + rnd.choice("-_./") for _ in range(4)) for _ in range(400)]
    frame = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: r.verdict for r in judge_urls(frame).collect()}
    assert got == {k: plain(u, PATTERN_RULES) for k, u in enumerate(urls)}
    assert {"allow", "block"} == set(got.values())


def test_rarest_token(spark):
    frame = spark.createDataFrame([(1, "http://a.com/a/b"), (2, "http://a.com/a"), (3, None)], "page_id long, url string")
    assert rarest_tokens(frame, [PatternRule.of("a", "b"), PatternRule.of("a"), PatternRule.of("a", "zz")]) == {
        "b": [0], "a": [1], "zz": [2]}


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "no scheme/fr/"), (4, "HTTP://A.ORG"), (5, "x://A.Org/q?http://b"), (6, "http://example.org/en/1?x"),
            (7, "http://notexample.org/es/"), (8, "http://sub.example.org/es/a"), (9, "http://com/de/"), (9, "http://com/de/"), (None, "a://É.COM/fr/\n/z"),
            (10, "x://org:80/")]
    frame = spark.createDataFrame([(*r, "v") for r in rows], "page_id long, url string, verdict string")
    got = sorted(((r.page_id or 0, r.host, r.path, r.rule, r.verdict) for r in judge_urls(frame).collect()), key=str)
    assert got == sorted([
        (1, "", "", None, "allow"), (2, "", "", None, "allow"), (3, "", "", None, "allow"), (4, "a.org", "", None, "allow"),
        (5, "a.org", "/q", "org/", "allow"), (6, "example.org", "/en/1", "example.org/en/1", "block"),
        (7, "notexample.org", "/es/", "org/", "allow"), (8, "sub.example.org", "/es/a", "example.org/es/", "block"),
        (9, "com", "/de/", "com/de/", "block"), (9, "com", "/de/", "com/de/", "block"),
        (0, "É.com", "/fr/\n/z", "com/fr/", "allow"), (10, "org:80", "/", None, "allow")], key=str)
    assert judge_urls(frame.limit(0)).count() == 0
    assert frame.select(split_url(F.col("url"))[1]).count() == len(rows)
