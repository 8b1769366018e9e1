"""URL filter: host rules, and pattern rules found through their rarest literal token."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quaestor.llm.decontaminate import LOWER, UPPER
from quaestor.llm.tables import read_table

# Host, path, verdict.
HOST_RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
              ("com", "/fr/", "allow"), ("com", "/de/", "block"))

TOKEN = r"([a-z0-9]+)"
EDGE, STOP = r"(?:^|[^a-z0-9])", r"(?:[^a-z0-9]|$)"


@dataclass(frozen=True)
class PatternRule:
    """A regular expression over the lower-cased URL; each token in ``literals`` stands alone in whatever it matches."""
    pattern: str
    literals: tuple[str, ...]
    verdict: str = "block"

    @classmethod
    def of(cls, *tokens: str, between: str = r"[^a-z0-9]+(?:[a-z0-9]+[^a-z0-9]+)*?", verdict: str = "block") -> PatternRule:
        """The tokens in this order, any others between them; by default anywhere, with ``between`` "-" side by side."""
        return cls(EDGE + between.join(tokens) + STOP, tokens, verdict)


def _adjacent(*tokens: str) -> PatternRule:
    return PatternRule.of(*tokens, between=r"[-_.]")


PATTERN_RULES = (
    _adjacent("casino", "win"), _adjacent("free", "bets"), _adjacent("cheap", "pills"), _adjacent("ads", "track"),
    _adjacent("online", "casino"), _adjacent("sports", "betting"), _adjacent("poker", "bonus"), _adjacent("free", "spins"),
    _adjacent("payday", "loan"), _adjacent("payday", "loans"), _adjacent("replica", "watches"), _adjacent("buy", "followers"),
    _adjacent("buy", "viagra"), _adjacent("cheap", "meds"), _adjacent("adult", "video"), _adjacent("xxx", "videos"),
    _adjacent("click", "track"), _adjacent("ad", "server"), PatternRule.of("doubleclick"), PatternRule.of("phishing"),
    PatternRule.of("warez"), PatternRule.of("torrent", "crack"), PatternRule.of("keygen"), PatternRule.of("wp", "login", "php"),
    PatternRule.of("popunder"), PatternRule.of("escort", "girls"),
    PatternRule(EDGE + r"report[^a-z0-9]phishing" + STOP, ("report", "phishing"), "allow"),
)


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null and for a URL without ``://``."""
    part = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(text, part, 1), UPPER, LOWER), F.regexp_extract(text, part, 2)


def host_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = HOST_RULES) -> Column:
    """Struct ``rule, verdict`` of the longest rule that fits, or null. The rules are a short list given in code."""
    def fits(rule: tuple[str, str, str]) -> Column:
        return ((host == rule[0]) | F.endswith(host, F.lit("." + rule[0]))) & F.startswith(path, F.lit(rule[1]))
    found = F.lit(None)
    for rule in sorted(rules, key=lambda r: len(r[0] + r[1])):
        found = F.when(fits(rule), F.struct(F.lit(rule[0] + rule[1]).alias("rule"), F.lit(rule[2]).alias("verdict"))).otherwise(found)
    return found


def tokens_of(url: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.translate(F.coalesce(url, F.lit("")), UPPER, LOWER), F.lit(TOKEN), F.lit(1)))


def rarest_tokens(urls: DataFrame, rules: Sequence[PatternRule]) -> dict[str, list[int]]:
    """Rules by the literal token that fewest URLs of the table hold; only counts of the rules' own tokens are collected."""
    literals = sorted({t for r in rules for t in r.literals})
    held = urls.select(F.explode(F.array_intersect(tokens_of(F.col("url")), F.lit(literals))).alias("token"))
    counts = {r["token"]: r["count"] for r in held.groupBy("token").count().collect()}
    index: dict[str, list[int]] = {}
    for k, rule in enumerate(rules):
        index.setdefault(min(rule.literals, key=lambda t: (counts.get(t, 0), t)), []).append(k)
    return index


def pattern_verdict(url: Column, rules: Sequence[PatternRule], index: dict[str, list[int]]) -> Column:
    """``allow`` if a rule of that kind matches, else ``block`` if one does, else ``allow``.

    The URL's tokens fetch the rules listed under them; a URL with none of the
    index's tokens runs no regular expression.
    """
    plain = F.translate(F.coalesce(url, F.lit("")), UPPER, LOWER)
    fetched = F.array_intersect(tokens_of(url), F.lit(sorted(index)))

    def matches(verdict: str) -> Column:
        runs = [F.array_contains(fetched, token) & F.rlike(plain, F.lit(rules[k].pattern))
                for token, which in sorted(index.items()) for k in which if rules[k].verdict == verdict]
        out = F.lit(False)
        for run in runs:
            out = out | run
        return out
    return (F.when(F.size(fetched) == 0, "allow").when(matches("allow"), "allow").when(matches("block"), "block").otherwise("allow"))


def judge_urls(pages: DataFrame, rules: Sequence[PatternRule] = PATTERN_RULES) -> DataFrame:
    """``page_id, url, host, path, rule, verdict`` per row of ``pages(page_id, url)``.

    Null URLs and such without ``://`` have empty host and path, fit no host
    rule and are judged by the patterns (null: allow). Repeated rows stay.
    """
    urls = pages.select("page_id", "url")
    index = rarest_tokens(urls, rules)
    host, path = split_url(F.col("url"))
    parts = urls.withColumn("host", host).withColumn("path", path)
    judged = parts.withColumn("found", host_rule(F.col("host"), F.col("path")))
    return judged.select("page_id", "url", "host", "path", F.col("found.rule").alias("rule"),
                         F.coalesce("found.verdict", pattern_verdict(F.col("url"), rules, index)).alias("verdict"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(read_table(spark, sf_dir, "pages")).drop("url")


def _any(verdict: str) -> str:
    return " OR ".join(f"regexp_matches(u, '{r.pattern}')" for r in PATTERN_RULES if r.verdict == verdict)


def _host_case(column: int) -> str:
    longest_first = sorted(HOST_RULES, key=lambda r: -len(r[0] + r[1]))
    return "CASE " + " ".join(
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{(h + p, v)[column]}'"
        for h, p, v in longest_first) + " END"


QUERIES = {"op4_url_filter": op4_url_filter}
ORACLE = {"op4_url_filter": f"""
WITH p AS (SELECT page_id, translate(coalesce(url, ''), '{UPPER}', '{LOWER}') AS u,
                  translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)([^?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
                  regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)([^?#]*)', 2) AS path FROM pages)
SELECT page_id, host, path, {_host_case(0)} AS rule,
       coalesce({_host_case(1)}, CASE WHEN {_any('allow')} THEN 'allow' WHEN {_any('block')} THEN 'block' ELSE 'allow' END) AS verdict
FROM p"""}
