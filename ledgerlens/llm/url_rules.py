"""URL filters by pattern rules that are indexed by their rarest literal token, on DataFrame
operations only.

A rule is a regular expression over ``host + path`` and the literal tokens that every matching URL
must hold. One grouped count over all URLs tells how frequent the rules' tokens are; each rule is
filed under its rarest one. URLs are split into tokens, an equi-join on the token fetches candidate
rules, and only those run their regular expression. Work is done once per distinct URL; the longest
matching rule wins (ties: the larger rule text), listed rules before the method's own patterns. Rules are a parameter; the index is broadcast only
up to ``BROADCAST_RULES`` rules, a larger one is joined by shuffle.

Cases: a null URL, or one without ``://``, has empty host and path and fits no rule; a URL with an
empty path fits no rule that asks for ``/``; equal URLs get equal verdicts; an empty table or an
empty rule list is allowed (then the default verdict holds).
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_RULES = 10_000
TOKEN_GAP = r"[^\p{L}\p{N}]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    text: str  # host and path, or a name
    pattern: str  # regular expression over host + path
    tokens: tuple[str, ...]  # every matching host + path holds these tokens
    verdict: str
    listed: bool = True  # False: one of the method's own patterns


def host_rule(verdict: str, text: str) -> Rule:
    """Fits the host and its subdomains where the path starts with the rule's path. The last token
    is literal only if the rule's text ends it."""
    host, slash, path = text.partition("/")
    tokens = [t for t in re.split(r"[\W_]+", host) if t]
    inner = re.split(r"[\W_]+", slash + path)
    tokens += [t for t in inner[:-1] if t]
    return Rule(text, "^(?:[^/]*\\.)?" + re.escape(text), tuple(dict.fromkeys(tokens)), verdict)


#: the rules that the registered query applies
HOST_RULES = [host_rule(v, t) for v, t in (
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))]

#: the method's own patterns for URLs that no listed rule fits: host labels of link farms and of
#: shops for pills, casinos, loans and copies of brands (fixed values)
SPAM_LABELS = ["spam", "farm", "pills", "casino", "viagra", "replica", "payday", "xxx", "porn", "warez", "lottery", "escort"]
OWN_RULES = [Rule(f"label:{w}", rf"^[^/]*(?<![a-z0-9]){w}(?![a-z0-9])", (w,), "block", False) for w in SPAM_LABELS]


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def url_host(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_index(urls: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """token -> rules filed under it; ``urls`` has the array column ``tokens``. A rule without a
    literal token is filed under the empty token, which every URL has."""
    spark = urls.sparkSession
    wanted = sorted({t for r in rules for t in r.tokens})
    counted = (urls.select(F.explode("tokens").alias("token")).where(F.col("token").isin(wanted))
               .groupBy("token").agg(F.count(F.lit(1)).alias("n")).collect()) if wanted else []  # a row per rule token at most
    seen = {r["token"]: r["n"] for r in counted}
    filed = [(min(r.tokens, key=lambda t: (seen.get(t, 0), t)) if r.tokens else "", r.text, r.pattern, r.verdict, r.listed)
             for r in rules]
    return spark.createDataFrame(filed, "token string, rule string, pattern string, verdict string, listed boolean")


def judge(pages: DataFrame, rules: Sequence[Rule] = tuple(HOST_RULES), own_rules: Sequence[Rule] = tuple(OWN_RULES),
          default: str = "allow", url: str = "url", carry: Sequence[str] = ("page_id",)) -> DataFrame:
    """``carry`` columns, host, path, rule (null if no listed rule fits), verdict and fit (text of
    the winning rule, listed or own) for every row."""
    distinct = pages.select(F.col(url).alias("u")).where(F.col("u").isNotNull()).distinct()
    urls = distinct.withColumn("at", F.concat(url_host(F.col("u")), url_path(F.col("u"))))
    urls = urls.withColumn("tokens", F.array_distinct(F.concat(F.array(F.lit("")), F.split("at", TOKEN_GAP))))
    index = rule_index(urls, [*rules, *own_rules])
    if len(rules) + len(own_rules) <= BROADCAST_RULES:
        index = F.broadcast(index)
    fits = (urls.select("u", "at", F.explode("tokens").alias("token")).join(index, "token").where(F.expr("at rlike pattern")))
    best = F.max_by(F.struct("rule", "verdict", "listed"), F.struct("listed", F.length("rule").alias("n"), F.col("rule").alias("r")))
    won = fits.groupBy("u").agg(best.alias("won"))
    named = pages.select(F.struct(*[F.col(c) for c in carry]).alias("row"), F.col(url).alias("of"))
    return named.join(won, F.col("of") == F.col("u"), "left").select(
        "row.*", url_host(F.col("of")).alias("host"), url_path(F.col("of")).alias("path"),
        F.when(F.col("won.listed"), F.col("won.rule")).alias("rule"),
        F.coalesce("won.verdict", F.lit(default)).alias("verdict"), F.col("won.rule").alias("fit"))
