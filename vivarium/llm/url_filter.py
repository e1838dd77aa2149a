"""URL rules: host and path rules, and pattern rules indexed by their rarest literal token.

A host rule (host, path, action) fits its host and all subdomains if the url's path starts with the rule's; of
those that fit, the longest wins (of equal lengths, the first by host, path and action). Rules are a table, joined to the suffixes of each distinct host name's labels.
Urls that none fits are judged by pattern rules, regular expressions with literal
tokens. A pattern is taken apart into its alternatives; each is indexed by the one of its tokens that the fewest urls hold; the tokens of a url fetch
candidate patterns through a hash join, and only those run. A pattern that matches blocks the url. Patterns of which some alternative has
no token that every match holds whole (and those that can't be taken apart) are run on all urls.

Edge cases: a null url, or one without "://", has an empty host and path, fits no rule and is allowed (no pattern
is run on a null). A very long url is judged whole. Repeated rows give repeated rows. An empty table gives an empty table. Other columns of the
table are ignored, also when they are called host, path, rule or verdict.
"""

from __future__ import annotations

import re
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: host, path, action
HOST_RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
#: Regular expressions over the whole url.
#: They are matched with the url's host in lower case.
PATTERNS = (
    r"://([^/?#]*\.)?casino-win\.",
    r"://([^/?#]*\.)?cheap-pills\.",
    r"://([^/?#]*\.)?free-bets\.",
    r"://([^/?#]*\.)?spam-farm\.",
    r"://([^/?#]*\.)?ads-track\.",
    r"://([^/?#]*\.)?adult-x\.",
)
#: Pattern rules up to which their index is broadcast.
BROADCAST_RULES = 200_000


def host_path(url: Column) -> tuple[Column, Column]:
    """The part after the first :// up to one of / ? # with A-Z lower-cased, and the part then up to ? or #."""
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    get = lambda k: F.coalesce(F.regexp_extract(url, parts, k), F.lit(""))
    return F.translate(get(1), upper, lower), get(2)


#: Alternatives of a pattern up to which they are told apart; beyond it, the pattern has no tokens.
ALTERNATIVES = 64


class _Gap(NamedTuple):
    """A part whose characters aren't known. first, last: whether it surely begins and ends beside no letter or digit; empty: whether it may be empty."""

    first: bool
    last: bool
    empty: bool


def _in_token(c: str) -> bool:
    return c.isascii() and c.isalnum()


def _side_ok(parts: list) -> bool:
    """Whether what the parts spell, read from the first on, surely begins with no letter or digit; true if it may be empty."""
    for x in parts:
        if isinstance(x, str):
            return not _in_token(x)
        if x is None:  # an edge of a word or of the text
            return True
        if not x.last:
            return False
        if not x.empty:
            return True
    return True


def _turned(parts: list) -> list:
    return [_Gap(x.last, x.first, x.empty) if isinstance(x, _Gap) else x for x in parts[::-1]]


def _gap(ways: list[list], empty: bool) -> _Gap:
    return _Gap(all(_side_ok(_turned(w[::-1])) for w in ways), all(_side_ok(w[::-1]) for w in ways), empty or any(all(x is None or isinstance(x, _Gap) and x.empty for x in w) for w in ways))


def _ways(tree) -> list[list]:
    """The alternatives of a parsed pattern as flat lists: characters, None for edges, gaps."""
    out: list[list] = [[]]
    for op, value in tree:
        name = str(op)
        if name == "LITERAL":
            more: list[list] = [[chr(value)]]
        elif name == "AT":
            more = [[] if str(value) == "AT_NON_BOUNDARY" else [None]]
        elif name in ("ASSERT", "ASSERT_NOT"):
            more = [[]]
        elif name == "SUBPATTERN":
            more = _ways(value[3])
        elif name == "BRANCH":
            more = [w for branch in value[1] for w in _ways(branch)]
        elif name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
            inner = _ways(value[2])
            more = inner if value[:2] == (1, 1) else [[_gap(inner, value[0] == 0)]]
        elif name == "IN":
            plain = all(str(k) == "LITERAL" and not _in_token(chr(v)) for k, v in value)
            more = [[_Gap(plain, plain, False)]]
        else:
            more = [[_Gap(False, False, name not in ("ANY", "NOT_LITERAL"))]]
        out = [a + b for a in out for b in more]
        if len(out) > ALTERNATIVES:
            raise ValueError("too many alternatives")
    return out


def literal_tokens(pattern: str) -> list[set[str]]:
    """For each alternative of a pattern, the runs of letters and digits that every match of it holds as whole tokens of the url. No list: it can't be told."""
    try:
        ways = _ways(re._parser.parse(pattern))
    except (re.error, ValueError, RecursionError):
        return []
    found = []
    for parts in ways:
        tokens, i = set(), 0
        while i < len(parts):
            j = i
            while j < len(parts) and isinstance(parts[j], str) and _in_token(parts[j]):
                j += 1
            # What is before and after a whole pattern isn't known.
            if j > i and i and j < len(parts) and _bounded(parts[:i][::-1]) and _bounded(_turned(parts[j:][::-1])):
                tokens.add("".join(parts[i:j]).lower())
            i = max(j, i + 1)
        found.append(tokens)
    return found


def _bounded(parts: list) -> bool:
    """As _side_ok, but parts that may all be empty don't tell what is beyond them."""
    return _side_ok(parts) and any(not isinstance(x, _Gap) or not x.empty for x in parts)


def host_lowered(url: Column) -> Column:
    """The url with its host, if it has one, in lower case."""
    host, _ = host_path(url)
    before = F.regexp_extract(url, r"(?s)^.*?://", 0)
    return F.when(url.contains("://"), F.concat(before, host, F.substring(url, F.length(before) + F.length(host) + 1, F.length(url)))).otherwise(url)


def url_tokens(url: Column) -> Column:
    return F.array_distinct(F.split(F.lower(url), "[^a-z0-9]+"))


def rule_index(urls: DataFrame, patterns: list[str]) -> DataFrame:
    """pattern, token: the rarest token, counted over the distinct urls, of each alternative of each pattern."""
    spark = urls.sparkSession
    rows = [(p, k, t) for p in patterns for k, tokens in enumerate(literal_tokens(p)) for t in sorted(tokens)]
    rules = spark.createDataFrame(rows, "pattern string, way int, token string")
    small = F.broadcast if len(rows) <= BROADCAST_RULES else (lambda df: df)
    seen = urls.select(F.explode(url_tokens(F.col("url"))).alias("token")).join(small(rules.select("token").distinct()), "token").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    counted = rules.join(seen, "token", "left").fillna(0, ["n"])
    return counted.groupBy("pattern", "way").agg(F.min_by("token", F.struct("n", "token")).alias("token")).select("pattern", "token").distinct()


def blocked_urls(urls: DataFrame, patterns: tuple = PATTERNS) -> DataFrame:
    """The distinct urls that a pattern matches."""
    indexed = [p for p in dict.fromkeys(patterns) if (ways := literal_tokens(p)) and all(ways)]
    others = [p for p in dict.fromkeys(patterns) if p not in set(indexed)]
    found = []
    if indexed:
        index = rule_index(urls, indexed)
        small = F.broadcast if len(indexed) * ALTERNATIVES <= BROADCAST_RULES else (lambda df: df)
        tokens = urls.select("url", F.explode(url_tokens(F.col("url"))).alias("token"))
        found.append(tokens.join(small(index), "token").where(F.expr("url rlike pattern")).select("url"))
    if others:
        found.append(urls.where(reduce(lambda a, b: a | b, [F.col("url").rlike(p) for p in others])).select("url"))
    return reduce(DataFrame.unionByName, found).distinct() if found else urls.limit(0).select("url")


def fitting_rules(urls: DataFrame, host_rules: tuple) -> DataFrame:
    """host, path, rule, action of the distinct pairs of host and path that a rule fits."""
    rules = urls.sparkSession.createDataFrame([(h, p, action) for h, p, action in host_rules], "rule_host string, rule_path string, action string")
    labels = F.split("host", r"[.]", -1)
    suffixes = F.array_distinct(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), ".")))
    spread = urls.select("host", "path").distinct().withColumn("rule_host", F.explode(suffixes))
    met = spread.join(F.broadcast(rules) if len(host_rules) <= BROADCAST_RULES else rules, "rule_host").where(F.col("path").startswith(F.col("rule_path")))
    order = F.struct((-F.length("rule_host") - F.length("rule_path")).alias("n"), "rule_host", "rule_path", "action")
    return met.groupBy("host", "path").agg(F.min(order).alias("x")).select("host", "path", F.concat("x.rule_host", "x.rule_path").alias("rule"), "x.action")


def judge_urls(pages: DataFrame, host_rules: tuple = HOST_RULES, patterns: tuple = PATTERNS) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict."""
    host, path = host_path(F.col("url"))
    judged = pages.select("page_id", "url").withColumns({"host": host, "path": path, "url": host_lowered(F.col("url"))})
    judged = judged.join(fitting_rules(judged, host_rules), ["host", "path"], "left")
    open_urls = judged.where("action is null and url is not null").select("url").distinct()
    blocked = blocked_urls(open_urls, patterns).select(F.col("url").alias("_blocked"))
    judged = judged.join(blocked, (F.col("url") == F.col("_blocked")) & F.col("action").isNull(), "left")
    verdict = F.coalesce("action", F.when(F.col("_blocked").isNotNull(), "block").otherwise("allow"))
    return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"))


_PATTERN_SQL = " OR ".join(f"regexp_matches(lowered, '{p}')" for p in PATTERNS)
SQL = rf"""
WITH u AS (
  SELECT page_id, url, CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), p AS (
  SELECT page_id, url, rest, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM u
), r AS (
  SELECT *, CASE WHEN url LIKE '%://%' THEN substr(url, 1, strpos(url, '://') + 2) || host || substr(rest, length(host) + 1) ELSE url END AS lowered, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/'
  END AS rule FROM p
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
    WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow'
    WHEN coalesce({_PATTERN_SQL}, false) THEN 'block'
    ELSE 'allow' END AS verdict
FROM r
"""
