"""URL filters: pattern rules indexed by their rarest literal token.

A rule is a host-and-path rule (``example.com/en/``) or a pattern
(``casino``, ``cheap-*``) over the host. Both become a regular expression over
``host#path`` (neither part can hold a ``#``) plus the literal tokens that any fitting url must hold as
whole tokens. Each rule is filed under the one of its tokens that is rarest
among the urls at hand; a url's own tokens fetch candidate rules, and only
those candidates run their regular expression.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchline.functions.columns import broadcast_if_small

ALLOW, BLOCK = "allow", "block"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TOKEN = re.compile(r"[a-z0-9]+")


@dataclass(frozen=True)
class Rule:
    """``explicit`` rules are the caller's host/path rules: the longest wins over any pattern."""
    name: str
    verdict: str
    regex: str
    tokens: tuple[str, ...]
    explicit: bool


def host_rule(host: str, path: str, verdict: str) -> Rule:
    """Fits ``host`` and all its subdomains where the url's path starts with ``path``."""
    host = host.translate(str.maketrans(_UPPER, _LOWER))
    # the path's last run of letters may go on in the url unless a separator ends it
    whole = _TOKEN.findall(host) + _TOKEN.findall(re.sub(r"[a-zA-Z0-9]+$", "", path).lower())
    return Rule(host + path, verdict, f"^(?:[^#]*[.])?{_quoted(host)}#{_quoted(path)}", tuple(whole), True)


def pattern_rule(pattern: str, verdict: str = BLOCK) -> Rule:
    """A pattern over the host; ``*`` stands for any run of host characters, ends match at token borders."""
    parts = pattern.lower().split("*")
    body = "[^#]*".join(_quoted(p) for p in parts)
    tokens: list[str] = []
    for k, part in enumerate(parts):  # a token beside a star may go on in the url
        if k > 0:
            part = re.sub(r"^[a-z0-9]+", "", part)
        if k < len(parts) - 1:
            part = re.sub(r"[a-z0-9]+$", "", part)
        tokens += _TOKEN.findall(part)
    if not tokens:
        raise ValueError(f"pattern {pattern!r} has no literal token to index it by")
    return Rule(pattern, verdict, f"^(?:[^#]*[^a-z0-9#])?{body}(?:[^a-z0-9]|$)", tuple(tokens), False)


def _quoted(text: str) -> str:
    return re.sub(r"([^a-zA-Z0-9])", r"\\\1", text)


#: The rules of the query's contract: (host, path, verdict). Fixed values.
CONTRACT_RULES = (
    host_rule("com", "/", ALLOW),
    host_rule("example.com", "/en/", BLOCK),
    host_rule("www.example.com", "/en/", ALLOW),
    host_rule("net", "/es/", BLOCK),
    host_rule("net", "/fr/", BLOCK),
)
#: Patterns of unwanted hosts for urls that no contract rule fits.
SPAM_PATTERNS = tuple(pattern_rule(p) for p in (
    "casino", "bets", "betting", "poker", "jackpot", "slots", "pills", "pharma", "viagra",
    "porn", "xxx", "sex", "ads", "adserver", "track", "tracker", "popup", "clickbait",
    "payday", "replica", "warez", "torrent", "malware", "phishing"))


def url_host(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*([^?#]*)", 1)


def _tokens(target: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.translate(target, _UPPER, _LOWER), "[^a-z0-9]+"), lambda t: t != ""))


def rule_index(urls: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(token, rule): each rule under its rarest token, counted over all of ``urls(tokens)``.

    Only the counts of tokens that occur in rules come to the driver: as many
    numbers as the rule list has tokens.
    """
    spark = urls.sparkSession
    wanted = sorted({t for r in rules for t in r.tokens})
    counts = dict(urls.select(F.explode("tokens").alias("t")).where(F.col("t").isin(wanted))
                  .groupBy("t").count().collect())
    rows = [(min(r.tokens, key=lambda t: (counts.get(t, 0), t)), r.name, r.verdict, r.regex, r.explicit, len(r.name))
            for r in rules]
    return spark.createDataFrame(rows, "token string, rule string, verdict string, regex string, explicit boolean, "
                                       "size int")


def judge(pages: DataFrame, rules: tuple[Rule, ...] = CONTRACT_RULES + SPAM_PATTERNS, id_col: str = "page_id",
          url_col: str = "url") -> DataFrame:
    """One row per input row: id, host, path, rule, verdict, matched_pattern.

    The longest fitting host rule gives rule and verdict (ties: the smaller
    text); a url that none fits is blocked by any fitting pattern and allowed
    otherwise, with rule NULL. NULL urls and urls without ``://`` have empty
    host and path and are allowed. Repeated rows are judged alike and all returned; other columns are ignored; an
    empty table gives an empty result.
    """
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"))
    parts = rows.select("url", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    target = F.concat("host", F.lit("#"), "path")
    urls = parts.where("host != ''").select("url", target.alias("target"), _tokens(target).alias("tokens"))
    index = broadcast_if_small(rule_index(urls, rules))
    fitting = (urls.select("url", "target", F.explode("tokens").alias("token"))
               .join(index, "token")
               .where(F.expr("target rlike regex"))
               .groupBy("url")
               .agg(F.max(F.when(F.col("explicit"), F.struct("size", "rule", "verdict"))).alias("own"),
                    F.max(F.when(~F.col("explicit"), F.struct("size", "rule", "verdict"))).alias("pattern")))
    return (rows.join(fitting, "url", "left")
            .select(F.col("id").alias(id_col), url_host(F.col("url")).alias("host"),
                    url_path(F.col("url")).alias("path"), F.col("own.rule").alias("rule"),
                    F.coalesce("own.verdict", "pattern.verdict", F.lit(ALLOW)).alias("verdict"),
                    F.col("pattern.rule").alias("matched_pattern")))
