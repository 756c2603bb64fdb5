"""Verdicts on URLs from pattern rules that are indexed by their rarest literal token."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from steploom.session import materialize

from .common import lower_ascii

ALLOW, BLOCK = "allow", "block"

#: Rule sets up to this size are sent to every task; larger ones are joined by token.
BROADCAST_RULES = 50_000


@dataclass(frozen=True)
class HostPath:
    """Fits ``host`` and its subdomains where the path starts with ``path``; the longest wins over everything."""

    action: str
    host: str
    path: str


@dataclass(frozen=True)
class Pattern:
    """Text anywhere in the lower-cased URL, ``*`` for any characters; an allowing pattern beats a blocking one."""

    action: str
    text: str


Rule = HostPath | Pattern


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    rest = _after_scheme(url)
    return lower_ascii(F.regexp_extract(rest, r"(?s)\A([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"(?s)\A[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", F.coalesce(url, F.lit("")))
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def tokens_of(url: Column) -> Column:
    """Distinct runs of a-z and 0-9 in the lower-cased URL, and the empty token that every URL has."""
    parts = F.split(lower_ascii(F.coalesce(url, F.lit(""))), "[^a-z0-9]+")
    return F.array_distinct(F.array_append(parts, F.lit("")))


def _rule_tokens(rule: Rule) -> list[str]:
    """Tokens that any fitting URL must have in full.  Tokens at an open edge of a rule may go on in the URL."""
    if isinstance(rule, HostPath):
        whole = f"/{rule.host}{rule.path}" if rule.path else f"/{rule.host}/"
        edges = (False, not rule.path)
    else:
        whole, edges = rule.text.lower(), (False, False)
    found = []
    for m in re.finditer(r"[a-z0-9]+", re.sub(r"[A-Z]", lambda c: c[0].lower(), whole)):
        before, after = whole[: m.start()][-1:], whole[m.end() :][:1]
        closed = (before not in ("", "*") or edges[0]) and (after not in ("", "*") or edges[1])
        if closed:
            found.append(m[0])
    return found


def _expression(rule: Rule) -> str:
    """Regular expression over ``host + ? + path`` (neither has a ``?``) or over the lower-cased URL."""
    if isinstance(rule, HostPath):
        return rf"(?s)\A(?:[^?]*\.)?{_quoted(rule.host)}\?{_quoted(rule.path)}"
    return "(?s)" + ".*".join(map(_quoted, rule.text.lower().split("*")))


def _quoted(text: str) -> str:
    return re.sub(r"([!-/:-@\[-`{-~])", r"\\\1", text)


def rule_table(like: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule with its regular expression and required tokens."""
    rows = [
        (
            i,
            r.action,
            r.host + r.path if isinstance(r, HostPath) else None,
            isinstance(r, HostPath),
            _expression(r),
            _rule_tokens(r) or [""],
        )
        for i, r in enumerate(rules)
    ]
    schema = "rule_id int, action string, rule string, exact boolean, expression string, tokens array<string>"
    return like.sparkSession.createDataFrame(rows, schema)


def rarest_token_index(urls: DataFrame, rules: DataFrame, small: bool = True) -> DataFrame:
    """Rules with the one of their tokens that the fewest URLs have (ties: the smallest).

    ``urls`` holds ``url``.  Counts cover all URLs; only tokens of some rule are counted,
    so the counted table is as small as the rules.  ``small``: the rules may be sent to every task.
    """
    needed = rules.select("rule_id", F.explode("tokens").alias("token"))
    seen = urls.select(F.explode(tokens_of(F.col("url"))).alias("token"))
    wanted = needed.select("token").distinct()
    counts = seen.join(F.broadcast(wanted) if small else wanted, "token", "left_semi").groupBy("token").count()
    ranked = needed.join(counts, "token", "left").groupBy("rule_id").agg(
        F.min_by("token", F.struct(F.coalesce("count", F.lit(0)), "token")).alias("token")
    )
    return rules.drop("tokens").join(ranked, "rule_id")


def judge_urls(pages: DataFrame, rules: Sequence[Rule], url: str = "url", keys: Sequence[str] = ("page_id",)) -> DataFrame:
    """``keys``, ``host``, ``path``, ``rule`` and ``verdict`` for every row of ``pages``.

    Each distinct URL is judged once.  Its tokens fetch the rules that are indexed under
    one of them, and only those rules run their regular expression.  The longest fitting
    ``HostPath`` decides (ties: block, then the text) and is named in ``rule``; otherwise
    the patterns decide, and ``rule`` is NULL: allow if an allowing pattern fits or none does.

    Rules without a whole token in them are indexed under a token that every URL has.
    Verdicts are stored before the pages are joined with them, so that the join reads two stored tables and a
    URL that a third of the pages has can be split; rows with a NULL URL do not join at all.

    A NULL or broken URL has an empty host and path and is allowed unless a pattern
    fits its text.  Repeated rows are judged alike; no rows give no rows; other columns are left out.
    """
    page = pages.select(*keys, F.col(url).alias("_url"))
    urls = page.where(F.col("_url").isNotNull()).select(F.col("_url").alias("url")).distinct()
    small = len(rules) <= BROADCAST_RULES
    index = rarest_token_index(urls, rule_table(pages, rules), small)
    if small:
        index = F.broadcast(index)
    candidates = urls.select("url", F.explode(tokens_of(F.col("url"))).alias("token")).join(index, "token")
    subject = F.when(
        F.col("exact"), F.concat(host_of(F.col("url")), F.lit("?"), path_of(F.col("url")))
    ).otherwise(lower_ascii(F.col("url")))
    fitting = candidates.where(F.regexp_like(subject, F.col("expression")))
    order = F.struct(F.length("rule"), F.col("action"), F.col("rule"))
    judged = fitting.groupBy("url").agg(
        F.max(F.when(F.col("exact"), order)).alias("best"),
        F.max(F.when(~F.col("exact"), F.col("action") == ALLOW)).alias("spared"),
    )
    verdict = (
        F.when(F.col("best").isNotNull(), F.col("best.action"))
        .when(~F.coalesce("spared", F.lit(True)), BLOCK)
        .otherwise(ALLOW)
    )
    stored = materialize(judged.select("url", F.col("best.rule").alias("_rule"), verdict.alias("_verdict")), "verdicts")
    known, absent = page.where(F.col("_url").isNotNull()), page.where(F.col("_url").isNull())
    # A sort-merge join at every size: a broadcast would grow with the URLs.
    joined = known.join(stored.hint("merge"), known["_url"] == stored["url"], "left").select(
        *keys,
        host_of(F.col("_url")).alias("host"),
        path_of(F.col("_url")).alias("path"),
        F.col("_rule").alias("rule"),
        F.coalesce("_verdict", F.lit(ALLOW)).alias("verdict"),
    )
    empty = [F.lit("").alias("host"), F.lit("").alias("path"), F.lit(None).cast("string").alias("rule"), F.lit(ALLOW).alias("verdict")]
    return joined.unionByName(absent.select(*keys, *empty))
