"""URL filters: rules indexed by their rarest literal token.

A rule has a pattern (regular expression over ``host + path``) and the literal tokens that
any fitting URL must contain. Each rule is filed under the one of its tokens that fewest
distinct URLs contain; a URL fetches the rules filed under its own tokens, and only those
run their pattern. Everything is a DataFrame expression; a join on the token replaces the
index lookup, so the rules may be many.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.small import small_table

TOKEN = r"[a-z0-9]+"


class Rule(NamedTuple):
    """``name``: what the result calls it; a longer name goes before a shorter one."""

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]


def prefix_rule(verdict: str, host: str, path: str) -> Rule:
    """A rule for a host with all its subdomains and every path that starts with ``path``."""
    host = host.lower()
    end = _quoted(path) if path else "(?=/|$)"
    pattern = rf"^(?:[^/]*\.)?{_quoted(host)}{end}"
    # The last token of the path may go on in the URL, so it is no whole token of it.
    whole = re.findall(TOKEN, host)
    inner = re.findall(TOKEN + r"(?=[^A-Za-z0-9])", path)
    inner = [t for t in inner if not re.search("[A-Z]" + re.escape(t), path)]
    return Rule(host + path, verdict, pattern, tuple(dict.fromkeys(whole + inner)))


def _quoted(literal: str) -> str:
    return re.sub(r"([^A-Za-z0-9_/\-])", r"\\\1", literal)


def split_url(url: Column) -> dict[str, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``, also for null."""
    position = F.instr(url, "://")
    after = F.when(position > 0, F.substr(url, position + 3))
    host = F.regexp_extract(after, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(after, r"(?s)^[^/?#]*([^?#]*)", 1)
    lowered = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return {
        "host": F.coalesce(lowered, F.lit("")),
        "path": F.coalesce(path, F.lit("")),
    }


def _tokens(host: Column, path: Column) -> Column:
    """Distinct maximal runs of a-z and 0-9."""
    cleaned = F.regexp_replace(F.concat_ws("/", host, path), r"[^a-z0-9]+", " ")
    return F.array_distinct(F.filter(F.split(cleaned, " "), lambda t: t != ""))


def filter_urls(
    pages: DataFrame, rules: Sequence[Rule], default: str = "allow", url: str = "url"
) -> DataFrame:
    """``pages`` plus host, path, rule (null where none fits) and verdict.

    Of the rules that fit, the longest name wins, then the first in alphabetical order.
    Without a fitting rule the verdict is ``default``. A null URL and one without ``://``
    have empty host and path and fit no rule. Repeated rows stay; an empty table gives
    none; columns with the name of a new one are replaced. Verdicts are worked out once for
    each distinct (host, path).
    """
    rules = sorted(rules, key=lambda r: r.name)
    for r in rules:
        if not r.tokens:
            raise ValueError(f"rule {r.name} has no literal token")
    spark = pages.sparkSession
    parted = pages.withColumns(split_url(F.col(url)))
    places = parted.select("host", "path").where("host <> ''").distinct()
    offered = places.select("host", "path", F.explode(_tokens(F.col("host"), F.col("path"))).alias("token"))
    wanted = small_table(spark, [(t,) for t in sorted({t for r in rules for t in r.tokens})], "token string")
    # One row for each token that a rule names, so as few as the list of rules makes.
    counted = offered.join(wanted, "token").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    seen = {r["token"]: r["n"] for r in counted.collect()}
    filed = [
        (k, r.name, r.verdict, r.pattern, min(r.tokens, key=lambda t: (seen.get(t, 0), t)))
        for k, r in enumerate(rules)
    ]
    index = small_table(
        spark, filed, "rule_no int, rule string, verdict string, pattern string, token string"
    )
    fits = F.expr("regexp_like(concat(host, path), pattern)")
    best = F.max_by(
        F.struct("rule", "verdict"), F.struct(F.length("rule"), -F.col("rule_no"))
    )
    judged = (
        offered.join(index, "token").where(fits).groupBy("host", "path").agg(best.alias("best"))
    )
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    return parted.join(judged, ["host", "path"], "left").select(
        *kept,
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )

