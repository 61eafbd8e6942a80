"""URL filter: pattern rules indexed by their rarest literal token.

A rule is written as

* ``host/path`` (kind ``host``): fits that host and its subdomains when the url's path starts
  with the rule's path; or
* a pattern (kind ``pattern``): literal text found anywhere in host + path, where ``*`` stands
  for any run and ``^`` for one separator or the end; ASCII case does not matter.

Every rule becomes a regular expression and a set of *whole* literal tokens, tokens that any
matching url must hold between separators.  The rule is filed under the token that the fewest
urls hold; a url's tokens fetch its candidate rules, and only those run their expression.
Rules without a whole token are candidates of every url.

Everything is done on distinct (host, path) keys, so a url that fills a third of the table is
judged once, and only DataFrame functions run.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import ascii_lower, staged

MAX_RULE_BYTES = 64 << 20  # the rule index is broadcast; a larger rule list is refused
_SEPARATOR = r"(?:[^A-Za-z0-9_.%-]|$)"


@dataclass(frozen=True)
class UrlRule:
    rule: str
    action: str  # "allow" or "block"
    kind: str = "host"

    def regex(self) -> str:
        """Expression searched for in host + path."""
        if self.kind == "host":
            return r"(?s)^(?:[^/]*\.)?" + re.escape(self.rule)
        out = [re.escape(c) if c not in "*^" else (".*" if c == "*" else _SEPARATOR) for c in self.rule]
        return "(?is)" + "".join(out)

    def tokens(self) -> list[str]:
        """Literal tokens that stand whole (between separators) in every matching url."""
        text = self.rule.lower()
        found = []
        for m in re.finditer(r"[a-z0-9]+", text):
            left = text[m.start() - 1] if m.start() else ("." if self.kind == "host" else "*")
            right = text[m.end()] if m.end() < len(text) else "*"
            if left != "*" and right != "*":
                found.append(m.group())
        return sorted(set(found))


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; else empty."""
    return ascii_lower(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0))


def url_path(url: Column) -> Column:
    """After the host up to ``? #`` or the end; else empty."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def _tokens(key: Column) -> Column:
    """Distinct tokens of host + path; the empty token stands for rules without one."""
    words = F.filter(F.split(ascii_lower(key), "[^a-z0-9]+"), lambda t: t != "")
    return F.concat(F.array_distinct(words), F.array(F.lit("")))


def _rule_frames(spark: SparkSession, rules: Sequence[UrlRule]) -> tuple[DataFrame, DataFrame]:
    if sum(len(r.rule) for r in rules) > MAX_RULE_BYTES:
        raise ValueError("rule list too large to broadcast")
    body = [(i, r.rule, r.action, r.kind, r.regex()) for i, r in enumerate(rules)]
    toks = [(i, t) for i, r in enumerate(rules) for t in (r.tokens() or [""])]
    return (spark.createDataFrame(body, "rule_id int, rule string, action string, kind string, regex string"),
            spark.createDataFrame(toks, "rule_id int, token string"))


def rarest_token_index(keys: DataFrame, rules: Sequence[UrlRule]) -> DataFrame:
    """One row per rule: its rarest token over all ``keys`` (column ``tokens``) and its expression."""
    body, toks = _rule_frames(keys.sparkSession, rules)
    held = (keys.select(F.explode("tokens").alias("token"))
            .join(F.broadcast(toks.select("token").distinct()), "token")
            .groupBy("token").agg(F.count(F.lit(1)).alias("n")))
    best = (toks.join(held, "token", "left")
            .groupBy("rule_id").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")).alias("best")))
    return body.join(best, "rule_id").select("rule", "action", "kind", "regex", F.col("best.token").alias("token"))


def filter_urls(df: DataFrame, rules: Sequence[UrlRule], id_col: str = "page_id", url_col: str = "url",
                default: str = "allow") -> DataFrame:
    """One row per input row: id, host, path, rule, verdict, pattern_rule.

    Host rules come before patterns; among rules of one kind the longest wins, then the
    greatest by code point.  ``rule`` is the deciding host rule or null, ``pattern_rule`` the
    deciding pattern where no host rule fits.  No rule: ``default``.
    A null url, or one without ``://``, has empty host and path.  Null or repeated ids keep
    their rows.  An empty table gives an empty result; other columns are ignored.
    """
    rows = df.select(F.col(id_col).alias(id_col), url_host(F.col(url_col)).alias("host"),
                     url_path(F.col(url_col)).alias("path"))
    keys = staged(rows.select("host", "path").distinct(), "urls")
    keys = keys.withColumn("target", F.concat("host", "path")).withColumn("tokens", _tokens(F.col("target")))
    index = staged(rarest_token_index(keys, rules), "rule-index")
    hits = (keys.withColumn("token", F.explode("tokens"))
            .join(F.broadcast(index), "token")
            .where(F.rlike("target", F.col("regex"))))
    best = hits.groupBy("host", "path").agg(F.max(F.struct(
        (F.col("kind") == "host").alias("is_host"), F.length("rule").alias("n"), "rule", "action")).alias("b"))
    verdicts = staged(best.select(
        "host", "path", F.when(F.col("b.is_host"), F.col("b.rule")).alias("rule"),
        F.col("b.action").alias("verdict"),
        F.when(~F.col("b.is_host"), F.col("b.rule")).alias("pattern_rule")), "url-verdicts")
    out = rows.join(verdicts, ["host", "path"], "left")
    return out.select(id_col, "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"),
                      "pattern_rule")
