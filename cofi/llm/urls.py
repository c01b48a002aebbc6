"""URL filters by pattern rules (operator 9), DataFrame functions only.

Every rule is a regular expression over ``host + path + rest`` of a URL, with the literal
tokens (runs of ASCII letters and digits) that any URL it matches has. Rules are indexed by
the rarest of these, counted over all URLs; the tokens of a URL fetch the rules that are
listed under them, and only those run their expression. A rule without such a token is
listed under the empty token, which every URL has.

Host rules (host, path) fit their host and all subdomains where the path starts with
theirs; the longest wins, and host rules go before pattern rules. Among pattern rules an
exception (allow) goes before a block, then the longer one, then the smaller text.

Defined cases: a null URL, or one without ``://``, has empty host and path and is judged by
the pattern rules on its whole text; repeated URLs are judged once and every row gets the
verdict; no fitting rule means ``DEFAULT``; an empty table gives an empty table.
"""

from __future__ import annotations

import re
import string
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cofi.session import materialize

DEFAULT = "allow"
TOKEN = "[a-z0-9]+"


class Rule(NamedTuple):
    text: str
    verdict: str
    regex: str
    tokens: list[str]
    host_rule: bool


def host_rule(host: str, path: str, verdict: str) -> Rule:
    literal = host + path
    # a prefix of a path may end inside a token; the host starts at a label
    whole = re.findall(r"[A-Za-z0-9]+(?=[^A-Za-z0-9])", literal)
    return Rule(literal, verdict, r"^(?:[^/?#]*\.)?" + re.escape(literal), [t.lower() for t in whole], True)


def pattern_rule(pattern: str, verdict: str) -> Rule:
    """``*`` stands for any text, a leading ``||`` for the start of a host or of one of its labels."""
    body = pattern.removeprefix("||")
    parts = body.split("*")
    regex = (r"^(?:[^/?#]*\.)?" if body != pattern else "") + ".*".join(map(re.escape, parts))
    whole = [t.lower() for i, p in enumerate(parts) for t in re.findall(
        (r"(?:^|(?<=[^A-Za-z0-9]))" if body != pattern and not i else r"(?<=[^A-Za-z0-9])") + r"[A-Za-z0-9]+(?=[^A-Za-z0-9])", p)]
    return Rule(pattern, verdict, "(?s)" + regex, whole, False)


def rule_table(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    """(rule, verdict, regex, tokens, host_rule, size): written out as one row of literals."""
    rows = [F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"), F.lit(r.regex).alias("regex"),
                     F.array(*[F.lit(t) for t in (r.tokens or [""])]).alias("tokens"),
                     F.lit(r.host_rule).alias("host_rule"), F.lit(len(r.text)).alias("size")) for r in rules]
    return spark.range(1).select(F.inline(F.array(*rows)))


def split_url(url: Column) -> dict[str, Column]:
    """host (A-Z lower-cased), path and the rest of a URL; without ``://`` all of it is rest, after a
    question mark, where no host rule looks."""
    at = F.instr(url, "://")
    after = F.when(at > 0, url.substr(at + 3, F.length(url)))
    host = F.translate(F.regexp_extract(after, r"^([^/?#]*)", 1), string.ascii_uppercase, string.ascii_lowercase)
    return {"host": F.coalesce(host, F.lit("")),
            "path": F.coalesce(F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1), F.lit("")),
            "rest": F.coalesce(F.regexp_extract(after, r"(?s)^[^/?#]*[^?#]*(.*)$", 1), F.concat(F.lit("?"), url), F.lit(""))}


def rarest_tokens(rules: DataFrame, tokens: DataFrame) -> DataFrame:
    """The rules with ``token``: of their tokens the one that the fewest URLs have."""
    listed = rules.select("rule", F.explode("tokens").alias("token"))
    known = listed.select("token").distinct()
    counts = tokens.join(known, "token").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    best = (listed.join(counts, "token", "left")
            .groupBy("rule").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token"))["token"].alias("token")))
    return rules.drop("tokens").join(best, "rule")


def judge(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """(page_id, host, path, rule, verdict, pattern) per row of ``pages``: ``rule`` is the host rule
    that decided, ``pattern`` the pattern rule that did; both null means DEFAULT."""
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"))
    urls = rows.select("url").distinct().where("url IS NOT NULL")
    parts = split_url(F.col("url"))
    urls = urls.select("url", F.concat(parts["host"], parts["path"], parts["rest"]).alias("canon"))
    urls = materialize(urls.withColumn("tokens", F.array_distinct(F.concat(
        F.array(F.lit("")), F.regexp_extract_all(F.lower("canon"), F.lit(TOKEN), F.lit(0))))), "urls")
    index = materialize(rarest_tokens(rules, urls.select(F.explode("tokens").alias("token"))), "url-rules")
    fits = urls.select("url", "canon", F.explode("tokens").alias("token")).join(index, "token").where(
        F.regexp_like(F.col("canon"), F.col("regex")))
    rank = F.struct("host_rule", F.when(F.col("host_rule"), 0).otherwise((F.col("verdict") == "allow").cast("int")), "size")
    best = fits.groupBy("url").agg(F.max_by(F.struct("rule", "verdict", "host_rule"), F.struct(rank, "rule")).alias("best"))
    best = best.select(F.col("url").alias("of_url"), "best.*")
    host, path = (split_url(F.col("url"))[k].alias(k) for k in ("host", "path"))
    return rows.join(best, F.col("url") == F.col("of_url"), "left").select(
        "page_id", host, path, F.when(F.col("host_rule"), F.col("rule")).alias("rule"),
        F.coalesce("verdict", F.lit(DEFAULT)).alias("verdict"), F.when(~F.col("host_rule"), F.col("rule")).alias("pattern"))


#: The host rules of the registered query.
HOST_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
              ("net", "/es/", "block"), ("net", "/fr/", "block")]
#: Its pattern rules: trackers, feeds and numbered listings go, plain article pages stay.
PATTERN_RULES = [("||ads-track.example.", "block"), ("?utm_source=*", "block"), ("?page=*&ref=", "block"), ("||blog.*/*.html", "allow")]


def registered_rules() -> list[Rule]:
    return [host_rule(*r) for r in HOST_RULES] + [pattern_rule(*r) for r in PATTERN_RULES]


def oracle_sql() -> str:
    """DuckDB SQL: every rule's expression on every URL."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    rows = ", ".join(f"({quote(r.text)}, {quote(r.verdict)}, {quote(r.regex)}, {r.host_rule}, {len(r.text)})"
                     for r in registered_rules())
    after = "CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) END"
    lower = f"translate(regexp_extract({after}, '^([^/?#]*)', 1), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    return f"""
WITH rules(rule, verdict, regex, host_rule, size) AS (VALUES {rows}),
  u AS (SELECT row_number() OVER () AS row_no, page_id, url, coalesce({lower}, '') AS host,
      coalesce(regexp_extract({after}, '^[^/?#]*([^?#]*)', 1), '') AS path,
      coalesce(regexp_extract({after}, '(?s)^[^/?#]*[^?#]*(.*)$', 1), '?' || url, '') AS rest FROM pages),
  f AS (SELECT u.*, r.rule, r.verdict, r.host_rule, row_number() OVER (PARTITION BY row_no ORDER BY r.host_rule DESC,
      CASE WHEN r.host_rule THEN 0 WHEN r.verdict = 'allow' THEN 1 ELSE 0 END DESC, r.size DESC, r.rule DESC) AS rn
    FROM u LEFT JOIN rules r ON regexp_matches(host || path || rest, r.regex))
SELECT page_id, host, path, CASE WHEN host_rule THEN rule END AS rule, coalesce(verdict, '{DEFAULT}') AS verdict,
  CASE WHEN NOT host_rule THEN rule END AS pattern FROM f WHERE rn = 1"""
