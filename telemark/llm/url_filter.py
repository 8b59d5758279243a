"""URL filtering by pattern rules indexed by their rarest literal token.

A rule is a pattern over `host + path` of a URL, in which `*` stands for any run of
characters; it must match from the start of the host, or of one of its parent domains,
and may end anywhere ("example.com/en/" fits www.example.com/en/x; "*/casino/" fits any
host). A rule's literal tokens are the runs of letters and digits that the pattern bounds
on both sides, so a URL that the rule fits has all of them among its own tokens. Each rule
is filed under the one of them that is rarest among all URLs. A URL looks its tokens up,
and only the rules so fetched run their regular expressions on it. A rule without such a
token is filed under the empty token, which every URL has.

The longest fitting rule wins (ties: the smaller rule text). Rules of the first tier win
over those of the second; with no fitting rule the verdict is allow.

Frequencies are counted over all URLs; the fetch is an equi-join on the token, broadcast
where the rules' checked size allows, else salted, so that tokens of a third of all URLs
("com") spread. Candidates are reduced to the best rule per URL before anything else.

Null URLs and those without "://" have empty host and path, fit no rule and are allowed.
Repeated rows are judged each. Other columns are not read.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemark.llm.tables import stored
from telemark.operators.joins import attach

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ESCAPED = r"([\\.\[\]{}()+?^$|])"


def split_url(url: str = "url") -> tuple:
    """(host, path) expressions: the host between the first "://" and the next of / ? # ,
    A-Z lower-cased; the path from there up to ? or #."""
    parts = F.coalesce(F.col(url), F.lit(""))
    rest = F.when(F.instr(parts, "://") > 0, F.expr(f"substring(coalesce(`{url}`, ''), locate('://', coalesce(`{url}`, '')) + 3)")).otherwise("")
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    return F.translate(host, UPPER, LOWER), F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def rule_table(spark: SparkSession, rules: list[tuple[str, str, int]]) -> DataFrame:
    """(rule, action, tier, pattern) from (rule, allow or block, tier)."""
    raw = spark.createDataFrame(rules, "rule string, action string, tier int")
    body = F.regexp_replace(F.regexp_replace("rule", _ESCAPED, r"\\$1"), r"\*", ".*")
    start = F.when(F.col("rule").startswith("*"), F.lit("(?s)^")).otherwise(F.lit(r"(?s)^(?:[^/]*\.)?"))
    return raw.withColumn("pattern", F.concat(start, body))


def index_rules(rules: DataFrame, frequencies: DataFrame) -> DataFrame:
    """The rules with the token each is filed under. A token counts only where the pattern
    holds its two bounds: a rule starts at a bound unless with `*`, and may end inside a token."""
    bounded = F.concat(F.when(F.col("rule").startswith("*"), F.lit("*")).otherwise(F.lit(".")), F.translate("rule", UPPER, LOWER), F.lit("*"))
    tokens = F.regexp_extract_all(bounded, F.lit(r"(?<=[^a-z0-9*])([a-z0-9]+)(?=[^a-z0-9*])"), 1)
    each = rules.select("rule", "tier", F.explode_outer(tokens).alias("token"))
    counted = each.join(frequencies, "token", "left")
    best = counted.groupBy("rule", "tier").agg(
        F.min(F.struct(F.coalesce("urls", F.lit(0)).alias("urls"), F.coalesce("token", F.lit("")).alias("token")))["token"].alias("token"))
    return rules.join(best, ["rule", "tier"])


def url_tokens(host, path):
    """Distinct tokens of a URL, A-Z lower-cased, with the empty one."""
    found = F.regexp_extract_all(F.translate(F.concat(host, path), UPPER, LOWER), F.lit("([a-z0-9]+)"), 1)
    return F.array_distinct(F.concat(found, F.array(F.lit(""))))


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(id, host, path, rule, pattern_rule, verdict) per row: `rule` is the fitting rule of
    the first tier, `pattern_rule` that of the second; the verdict is the first of both."""
    host, path = split_url(url_col)
    urls = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    frequencies = urls.select(F.explode(url_tokens(F.col("host"), F.col("path"))).alias("token")).groupBy("token").agg(
        F.count("*").alias("urls"))
    index = stored(index_rules(rules, frequencies).select("token", "rule", "action", "tier", "pattern"), "rules")
    # Each distinct URL is judged once, however many rows have it.
    distinct = urls.select("host", "path").distinct().withColumn("token", F.explode(url_tokens(F.col("host"), F.col("path"))))
    fetched = attach(distinct, index, "token", "inner")
    fits = fetched.filter(F.expr("rlike(concat(host, path), pattern)"))
    rank = F.struct((-F.length("rule")).alias("longest"), "rule", "action")
    best = fits.groupBy("host", "path").agg(
        F.min(F.when(F.col("tier") == 1, rank)).alias("one"), F.min(F.when(F.col("tier") == 2, rank)).alias("two"))
    verdict = F.coalesce("one.action", "two.action", F.lit("allow"))
    judged = urls.join(best, ["host", "path"], "left")
    return judged.select(F.col("id").alias(id_col), "host", "path", F.col("one.rule").alias("rule"),
                         F.col("two.rule").alias("pattern_rule"), verdict.alias("verdict"))
