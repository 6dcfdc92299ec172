"""URL filters: pattern rules behind an index of their rarest literal token.

A rule is a regular expression over host + path, its literal tokens (runs of
a-z0-9 that every match holds as whole tokens of the URL) and an action. Each
rule is filed under its rarest token, counted over the URLs themselves; the
tokens of a URL fetch candidate rules and only these run. Host rules (host,
path) are turned into such patterns; the longest that fits wins. URLs that no
host rule fits are judged by the pattern rules below: blocked if one fits,
otherwise allowed.

DataFrame functions only. Cases: a null URL or one without "://" has an empty
host and path, fits nothing and is allowed. Repeated rows and rows with equal
or null ids each give a row. Extra columns are ignored; an empty table gives an
empty result. Among host rules of one length the smaller name wins.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from assetqueue.llm.common import LOWER, UPPER, broadcast_if_small

HOST_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
#: (name, pattern over host + path, literal tokens, action) for the rest; rules may share a name
PATTERN_RULES = [
    ("spam-farm", r"^(?:[^/]*\.)?spam-farm\.", ["spam", "farm"], "block"),
    ("spam-farm", r"^(?:[^/]*\.)?spamfarm\.", ["spamfarm"], "block"),
    ("casino", r"(?:^|[./_-])casino(?:[./_-]|$)", ["casino"], "block"),
    ("viagra", r"(?:^|[./_-])viagra(?:[./_-]|$)", ["viagra"], "block"),
    ("porn", r"(?:^|[./_-])porn(?:[./_-]|$)", ["porn"], "block"),
    ("login", r"^[^/]+/(?:.*/)?login(?:\.\w+)?/?$", ["login"], "block"),
    ("cart", r"^[^/]+/(?:.*/)?cart(?:\.\w+)?/?$", ["cart"], "block"),
    ("cart", r"^[^/]+/(?:.*/)?checkout(?:\.\w+)?/?$", ["checkout"], "block"),
]
MAX_BROADCAST = 1_000_000
RULE_SCHEMA = "n int, rule string, pattern string, literals array<string>, action string, rank int"


def tokens(c: Column) -> Column:
    return F.array_distinct(F.array_remove(F.split(F.translate(c, UPPER, LOWER), "[^a-z0-9]+"), ""))


def host_rules(rules=HOST_RULES) -> list:
    """(host, path, action) as pattern rules; the rank is the rule's length."""
    return [(h + p, rf"^(?:[^/]*\.)?{re.escape(h)}{re.escape(p)}", [t for t in re.split("[^a-z0-9]+", h.lower()) if t],
             action, len(h + p)) for h, p, action in rules]


def indexed(rules: DataFrame, urls: DataFrame) -> DataFrame:
    """Rules with the token they are filed under: their rarest literal; "" where a rule has none."""
    lit = rules.select("n", F.explode("literals").alias("token")).distinct()
    seen = urls.select(F.explode("tokens").alias("token")).join(broadcast_if_small(lit.select("token").distinct(), MAX_BROADCAST), "token")
    freq = lit.join(seen.groupBy("token").count(), "token", "left")
    best = freq.groupBy("n").agg(F.min_by("token", F.struct(F.coalesce("count", F.lit(0)), F.col("token"))).alias("token"))
    return rules.drop("literals").join(best, "n", "left").withColumn("token", F.coalesce("token", F.lit("")))


def filter_urls(pages: DataFrame, id_col="page_id", url_col="url", hosts=HOST_RULES, patterns=PATTERN_RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, pattern) for every row of ``pages``."""
    spark = pages.sparkSession
    after = F.regexp_extract(F.coalesce(F.col(url_col).cast("string"), F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(after, r"(?s)^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(after, r"(?s)^[^/?#]*([^?#]*)", 1)
    urls = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    # one row per different (id, host, path), with its number of rows
    urls = urls.groupBy("page_id", "host", "path").agg(F.count("*").alias("times"))
    urls = urls.withColumn("target", F.concat("host", "path")).withColumn("tokens", tokens(F.col("target")))
    table = host_rules(hosts) + [(n, p, lits, a, 0) for n, p, lits, a in patterns]
    rules = indexed(spark.createDataFrame([(n, *r) for n, r in enumerate(table)], RULE_SCHEMA), urls)
    fetched = urls.withColumn("token", F.explode(F.concat("tokens", F.array(F.lit("")))))
    fetched = fetched.join(broadcast_if_small(rules, MAX_BROADCAST), "token", "left")
    fits = F.expr("rlike(target, pattern)")
    best = fetched.groupBy("page_id", "host", "path", "times").agg(
        F.min(F.when(fits & (F.col("rank") > 0), F.struct((-F.col("rank")).alias("r"), "rule", "action"))).alias("host_rule"),
        F.min(F.when(fits & (F.col("rank") == 0), F.struct("rule", "action"))).alias("pattern_rule"))
    return best.select(
        "page_id", "host", "path", F.col("host_rule.rule").alias("rule"),
        F.coalesce("host_rule.action", "pattern_rule.action", F.lit("allow")).alias("verdict"),
        F.when(F.col("host_rule").isNull(), F.col("pattern_rule.rule")).alias("pattern"),
        F.explode(F.array_repeat(F.lit(1), F.col("times").cast("int"))).alias("__n")).drop("__n")
