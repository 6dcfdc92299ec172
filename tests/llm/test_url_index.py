"""The index of the URL rules loses no match: every rule run on every URL gives the same verdicts."""

import re

import duckdb

from assetqueue.llm import url_filter
from assetqueue.llm.sql import OP4

#: the patterns of the contract, by name; not read from the operator
PATTERNS = {"spam-farm": r"^(?:[^/]*\.)?spam-?farm\.", "casino": r"(?:^|[./_-])casino(?:[./_-]|$)",
            "viagra": r"(?:^|[./_-])viagra(?:[./_-]|$)", "porn": r"(?:^|[./_-])porn(?:[./_-]|$)",
            "login": r"^[^/]+/(?:.*/)?login(?:\.\w+)?/?$", "cart": r"^[^/]+/(?:.*/)?(?:cart|checkout)(?:\.\w+)?/?$"}
WORDS = ["spam-farm", "spamfarm", "spam.farm", "spam", "farm", "xspamfarm", "casino", "viagra", "porn", "login", "cart", "checkout", "a"]
URLS = [f"http://{u}" for w in WORDS for u in (
    f"{w}.example.com/x", f"m.{w}.com/", f"{w}.com", f"{w}/", f"x-{w}.com/", f"x.com/{w}", f"x.com/a/{w}.php", f"x.com/{w}/", f"x.com/{w}.de/a",
    f"x.com/a_{w}_b", f"x.com/{w}s", f"x.com/{w.upper()}", f"{w.upper()}.com/a", f"x.com/a?{w}")]


def test_index_loses_no_rule(spark):
    rows = list(enumerate(URLS))
    out = url_filter.filter_urls(spark.createDataFrame(rows, "page_id long, url string"), hosts=[]).collect()
    fits = {r.page_id: sorted(n for n, p in PATTERNS.items() if re.search(p, r.host + r.path)) for r in out}
    assert {r.page_id: (r.verdict, r.pattern) for r in out} == {i: ("block" if f else "allow", f[0] if f else None) for i, f in fits.items()}
    assert len(out) == len(rows) and {n for f in fits.values() for n in f} == set(PATTERNS)


def test_both_spellings_as_in_sql(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    con = duckdb.connect()
    con.register("pages", pages.toPandas())
    got = {tuple(r) for r in url_filter.filter_urls(pages).collect()}
    assert got == set(con.execute(OP4).fetchall())
    assert ("spamfarm.example.com", "block", "spam-farm") in {(r[1], r[4], r[5]) for r in got}


def test_every_rule_is_filed_under_a_literal():
    assert all(lits for _, _, lits, _ in url_filter.PATTERN_RULES) and all(r[2] for r in url_filter.host_rules())
