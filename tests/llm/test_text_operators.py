"""Decontamination, URL filters, line dedup and near-duplicates on small fixtures."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from assetqueue.llm import decontamination, line_dedup, near_dup, url_filter

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], DOCS)


def words_of(text):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def hits_by_hand(text, items, window=10):
    w, hit, found = words_of(text), set(), set()
    for item, t in items:
        q = words_of(t)
        n = min(window, len(q))
        for s in range(len(q) - n + 1 if n else 0):
            for p in range(len(w) - n + 1):
                if w[p: p + n] == q[s: s + n]:
                    hit.update(range(p, p + n))
                    found.add(str(item))
    return len(w), len(hit), sorted(found)


def test_contamination_equals_brute_force(spark):
    rng = random.Random(3)
    vocab = ["the", "of", "Éa", "éa", "x1", "ba", "NA", "la", "zu"]
    item = lambda n: " ".join(rng.choice(vocab) + rng.choice(["", ",", "."]) for _ in range(n))
    items = [(i, item(rng.choice([3, 9, 10, 11, 25]))) for i in range(8)] + [(3, "short one"), (9, None), (10, " .. "), (11, "")]
    rows = [(0, None, "a"), (1, "", "a"), (2, "?!", "a"), (3, "... Short ONE!", "a"), (3, "... Short ONE!", "a"), (None, "short one", "a")]
    for i in range(4, 40):
        parts = [item(rng.randint(0, 30)), rng.choice(items[:8])[1], item(rng.randint(0, 5)), rng.choice(items[:8])[1][rng.randint(0, 9):]]
        rows.append((i, " ".join(parts[: rng.randint(1, 4)]), "a"))
    rows.append((40, " ".join([items[0][1]] * 900), "a"))
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("row", F.lit(1))
    out = decontamination.contamination(docs(spark, rows).withColumn("term", F.lit("x")), bench).collect()
    got = sorted(((r.doc_id is None, r.doc_id or 0), r.n_words, r.n_hit, r.n_items, r["items"], r.contaminated) for r in out)
    want = []
    for i, t, _ in rows:
        n, h, found = hits_by_hand(t, items)
        want.append(((i is None, i or 0), n, h, len(found), found, h > 0))
    assert got == sorted(want)
    assert decontamination.contamination(docs(spark, rows[:0]), bench).count() == 0
    none = decontamination.contamination(docs(spark, rows), bench.limit(0))
    assert none.count() == len(rows) and none.where("contaminated").count() == 0


def test_proximity_allows_displaced_words(spark):
    items = decontamination.items_of(spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string"))
    vocab = decontamination.vocabulary(items)
    index = decontamination.build_index(docs(spark, [(1, "alpha beta gamma", "a"), (2, "alpha x beta gamma", "a"), (3, "alpha", "a")]), vocab)
    numbered = decontamination.numbered_items(items, vocab, index, 10)
    ids = {r["row"]: r.doc_id for r in index.where("term = -1").collect()}
    near = lambda slop: {ids[r["row"]] for r in decontamination.proximity_matches(index, numbered, 10, slop).collect()}
    assert near(0) == {1} and near(1) == {1, 2}


def test_url_rules(spark):
    urls = ["http://a.example.net/en/1", "https://x.net/", "https://x.net", "http://NET/a", "http://example.com/de/x?y", "http://m.example.com/DE/x",
            "http://foo.org/fr/", "http://notorg/fr/", "http://spam-farm.example.org/en/1", "http://a.com/r?u=http://b.net/x", "no scheme net/", "", None,
            "http://example.net/en/casino", "http://x.com/casino", "http://x.com/a/login.php?x", "ftp://é.net/ü#f", "http://x.com/" + "a/" * 20000]
    rows = [(i, u, "h", "rule") for i, u in enumerate(urls)] + [(0, urls[0], "h", "rule"), (None, urls[1], None, None)]
    out = url_filter.filter_urls(spark.createDataFrame(rows, "page_id long, url string, html string, rule string")).collect()
    got = {r.page_id: (r.rule, r.verdict) for r in out}
    assert len(out) == len(rows)
    assert [got[i] for i in range(17)] == [
        ("example.net/en/", "allow"), ("net/", "block"), (None, "allow"), ("net/", "block"), ("example.com/de/", "block"), (None, "allow"),
        ("org/fr/", "allow"), (None, "allow"), (None, "block"), (None, "allow"), (None, "allow"), (None, "allow"), (None, "allow"),
        ("example.net/en/", "allow"), (None, "block"), (None, "block"), ("net/", "block")]
    host = {r.page_id: (r.host, r.path) for r in out}
    assert host[3] == ("net", "/a") and host[4] == ("example.com", "/de/x") and host[12] == ("", "") and host[10] == ("", "")
    assert got[None] == ("net/", "block")
    empty = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.filter_urls(empty).count() == 0


def test_line_dedup(spark):
    common = "same footer on every site"
    rows = [(i, f"own line {i}\n{common}\n\n  {common} ", f"s{i % 6}") for i in range(12)]
    rows += [(20, None, "s1"), (21, "", "s2"), (22, common, "s3"), (23, "twice\ntwice", None), (24, "x " * 50000, "s1"), (24, "x " * 50000, "s1")]
    out = line_dedup.dedup_lines(docs(spark, rows).withColumn("pos", F.lit(7))).collect()
    text = {r.doc_id: r.text for r in out}
    assert text[0] == f"own line 0\n{common}\n"
    assert all(text[i] == f"own line {i}\n" for i in range(1, 12))
    assert 22 not in text and text[20] is None and text[21] == "" and text[23] == "twice\ntwice"
    assert len(out) == len(rows) - 1 and sum(r.n_removed for r in out) == 1 + 2 * 11
    few = [(i, common, f"s{i % 4}") for i in range(50)]
    assert line_dedup.dedup_lines(docs(spark, few)).where("n_removed > 0").count() == 0
    assert line_dedup.dedup_lines(docs(spark, [])).count() == 0


def groups_by_hand(rows, width, percent):
    sets = {}
    for i, t, _ in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k: k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()
    comp = {i: i for i in sets}

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i

    ids = sorted(sets)
    for x in ids:
        for y in ids:
            c = len(sets[x] & sets[y])
            if x < y and c and 100 * c >= percent * (len(sets[x]) + len(sets[y]) - c):
                a, b = sorted((find(x), find(y)))
                comp[b] = a
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("leaders", [2, 64])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, leaders):
    monkeypatch.setattr(near_dup, "LEADERS", leaders)
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(rng.randint(1, 6)))
    rows = [(0, None, "a"), (1, "", "a"), (2, " \n\t", "a"), (3, "one", "a"), (4, "ONE ", "a"), (5, "one two", "a"), (6, "two one", "a")]
    for g in range(6):
        base = [word() for _ in range(rng.choice([8, 60, 200]))]
        for _ in range(12):
            t = list(base)
            for _ in range(rng.choice([0, 1, 2, 5, 20])):
                t[rng.randrange(len(t))] = word()
            rows.append((len(rows), " ".join(t), "a"))
    chain = [word() for _ in range(120)]  # each is near its neighbours only
    for k in range(30):
        chain[3 * k] = word()
        rows.append((len(rows), " ".join(chain), "a"))
    rows.append((len(rows), "z " * 60000, "a"))
    out = near_dup.near_duplicates(docs(spark, rows).withColumn("comp", F.lit(1))).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == groups_by_hand(rows, 3, 85)
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)


def test_near_duplicates_null_ids_repeated_rows_empty_table(spark):
    out = near_dup.near_duplicates(docs(spark, [(None, "a b c d", "x"), (5, "a b c d", "x"), (5, "a b c d", "x"), (2, "a b c d", "x")])).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in out if r.doc_id) == [(2, 2, True), (5, 2, False), (5, 2, False)]
    assert len(out) == 4
    assert near_dup.near_duplicates(docs(spark, [])).count() == 0


def test_signature_estimate_is_close(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    for j in (0.3, 0.85):
        errs = []
        for _ in range(40):
            pool = rng.integers(0, 1 << 63, 1000, dtype=np.uint64)
            both = int(1000 * j)
            a, b = np.unique(pool[: both + (1000 - both) // 2]), np.unique(np.concatenate([pool[:both], pool[both + (1000 - both) // 2:]]))
            bits = [[(int(x) & (1 << 64) - 1) >> 2 * k & 3 for x in near_dup._signature(s)[1] for k in range(32)] for s in (a, b)]
            match = np.mean(np.array(bits[0]) == np.array(bits[1]))
            errs.append((match - 0.25) / 0.75 - j)
        assert abs(np.mean(errs)) < 0.03


def test_digest_of_no_items():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")


def test_postings_are_gathered_a_bounded_number_a_task(spark, monkeypatch):
    """A file of the index holds more postings than a task should sort in memory."""
    monkeypatch.setattr(decontamination, "TASK_POSTINGS", 100)
    vocab = [(f"w{i}", i) for i in range(20)] + [("", decontamination.END_TERM)]
    rows = [(i, " ".join(f"w{(i + j) % 25}" for j in range(30)), "a") for i in range(100)]
    index = decontamination.build_index(docs(spark, rows), spark.createDataFrame(vocab, "word string, term long")).coalesce(1)
    n = index.count()
    hit = index.where("doc_id % 10 <> 3").select("row")
    lists = decontamination.posting_lists(index, hit)
    want: dict = {}
    for r in index.where(F.col("term") >= 0).join(hit, "row").collect():
        want.setdefault((r["row"], r["pos"] // decontamination.BLOCK), []).append((r["pos"] << 32) | r["term"])
    out = lists.withColumn("task", F.spark_partition_id()).collect()
    assert {(r["row"], r["block"]): sorted(r["codes"]) for r in out} == {k: sorted(x) for k, x in want.items()} and len(out) == len(want) == 90
    tasks: dict = {}
    for r in out:
        tasks[r["task"]] = tasks.get(r["task"], 0) + len(r["codes"])
    assert max(tasks.values()) < n / 4 and len(tasks) > 8
    gathered = lists._jdf.queryExecution().executedPlan().toString().partition("partial_collect_list")[2]
    assert "REPARTITION_BY_NUM" in gathered
