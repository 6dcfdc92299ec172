"""Phrase mining against brute force, its automata against dictionaries, its cases on hand-made rows."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from assetqueue.llm import phrase_mining as P

SCHEMA = "lang string, text string"


def by_hand(rows, min_count, max_words=5, top=2000, percent=100):
    n, f = Counter(), {}
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            c = f.setdefault(lang, Counter())
            for i in range(len(w)):
                for k in range(1, max_words + 1):
                    if i + k <= len(w):
                        c[tuple(w[i: i + k])] += 1
    out = []
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= min_count}
        rows = []
        for p, a in cand.items():
            if any(len(q) > len(p) and 100 * cand[q] >= percent * a and any(q[i: i + len(p)] == p for i in range(len(q))) for q in cand):
                continue
            score, _, left, right = min((1000 * a * n[lang] // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), left, right))
        for i, (s, a, p, left, right) in enumerate(sorted(rows)[:top]):
            out.append((lang, i + 1, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def texts(seed, n, langs=("en", "fr")):
    rng = random.Random(seed)
    words = ["The", "of", "a", "b", "to", "New", "York", "city", "é", "z#", "\x01x", "Wörld"]
    passage = "the  quick\tbrown FOX jumps over the lazy dog, again and again"
    rows = []
    for _ in range(n):
        t = " ".join(rng.choice(words) + rng.choice(["", "", "", ",", "."]) for _ in range(rng.randint(0, 30)))
        if rng.random() < 0.3:
            t += "\n" + passage
        rows.append((rng.choice(langs), t))
    return rows


def run(spark, rows, **kw):
    return sorted(tuple(r) for r in P.collocations(spark.createDataFrame(rows, SCHEMA), **kw).collect())


@pytest.mark.parametrize("shard,size", [(8_000_000, 4_000_000), (400, 40), (60, 7)])
def test_equals_brute_force(spark, monkeypatch, shard, size):
    """Few or many shards and ranges, also ranges within one word."""
    monkeypatch.setattr(P, "SHARD_BYTES", shard)
    monkeypatch.setattr(P, "RANGE_WORDS", size)
    monkeypatch.setattr(P, "HASH_RANGE_BYTES", 10 * size)
    rows = texts(1, 120) + [(None, "a a a a a a a. a a"), ("en", None), ("en", "")] + [("en", "same row again")] * 12
    assert run(spark, rows, min_count=4) == by_hand(rows, 4)


def test_ties_top_and_percent(spark):
    rows = texts(2, 60, ("en",)) + [("x", "p q. r s. P q; r s! t u")] * 5
    assert run(spark, rows, min_count=3, top=2) == by_hand(rows, 3, top=2)
    assert run(spark, rows, min_count=3, percent=40) == by_hand(rows, 3, percent=40)
    assert run(spark, rows, min_count=3, max_words=2) == by_hand(rows, 3, max_words=2)


def test_empty_long_and_extra_columns(spark, monkeypatch):
    assert run(spark, []) == [] and run(spark, [("en", None), (None, "")]) == [] and run(spark, [("en", "a b")] * 3) == []
    monkeypatch.setattr(P, "SHARD_BYTES", 1000)
    rows = [("en", "one two three. " * 3000 + "x" * 5000)]
    docs = spark.createDataFrame([(*r, 1, "k", 2) for r in rows], SCHEMA + ", n long, kind string, range int")
    got = sorted(tuple(r) for r in P.collocations(docs).collect())
    assert got == by_hand(rows, 100) and got[0][2] == "one two three"


def test_exact_beyond_64_bits():
    a, n = 3 * 10**9, 4 * 10**12
    assert P.lowest_cut(a, [a + 1, a], [a + 7, a + 9], n) == min((1000 * a * n // (x * y), k, x, y) for k, (x, y) in enumerate([(a + 1, a + 7), (a, a + 9)]))
    assert P.lowest_cut(5, [10, 10], [10, 10], 1)[1] == 0


def random_ngrams(rng, n, depth=5, v=6):
    rows = np.zeros((n, depth), np.int64)
    for i in range(n):
        k = rng.randint(1, depth)
        rows[i, :k] = [rng.randint(1, v) for _ in range(k)]
    return rows[np.lexsort(rows.T[::-1])]


def weights(automaton):
    out, names = {}, [()]
    for parent, label, weight in automaton.paths():
        names = [(*names[p], x) for p, x in zip(parent.tolist(), label.tolist())]
        out.update(zip(names, weight.tolist()))
    return out


def counted(rows):
    c = Counter()
    for r in rows.tolist():
        for k in range(1, 6):
            if k <= len(r) and r[k - 1]:
                c[tuple(x - 1 for x in r[:k])] += 1
    return dict(c)


def test_automata():
    rng = random.Random(3)
    parts = [random_ngrams(rng, n) for n in (1, 50, 400)]
    built = [P.Counts.unpack(P.Counts.build(r).pack()) for r in parts]
    assert [weights(b) for b in built] == [counted(r) for r in parts]
    paths, numbers = P.union(built, 0)
    total = Counter()
    for r in parts:
        total.update(counted(r))
    least = P.common(paths, 20)
    assert weights(least) == {k: c for k, c in total.items() if c >= 20}
    whole = weights(P.common(paths, 1))
    assert whole == dict(total) and all(len(x) == len(paths) or x for x in numbers)
    for b, r in zip(built, parts):
        found = np.concatenate(P.compose(b, least)) if b.levels else []
        assert found.tolist() == [total[k] if total[k] >= 20 else 0 for k in weights(b)]
    shared = P.Counts.build(np.array([[a, 1, 2, 3] for a in range(1, 200)]))
    assert sum(len(d) for d, *_ in shared.levels[1:]) == 3  # equal ends are one chain of states


def test_pack_round_trip():
    arrays = [np.array([], np.int64), np.array([0, 127]), np.array([128, 40000]), np.array([1 << 40]), np.array([(1 << 63) - 1])]
    assert all((a == b).all() and len(a) == len(b) for a, b in zip(arrays, P.unpack(P.pack(arrays))))
