"""The pipeline's stages against plain rules on a small fixture: lines, near-duplicates, decontamination."""

import random

import pytest
from test_text_operators import DOCS, groups_by_hand, hits_by_hand

import corpus_pipeline


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6)))
    feet = ["all rights reserved", " one footer of many sites ", "rare footer"]
    rows = []
    for _ in range(10):
        base = [word() for _ in range(60)]
        for _ in range(6):
            t = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 6])):
                t[rng.randrange(60)] = word()
            text = " ".join(t[:30]) + "\n\n" + " ".join(t[30:])
            if rng.random() < 0.5:
                text += "\n" + rng.choice(feet)
            rows.append((len(rows), text, f"s{rng.randrange(7)}"))
    rows += [(100 + i, "all rights reserved", f"s{i}") for i in range(3)] + [(110, None, "s1"), (111, "", "s2"), (112, "rare footer", None)]
    return rows


def stage(spark, name, rows, sf_dir=""):
    docs = spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], DOCS)
    return dict(corpus_pipeline.STAGES)[name](spark, docs, sf_dir).collect()


def lines_by_hand(rows, least=5):
    sites, first = {}, {}
    for i, t, s in sorted(rows, key=lambda r: r[0]):
        for k, line in enumerate((t or "").split("\n")):
            x = line.strip(" ")
            sites.setdefault(x, set()).update({s} - {None})
            first.setdefault(x, (i, k))
    out = {}
    for i, t, _ in rows:
        lines = (t or "").split("\n")
        kept = [x for k, x in enumerate(lines) if not x.strip(" ") or len(sites[x.strip(" ")]) < least or first[x.strip(" ")] == (i, k)]
        text = t if t is None else "\n".join(kept)
        if len(kept) == len(lines) or text.strip(" "):
            out[i] = text
    return out


def test_lines(spark, rows):
    want = lines_by_hand(rows)
    out = stage(spark, "line dedup", rows)
    assert {r.doc_id: r.text for r in out} == want and len(out) == len(want)
    assert len(want) < len(rows) and any(want.get(i, t) != t for i, t, _ in rows)


def test_near_duplicates(spark, rows):
    want = {i for i, (_, c) in groups_by_hand(rows, 5, 80).items() if i == c}
    assert sorted(r.doc_id for r in stage(spark, "near-duplicates", rows)) == sorted(want)
    assert want != {i for i, (_, c) in groups_by_hand(rows, 3, 85).items() if i == c}


def test_decontamination(spark, rows, tmp_path):
    items = [(1, " ".join(rows[0][1].split()[5:17])), (2, " ".join(rows[20][1].split()[:25])), (3, "rare footer"), (4, "not there")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    want = [i for i, t, _ in rows if not hits_by_hand(t, items)[1]]
    assert sorted(r.doc_id for r in stage(spark, "benchmark decontamination", rows, str(tmp_path))) == sorted(want)
    assert 0 < len(want) < len(rows)
