"""Quality classifier: held-out accuracy, statistics by hand, moments against numpy, its cases."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from assetqueue.llm import quality as Q

SF = "/root/testdata/sf0.01"


def auc(pairs):
    good, bad = [s for s, y in pairs if y], [s for s, y in pairs if not y]
    return sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad))


def test_held_out(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    out = Q.quality(docs, labels)
    rows = out.join(labels, "doc_id").where("held_out").collect()
    assert auc([(r.score, r.quality) for r in rows]) > 0.97
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95
    assert out.count() == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    # labels of held-out rows teach nothing
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    other = {r.doc_id: r.score for r in Q.quality(docs, flipped).collect()}
    assert all(abs(other[r.doc_id] - r.score) < 1e-9 for r in rows)


def test_statistics_by_hand():
    x = dict(zip(Q.STATISTICS, Q.statistics(["The cat THE cat the cat!\n\nThe cat THE cat the cat!\n12 | #"])[0]))
    assert x["log_words"] == pytest.approx(np.log1p(15)) and x["log_lines"] == pytest.approx(np.log1p(3))
    assert x["stop_words"] == pytest.approx(np.sqrt(6 / 15)) and x["bare_words"] == pytest.approx(np.sqrt(3 / 15))
    assert x["distinct"] == pytest.approx(np.log1p(6) - np.log1p(15))  # the, cat, cat!, 12, |, #
    assert x["repeated_lines"] == pytest.approx(np.sqrt(1 / 3)) and x["capitals"] == pytest.approx(np.sqrt(8 / 36))
    assert x["top_word"] == pytest.approx(np.sqrt(6 / 15)) and x["same_as_before"] == 0
    # the cat the | cat the cat | cat the cat! | the cat! the | cat! the cat
    assert x["repeated_threes"] == pytest.approx(np.sqrt((13 - 8) / 13))
    together = Q.statistics(["a b", None, "", "x " * 50, " \n "])
    alone = np.vstack([Q.statistics([t]) for t in ["a b", None, "", "x " * 50, " \n "]])
    assert (together == alone).all() and not together[[1, 2, 4]].any()


def test_moments_and_factors(spark):
    rng = np.random.default_rng(1)
    p = len(Q.STATISTICS)
    x = rng.normal(size=(400, p)) @ rng.normal(size=(p, p))
    label, fold = rng.integers(0, 2, 400), rng.integers(0, Q.FOLDS, 400)
    rows = [(int(f), int(y), v.tolist()) for f, y, v in zip(fold, label, x)]
    sums = Q.moments(spark.createDataFrame(rows, "fold int, label int, x array<double>").repartition(5))
    for (f, y), (n, s, q) in sums.items():
        part = x[(fold == f) & (label == y)]
        assert n == len(part) and np.allclose(s, part.sum(axis=0)) and np.allclose(q, part.T @ part)
    m = Q.Discriminant(sums, 0.0, 0.0)
    want = 0
    for c, sign in ((1, 1), (0, -1)):
        part = x[label == c]
        cov, d = np.cov(part.T, bias=True), x - part.mean(axis=0)
        want = want + sign * (np.log(len(part) / 400) - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d))
    assert np.allclose(m.difference(x), want, rtol=1e-2, atol=0.05)


def test_cases(spark):
    rng = random.Random(2)
    good = lambda: " ".join(rng.choice("the of river walked slowly along old stone bridge and".split()) for _ in range(40)) + "."
    rows = [(i, good() if i % 2 else "## $$ " * 20, "q", 1) for i in range(200)]
    rows += [(None, good(), "q", 1), (7, good(), "q", 1), (7, good(), "q", 1), (900, None, "q", 1), (901, "", "q", 1), (902, "x " * 400_000, "q", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string, x int")
    marks = spark.createDataFrame([(i, i % 2, 0) for i in range(200)] + [(7, 0, 1), (None, 1, 1), (3, None, 1)], "doc_id long, quality int, held_out int")
    out = Q.quality(docs, marks).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    by = {r.doc_id: r for r in out}
    assert all(by[i].predicted == i % 2 for i in range(8, 200)) and not by[None].held_out and by[None].predicted == 1
    one = Q.quality(docs, marks.where("quality = 1")).collect()
    assert {r.score for r in one} == {1.0} and {r.score for r in Q.quality(docs, marks.limit(0)).collect()} == {0.5}
    assert Q.quality(docs.limit(0), marks).count() == 0
