"""Token counts, packing, shards, language model, toxicity and top-k."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from assetqueue.llm import bpe, lm_scoring, packing, token_counts, token_output, topk, toxicity

SF, SF_LABELS = "/root/testdata/sf0.01", "/root/testdata/sf0.1"
ALPHABET = list("abc éßz,.!1²'sd\n\t 　") + ["  ", " ", " ", " ", "the", "\n\n", "你", "<|endoftext|>"]


def texts(n, top, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, top))) for _ in range(n)]


def frame(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "doc_id long, text string").withColumn("ids", F.lit(1))


def test_cached_ids_are_the_library_s():
    enc = bpe.Encoder(bpe.default_path("byte_bpe_50k.json"))
    for t in texts(4000, 30, 1):
        assert np.frombuffer(enc.encode(t), "<u4").tolist() == enc.lib.encode(t, add_special_tokens=False).ids, t
    ranks = bpe.RankEncoder(bpe.default_path("byte_bpe_50k.tiktoken"))
    for t in texts(2000, 30, 7):
        assert np.frombuffer(ranks.encode(t), "<u4").tolist() == ranks.lib.encode_ordinary(t), t
    other = bpe.Encoder(bpe.default_path("word_bpe_49k.json"))
    assert not other.cuts
    assert np.frombuffer(other.encode("Hello  there"), "<u4").tolist() == other.lib.encode("Hello  there", add_special_tokens=False).ids


def test_spliced_counts_equal_whole_counts(spark):
    c = token_counts.PieceCounter(bpe.default_path("piece_bpe_32k.model"))
    rng = random.Random(2)
    for t in texts(800, 400, 2):
        assert c.count(t, rng.choice([7, 20, 50]), rng.choice([2, 5, 11])) == len(c.lib.encode(t)), t
    values = [None, "", "a", "word " * 60000, "x" * 70000, *texts(20, 200, 4)]
    out = {r.doc_id: r for r in token_counts.token_counts(frame(spark, values)).collect()}
    for i, t in enumerate(values):
        n = len(c.lib.encode(t or ""))
        assert (out[i].n_bytes, out[i].n_tokens, out[i].over_limit) == (len((t or "").encode()), n, n > 4096)
    assert token_counts.token_counts(frame(spark, values).limit(0)).count() == 0


def test_subset_sum_is_closest():
    rng = random.Random(1)
    for _ in range(200):
        counts = {rng.randint(1, 40): rng.randint(1, 4) for _ in range(rng.randint(0, 5))}
        cap = rng.randint(0, 100)
        sums = {0}
        for k, n in counts.items():
            sums = {s + k * j for s in sums for j in range(n + 1) if s + k * j <= cap}
        need = packing.best_fill(counts, cap)
        assert all(need[k] <= counts[k] for k in need)
        assert sum(k * n for k, n in need.items()) == max(sums)


@pytest.mark.parametrize("bucket_docs", [7, 4000])
def test_packing_round_trip(spark, monkeypatch, bucket_docs):
    monkeypatch.setattr(packing, "BUCKET_DOCS", bucket_docs)
    values = [None, "", "same text", "same text", "long " * 3000, *texts(60, 1500, 6), *["copy " * 700] * 40]
    lib = bpe.Encoder(bpe.default_path("byte_bpe_50k.json")).lib
    ids = [lib.encode(t or "", add_special_tokens=False).ids + [0] for t in values]
    out = packing.pack(frame(spark, values)).collect()
    covered, seqs = Counter(), {}
    for r in out:
        part = np.array(ids[r.doc_id][r.start: r.start + r.length], "<u4")
        assert r.length == len(part) > 0 and r.doc_tokens == len(ids[r.doc_id]) and r.ids_crc32 == zlib.crc32(part.tobytes())
        covered.update((r.doc_id, k) for k in range(r.start, r.start + r.length))
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert covered == Counter((i, k) for i, x in enumerate(ids) for k in range(len(x)))
    for s in seqs.values():
        at = 0
        for o, n in sorted(s):
            assert o == at
            at += n
        assert at <= 1024
    if bucket_docs == 4000:
        assert len(seqs) <= sum(map(len, ids)) / 1024 * 1.01 + 1
    assert packing.pack(frame(spark, values).limit(0)).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 1000, 4097])
def test_feistel_is_a_permutation(n):
    s = token_output.slots(np.arange(n), n)
    assert sorted(s.tolist()) == list(range(n))
    assert token_output.slots(s, n, inverse=True).tolist() == list(range(n))
    if n > 100:
        assert (s != token_output.slots(np.arange(n), n, key=9)).any()


def test_shards_round_trip(spark, tmp_path):
    values = [None, "", "b", "b", *texts(50, 3000, 8)]
    out = token_output.materialise(frame(spark, values).repartition(3), str(tmp_path / "s"), shard_records=40).collect()
    lib = bpe.RankEncoder(bpe.default_path("byte_bpe_50k.tiktoken")).lib
    ids = [lib.encode_ordinary(t or "") + [0] for t in values]
    assert sorted(r.slot for r in out) == list(range(len(out))) and len(out) == sum(-(-len(x) // 256) for x in ids)
    for r in out:
        assert (r.shard, r.record) == divmod(r.slot, 40)
        row = token_output.read_records(r.path, r.record, 1)[0]
        want = ids[r.doc_id][r.start: r.start + 256]
        assert row.tolist() == want + [0] * (256 - len(want)) and r.n_ids == len(want)
        assert r.ids_crc32 == zlib.crc32(np.array(want, "<u2").tobytes())
    assert token_output.materialise(frame(spark, values).limit(0), str(tmp_path / "t")).count() == 0


def test_language_model_equals_brute_force(spark, monkeypatch):
    weights = np.random.default_rng(1).dirichlet([1, 1, 1], lm_scoring.MAX_BUCKET + 1)
    weights[0] = [0, 0.7, 0.3]
    monkeypatch.setattr(lm_scoring, "fit_weights", lambda hist, v: weights)
    rng = random.Random(3)
    values = [None, "", " \n", "One ONE", *[" ".join(rng.choice("a b c dé É e f".split()) for _ in range(rng.randint(1, 40))) for _ in range(80)]]
    values.append("w " * 40000)
    out = lm_scoring.score(frame(spark, values), block_bytes=500).collect()
    tokens = [[w for w in (t or "").encode().lower().split()] + [None] for t in values]
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i in range(len(values))]
    c, pair, ctx = Counter(), Counter(), Counter()
    for t, h in zip(tokens, held):
        if not h:
            c.update(t)
            pair.update(zip(["<s>", *t], t))
            ctx.update(["<s>", *t[:-1]])
    n, v = sum(c.values()), len(c)
    assert len(out) == len(values)
    for r in out:
        t = tokens[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(t), sum(c[x] > 0 for x in t), n)
        assert math.isclose(r.base_score, sum(math.log10((c[x] + 1) / (n + v + 1)) for x in t), rel_tol=1e-9)
        score = 0.0
        for p, x in zip(["<s>", *t], t):
            a2, a1, a0 = weights[ctx[p].bit_length()]
            score += math.log10((a2 * pair[p, x] / ctx[p] if ctx[p] else 0) + a1 * c[x] / n + a0 / (v + 1))
        assert math.isclose(r.score, score, rel_tol=1e-9)
    assert lm_scoring.score(frame(spark, values).limit(0)).count() == 0


def test_weights_raise_the_likelihood():
    g = lm_scoring.GRID
    hist = np.array([[3, 1 + 2 * g, 1 + 8 * g, 700], [3, 0, 1 + 8 * g, 250], [3, 0, 0, 50], [0, 0, 1 + 8 * g, 90], [0, 0, 0, 10]], float)
    w = lm_scoring.fit_weights(hist, 1000.0)
    assert np.allclose(w.sum(axis=1), 1) and w[3, 0] > 0.6 and w[0, 0] == 0

    def loglik(a):
        return sum(n * math.log(a[0] * (2 ** -2 if x2 else 0) + a[1] * (2 ** -8 if x1 else 0) + a[2] / 1001) for k, x2, x1, n in hist if k == 3)

    assert all(loglik(w[3]) >= loglik(a) - 1e-6 for a in ([0.5, 0.4, 0.1], [0.8, 0.1, 0.1], [0.7, 0.25, 0.05]))


def test_model_beats_the_base_on_held_out_text(spark):
    out = lm_scoring.score(spark.read.parquet(f"{SF}/documents.parquet")).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert out[0] > out[1]


def test_toxicity_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF_LABELS}/{n}.parquet") for n in ("documents", "labels"))
    out = toxicity.toxicity(docs, labels.withColumn("text", F.lit("x")))
    rows = out.join(labels.select("doc_id", "toxic"), "doc_id").where("held_out").collect()
    pos, neg = ([r.score for r in rows if r.toxic == k] for k in (1, 0))
    auc = np.mean([(p > q) + 0.5 * (p == q) for p in pos for q in neg])
    assert auc > 0.98
    assert np.mean([r.predicted for r in rows if r.toxic == 0]) < 0.02
    assert out.count() == docs.count()


def test_toxicity_edge_cases(spark):
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "hi " * 50000), (3, "hi"), (None, "you idiot")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    out = toxicity.toxicity(odd, none).collect()
    assert len(out) == 5 and all(r.score == 0.0 and r.predicted == 0 for r in out)
    assert toxicity.toxicity(odd.limit(0), none).count() == 0
    f = dict(zip(toxicity.FEATURES, toxicity.features_of("You LOSER, what an id1ot, s t u p i d!", {})))
    assert f["near_second_person"] > 0 and f["uncovered"] > 0 and f["all_caps"] > 0 and f["insults"] > 0


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    vecs = [rng.normal(size=24).tolist() for _ in range(600)]
    vecs[7:20] = [vecs[6]] * 13
    vecs += [None, [], [1.0, None] * 12, [float("nan")] * 24, [float("inf")] * 24, [0.5] * 3, [1e9] * 24, [-1e12] * 24]
    rows = [(i, v, i % 3) for i, v in enumerate(vecs)] + [(5, vecs[5], 1), (None, vecs[3], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int")
    out = topk.top_k(df, F.col("vec_id") % 50 == 0).collect()
    good = {i: [int(math.floor(256 * x)) for x in v] for i, v in enumerate(vecs)
            if v and all(x is not None and math.isfinite(x) for x in v)}
    want = set()
    for i in good:
        if i % 50 == 0:
            s = sorted((-sum(a * b for a, b in zip(good[i], good[j])), j) for j in good if j != i and len(good[j]) == len(good[i]))[:5]
            want |= {(i, k + 1, j, -x) for k, (x, j) in enumerate(s)}
    assert {tuple(r) for r in out} == want and len(out) == len(want)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_ids_of_many_texts_are_the_library_s():
    """Line feeds, runs of white space, other white space, special strings, nulls: each text as the library has it."""
    odd = [None, "", "\n", " ", "\n\n", "a\n\nb", "a\n\n\nb", "a \nb", "a\n b", "a\n\n", "\na", " a", "a  b", "a b", "a\tb", "a <|endoftext|> b"]
    values = odd + texts(3000, 30, 11) + ["\n".join(texts(40, 12, 12)), "word " * 50_000]
    for enc in (bpe.Encoder(bpe.default_path("byte_bpe_50k.json")), bpe.RankEncoder(bpe.default_path("byte_bpe_50k.tiktoken")),
                bpe.Encoder(bpe.default_path("word_bpe_49k.json"))):
        assert enc.encode_many(pa.array([], pa.string())) == []
        got = enc.encode_many(pa.array(values, pa.string()))
        assert len(got) == len(values)
        for t, ids in zip(values, got):
            assert ids == enc.whole(t or ""), t


def test_slices_of_bounded_size_hold_every_row():
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * n for n in (5, 0, 30, 1, 9, 9)] + [None], pa.string())], names=["text"])
    parts = list(bpe.text_slices(batch, max_bytes=10))
    assert [x for p in parts for x in p.column("text").to_pylist()] == batch.column("text").to_pylist()
    assert len(parts) > 2 and list(bpe.text_slices(batch.slice(0, 0))) == []
