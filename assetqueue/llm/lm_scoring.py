"""Deleted interpolation: a bigram model with mixture weights by context frequency.

P(w | v) = a2 * c(v,w)/c(v) + a1 * c(w)/N + a0 / (V+1), with (a2, a1, a0)
taken by the frequency bucket (power of two) of the context v. Counts come from
the training rows. For the weights, the training rows of every eighth block are
held out: expectation-maximisation over their tokens, with the counts of the
other blocks. What EM needs is a histogram of its tokens by bucket and by the two component
probabilities on a fine logarithmic grid: bounded whatever the input.

Texts are dealt into blocks by a hash of id and text. A block asks for the
counts of its distinct words and word pairs only (packed arrays of 64-bit
hashes, cut by hash range), so a frequent pair costs one entry a block. Key
ranges add up the blocks' training counts and answer in the same order; the
block then scores its documents. Request order is a function of content, so a
task that runs again gives the same arrays.

Cases: null and empty texts have one token, the end. Rows are scored each for
itself (repeated rows; null ids are training rows). Without training rows
every component but the uniform one is zero. An empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from assetqueue.llm.common import batch_words, mix64, written

BLOCK_BYTES, RANGE_BYTES, LEAST_BLOCKS = 12_000_000, 8_000_000, 16
MODULUS, HELD_OUT, FOLDS, EM_STEPS, GRID = 7, 2, 8, 60, 8
MAX_BUCKET = 48
END, START = np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344)
_PAIR = np.uint64(0xA0761D6478BD642F)


def fold(id_col: Column, modulus: int) -> Column:
    return F.crc32(id_col.cast("string")) % modulus


class Block:
    """Tokens of a block's documents and its distinct keys, in an order given by content."""

    def __init__(self, t: pa.Table):
        texts = t.column("text").to_pylist()
        h, bound = batch_words(texts)
        n_words = np.diff(bound)
        # each document's words, then its end
        self.n_tokens = n_words + 1
        self.ends = np.cumsum(self.n_tokens)
        self.starts = self.ends - self.n_tokens
        tok = np.empty(self.ends[-1] if len(texts) else 0, np.uint64)
        place = np.ones(len(tok), bool)
        place[self.ends - 1] = False
        tok[place] = h
        tok[~place] = END
        prev = np.empty_like(tok)
        prev[1:] = tok[:-1]
        prev[self.starts] = START
        pair = mix64(prev * _PAIR + (tok ^ (prev >> np.uint64(29))))
        self.doc = np.repeat(np.arange(len(texts)), self.n_tokens)
        keys, inverse = np.unique(np.concatenate([tok, pair, np.array([START], np.uint64)]), return_inverse=True)
        self.keys, n = keys, len(tok)
        self.tok, self.pair, start = inverse[:n], inverse[n: 2 * n], inverse[-1]
        self.ctx = np.empty_like(self.tok)
        self.ctx[1:] = self.tok[:-1]
        self.ctx[self.starts] = start
        train = t.column("train").to_numpy().astype(np.int64)
        self.train, self.start, self.n_train = train[self.doc], start, int(train.sum())

    def training_counts(self) -> np.ndarray:
        """How often each key occurs in the training rows; the start counts as a context."""
        sel, n = self.train > 0, len(self.keys)
        c = np.bincount(self.tok[sel], minlength=n) + np.bincount(self.pair[sel], minlength=n)
        c[self.start] += self.n_train
        return c

    def is_word(self) -> np.ndarray:
        w = np.zeros(len(self.keys), np.int8)
        w[self.tok] = 1
        return w


def _edges(ranges: int) -> np.ndarray:
    return np.array([(i << 64) // ranges for i in range(ranges)], np.uint64)


def _narrow(x: np.ndarray) -> bytes:
    """Counts as four bytes each, little-endian, eight where one needs them (the first byte says which); most are 1 and compress to little."""
    size = 8 if len(x) and x.max() > 0xFFFFFFFF else 4
    return bytes([size]) + x.astype(f"<u{size}").tobytes()


def _widened(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1)


def _gaps(keys: np.ndarray) -> bytes:
    """Sorted keys as differences, byte by byte apart: the high bytes are zeros and compress away."""
    return np.diff(keys, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def _ungap(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(data, np.uint8).reshape(8, -1).T.copy().view("<u8")[:, 0], dtype=np.uint64)


_REQUEST = "block long, part long, keys binary, c binary, w binary, tokens long"
_ANSWER = "block long, part long, c binary, f binary, words long, tokens long"


def _requests(ranges: int):
    def run(key, t):
        b = Block(t)
        c, w = b.training_counts(), b.is_word()
        at = np.append(np.searchsorted(b.keys, _edges(ranges)), len(b.keys))
        rows = [[key[0].as_py(), r, _gaps(b.keys[lo:hi]), _narrow(c[lo:hi]), w[lo:hi].tobytes(), 0]
                for r, (lo, hi) in enumerate(zip(at[:-1], at[1:])) if hi > lo]
        rows[0][-1] = int(b.train.sum())
        types = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64()]
        return pa.table([pa.array(x, y) for x, y in zip(zip(*rows), types)], names=["block", "part", "keys", "c", "w", "tokens"])

    return run


def _answers(key, t):
    """Add up one key range over the blocks; answer each block in the order of its request."""
    keys = [_ungap(x) for x in t.column("keys").to_pylist()]
    blocks = np.array(t.column("block").to_pylist())
    sizes = np.array([len(k) for k in keys])
    uniq, inv = np.unique(np.concatenate(keys), return_inverse=True)
    counts, fold = np.concatenate([_widened(x) for x in t.column("c").to_pylist()]), np.repeat(blocks % FOLDS == 0, sizes)
    c = np.bincount(inv, weights=counts, minlength=len(uniq))
    f = np.bincount(inv, weights=counts * fold, minlength=len(uniq))
    w = np.zeros(len(uniq), bool)
    w[inv[np.concatenate([np.frombuffer(x, np.int8) for x in t.column("w").to_pylist()]) > 0]] = True
    cuts = np.cumsum(sizes)[:-1]
    ca, fa = np.split(c[inv], cuts), np.split(f[inv], cuts)
    held = [_narrow(x) if k % FOLDS == 0 else b"" for x, k in zip(fa, blocks)]  # only held-out blocks need it
    return pa.table([t.column("block"), t.column("part"), pa.array([_narrow(x) for x in ca], pa.binary()), pa.array(held, pa.binary()),
                     pa.array([int((w & (c > 0)).sum())] + [0] * (len(keys) - 1), pa.int64()), t.column("tokens")],
                    names=["block", "part", "c", "f", "words", "tokens"])


def _joined(answers: pa.Table, name: str) -> np.ndarray:
    """A block's counts, in the order of its keys."""
    parts = answers.sort_by("part").column(name).to_pylist()
    return np.concatenate([_widened(x) for x in parts]).astype(np.float64)


def _components(c_ctx, c_pair, c_tok, n):
    with np.errstate(divide="ignore", invalid="ignore"):
        p2 = np.where(c_ctx > 0, c_pair / np.maximum(c_ctx, 1), 0.0)
        p1 = c_tok / n if n > 0 else np.zeros_like(c_tok)
    return p2, p1


def bucket_of(c_ctx: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else 1 + floor(log2 of its count)."""
    return np.minimum(np.frexp(c_ctx)[1], MAX_BUCKET)


def _cell(p: np.ndarray) -> np.ndarray:
    """Cell of a probability on the logarithmic grid; 0 for zero."""
    return np.where(p > 0, 1 + np.round(-np.log2(np.maximum(p, 1e-300)) * GRID), 0).astype(np.int64)


def _histogram(n_rest: float):
    def run(key, docs, answers):
        b = Block(docs)
        rest = _joined(answers, "c") - _joined(answers, "f")
        sel = np.flatnonzero(b.train)
        p2, p1 = _components(rest[b.ctx[sel]], rest[b.pair[sel]], rest[b.tok[sel]], n_rest)
        cells = np.stack([bucket_of(rest[b.ctx[sel]]), _cell(p2), _cell(p1)])
        cells, n = np.unique(cells, axis=1, return_counts=True) if len(sel) else (cells, np.empty(0, np.int64))
        return pa.table([pa.array(x, pa.int64()) for x in (*cells, n)], names=["bucket", "x2", "x1", "n"])

    return run


def fit_weights(hist: np.ndarray, v: float, steps: int = EM_STEPS) -> np.ndarray:
    """EM: weights (bigram, unigram, uniform) for each bucket; hist rows: bucket, cell 2, cell 1, tokens."""
    weights = np.tile(np.array([0.0, 0.9, 0.1]), (MAX_BUCKET + 1, 1))
    for k in range(MAX_BUCKET + 1):
        rows = hist[hist[:, 0] == k]
        probs = [np.where(rows[:, i] > 0, 2.0 ** (-(rows[:, i] - 1) / GRID), 0.0) for i in (1, 2)]
        p = np.stack([*probs, np.full(len(rows), 1 / (v + 1))], axis=1) if len(rows) else np.empty((0, 3))
        n = rows[:, 3].astype(float)
        w = np.array([0.4, 0.5, 0.1]) if k else weights[0].copy()
        if not len(rows):  # no held-out token: as the bucket below
            weights[k] = weights[k - 1] if k > 1 else [0.0, 0.9, 0.1]
            continue
        for _ in range(steps):
            post = w * p
            post /= post.sum(axis=1, keepdims=True)
            w = (post * n[:, None]).sum(axis=0) + np.array([0.0 if k == 0 else 0.01, 0.01, 0.01])
            w /= w.sum()
        weights[k] = w
    return weights


_SCORE = ("doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")


def _scores(n_all: float, v: float, weights: np.ndarray):
    def run(key, docs, answers):
        b = Block(docs)
        c = _joined(answers, "c")
        ct = c[b.tok]
        p2, p1 = _components(c[b.ctx], c[b.pair], ct, n_all)
        a = weights[bucket_of(c[b.ctx])]
        p = a[:, 0] * p2 + a[:, 1] * p1 + a[:, 2] / (v + 1)
        per = lambda x: np.add.reduceat(x, b.starts) if len(x) else x
        return pa.table([docs.column("doc_id"), docs.column("held_out"), pa.array(b.n_tokens.astype(np.int64)),
                         pa.array(per((ct > 0).astype(np.int64))), pa.array(per(np.log10((ct + 1) / (n_all + v + 1)))),
                         pa.array(per(np.log10(p)))],
                        names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    return run


def score(docs: DataFrame, id_col="doc_id", text_col="text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rem = F.coalesce(fold(F.col(id_col), MODULUS), F.lit(-1))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), (rem == HELD_OUT).alias("held_out"),
                       (rem != HELD_OUT).cast("long").alias("train"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    blocks, ranges = max(size // block_bytes + 1, LEAST_BLOCKS), size // RANGE_BYTES + 1
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)))

    requests = rows.groupBy("block").applyInArrow(_requests(ranges), _REQUEST)
    answers = written(requests.groupBy("part").applyInArrow(_answers, _ANSWER), "answers")
    held = F.col("block") % FOLDS == 0
    total = answers.agg(*[F.coalesce(F.sum(x), F.lit(0)) for x in ("words", "tokens", F.when(held, F.col("tokens")))]).first()
    v, n, n_held = (int(x) for x in total)

    answers = answers.select("block", "part", "c", "f")
    hist = (rows.where(held).groupBy("block").cogroup(answers.where(held).groupBy("block"))
            .applyInArrow(_histogram(n - n_held), "bucket long, x2 long, x1 long, n long")
            .groupBy("bucket", "x2", "x1").agg(F.sum("n").alias("n")).collect())
    weights = fit_weights(np.array([tuple(r) for r in hist], dtype=np.float64).reshape(-1, 4), v)
    out = rows.groupBy("block").cogroup(answers.drop("f").groupBy("block")).applyInArrow(_scores(n, v, weights), _SCORE)
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")
