"""Quality: regularised quadratic discriminant over transformed document statistics.

Each class has a mean and a covariance of the statistics; a covariance is shrunk
towards the pooled one and towards the diagonal. A text's score is the difference
of its two log densities (Mahalanobis distances by Cholesky factors, computed once
and cached in the model), put on the scale of a probability by a logistic fit on
differences from models that did not see the row.

What the fit needs of the labelled training rows are counts, sums and sums of
products by fold and class: tasks add them up, all labelled rows take part, and
the driver gets ``FOLDS`` x 2 rows. Shrinkage is chosen among ``GRID`` by the
log loss of rows outside the model's folds. Language, source, id and labels are
no statistics.

Cases: null and empty texts have all statistics zero and get a score. Very long
texts are counted whole, one at a time. Rows without a label only get scored. If
the training rows lack one of the classes, all scores are the share of good rows
(a half without any). Rows are scored each for itself (repeated rows; null ids:
not held out). Several labels of an id: the largest. An empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, functions as F

from assetqueue.llm.common import broadcast_if_small, cut, hash_words, mix64, written

THRESHOLD, MODULUS, HELD_OUT, FOLDS = 0.7, 4, 2, 4
GRID = [(pool, ridge) for pool in (0.02, 0.1, 0.3, 0.6) for ridge in (0.001, 0.01, 0.1)]
BATCH_BYTES = 4_000_000

STOP_WORDS = """the of and to in is it that for on with as are this was be by or from at
der die das und ist nicht ein eine mit von zu den für auf sich im dem des
le la les de des et est que un une dans pour pas qui sur par en du
el los las del y es se no una con su para al lo como más por""".split()
STATISTICS = """log_words word_bytes capitals digits marks exclamations bars symbols non_ascii spaces stop_words distinct
same_as_before repeated_threes top_word log_line_words repeated_lines bare_words log_lines""".split()

# one class a byte: 0 other letters and bytes, then as listed
_CLASSES = {1: range(65, 91), 2: range(97, 123), 3: range(48, 58), 4: b".,;:?'\"-()", 5: b"!", 6: b"|", 7: b"#$%&*+/<=>@[\\]^_`{}~",
            8: range(128, 256), 9: b" \t\n\x0b\x0c\r"}
_CLASS = np.zeros(256, np.uint8)
for _k, _bytes in _CLASSES.items():
    _CLASS[list(_bytes)] = _k
_K = 10


def _stop_hashes() -> np.ndarray:
    return np.sort(hash_words(" ".join(dict.fromkeys(STOP_WORDS)).encode())[1])


def statistics(texts: list) -> np.ndarray:
    """One row of ``STATISTICS`` per text."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    n = len(raw)
    sizes = np.array([len(x) for x in raw], np.int64)
    buf = np.frombuffer(b"".join(raw), np.uint8)
    byte = np.bincount(np.repeat(np.arange(n) * _K, sizes) + _CLASS[buf], minlength=n * _K).reshape(n, _K).astype(float)
    starts = np.concatenate(([0], np.cumsum(sizes + 1)))
    low = b" ".join(raw).lower()
    offs, h = hash_words(low)
    bound = np.searchsorted(offs, starts)
    words = np.diff(bound).astype(float)
    doc = np.repeat(np.arange(n), np.diff(bound))
    per_doc = lambda where: np.bincount(doc[where], minlength=n).astype(float)
    stops = _stop_hashes()
    at = np.minimum(np.searchsorted(stops, h), len(stops) - 1)
    stop = per_doc(stops[at] == h)
    inside = doc[1:] == doc[:-1]
    same = np.bincount(doc[1:][inside & (h[1:] == h[:-1])], minlength=n).astype(float)
    salt = mix64(doc.astype(np.uint64) + np.uint64(1))
    _, first, counts = np.unique(h ^ salt, return_index=True, return_counts=True)
    distinct = np.bincount(doc[first], minlength=n).astype(float)
    top = np.zeros(n)
    np.maximum.at(top, doc[first], counts)
    triple = (doc[2:] == doc[:-2]) if len(doc) > 2 else np.zeros(0, bool)
    three = mix64(h[:-2] * np.uint64(3) + mix64(h[1:-1] * np.uint64(5) + h[2:]))[triple] ^ salt[2:][triple] if len(doc) > 2 else h[:0]
    where = doc[2:][triple] if len(doc) > 2 else doc[:0]
    _, first3 = np.unique(three, return_index=True)
    threes = np.bincount(where, minlength=n).astype(float)
    repeated = threes - np.bincount(where[first3], minlength=n)
    lettered = np.zeros(len(low) + 1, np.int64)
    kinds = _CLASS[np.frombuffer(low, np.uint8)]
    lettered[1:] = np.cumsum((kinds == 2) | (kinds == 8))
    ends = np.append(offs[1:], len(low))
    bare = per_doc(lettered[ends] == lettered[offs])
    lines = [[x for x in (t or "").split("\n") if x.strip()] for t in texts]
    n_lines = np.array([len(x) for x in lines], float)
    once = np.array([len(set(x)) for x in lines], float)
    w, size = np.maximum(words, 1), np.maximum(sizes, 1).astype(float)
    share = lambda x, of: np.sqrt(x / np.maximum(of, 1))
    letters = byte[:, 1] + byte[:, 2]
    out = np.column_stack([
        np.log1p(words), np.log1p((size - byte[:, 9]) / w), share(byte[:, 1], letters), share(byte[:, 3], size), share(byte[:, 4], size),
        share(byte[:, 5], size), share(byte[:, 6], size), share(byte[:, 7], size), share(byte[:, 8], size), share(byte[:, 9], size),
        share(stop, w), np.log1p(distinct) - np.log1p(words), share(same, w), share(repeated, threes), share(top, w),
        np.log1p(words / np.maximum(n_lines, 1)), share(n_lines - once, n_lines), share(bare, w), np.log1p(n_lines)])
    out[words == 0] = 0.0
    return out


def _slices(texts):
    """Runs of rows of bounded size; one long text makes a run of its own."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t or "")
        if i > at and size + n > BATCH_BYTES:
            yield at, i
            at, size = i, 0
        size += n
    if len(texts) > at:
        yield at, len(texts)


def features(rows: DataFrame) -> DataFrame:
    """(doc_id, held_out, x) of rows (doc_id, held_out, text)."""

    def run(batches):
        for b in batches:
            texts = b.column("text").to_pylist()
            for lo, hi in _slices(texts):
                x = statistics(texts[lo:hi])
                x = pa.ListArray.from_arrays(pa.array(np.arange(hi - lo + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(lo, hi - lo), b.column("held_out").slice(lo, hi - lo), x],
                                                 names=["doc_id", "held_out", "x"])

    return rows.select("doc_id", "held_out", "text").mapInArrow(run, "doc_id long, held_out boolean, x array<double>")


# ---- fit ----------------------------------------------------------------------------------------------


def _matrix(col) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), -1)


def moments(train: DataFrame) -> dict:
    """{(fold, label): (n, sum, sum of products)} of rows (fold, label, x); tasks send one row per fold and label."""

    def run(batches):
        total = {}
        for b in batches:
            x = _matrix(b.column("x"))
            fold, label = (b.column(c).to_numpy(zero_copy_only=False) for c in ("fold", "label"))
            for k in {*zip(fold.tolist(), label.tolist())}:
                part = x[(fold == k[0]) & (label == k[1])]
                n, s, q = total.get(k, (0, 0.0, 0.0))
                total[k] = (n + len(part), s + part.sum(axis=0), q + part.T @ part)
        rows = [(*k, n, [*s.tolist(), *q.ravel().tolist()]) for k, (n, s, q) in total.items()]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.float64())))],
                                             names=["fold", "label", "n", "v"])

    parts = train.select("fold", "label", "x").mapInArrow(run, "fold int, label int, n long, v array<double>")
    parts = parts.select("fold", "label", "n", F.posexplode("v").alias("i", "v"))
    sums = parts.groupBy("fold", "label", "i").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect()
    p, out = len(STATISTICS), {}
    for r in sums:  # FOLDS x 2 x (p + p * p) numbers
        n, v = out.setdefault((r.fold, r.label), (r.n, np.zeros(p + p * p)))
        v[r.i] = r.v
    return {k: (n, v[:p], v[p:].reshape(p, p)) for k, (n, v) in out.items()}


class Discriminant:
    """Means and Cholesky factors of both classes after shrinkage, in pooled units."""

    def __init__(self, sums: dict, pool: float, ridge: float):
        by = {}
        for c in (0, 1):
            parts = [v for (_, label), v in sums.items() if label == c]
            by[c] = (sum(v[0] for v in parts), sum(v[1] for v in parts), sum(v[2] for v in parts))
        n = by[0][0] + by[1][0]
        cov = {c: q / m - np.outer(s / m, s / m) for c, (m, s, q) in by.items()}
        pooled = sum(by[c][0] / n * cov[c] for c in by)
        self.scale = 1 / np.sqrt(np.maximum(np.diag(pooled), 0) + 1e-6)
        unit = np.outer(self.scale, self.scale)
        self.means, self.factors, self.base = {}, {}, {}
        for c in by:
            s = ((1 - pool) * cov[c] + pool * pooled) * unit
            s = (1 - ridge) * s + ridge * np.diag(np.maximum(np.diag(s), 1e-3))
            spread, axes = np.linalg.eigh(s)  # a statistic without spread leaves rounding errors below zero
            chol = np.linalg.cholesky((axes * np.maximum(spread, 1e-6)) @ axes.T)
            self.means[c] = by[c][1] / by[c][0] * self.scale
            self.factors[c] = np.linalg.inv(chol)
            self.base[c] = np.log(by[c][0] / n) - np.log(np.diag(chol)).sum()

    def difference(self, x: np.ndarray) -> np.ndarray:
        """Log density and prior of class 1 less those of class 0."""
        z = x * self.scale
        log = {c: self.base[c] - 0.5 * (((z - self.means[c]) @ self.factors[c].T) ** 2).sum(axis=1) for c in (0, 1)}
        return log[1] - log[0]


def _without(sums: dict, fold: int) -> dict:
    return {k: v for k, v in sums.items() if k[0] != fold}


def _both(sums: dict) -> bool:
    return {label for _, label in sums} == {0, 1}


def choose(train: DataFrame, sums: dict) -> tuple:
    """The (pool, ridge) of least log loss on rows outside the model's folds."""
    models = {k: [Discriminant(_without(sums, k), *g) for g in GRID] for k in range(FOLDS) if _both(_without(sums, k))}

    def run(batches):
        loss = np.zeros(len(GRID))
        for b in batches:
            x, fold = _matrix(b.column("x")), b.column("fold").to_numpy(zero_copy_only=False)
            sign = 2.0 * b.column("label").to_numpy(zero_copy_only=False) - 1
            for k, fitted in models.items():
                at = fold == k
                if at.any():
                    loss += [np.logaddexp(0, -sign[at] * np.arcsinh(m.difference(x[at]))).sum() for m in fitted]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(GRID), dtype=np.int32)), pa.array(loss)], names=["i", "loss"])

    losses = train.select("fold", "label", "x").mapInArrow(run, "i int, loss double").groupBy("i").agg(F.sum("loss").alias("loss")).collect()
    best = min(losses, key=lambda r: (round(r.loss, 6), -r.i), default=None)
    return GRID[best.i] if best else GRID[-1]


def differences(rows: DataFrame, models: dict, schema: str) -> DataFrame:
    """``rows`` with x replaced by d, the arsinh of the difference; ``models`` by fold, or under None for all rows."""
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches):
        for b in batches:
            x, d = _matrix(b.column("x")), np.zeros(b.num_rows)
            if None in models:
                d[:] = models[None].difference(x)
            else:
                fold = b.column("fold").to_numpy(zero_copy_only=False)
                for k, m in models.items():
                    d[fold == k] = m.difference(x[fold == k])
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names[:-1]), pa.array(np.arcsinh(d))], names=names)

    return rows.mapInArrow(run, schema)


def quality(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", label_col="quality") -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row."""
    rem = F.coalesce(F.crc32(F.col(id_col).cast("string")) % MODULUS, F.lit(-1))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), (rem == HELD_OUT).alias("held_out"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    vecs = written(features(rows), "statistics")
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label")).dropna()
    marks = marks.groupBy("doc_id").agg((F.max("label") > 0).cast("int").alias("label"))
    train = vecs.where(~F.col("held_out")).join(broadcast_if_small(cut(marks), 1_000_000), "doc_id")
    train = cut(train.select(F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)).cast("int").alias("fold"), "label", "x"))
    sums = moments(train)
    if not _both(sums):
        n = {c: sum(v[0] for (_, label), v in sums.items() if label == c) for c in (0, 1)}
        out = vecs.withColumn("score", F.lit(n[1] / (n[0] + n[1]) if sums else 0.5))
    else:
        best = choose(train, sums)
        apart = {k: Discriminant(_without(sums, k), *best) for k in range(FOLDS) if _both(_without(sums, k))}
        seen = train.where(F.col("fold").isin(list(apart)))
        d = differences(seen, apart, "label int, d double").select(array_to_vector(F.array("d")).alias("x"), F.col("label").cast("double").alias("label"))
        slope, shift = 1.0, 0.0
        if apart and d.select("label").distinct().count() == 2:
            fit = LogisticRegression(featuresCol="x", labelCol="label", regParam=1e-4).fit(d)
            slope, shift = float(fit.coefficients[0]), float(fit.intercept)
        out = differences(vecs, {None: Discriminant(sums, *best)}, "doc_id long, held_out boolean, d double")
        out = out.withColumn("score", 1 / (1 + F.exp(-(slope * F.col("d") + shift))))
    return out.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
