"""Boosted trees (M7): quantile-binned histograms, second-order gains and leaves.

Features are cut at (approximate) quantiles into at most ``MAX_BINS`` bins, once, in
one aggregate. The rows become blocks: binned bytes column by column, labels, weights
and margins of some thousand rows each, settled and dealt to as many partitions as
there are cores. A round grows one tree for every target at once (the horizons share
the features), and each level of it is one job: tasks add up sums of gradient, hessian
and rows by (target, node, feature, bin) over their blocks, for the root or for the
child of fewer rows (the other one is the rest of its parent); partial sums of many
tasks meet in two steps, and the driver sees one histogram per level, whose size the
data cannot change. Margins are brought up to date in the blocks every ``ROUNDS_A_MOVE``
rounds, in between a task applies the trees grown since; every ``ROUNDS_A_BLOCK`` rounds
they are computed from the settled blocks again, which cuts the lineage.

A split sends bins up to its threshold to the left; it needs ``min_leaf`` rows and
some hessian on both sides and the largest gain G^2/(H + l2), the first feature and
bin among equal ones. A node without such a split is a leaf. Missing values take bin 0.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from assetqueue.session import settle

MAX_BINS, ROUNDS_A_MOVE, ROUNDS_A_BLOCK, PARTIALS = 255, 4, 60, 16
ROWS_DEALT, ROWS_A_BLOCK, ROWS_A_PART = 4096, 32_768, 20_480
BYTES_A_BLOCK, BYTES_A_PART = 2 ** 22, 2 ** 25  # of bins
MIN_HESSIAN, EQUAL = 1e-3, 1e-9


def quantile_edges(df: DataFrame, features: str = "features", bins: int = MAX_BINS, accuracy: int = 10_000) -> list:
    """Per feature the sorted distinct values at the quantiles i / bins: one aggregate over all features."""
    first = df.select(F.size(features).alias("n")).first()
    if first is None:
        return []
    probs = ", ".join(f"{i / bins}D" for i in range(1, bins))
    got = df.agg(*[F.expr(f"percentile_approx({features}[{i}], array({probs}), {accuracy})").alias(f"q{i}") for i in range(first.n)]).first()
    return [np.unique(np.array(got[f"q{i}"] or [], float)) for i in range(first.n)]


def binned(x: np.ndarray, edges: list) -> np.ndarray:
    """Bin of each value: how many edges lie below it; missing values are in bin 0."""
    out = np.zeros(x.shape, np.uint8)
    for f, e in enumerate(edges):
        out[:, f] = np.where(np.isnan(x[:, f]), 0, np.searchsorted(e, x[:, f], side="left"))
    return out


@dataclass
class Tree:
    """A complete binary tree in heap order; ``feature`` -1 marks a leaf."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    @classmethod
    def leafless(cls, depth: int):
        n = 2 ** (depth + 1) - 1
        return cls(np.full(n, -1), np.zeros(n, int), np.zeros(n))

    def reached(self, bins: np.ndarray, depth: int) -> dict:
        """By node of the first ``depth`` levels and child of one: which rows pass it; fastest if ``bins`` lies by column."""
        masks = {0: np.ones(len(bins), bool)}
        for node in range(2 ** depth - 1):  # parents before children
            f = self.feature[node]
            if f >= 0:
                low = bins[:, f] <= int(self.threshold[node])  # a plain number: bytes are compared as bytes
                masks[2 * node + 1], masks[2 * node + 2] = masks[node] & low, masks[node] & ~low
        return masks

    def margins(self, bins: np.ndarray, depth: int) -> np.ndarray:
        leaf = np.zeros(len(bins), np.uint8 if depth < 8 else np.int64)
        for node, mask in self.reached(bins, depth).items():
            if node >= 2 ** depth - 1 or self.feature[node] < 0:
                leaf += mask * leaf.dtype.type(node)  # a row is in one leaf
        return self.value.take(leaf)


def _matrix(col, dtype=np.float64) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).astype(dtype).reshape(len(col), -1)


_BLOCK = "bins binary, y binary, w binary, m binary"


def _blocks(df: DataFrame, edges, start) -> DataFrame:
    """Rows (features, y array, w array) as small blocks; ``y`` and ``w`` hold one value for each target."""
    schema = pa.schema([(c, pa.binary()) for c in ("bins", "y", "w", "m")])

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS_DEALT):
                b = batch.slice(lo, ROWS_DEALT)
                bins = binned(_matrix(b.column("features")), edges)
                y, w = _matrix(b.column("y")), _matrix(b.column("w"))
                m = np.repeat(start[None, :], len(bins), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array([x.T.tobytes()], pa.binary()) for x in (bins, y, w, m)], schema=schema)

    return df.select("features", "y", "w").mapInArrow(run, _BLOCK)


def _arrays(blocks: DataFrame, n_targets):
    """The blocks as an RDD of arrays (bins, y, w, margins), feature or target by row, of about ``ROWS_A_BLOCK`` rows,
    fewer if a row has very many features."""
    def read(rows):
        some, n = [], 0
        for r in rows:
            y, w, m = (np.frombuffer(x).reshape(n_targets, -1) for x in (r.y, r.w, r.m))
            some.append((np.frombuffer(r.bins, np.uint8).reshape(-1, y.shape[1]), y, w, m))
            n += y.shape[1]
            if n >= min(ROWS_A_BLOCK, BYTES_A_BLOCK // max(1, len(some[0][0]))):
                yield tuple(np.concatenate(x, axis=1) for x in zip(*some))
                some, n = [], 0
        if some:
            yield tuple(np.concatenate(x, axis=1) for x in zip(*some))

    return blocks.rdd.mapPartitions(read)


def _advanced(m, bins, rounds, depth):
    """Margins after the trees of ``rounds`` (one list of trees, by target, for each round)."""
    m = m.copy()
    for trees in rounds:
        for k, t in enumerate(trees):
            m[k] += t.margins(bins.T, depth)
    return m


def _moved(blocks, rounds, depth):
    return blocks.map(lambda b: (*b[:3], _advanced(b[3], b[0], rounds, depth))) if rounds else blocks


def _histogram(blocks, parts: int, growing, smaller, level, n_features, n_bins, rows_too: bool) -> np.ndarray:
    """Sums of (gradient, hessian, rows) by target, node, feature and bin, for the root or, of each split one
    level up, the child that ``smaller`` names. Without ``rows_too`` rows are not counted."""
    shape, steps = (len(growing), max(1, 2 ** level // 2), 3, n_features, n_bins), PARTIALS

    def add(totals, bins, sums):
        for f in range(n_features):
            at = bins[f].astype(np.intp)
            rows = np.bincount(at, minlength=n_bins) if rows_too else 0
            for total, (g, h) in zip(totals, sums):
                total[0, f] += np.bincount(at, g, n_bins)
                total[1, f] += np.bincount(at, h, n_bins)
                total[2, f] += rows

    def run(part, rows):
        total = np.zeros(shape)
        for bins, y, w, m in rows:
            p = 1 / (1 + np.exp(-m))
            g, h = w * (p - y), w * p * (1 - p)
            if not level:
                add(total[:, 0], bins, [*zip(g, h)])
                continue
            for k, tree in enumerate(growing):
                masks = tree.reached(bins.T, level)
                for i, node in enumerate(smaller[k]):
                    if node in masks:
                        live = np.flatnonzero(masks[node])
                        add([total[k, i]], bins.take(live, axis=1), [(g[k, live], h[k, live])])
        yield part % steps, total

    partial = blocks.mapPartitionsWithIndex(run)
    if parts > steps:
        partial = partial.reduceByKey(np.add, steps)
    return np.moveaxis(sum((x for _, x in sorted(partial.collect(), key=lambda x: x[0])), np.zeros(shape)), 2, -1)


def _smaller(above: np.ndarray, trees: list, level: int) -> list:
    """By target and node one level up: which of its children has fewer rows, the left one among equals; -1 for a leaf."""
    first, out = 2 ** (level - 1) - 1, []
    for k, t in enumerate(trees):
        out.append([])
        for i, node in enumerate(range(first, 2 * first + 1)):
            f = t.feature[node]
            low, high = (above[k, i, f, s, 2].sum() for s in (slice(t.threshold[node] + 1), slice(t.threshold[node] + 1, None))) if f >= 0 else (0, 0)
            out[k].append(2 * node + 1 + int(low > high) if f >= 0 else -1)
    return out


def _children(above: np.ndarray, one: np.ndarray, smaller: list) -> np.ndarray:
    """Both children of each node, in order: ``one`` of them and the rest of the parent's sums; a leaf has none."""
    rest = above - one
    rest[rest[..., 2] == 0] = 0.0  # no rows: what is left of the sums is rounding
    nodes = np.array(smaller)[:, :, None, None, None]
    rest = np.where(nodes >= 0, rest, 0.0)
    right = (nodes >= 0) & (nodes % 2 == 0)  # right children have even numbers
    both = np.stack((np.where(right, rest, one), np.where(right, one, rest)), axis=2)
    return both.reshape(len(above), -1, *above.shape[2:])


def _split(sums: np.ndarray, min_leaf: int, l2: float):
    """(feature, bin) of the best split of one node, or None; ``sums``: feature, bin, (g, h, n)."""
    left = np.cumsum(sums, axis=1)
    total = left[:, -1:, :]
    right = total - left
    ok = (left[..., 2] >= min_leaf) & (right[..., 2] >= min_leaf) & (left[..., 1] >= MIN_HESSIAN) & (right[..., 1] >= MIN_HESSIAN)
    part = lambda s: s[..., 0] ** 2 / np.maximum(s[..., 1] + l2, 1e-300)
    gain = np.where(ok, part(left) + part(right) - part(total), -np.inf)
    best = gain.max()
    if not best > EQUAL:
        return None
    return np.unravel_index(int(np.flatnonzero(gain.ravel() >= best - EQUAL * best)[0]), gain.shape)


@dataclass
class BoostedTrees:
    """A fitted learner: bin edges by feature, trees by round, the margin to start from."""

    edges: list
    trees: list
    start: float
    depth: int

    def margins(self, features) -> "F.Column":
        """Margin of an array column, by Arrow batches."""
        edges, trees, start, depth = self.edges, self.trees, self.start, self.depth

        @F.pandas_udf("double")
        def run(vecs):
            import pandas as pd

            if not len(vecs):
                return pd.Series([], dtype=float)
            bins = np.asfortranarray(binned(np.stack(vecs.to_numpy()).astype(float), edges))
            out = np.full(len(bins), start)
            for t in trees:
                out += t.margins(bins, depth)
            return pd.Series(out)

        return run(features)

    def to_json(self) -> str:
        return json.dumps({"start": self.start, "depth": self.depth, "edges": [e.tolist() for e in self.edges],
                           "trees": [[t.feature.tolist(), t.threshold.tolist(), t.value.tolist()] for t in self.trees]})

    @classmethod
    def from_json(cls, text: str):
        d = json.loads(text)
        trees = [Tree(np.array(f), np.array(t), np.array(v, float)) for f, t, v in d["trees"]]
        return cls([np.array(e, float) for e in d["edges"]], trees, d["start"], d["depth"])


def fit(df: DataFrame, edges: list | None = None, rounds: int = 300, depth: int = 3, step: float = 0.05, min_leaf: int = 20,
        l2: float = 0.0) -> list[BoostedTrees]:
    """One learner for each target of rows (features array, y array, w array: a value for each target)."""
    edges = quantile_edges(df) if edges is None else [np.asarray(e, float) for e in edges]
    sized = df.select(F.size("y").alias("n")).first()
    if sized is None:
        raise ValueError("no rows to learn from")
    n_targets, n_features = sized.n, len(edges)
    n_bins = max((len(e) for e in edges), default=0) + 1
    sums = df.agg(F.count("*").alias("n"), *[F.sum(F.col("w")[k] * F.col("y")[k]).alias(f"p{k}") for k in range(n_targets)],
                  *[F.sum(F.col("w")[k]).alias(f"w{k}") for k in range(n_targets)]).first()
    share = np.array([min(max(sums[f"p{k}"] / sums[f"w{k}"], 1e-12), 1 - 1e-12) for k in range(n_targets)])
    start = np.log(share / (1 - share))
    cores = df.sparkSession.sparkContext.defaultParallelism
    parts = max(1, min(-(-sums.n // ROWS_A_PART), max(cores, -(-sums.n * n_features // BYTES_A_PART))))
    settled = settle(_blocks(df, edges, start).repartition(parts))
    base = _arrays(settled, n_targets).persist()
    kept, grown, rows = base, [], None
    for r in range(rounds):
        before = kept
        if r and r % ROUNDS_A_MOVE == 0:
            kept = (_moved(kept, grown[-ROUNDS_A_MOVE:], depth) if r % ROUNDS_A_BLOCK else _moved(base, grown, depth)).persist()
        blocks = _moved(kept, grown[r - r % ROUNDS_A_MOVE:], depth)
        trees = [Tree.leafless(depth) for _ in range(n_targets)]
        for level in range(depth):
            smaller = _smaller(hist, trees, level) if level else None
            got = _histogram(blocks, parts, trees, smaller, level, n_features, n_bins, level > 0 or r == 0)
            if level == 0:
                if before not in (base, kept):
                    before.unpersist()
                rows = got[..., 2].copy() if r == 0 else rows  # all rows are in the root in every round
                got[..., 2] = rows
            hist = _children(hist, got, smaller) if level else got
            for k, tree in enumerate(trees):
                for i in range(2 ** level):
                    node = 2 ** level - 1 + i
                    g, h, n = hist[k, i, 0].sum(axis=0) if n_features else (0.0, 0.0, 0)
                    if n:
                        tree.value[node] = -step * g / max(h + l2, 1e-300)
                        at = _split(hist[k, i], min_leaf, l2)
                        if at is not None:
                            tree.feature[node], tree.threshold[node] = at
                            low = hist[k, i, at[0], : at[1] + 1].sum(axis=0)
                            for child, (gc, hc, _) in ((2 * node + 1, low), (2 * node + 2, hist[k, i, at[0]].sum(axis=0) - low)):
                                tree.value[child] = -step * gc / max(hc + l2, 1e-300)
        grown.append(trees)
    kept.unpersist()
    base.unpersist()
    settled.unpersist()
    return [BoostedTrees(edges, [trees[k] for trees in grown], float(start[k]), depth) for k in range(n_targets)]
