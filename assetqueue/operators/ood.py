"""Out-of-distribution flags with an isolation forest (M14), in DataFrame operations only.

* Sampling: one hash of a row's key gives two numbers u and v; its place in tree t is
  the fraction of u + v * t, so rows are independent within a tree and no tree needs a
  hash of its own. Rows below a threshold sized for about 4 x psi rows a tree are
  candidates, and each tree takes its psi first ones.
* Growth, a level at a time for all trees: one aggregate per level gives each node's
  size and its least and largest value per feature. A node splits at a hash-drawn
  feature (of those that vary) and a hash-drawn place between the two; nodes of one
  row, without a varying feature or at depth ceil(log2(psi)) are leaves. A leaf of n
  rows at depth d has path length d + c(n).
* The forest has at most trees x (2 psi - 1) nodes, whatever the data; it becomes three
  literal arrays, and rows walk down all trees by higher-order functions.

Scores are rounded to nine digits, so that equal ones are equal in whatever order they
are summed. The flag threshold is the exact (1 - contamination) quantile of the train
scores. Without train rows there is no threshold, and flags are null.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from assetqueue.functions.quantile import exact_quantiles
from assetqueue.session import settle

EULER = 0.5772156649015329
OVERSAMPLING = 4.0


def c_factor(n: float) -> float:
    """Average path length of an unsuccessful BST search over n points."""
    if n <= 1:
        return 0.0
    if n <= 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + EULER) - 2.0 * (n - 1.0) / n


def _unit(digest: Column, part: int) -> Column:
    """A number in [0, 1) from 13 hex digits of a digest."""
    return F.conv(F.substring(digest, 1 + 13 * part, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def sample_per_tree(train: DataFrame, key_cols, n_trees: int = 200, psi: int = 256, seed: int = 42, vec_col: str = "features"):
    """((tree, key, features) with psi rows a tree, psi); psi is at most the number of rows."""
    n = train.count()
    psi = int(min(psi, n))
    share = min(1.0, OVERSAMPLING * psi / max(n, 1))
    key = F.concat_ws("|", *[F.col(c).cast("string") for c in key_cols])
    digest = F.md5(F.concat(F.col("__key"), F.lit(f"|{seed}")))
    drawn = train.select(key.alias("__key"), F.col(vec_col).alias("features")).select("__key", "features", _unit(digest, 0).alias("u"), _unit(digest, 1).alias("v"))
    at = lambda t: (F.col("u") + F.col("v") * t) - F.floor(F.col("u") + F.col("v") * t)
    picks = F.filter(F.transform(F.sequence(F.lit(0), F.lit(n_trees - 1)), lambda t: F.struct(t.alias("tree"), at(t).alias("at"))),
                     lambda s: s["at"] < F.lit(share))
    cand = drawn.select("__key", "features", F.explode(picks).alias("p")).select("p.tree", "p.at", "__key", "features")
    first = Window.partitionBy("tree").orderBy("at", "__key")
    return cand.withColumn("__r", F.row_number().over(first)).where(F.col("__r") <= psi).drop("__r", "at"), psi


def _nodes(rows: DataFrame, depth: int, max_depth: int, n_features: int, seed: int) -> DataFrame:
    """(tree, node, depth, n, feature, threshold) of a level; feature -1 for leaves."""
    ends = {end: F.expr(f"array({', '.join(f'{fn}(features[{i}])' for i in range(n_features))})") for end, fn in (("lo", "min"), ("hi", "max"))}
    stats = rows.groupBy("tree", "node").agg(F.count("*").alias("n"), *[e.alias(end) for end, e in ends.items()])
    varying = F.expr("filter(transform(lo, (x, i) -> struct(i AS f, x AS lo, hi[i] AS hi)), s -> s.hi > s.lo)")
    digest = F.md5(F.concat_ws("|", F.lit("split"), F.col("tree"), F.col("node"), F.lit(seed)))
    pick = F.get("varying", F.floor(_unit(digest, 0) * F.size("varying")).cast("int"))
    split = (F.col("n") > 1) & (F.size("varying") > 0) & F.lit(depth < max_depth)
    return stats.select("tree", "node", "n", varying.alias("varying")).select("tree", "node", "n", F.when(split, pick).alias("s"), digest.alias("d")).select(
        "tree", "node", F.lit(depth).alias("depth"), "n", F.coalesce("s.f", F.lit(-1)).alias("feature"),
        (F.col("s.lo") + _unit(F.col("d"), 1) * (F.col("s.hi") - F.col("s.lo"))).alias("threshold"))


@dataclass
class Forest:
    """Per (tree, node) at ``tree * width + node``: left child's place, split feature and threshold, a leaf's path length.

    The right child is next to the left one; a leaf is its own left child and has no threshold, so a row stays there.
    """

    left: list
    feature: list
    threshold: list
    length: list
    n_trees: int
    depth: int
    psi: int

    def score(self, vec_col: str = "features") -> Column:
        """Anomaly score 2^(-E[h(x)] / c(psi)), rounded to nine digits."""
        # constant expressions: the optimizer turns each into one array literal
        literal = lambda xs, t: F.split(F.lit(",".join("-" if x is None else repr(x) for x in xs)), ",").try_cast(f"array<{t}>")
        left, feature = literal(self.left, "int"), literal(self.feature, "int")
        threshold, length = literal(self.threshold, "double"), literal(self.length, "double")
        x = F.col(vec_col)

        def step(at, _):
            return F.get(left, at) + F.when(F.get(x, F.get(feature, at)) >= F.get(threshold, at), 1).otherwise(0)

        roots = F.sequence(F.lit(1), F.lit(1 + (self.n_trees - 1) * 2 ** (self.depth + 1)), F.lit(2 ** (self.depth + 1)))
        steps = F.sequence(F.lit(1), F.lit(max(1, self.depth)))
        total = F.aggregate(roots, F.lit(0.0), lambda s, root: s + F.get(length, F.aggregate(steps, root, step)))
        mean = total / F.lit(float(self.n_trees))
        raw = F.pow(F.lit(2.0), -mean / F.lit(c_factor(self.psi) or 1.0))
        return F.floor(raw * F.lit(1e9) + F.lit(0.5)) / F.lit(1e9)


def fit_forest(train: DataFrame, key_cols=("vehicle_id", "date"), n_trees: int = 200, psi: int = 256, seed: int = 42,
               vec_col: str = "features") -> Forest:
    sample, psi = sample_per_tree(train, key_cols, n_trees, psi, seed, vec_col)
    depth = int(math.ceil(math.log2(max(psi, 2))))
    rows = settle(sample.withColumn("node", F.lit(1)))
    first = rows.select(F.size("features").alias("n")).first()
    forest, spark = [], train.sparkSession
    for level in range(depth + 1 if first else 0):
        nodes = _nodes(rows, level, depth, first.n, seed).collect()  # at most n_trees * 2 ** level rows
        forest += nodes
        inner = [(r.tree, r.node, r.feature, r.threshold) for r in nodes if r.feature >= 0]
        if not inner:
            break
        inner = spark.createDataFrame(inner, "tree int, node int, feature int, threshold double")
        right = F.when(F.get("features", F.col("feature")) >= F.col("threshold"), 1).otherwise(0)
        rows = settle(rows.join(inner, ["tree", "node"]).select("tree", "features", (2 * F.col("node") + right).alias("node")))
    width = 2 ** (depth + 1)
    size = n_trees * width
    left, feature, threshold, length = list(range(size)), [0] * size, [None] * size, [0.0] * size
    for r in forest:
        at = r.tree * width + r.node
        if r.feature < 0:
            length[at] = r.depth + c_factor(r.n)
        else:
            left[at], feature[at], threshold[at] = r.tree * width + 2 * r.node, r.feature, r.threshold
    return Forest(left, feature, threshold, length, n_trees, depth, psi)


def ood_flags(train_vec: DataFrame, rows_vec: DataFrame, contamination: float = 0.02, n_trees: int = 200,
              psi: int = 256, seed: int = 42, key_cols=("vehicle_id", "date"), train_flag: str | None = None) -> DataFrame:
    """Fit on the train slice, flag rows whose score exceeds the train
    (1 - contamination) percentile.

    ``train_flag`` names a boolean column of ``rows_vec`` that marks its train rows: all rows are then scored
    once, and the threshold is taken from the marked ones.
    """
    forest = fit_forest(train_vec, key_cols, n_trees, psi, seed)
    scored = rows_vec.withColumn("ood_score", forest.score())
    if train_flag:
        scored = settle(scored)
        scores = scored.where(F.col(train_flag)).select(F.col("ood_score").alias("s"))
    else:
        scores = train_vec.select(forest.score().alias("s")).persist()  # scored once for both passes of the quantile
    thr = exact_quantiles(scores, "s", [1.0 - contamination]).get((), [None])[0]
    scores.unpersist()
    return scored.withColumn("ood_flag", F.col("ood_score") > F.lit(thr).cast("double"))
