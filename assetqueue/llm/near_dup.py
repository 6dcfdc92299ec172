"""MinHash near-duplicates with b-bit signatures, and exact confirmation.

Each text becomes a set of distinct word shingles. Minima of ``K`` hash
permutations give band keys (candidates) and, by their low two bits, a packed
signature whose matching rate, corrected for chance collisions, estimates the
similarity. Candidates whose estimate is far below the threshold go; all others
are confirmed on full sets. Groups are found by rounds in which each bucket
tests a bounded block of its members (leaders) against the rest, so that
neither all pairs of a bucket nor a whole bucket is ever gathered. Before that,
members of the open buckets meet over their rare shingles: by the prefix rule a
linked pair shares one of the first few of either in order of frequency. A pair
that shares none of the rare ones has at most its frequent shingles in common,
and members too far away by that bound leave the rounds. Leaders are those with
the largest share of frequent shingles, the middle of a group, which unite it soonest.

Cases: null, empty or blank text: empty set, linked with nothing. Fewer words
than a shingle: the whole word sequence is the one element. Equal sets are one
class whatever their number. Rows with the same id are one node. A null id has
no component and is kept. Extra columns are ignored. An empty table gives an
empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from assetqueue.llm.bpe import slices
from assetqueue.llm.common import batch_words, broadcast_if_small, cut, mix64, trimmed

K, BITS = 128, 2
MISS = (1 - 0.85 ** 5) ** 25  # odds that a pair at the threshold shares no band: once in 2 million
LEADERS, RARE = 512, 32
MAX_BROADCAST_IDS = 1_000_000

_rng = np.random.default_rng(20240607)
_A = (_rng.integers(0, 1 << 32, K, dtype=np.uint64).astype(np.uint32) | np.uint32(1))[:, None]
_B = _rng.integers(0, 1 << 32, K, dtype=np.uint64).astype(np.uint32)[:, None]
_P = [np.uint64(x | 1) for x in _rng.integers(0, 1 << 63, 16, dtype=np.uint64).tolist()]


def shingle_sets(texts: list, width: int):
    """Sorted distinct 64-bit shingle hashes of each text."""
    h, bound = batch_words(texts)
    mult = [np.uint64(pow(int(_P[0]), k + 1, 1 << 64)) for k in range(width)]
    n = len(h) - width + 1
    sh = np.zeros(max(n, 0), np.uint64)
    for k in range(width):
        if n > 0:
            sh += h[k: k + n] * mult[k]
    sh = mix64(sh)
    for i in range(len(texts)):
        lo, hi = bound[i], bound[i + 1]
        if hi - lo >= width:
            yield np.unique(sh[lo: hi - width + 1])
        elif hi > lo:
            acc = np.array([hi - lo], np.uint64)
            for x in h[lo:hi]:
                acc = mix64(acc * _P[1] + x)
            yield acc
        else:
            yield sh[:0]


def _minima(s: np.ndarray) -> np.ndarray:
    x, best = (s >> np.uint64(32)).astype(np.uint32), None
    for at in range(0, len(x), 2048):
        m = (_A * x[None, at: at + 2048] + _B).min(axis=1)
        best = m if best is None else np.minimum(best, m)
    return best


def banding(percent: int) -> tuple[int, int]:
    """(bands, rows): the longest bands with which a pair at the threshold is missed with odds of ``MISS`` at most."""
    for rows in range(min(K, len(_P) - 6), 0, -1):
        miss = 1 - (percent / 100) ** rows
        bands = math.ceil(math.log(MISS) / math.log(miss) - 1e-9) if miss > 0 else 1
        if bands * rows <= K:
            return bands, rows
    raise ValueError(f"{K} minima are too few for {percent} %")


def _signature(s: np.ndarray, percent: int = 85):
    bands, length = banding(percent)
    m = _minima(s)
    rows = m[: bands * length].reshape(bands, length).astype(np.uint64)
    key = np.arange(1, bands + 1, dtype=np.uint64) * _P[2]
    for j in range(length):
        key = mix64(key ^ (rows[:, j] + _P[3 + j]))
    low = (mix64(m.astype(np.uint64)) & np.uint64((1 << BITS) - 1)).reshape(-1, 64 // BITS)
    packed = (low << (np.arange(64 // BITS, dtype=np.uint64) * np.uint64(BITS))).sum(axis=1, dtype=np.uint64)
    return key.view(np.int64), packed.view(np.int64)


_SIG_SCHEMA = "doc_id long, n_shingles long, f0 long, f1 long, s0 long, s1 long, s2 long, s3 long, bands array<long>"


def signatures(docs: DataFrame, id_col="doc_id", text_col="text", width: int = 3, percent: int = 85) -> DataFrame:
    """One row per row of ``docs``: set size, 128-bit set fingerprint, packed low bits, band keys."""

    def run(batches):
        for b in (part for batch in batches for part in slices(batch)):
            cols = {n: [] for n in ("n", "f0", "f1", "s0", "s1", "s2", "s3", "bands")}
            for s in shingle_sets(b.column(1).to_pylist(), width):
                cols["n"].append(len(s))
                if len(s):
                    keys, packed = _signature(s, percent)
                    f0 = mix64(s * _P[10] + _P[11]).sum(dtype=np.uint64)
                    f1 = mix64(s ^ _P[12]).sum(dtype=np.uint64)
                    cols["f0"].append(int(f0.view(np.int64)))
                    cols["f1"].append(int(f1.view(np.int64)))
                    cols["bands"].append(keys)
                else:
                    packed = (0, 0, 0, 0)
                    cols["f0"].append(0)
                    cols["f1"].append(0)
                    cols["bands"].append([])
                for k in range(4):
                    cols[f"s{k}"].append(int(packed[k]))
            longs = [pa.array(cols[n], pa.int64()) for n in ("n", "f0", "f1", "s0", "s1", "s2", "s3")]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *longs, pa.array(cols["bands"], pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "f0", "f1", "s0", "s1", "s2", "s3", "bands"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(trimmed(run), _SIG_SCHEMA)


def estimate(a, b) -> Column:
    """Similarity from matching two-bit fields, corrected for chance matches (1 in 4)."""
    match = F.lit(float(K))
    for k in range(4):
        x = a[f"s{k}"].bitwiseXOR(b[f"s{k}"])
        odd = x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(0x5555555555555555))
        match = match - F.bit_count(odd)
    chance = 2.0 ** -BITS
    return (match / K - chance) / (1 - chance)


def estimate_floor(percent: int) -> float:
    """Five standard deviations below the threshold: fewer than one true link in a million falls under it."""
    c, j = 2.0 ** -BITS, percent / 100
    e = c + (1 - c) * j
    return j - 5 * (e * (1 - e) / K) ** 0.5 / (1 - c)


def texts_of(ids: DataFrame, docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with one of the ids (a single column)."""
    ids = ids.toDF("doc_id").distinct()
    return docs.join(broadcast_if_small(ids, MAX_BROADCAST_IDS), "doc_id", "left_semi")


def confirmed(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * |A n B| >= percent * |A u B| on full sets.

    The member's text joins first and the leader's last, straight into the
    comparison: a leader of many members is never copied through a shuffle.
    """
    both = (pairs.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb")), "b")
            .join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta")), "a"))

    def run(batches):
        for t in (part for batch in batches for part in slices(batch)):
            left = t.column("ta").dictionary_encode()
            sets = list(shingle_sets(left.dictionary.to_pylist(), width))
            keep = []
            for i, y in zip(left.indices.to_pylist(), shingle_sets(t.column("tb").to_pylist(), width)):
                x = sets[i]
                both_n = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both_n > 0 and 100 * both_n >= percent * (len(x) + len(y) - both_n))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([t.column("a").filter(mask), t.column("b").filter(mask)], names=["a", "b"])

    return both.select("a", "b", "ta", "tb").mapInArrow(trimmed(run), "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, comp): smallest node reachable over ``edges`` (a, b); min-label steps with pointer jumps."""
    e = cut(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    lab = e.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("comp"))
    lab = cut(lab)
    while True:
        nb = e.join(lab, e.b == lab.node).groupBy("a").agg(F.min("comp").alias("m"))
        step = lab.join(nb, lab.node == nb.a).select("node", F.col("comp").alias("old"), F.least("comp", "m").alias("comp"))
        up = lab.select(F.col("node").alias("u"), F.col("comp").alias("uc"))
        new = cut(step.join(up, F.col("comp") == F.col("u"), "left")
                  .select("node", F.least("comp", F.coalesce("uc", "comp")).alias("comp"), "old"))
        if new.where("comp <> old").isEmpty():
            return new.select("node", "comp")
        lab = new.select("node", "comp")


def _united(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame | None:
    """(node, comp): components that confirmed pairs (a, ca, b, cb) join, or None; ca and cb are those of a and b."""
    if pairs.isEmpty():
        return None
    links = confirmed(pairs.select("a", "b"), texts, width, percent).join(pairs, ["a", "b"])
    edges = cut(links.select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct())
    return None if edges.isEmpty() else components(edges)


def _renamed(rows: DataFrame, up: DataFrame | None) -> DataFrame:
    if up is None:
        return rows
    up = up.select("node", F.col("comp").alias("__up"))
    return rows.join(up, rows["comp"] == up["node"], "left").withColumn("comp", F.coalesce("__up", "comp")).drop("node", "__up")


def near_duplicates(docs: DataFrame, id_col="doc_id", text_col="text", width: int = 3, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sigs = cut(signatures(docs, width=width, percent=percent))
    classes = cut(sigs.where("n_shingles > 0 and doc_id is not null").groupBy("f0", "f1", "n_shingles")
                  .agg(F.min("doc_id").alias("id")))
    reps = sigs.join(classes.select(F.col("id").alias("doc_id")).distinct(), "doc_id", "left_semi").where("n_shingles > 0")
    sig_cols = ["s0", "s1", "s2", "s3"]
    floor = estimate_floor(percent)

    # first, a few bands and one leader a bucket: large groups of copies become one component
    few = reps.select(F.col("doc_id").alias("id"), *sig_cols, F.explode(F.slice("bands", 1, 3)).alias("key"))
    hub = few.groupBy("key").agg(F.min("id").alias("a"), F.max("id").alias("z")).where("a < z").select("key", "a")
    pairs = few.join(hub, "key").where("a < id").select("a", F.col("id").alias("b")).distinct()
    sa = reps.select(F.col("doc_id").alias("a"), F.struct(*sig_cols).alias("x"))
    sb = reps.select(F.col("doc_id").alias("b"), F.struct(*sig_cols).alias("y"))
    pairs = cut(pairs.join(sb, "b").join(sa, "a").where(estimate(F.col("x"), F.col("y")) >= floor).select("a", "b").distinct())
    both = pairs.select("a").union(pairs.select("b"))
    pairs = pairs.select("a", F.col("a").alias("ca"), "b", F.col("b").alias("cb"))
    labels = reps.select(F.col("doc_id").alias("id"), F.col("doc_id").alias("comp")).distinct()
    labels = cut(_renamed(labels, _united(pairs, texts_of(both, docs), width, percent)))

    # then every band: buckets that still hold several components, a block of leaders at a time
    rows = reps.join(labels, reps.doc_id == labels.id).select("id", "comp", F.col("n_shingles").alias("n"), *sig_cols, F.explode("bands").alias("key"))
    live, ups = _several(rows), []
    if not live.isEmpty():
        texts = cut(texts_of(live.select("id"), docs))
        spelled = _spelled(texts, width, percent)
        ups.append(_united(_rare_pairs(live, spelled, floor), texts, width, percent))
        live = _renamed(live.join(spelled.select("id", "s"), "id"), ups[-1])
        live = _several(_reachable(live, percent))
    while not live.isEmpty():
        own = live.withColumn("rank", F.struct((1 - F.col("s") / F.col("n")).alias("r"), "id"))
        first = own.withColumn("rn", F.row_number().over(Window.partitionBy("key").orderBy("rank"))).where(F.col("rn") <= LEADERS)
        leaders = cut(first.groupBy("key").agg(F.max("rank").alias("last"), F.collect_list(F.struct("rank", "id", "comp", "n", "s", *sig_cols)).alias("lead")))
        me = F.struct("n", "s", *sig_cols)
        found = F.filter("lead", lambda l: (l["rank"] < F.col("rank")) & (l["comp"] != F.col("comp"))
                         & (100 * _most(l, me) >= percent * (l["n"] + me["n"] - _most(l, me))) & (estimate(l, me) >= floor))
        # a member meets the same leaders in many buckets: its lists are put together before they are spread out
        met = own.join(leaders, "key").select(
            F.col("id").alias("b"), F.col("comp").alias("cb"), F.transform(found, lambda l: F.struct(l["id"].alias("a"), l["comp"].alias("ca"))).alias("l"))
        met = met.where(F.size("l") > 0).groupBy("b", "cb").agg(F.array_distinct(F.flatten(F.collect_list("l"))).alias("l"))
        pairs = cut(met.select("b", "cb", F.explode("l").alias("l")).select("l.a", "l.ca", "b", "cb"))
        ups.append(_united(pairs, texts, width, percent))
        rest = own.join(leaders.select("key", "last"), "key").where(F.col("rank") > F.col("last")).drop("last", "rank")
        live = _several(_reachable(_renamed(rest, ups[-1]), percent))
    for up in ups:
        labels = _renamed(labels, up)

    of_class = classes.join(labels, "id").select("f0", "f1", "n_shingles", "comp")
    # a row is in its class; an id that occurs with several texts takes the smallest component of them
    per_id = sigs.select("doc_id", "n_shingles", "f0", "f1").join(of_class, ["f0", "f1", "n_shingles"], "left")
    out = F.coalesce("comp", "doc_id")
    return per_id.select("doc_id", "n_shingles", out.alias("component_id"), F.coalesce(out == F.col("doc_id"), F.lit(True)).alias("kept"))


def _several(rows: DataFrame) -> DataFrame:
    """The rows of the buckets with more than one component."""
    many = rows.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("key")
    return cut(rows.join(many, "key", "left_semi").distinct())


def _most(x, y) -> Column:
    """The most shingles that two members can share that share no rare one."""
    return F.least(x["s"], y["s"])


def _reachable(live: DataFrame, percent: int) -> DataFrame:
    """Rows whose frequent shingles alone could reach the threshold with the smallest set of their bucket."""
    least = live.groupBy("key").agg(F.min("n").alias("least"))
    size = F.greatest("least", "s")  # the best partner is no smaller than what is shared, if it may be so small
    return live.join(least, "key").where(100 * F.col("s") >= percent * (F.col("n") + size - F.col("s"))).drop("least")


def _spelled(texts: DataFrame, width: int, percent: int) -> DataFrame:
    """(id, s, rare): of each member, how many shingles are frequent, and the rare ones of its prefix (of each of its texts).

    Frequencies count the members ``texts``; rare: in at most ``RARE`` of them. The
    prefix of a set of n: its n - ceil(percent * n / 100) + 1 least frequent shingles.
    """

    def run(batches):
        for b in (part for batch in batches for part in slices(batch)):
            sets = [x.view(np.int64) for x in shingle_sets(b.column("text").to_pylist(), width)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("th"), pa.array(sets, pa.list_(pa.int64()))], names=["id", "th", "tokens"])

    one = texts.groupBy("doc_id", F.xxhash64("text").alias("th")).agg(F.min("text").alias("text"))
    rows = one.mapInArrow(trimmed(run), "id long, th long, tokens array<long>").select("id", "th", F.explode("tokens").alias("token"))
    rows = rows.join(rows.groupBy("token").agg(F.count("*").alias("df")), "token")
    sets = rows.groupBy("id", "th").agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("t"))
    n = F.size("t")
    prefix = F.slice("t", 1, n - F.ceil(n * percent / F.lit(100)).cast("int") + 1)
    rare = F.transform(F.filter(prefix, lambda x: (x["df"] > 1) & (x["df"] <= RARE)), lambda x: x["token"])
    own = sets.select("id", F.size(F.filter("t", lambda x: x["df"] > RARE)).cast("long").alias("s"), rare.alias("rare"))
    # an id with several texts: the most frequent shingles of any, and the rare ones of all
    return cut(own.groupBy("id").agg(F.max("s").alias("s"), F.array_distinct(F.flatten(F.collect_list("rare"))).alias("rare")))


def _rare_pairs(live: DataFrame, spelled: DataFrame, floor: float) -> DataFrame:
    """Pairs (a, ca, b, cb) of different components that share a rare shingle of both prefixes; at most RARE members a shingle."""
    members = live.select("id", "comp", F.struct("s0", "s1", "s2", "s3").alias("sig")).distinct()
    rows = spelled.select("id", F.explode("rare").alias("token")).join(members, "id")
    lists = rows.groupBy("token").agg(F.array_sort(F.collect_list(F.struct("id", "comp", "sig"))).alias("m")).where(F.size("m") > 1)
    near = lambda x: F.transform(F.filter("m", lambda y: (y["id"] > x["id"]) & (y["comp"] != x["comp"])
                                          & (estimate(x["sig"], y["sig"]) >= floor)), lambda y: F.struct(
                                              x["id"].alias("a"), x["comp"].alias("ca"), y["id"].alias("b"), y["comp"].alias("cb")))
    found = F.array_distinct(F.flatten(F.transform("m", near)))
    return cut(lists.select(F.explode(found).alias("p")).select("p.*").distinct())
