"""Toxicity: gradient-boosted trees over dense features, isotonic calibration.

Features of a text: densities of a fixed lexicon and of one learned from the
labels (words and word beginnings that are far commoner in toxic texts), insults
near a second person, shares of capitals and punctuation, rates of obfuscation
(digits or marks inside words, stretched letters, spelled-out words) and what
undoing it uncovers. Trees and calibration are fitted on a bounded sample of the
labelled training rows (``SAMPLE``, smallest hashes first); the lexicon counts
all of them. Language, source and id are no features.

Cases: null and empty texts have all features zero and get a score. Rows
without a label only get scored. If the sample lacks one of the classes, all
scores are the share of toxic rows in it. Rows are scored each for itself
(repeated rows, null ids: not held out). Several labels of an id: the largest.
An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, functions as F

from assetqueue.llm.bpe import slices
from assetqueue.llm.common import broadcast_if_small, cut, trimmed, written

SAMPLE, TREES, DEPTH, THRESHOLD = 20_000, 30, 4, 0.3
MODULUS, HELD_OUT = 4, 2
LEXICON, RATIO = 4096, 8.0
PREFIXES = (4, 5, 6)

INSULTS = frozenset("""idiot moron stupid loser scum trash pathetic worthless disgusting clown dumb jerk fool imbecile
idiota estúpido imbécil tonto basura asqueroso idioten dumm depp trottel abschaum widerlich
crétin débile connard minable ordure""".split())
SECOND_PERSON = frozenset("""you your yours yourself ur du dich dir dein deine ihr euch tu te toi ton tes vous votre tú ti
tus usted ustedes vosotros""".split())
LETTERS = re.compile(r"[^\W\d_]+")
TOKENS = re.compile(r"\S+")
MIXED = re.compile(r"[^\W\d_][\d@$*!.\-_]+[^\W\d_]")
STRETCHED = re.compile(r"([^\W\d_])\1\1")
SPELLED = re.compile(r"(?<!\S)(?:\w[ .\-*]){3,}\w(?!\S)")
LEET = str.maketrans("013457@$", "oieastas")
INNER = re.compile(r"(?<=\w)[*.\-_](?=\w)")

FEATURES = ("insults log_insults learned log_learned learned_weight max_weight second_person near_second_person capitals "
            "all_caps exclamations questions marks mixed stretched spelled uncovered log_words word_length").split()


def terms_of(words) -> set:
    """Words and word beginnings that may enter the learned lexicon."""
    out = {w for w in words if len(w) > 2}
    for n in PREFIXES:
        out.update(w[:n] + "~" for w in words if len(w) > n)
    return out


def by_length(lexicon: dict) -> list:
    """The lexicon's whole words, then its word beginnings by their length, as (length, {text: weight})."""
    whole = {t: x for t, x in lexicon.items() if not t.endswith("~")}
    return [(0, whole), *((n, {t[:n]: x for t, x in lexicon.items() if t.endswith("~") and len(t) == n + 1}) for n in PREFIXES)]


def features_of(text: str, lexicon: dict, parts: list | None = None) -> list:
    (_, whole), *prefixes = parts or by_length(lexicon)
    low = text.lower()
    words = LETTERS.findall(low)
    if not words:
        return [0.0] * len(FEATURES)
    n, counts = len(words), Counter(words)
    weight = {}
    for w in counts:
        best = whole.get(w, 0.0)
        for k, known in prefixes:
            if len(w) <= k:
                break
            x = known.get(w[:k], 0.0)
            if x > best:
                best = x
        if best:
            weight[w] = best
    bad = {w for w in counts if w in INSULTS}
    insults, learned = sum(counts[w] for w in bad), sum(counts[w] for w in weight)
    total = sum(counts[w] * x for w, x in weight.items())
    bad |= weight.keys()
    you = near = 0
    if any(w in SECOND_PERSON for w in counts):
        places = [i for i, w in enumerate(words) if w in SECOND_PERSON]
        you = len(places)
        if bad:
            near = sum(any(w in bad for w in words[max(0, i - 5): i + 6]) for i in places)
    uncovered = 0
    if MIXED.search(low) or SPELLED.search(low):
        plain = SPELLED.sub(lambda m: re.sub(r"[ .\-*]", "", m[0]), low)
        plain = INNER.sub("", plain).translate(LEET)
        uncovered = max(0, sum(w in INSULTS or w in lexicon for w in LETTERS.findall(plain)) - insults - learned)
    size = len(text)
    ascii_ = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    capitals = int(((ascii_ >= 65) & (ascii_ <= 90)).sum())
    return [insults / n, math.log1p(insults), learned / n, math.log1p(learned), total / n, max(weight.values(), default=0.0),
            you / n, near / n, capitals / size, sum(w.isupper() and len(w) > 2 for w in text.split()) / n,
            text.count("!") / size, text.count("?") / size, sum(text.count(c) for c in ".,;:!?*%&$#@") / size,
            len(MIXED.findall(low)) / n, len(STRETCHED.findall(low)) / n, len(SPELLED.findall(low)) / n, uncovered / n,
            math.log1p(n), sum(map(len, words)) / n]


def _documents(docs, id_col, text_col):
    rem = F.coalesce(F.crc32(F.col(id_col).cast("string")) % MODULUS, F.lit(-1))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), (rem == HELD_OUT).alias("held_out"),
                       text.alias("text"))


def _term_counts(rows: DataFrame, only: frozenset | None) -> DataFrame:
    """(term, n): in how many texts each term stands; partial counts leave the task in bounded portions."""

    def run(batches):
        seen: Counter = Counter()

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array(list(seen)), pa.array(list(seen.values()), pa.int64())], names=["term", "n"])
            seen.clear()
            return out

        for b in batches:
            for text in b.column(0).to_pylist():
                terms = terms_of(set(LETTERS.findall(text.lower())))
                seen.update(terms if only is None else terms & only)
                if len(seen) > 300_000:
                    yield flush()
        if seen:
            yield flush()

    return rows.select("text").mapInArrow(trimmed(run), "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))


def learn_lexicon(labelled: DataFrame, size: int = LEXICON) -> dict:
    """{term: log ratio of its rates in toxic and other texts}; each different text counts once.

    All terms in at least a 200th of the toxic texts (and in three) are ranked: at most 200 times
    as many as a toxic text has terms on average, however large the corpus. The best ``size`` stay.
    """
    first = labelled.groupBy("th").agg(F.min("doc_id").alias("doc_id"), F.max("toxic").alias("toxic"))
    first = cut(first)
    n_pos, n_neg = first.agg(F.sum(F.when(F.col("toxic") == 1, 1).otherwise(0)), F.sum(F.when(F.col("toxic") == 1, 0).otherwise(1))).first()
    if not n_pos or not n_neg:
        return {}
    rows = labelled.drop("toxic").join(broadcast_if_small(first, 1_000_000), ["th", "doc_id"])
    pos = _term_counts(rows.where("toxic = 1"), None).where(F.col("n") >= max(3, n_pos // 200))
    pos = {r.term: r.n for r in pos.collect()}
    neg = {r.term: r.n for r in _term_counts(rows.where("toxic <> 1"), frozenset(pos)).collect()}
    ratio = {t: (n / n_pos) / ((neg.get(t, 0) + 0.5) / n_neg) for t, n in pos.items()}
    best = sorted((t for t in pos if ratio[t] >= RATIO), key=lambda t: (-pos[t] * math.log(ratio[t]), t))
    return {t: math.log(ratio[t]) for t in best[:size]}


def features(rows: DataFrame, lexicon: dict) -> DataFrame:
    parts = by_length(lexicon)

    def run(batches):
        for batch in batches:
            for b in slices(batch):
                vecs = [features_of(t, lexicon, parts) for t in b.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("th"), b.column("held_out"), pa.array(vecs, pa.list_(pa.float64()))],
                                                 names=["doc_id", "th", "held_out", "features"])

    return rows.mapInArrow(trimmed(run), "doc_id long, th long, held_out boolean, features array<double>")


def toxicity(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", label_col="toxic", sample: int = SAMPLE, lexicon: int = LEXICON) -> DataFrame:
    """(doc_id, th, held_out, score, predicted) for every row; th is the hash of the text."""
    rows = _documents(docs, id_col, text_col)
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("toxic")).dropna()
    marks = cut(marks.groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    marks = broadcast_if_small(marks, 1_000_000)
    labelled = rows.where(~F.col("held_out")).join(marks, "doc_id")
    vecs = written(features(rows, learn_lexicon(labelled, lexicon)), "features")
    train = (vecs.where(~F.col("held_out")).join(marks, "doc_id").withColumn("h", F.xxhash64("doc_id", "th"))
             .orderBy("h", "doc_id").limit(sample))
    train = cut(train.select(array_to_vector("features").alias("x"), F.col("toxic").cast("double").alias("toxic"), (F.pmod("h", F.lit(4)) == 0).alias("later")))
    seen = {(r.later, r.toxic): r["count"] for r in train.groupBy("later", "toxic").count().collect()}
    n_pos, n = sum(v for (_, t), v in seen.items() if t == 1), sum(seen.values())
    if not all(seen.get((later, t)) for later in (True, False) for t in (0.0, 1.0)):
        out = vecs.withColumn("score", F.lit(n_pos / n if n else 0.0))
    else:
        gbt = GBTClassifier(featuresCol="x", labelCol="toxic", maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, minInstancesPerNode=5,
                            seed=7, checkpointInterval=-1)
        model = gbt.fit(train.where(~F.col("later")))
        scored = lambda df: model.transform(df).withColumn("p1", vector_to_array("probability")[1])
        iso = IsotonicRegression(featuresCol="p1", labelCol="toxic", predictionCol="iso").fit(scored(train.where("later")).select("p1", "toxic"))
        out = iso.transform(scored(vecs.withColumn("x", array_to_vector("features"))))
        # a trace of the uncalibrated score keeps the order within the steps of the calibration
        out = out.withColumn("score", F.greatest(F.lit(0.0), F.least(F.lit(1.0), 0.99 * F.col("iso") + 0.01 * F.col("p1"))))
    return out.select("doc_id", "th", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
