"""Exact quantiles in two distributed passes.

``median`` / ``percentile`` keep every distinct value of a group in one buffer.
Here a sketch (``percentile_approx``) brackets each wanted rank, and one
aggregate then counts the rows below the bracket and the distinct values inside
it, combined map-side. The rank is found by a running count over the bracket,
about ``4 / accuracy`` of the group's rows, sorted (and spilled) by Spark.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F, types as T


def exact_quantiles(df: DataFrame, value: str, probs, keys=(), accuracy: int = 10_000) -> dict:
    """{key values: [quantile for each of ``probs``]}, linearly interpolated; nulls do not count.

    Groups (``keys``) are few: the columns of a model, the models of a report.
    """
    keys, probs, eps = list(keys), [float(p) for p in probs], 2.0 / accuracy
    base = df.select(*keys, F.lit(0).alias("__g"), F.col(value).cast("double").alias("__v")).where("__v is not null")
    around = sorted({min(1.0, max(0.0, p + e)) for p in probs for e in (-eps, eps)})
    sketched = base.groupBy(*keys, "__g").agg(F.count("*").alias("__n"), F.percentile_approx("__v", around, accuracy).alias("__q")).collect()
    wanted, sizes = [], {}
    for r in sketched:
        k, n, q = tuple(r[c] for c in keys), r["__n"], dict(zip(around, r["__q"]))
        sizes[k] = n
        for i, p in enumerate(probs):
            at = p * (n - 1)
            lo = q[max(0.0, p - eps)] if p - eps > 0 and n > accuracy else None
            hi = q[min(1.0, p + eps)] if p + eps < 1 and n > accuracy else None
            wanted.append((*k, 0, i, lo, hi, math.floor(at), math.ceil(at)))
    if not wanted:
        return {}
    long, double = T.LongType(), T.DoubleType()
    schema = T.StructType([f for c in keys for f in base.schema.fields if f.name == c]
                          + [T.StructField(n, t) for n, t in (("__g", T.IntegerType()), ("__i", T.IntegerType()), ("__lo", double),
                                                              ("__hi", double), ("__r1", long), ("__r2", long))])
    # one row per group and quantile: bounded by the arguments
    marks = F.broadcast(df.sparkSession.createDataFrame(wanted, schema).withColumnsRenamed({c: f"__k_{c}" for c in keys}))
    on = (base["__g"] == marks["__g"])
    for c in keys:
        on = on & base[c].eqNullSafe(marks[f"__k_{c}"])
    x = F.when(F.coalesce(F.col("__v") >= F.col("__lo"), F.lit(True)), F.col("__v"))  # null: below the bracket
    met = base.join(marks, on).where(F.coalesce(F.col("__v") <= F.col("__hi"), F.lit(True)))
    met = met.groupBy(*keys, "__i", "__r1", "__r2", x.alias("__x")).agg(F.count("*").alias("__c"))
    w = Window.partitionBy(*keys, "__i").orderBy(F.col("__x").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    met = met.withColumn("__cum", F.sum("__c").over(w))
    found = met.groupBy(*keys, "__i").agg(*[F.min(F.when(F.col("__cum") > F.col(f"__r{j}"), F.col("__x"))).alias(f"__x{j}") for j in (1, 2)])
    out = {k: [None] * len(probs) for k in sizes}
    for r in found.collect():
        k, p = tuple(r[c] for c in keys), probs[r["__i"]]
        at = p * (sizes[k] - 1)
        lo, hi = math.floor(at), math.ceil(at)
        a, b = r["__x1"], r["__x2"]
        out[k][r["__i"]] = a if lo == hi or a == b else (hi - at) * a + (at - lo) * b
    return out


def column_medians(df: DataFrame, cols) -> dict:
    """{column: exact median, or None without values} for several columns at once."""
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("v")) for c in cols])
    got = exact_quantiles(df.select(F.explode(pairs).alias("x")).select("x.*"), "v", [0.5], ["name"])
    return {c: got[(c,)][0] if (c,) in got else None for c in cols}
