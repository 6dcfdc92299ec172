"""Skew-safe running sums over long per-key histories.

A plain ``sum() over (partition by key order by t)`` sends a whole key's
history to one task; one hot key (a third of all rows) then stalls the job.
``prefix_sum`` splits each key's history into time buckets, so every window
partition is one (key, bucket) and bounded by the bucket width:

1. per-(key, bucket) totals - a partial aggregate, combined map-side;
2. exclusive running total of the bucket totals per key - one row per bucket,
   so this window is small even for a hot key;
3. running sum inside each (key, bucket) plus that bucket's offset.

The result is exact (same order, same rows), only the summation is regrouped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def day_number(date_col) -> Column:
    c = F.col(date_col) if isinstance(date_col, str) else date_col
    return F.datediff(c, F.lit("1970-01-01").cast("date"))


def prefix_sum(df: DataFrame, keys, order_col: str, values: dict, bucket_days: int = 64,
               tiebreak=None) -> DataFrame:
    """Add inclusive running sums per ``keys`` ordered by the date ``order_col``.

    ``values`` maps output column -> input Column/expression. Rows are ordered
    by (order_col, *tiebreak); order_col must be a date.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    tiebreak = list(tiebreak or [])
    bucket = F.floor(day_number(order_col) / F.lit(bucket_days)).cast("long")
    tmp = {name: f"__ps_{i}" for i, name in enumerate(values)}
    base = df.select("*", bucket.alias("__ps_b"), *[F.coalesce(expr.cast("double"), F.lit(0.0)).alias(tmp[n])
                                                     for n, expr in values.items()])
    totals = base.groupBy(*keys, "__ps_b").agg(*[F.sum(t).alias(t) for t in tmp.values()])
    wk = Window.partitionBy(*keys).orderBy("__ps_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, "__ps_b", *[F.coalesce(F.sum(t).over(wk), F.lit(0.0)).alias(t + "_o")
                                               for t in tmp.values()])
    wb = (Window.partitionBy(*keys, "__ps_b").orderBy(order_col, *tiebreak)
          .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    joined = base.join(offsets, [*keys, "__ps_b"], "left")
    out = joined.select(*df.columns, *[(F.col(t + "_o") + F.sum(t).over(wb)).alias(n) for n, t in tmp.items()])
    return out
