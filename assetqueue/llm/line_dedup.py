"""Cross-site line removal by distinct-site spread.

Each line (trimmed, by 128 bits of hash) gets a HyperLogLog sketch of the sites
that carry it; sketches merge map-side and by aggregation. Lines whose estimate
lies within the sketch's error of the threshold get an exact distinct count.
Lines on at least ``min_sites`` sites are boilerplate: the first occurrence (by
id, then place) stays, all others go. A document that had text and loses all of
it goes too: its lines stand in earlier documents.

Cases: blank lines are never boilerplate and never removed. Null texts and
empty texts stay as they are. A null site is no site. Repeated rows (same id and
text) share one fate. Extra columns stay untouched, but for ones named n_lines or
n_removed, which give way to the result's; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

MIN_SITES, LG_K = 5, 12
ERROR = 3 * 1.04 / 2 ** (LG_K / 2)


def lines(docs: DataFrame, id_col, text_col, site_col) -> DataFrame:
    """(id, th, site, pos, h1, h2): one row per line that is not blank."""
    cols = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("th"), F.col(site_col).alias("site"),
                       F.posexplode(F.split(text_col, "\n")).alias("pos", "line"))
    line = F.trim("line")
    return cols.where(F.length(line) > 0).select("id", "th", "site", "pos", F.xxhash64(line).alias("h1"),
                                                 F.xxhash64(F.lit(1), line).alias("h2"))


def boilerplate(rows: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """(h1, h2, first): lines on at least ``min_sites`` sites and their first occurrence."""
    sketched = rows.groupBy("h1", "h2").agg(
        F.hll_sketch_agg(F.col("site").cast("string"), LG_K).alias("sk"), F.min(F.struct("id", "th", "pos")).alias("first"))
    est = sketched.select("h1", "h2", "first", F.hll_sketch_estimate("sk").alias("n"))
    far = est.where(F.col("n") > min_sites * (1 + ERROR)).select("h1", "h2", "first")
    near = est.where(F.col("n").between(min_sites * (1 - ERROR), min_sites * (1 + ERROR)))
    pairs = rows.join(near.select("h1", "h2"), ["h1", "h2"], "left_semi").select("h1", "h2", "site").distinct()
    exact = pairs.groupBy("h1", "h2").agg(F.count("site").alias("sites")).where(F.col("sites") >= min_sites)
    return far.union(near.join(exact, ["h1", "h2"]).select("h1", "h2", "first"))


def dedup_lines(docs: DataFrame, min_sites: int = MIN_SITES, id_col="doc_id", text_col="text", site_col="source",
                drop_emptied: bool = True) -> DataFrame:
    """``docs`` with cleaned texts, and n_lines, n_removed."""
    rows = lines(docs, id_col, text_col, site_col)
    marked = rows.join(boilerplate(rows, min_sites), ["h1", "h2"])
    gone = marked.where(~F.struct("id", "th", "pos").eqNullSafe(F.col("first"))).select(
        F.col("id").alias("__id"), F.col("th").alias("__th"), "pos").distinct()
    gone = gone.groupBy("__id", "__th").agg(F.collect_list("pos").alias("__gone"))
    out = docs.withColumn("__h", F.xxhash64(text_col))
    out = out.join(gone, F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__h") == F.col("__th")), "left")
    kept = F.filter(F.split(text_col, "\n"), lambda _, i: ~F.array_contains("__gone", i))
    text = F.when(F.col("__gone").isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n"))
    out = out.select(*[F.col(c) for c in docs.columns if c != text_col], text.alias("__text"),
                     F.coalesce(F.size(F.split(text_col, "\n")), F.lit(0)).cast("long").alias("__n_lines"),
                     F.coalesce(F.size("__gone"), F.lit(0)).cast("long").alias("__n_removed"))
    if drop_emptied:
        out = out.where((F.col("__n_removed") == 0) | (F.length(F.trim("__text")) > 0))
    own = [c for c in docs.columns if c.lower() not in ("n_lines", "n_removed")]
    return out.select(*[F.col("__text" if c == text_col else c).alias(c) for c in own],
                      F.col("__n_lines").alias("n_lines"), F.col("__n_removed").alias("n_removed"))
