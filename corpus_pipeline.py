"""A training-corpus pipeline over ``documents``: five stages, each on what its predecessor kept.

All stages but the last return the columns of ``documents``; the last returns
the pieces of the packed sequences.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from assetqueue.llm import decontamination, line_dedup, near_dup, packing, toxicity
from assetqueue.llm.common import broadcast_if_small, cut, shared_dir, table, written

#: the stages' decisions are learned or iterative (boosted trees, subset sums over token ids)
ORACLE_SQL = None
MAX_BROADCAST = 1_000_000


def _without(docs: DataFrame, gone: DataFrame, keys: list) -> DataFrame:
    """Rows of ``docs`` whose keys are not in ``gone``, which is computed once; null is a key like any other."""
    gone = written(gone.select(*[F.col(k).alias(f"__gone_{k}") for k in keys]).distinct(), "gone")
    same = [F.col(k).eqNullSafe(F.col(f"__gone_{k}")) for k in keys]
    return docs.join(broadcast_if_small(gone, MAX_BROADCAST), same, "left_anti")


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with a number for each row, written so that it stays: ids may be null or repeated."""
    return written(docs.withColumn("__row", F.monotonically_increasing_id()), "numbered")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model predicts toxic go; rows of one id and text have one score."""
    gone = toxicity.toxicity(docs, table(spark, sf_dir, "labels")).where("predicted = 1")
    gone = gone.select("doc_id", F.col("th").alias("__th"))
    return _without(docs.withColumn("__th", F.xxhash64(F.coalesce("text", F.lit("")))), gone, ["doc_id", "__th"]).drop("__th")


def drop_boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines on many sites go but for their first occurrence; n_chars follows the text."""
    held = {c: f"__held_{c}" for c in docs.columns if c.lower() in ("n_lines", "n_removed")}
    out = line_dedup.dedup_lines(docs.withColumnsRenamed(held))
    n_chars = F.when(F.col("n_removed") > 0, F.char_length("text")).otherwise(F.col("n_chars"))
    out = out.withColumn("n_chars", n_chars.cast(docs.schema["n_chars"].dataType))
    return out.select(*[F.col(held.get(c, c)).alias(c) for c in docs.columns])


def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates stays, that of the smallest id: five-word shingles, similarity of 0.8 or more."""
    rows = _numbered(docs)
    found = near_dup.near_duplicates(rows, id_col="__row", width=5, percent=80)
    ids = rows.select("__row", F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__row").alias("at"))
    found = cut(found.select(F.col("doc_id").alias("__row"), "component_id").join(ids, "__row"))
    first = found.groupBy("component_id").agg(F.min("at").alias("at")).select("at.__row")
    return _without(rows, found.join(first, "__row", "left_anti"), ["__row"]).drop("__row")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of the benchmark go."""
    rows = _numbered(docs)
    found = decontamination.contamination(rows, table(spark, sf_dir, "benchmark"), id_col="__row")
    return _without(rows, found.where("contaminated").select(F.col("doc_id").alias("__row")), ["__row"]).drop("__row")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, packed into sequences; little is held at once, as the executors still hold memory of the stages before."""
    return packing.pack(docs, cached=100_000, block_bytes=1 << 21)


STAGES = [("toxicity", drop_toxic), ("line dedup", drop_boilerplate_lines), ("near-duplicates", keep_one_copy),
          ("benchmark decontamination", drop_contaminated), ("packing", pack_sequences)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn; each result is written to the shared folder and read again."""
    docs, base = table(spark, sf_dir, "documents"), f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{i}")
        docs = spark.read.parquet(f"{base}/{i}")
    return STAGES[-1][1](spark, docs, sf_dir)
