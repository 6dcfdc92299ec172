"""The registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from assetqueue.llm import (conversation_repair, decontamination, line_dedup, lm_scoring, near_dup, packing, phrase_mining, quality,
                            token_counts, token_output, topk, toxicity, url_filter)
from assetqueue.llm.common import table, written
from assetqueue.llm.sql import ORACLE_SQL  # noqa: F401


def op1_decontamination(spark, sf_dir):
    out = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    joined = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return out.select("doc_id", "n_words", "n_hit", "n_items", joined.alias("items_sha256"), "contaminated")


def op2_topk(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op3_near_dup(spark, sf_dir):
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85)


def op4_url_filter(spark, sf_dir):
    return url_filter.filter_urls(table(spark, sf_dir, "pages"))


def op5_token_counts(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op6_toxicity(spark, sf_dir):
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("th")


def op7_token_output(spark, sf_dir):
    return token_output.materialise(table(spark, sf_dir, "documents"), token_output.shard_dir(spark)).drop("path")


def op8_lm_scoring(spark, sf_dir):
    return lm_scoring.score(table(spark, sf_dir, "documents"))


def op9_line_dedup(spark, sf_dir):
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents"), drop_emptied=False)
    text = F.coalesce("text", F.lit(""))
    return out.select("doc_id", "n_lines", "n_removed", F.char_length(text).cast("long").alias("n_chars_left"),
                      F.sha2(text.cast("binary"), 256).alias("text_sha256"))


def op10_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


def op11_quality(spark, sf_dir):
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_conversation_repair(spark, sf_dir):
    turns = conversation_repair.damage(table(spark, sf_dir, "conversations"))
    found = written(conversation_repair.audits(turns), "audits")
    digests = conversation_repair.repaired_digests(turns, found).withColumnRenamed("conv_id", "id")
    out = found.join(digests, F.col("conv_id").eqNullSafe(F.col("id")))
    return out.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def op13_phrase_mining(spark, sf_dir):
    return phrase_mining.collocations(table(spark, sf_dir, "documents"))


def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_decontamination, op2_topk, op3_near_dup, op4_url_filter, op5_token_counts, op6_toxicity,
                                   op7_token_output, op8_lm_scoring, op9_line_dedup, op10_packing, op11_quality,
                                   op12_conversation_repair, op13_phrase_mining, pipeline)}
