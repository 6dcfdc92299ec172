"""The registered queries against their SQL, and the pipeline's stages on their own inputs."""

import duckdb
import pytest
from oracle_check import rows_of
from pyspark.sql import functions as F

import corpus_pipeline
from assetqueue.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.mark.parametrize("key", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, key):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    assert rows_of(QUERIES[key](spark, SF).toPandas()) == rows_of(con.execute(ORACLE_SQL[key]).df())


def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    seen = [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, seen[-1], SF).write.parquet(f"{tmp_path}/{i}")
        seen.append(spark.read.parquet(f"{tmp_path}/{i}"))
    for df in seen[1:-1]:
        assert df.columns == docs.columns
    start, toxic, lines, near, clean, packed = seen
    assert ids(start) >= ids(toxic) >= ids(lines) >= ids(near) >= ids(clean) == ids(packed)
    assert lines.where("n_chars <> char_length(text)").count() == 0
    groups = corpus_pipeline.near_dup.near_duplicates(lines, width=5, percent=80).collect()
    assert ids(near) == {r.doc_id for r in groups if r.kept}
    again = corpus_pipeline.decontamination.contamination(clean, spark.read.parquet(f"{SF}/benchmark.parquet"))
    assert again.where("contaminated").count() == 0
    whole = packed.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("t"))
    assert whole.where("n <> t").count() == 0
    rows = lambda df: sorted(map(tuple, df.select("doc_id", "start", "length", "ids_crc32").collect()))
    assert sum(r[2] for r in rows(corpus_pipeline.run(spark, SF))) == sum(r[2] for r in rows(packed))


def test_every_operator_has_a_query():
    assert {int(k[2:].split("_")[0]) for k in QUERIES if k.startswith("op")} == set(range(1, 14)) and "pipeline" in QUERIES
