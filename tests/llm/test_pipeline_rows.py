"""The pipeline's filters judge rows: null ids, repeated rows and ids with several texts."""

import random

from pyspark.sql import functions as F

import corpus_pipeline
from assetqueue.llm import line_dedup, near_dup

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)


def left(df):
    return sorted(((r.doc_id or -1, r.text) for r in df.collect()), key=str)


def words(seed, n=80):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(n))


def test_toxic_rows_go_whatever_their_id(spark, monkeypatch):
    judged = lambda d, _: d.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"),
                                   F.coalesce(F.col("text").contains("bad").cast("int"), F.lit(0)).alias("predicted"))
    monkeypatch.setattr(corpus_pipeline.toxicity, "toxicity", judged)
    rows = [(None, "bad"), (None, "good"), (None, None), (4, "bad"), (4, "good"), (4, "bad"), (5, "good"), (5, "good")]
    out = corpus_pipeline.drop_toxic(spark, docs(spark, rows), "/root/testdata/sf0.001")
    assert out.columns == docs(spark, rows).columns
    assert left(out) == sorted([(-1, "good"), (-1, None), (4, "good"), (5, "good"), (5, "good")], key=str)


def test_one_row_of_each_group_stays(spark):
    a, b, c, d = (words(k) for k in range(4))
    rows = [(None, a), (7, a), (7, a), (9, a + " more"), (7, b), (None, c), (None, c), (3, d), (3, d), (None, None), (None, None), (8, "")]
    out = corpus_pipeline.keep_one_copy(spark, docs(spark, rows), "")
    assert out.columns == docs(spark, rows).columns
    assert left(out) == sorted([(7, a), (7, b), (-1, c), (3, d), (-1, None), (-1, None), (8, "")], key=str)


def test_contaminated_rows_go_whatever_their_id(spark, tmp_path):
    item = words(9, 12)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(None, f"x {item} y"), (None, "clean"), (5, "clean"), (5, item), (6, "clean"), (6, "clean")]
    out = corpus_pipeline.drop_contaminated(spark, docs(spark, rows), str(tmp_path))
    assert left(out) == sorted([(-1, "clean"), (5, "clean"), (6, "clean"), (6, "clean")], key=str)


def test_every_text_of_an_id_has_rare_shingles(spark):
    a, b = sorted(words(k) for k in range(2))
    texts = spark.createDataFrame([(1, a), (1, b), (2, b + " more"), (3, a + " more")], "doc_id long, text string")
    rare = {r.id: set(r.rare) for r in near_dup._spelled(texts, 3, 85).collect()}
    assert rare[1] & rare[2] and rare[1] & rare[3]


def test_stages_keep_columns_that_bear_their_names(spark, monkeypatch):
    judged = lambda d, _: d.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"),
                                   F.col("text").contains("bad").cast("int").alias("predicted"))
    monkeypatch.setattr(corpus_pipeline.toxicity, "toxicity", judged)
    rows = [(i, f"own {i}\nshared line", "en", f"s{i}", 0, i, -i, "t") for i in range(6)] + [(9, "bad", "en", "s", 3, 1, 1, "t")]
    named = spark.createDataFrame(rows, DOCS + ", n_lines long, N_REMOVED long, th string")
    kept = corpus_pipeline.drop_toxic(spark, named, "/root/testdata/sf0.001")
    assert kept.columns == named.columns and kept.where("th = 't'").count() == 6
    out = corpus_pipeline.drop_boilerplate_lines(spark, kept, "")
    assert out.columns == named.columns
    got = {r.doc_id: (r.text, r.n_chars, r.n_lines, r.N_REMOVED) for r in out.collect()}
    assert got == {i: (f"own {i}", 5, i, -i) if i else ("own 0\nshared line", 0, 0, 0) for i in range(6)}


def test_line_counts_replace_columns_of_their_names(spark):
    named = spark.createDataFrame([(i, "a\nb", f"s{i}", "x") for i in range(5)], "doc_id long, text string, source string, n_removed string")
    got = {(r.doc_id, r.n_lines, r.n_removed) for r in line_dedup.dedup_lines(named, drop_emptied=False).collect()}
    assert got == {(0, 2, 0)} | {(i, 2, 2) for i in range(1, 5)}


def test_what_goes_is_computed_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = docs(spark, [(i, f"text {i}") for i in range(10)] + [(None, "text")])
    gone = rows.where("doc_id < 4 or doc_id is null").select("doc_id").mapInArrow(counted, "doc_id long")
    assert left(corpus_pipeline._without(rows, gone, ["doc_id"])) == left(rows.where("doc_id >= 4"))
    assert seen.value == 5
