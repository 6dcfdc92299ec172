"""Benchmark decontamination over a distributed positional inverted index.

The index holds one posting (document row, term, position) for each training
token whose term occurs in the test items, and one posting of the end term, -1,
that gives each document's length. A query starts from the rarest term of each
window: its postings, shifted by the term's place in the item, name diagonals
(document row, item, shift). Postings of the other terms, shifted alike, are
intersected with these, and windows whose places are all met are exact phrases.
``proximity_matches`` allows each term to be up to ``slop`` words off its place.

DataFrame functions only. Cases: null, empty and word-free texts have no words
and no hits; items without words have no windows, shorter items are one window.
Items that share an id count once. Each row of ``docs`` is judged for itself
(repeated rows, equal or null ids). Extra columns are ignored. Without items
nothing is hit; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from assetqueue.llm.common import ascii_lower, broadcast_if_small, written

WINDOW, BLOCK, MAX_BROADCAST, TASK_POSTINGS = 10, 1 << 14, 1_000_000, 1_000_000
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
END_TERM, VOCAB_PARTS = -1, 64


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text.cast("string"), F.lit(""))), NOT_WORD), "")


def items_of(benchmark: DataFrame, id_col="item_id", text_col="text") -> DataFrame:
    """(iid, item_id, words): one row per item row with words; iid is its own number."""
    rows = benchmark.select(F.col(id_col).cast("string").alias("item_id"), words(F.col(text_col)).alias("words"))
    return written(rows.where(F.size("words") > 0).select(F.monotonically_increasing_id().alias("iid"), "*"), "items")


def vocabulary(items: DataFrame) -> DataFrame:
    """(word, term): the test terms, numbered; the empty word is the end of a document."""
    terms = items.select(F.explode("words").alias("word")).distinct()
    n = F.monotonically_increasing_id()  # partition number above 33 bits of row number: made small
    dense = n.bitwiseAND(F.lit((1 << 33) - 1)) * VOCAB_PARTS + F.shiftright(n, 33)
    numbered = terms.coalesce(VOCAB_PARTS).select("word", dense.alias("term"))
    end = items.sparkSession.createDataFrame([("", END_TERM)], "word string, term long")
    return written(numbered.union(end), "terms")


def build_index(docs: DataFrame, vocab: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """Postings (row, doc_id, pos, term); only the end posting carries doc_id."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"),
                       F.concat(words(F.col(text_col)), F.array(F.lit(""))).alias("words"))
    tokens = rows.select("row", "doc_id", F.posexplode("words").alias("pos", "word"))
    posted = tokens.join(broadcast_if_small(vocab, MAX_BROADCAST), "word")
    return written(posted.select("row", F.when(F.col("term") == END_TERM, F.col("doc_id")).alias("doc_id"), "pos", "term"),
                   "postings")


def numbered_items(items: DataFrame, vocab: DataFrame, index: DataFrame, window: int) -> DataFrame:
    """(iid, item_id, terms, anchors): terms in order, and the places of the rarest term of every window."""
    freq = vocab.join(index.groupBy("term").count(), "term", "left").select("word", "term", F.coalesce("count", F.lit(0)).alias("n"))
    placed = items.select("iid", "item_id", F.posexplode("words").alias("q", "word")).join(freq, "word")
    rows = placed.groupBy("iid", "item_id").agg(F.array_sort(F.collect_list(F.struct("q", "term", "n"))).alias("t"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("t") - window, F.lit(0)))
    rare = F.transform(starts, lambda s: F.array_min(F.transform(F.slice("t", s + 1, window), lambda x: F.struct(x["n"], x["q"])))["q"])
    return rows.select("iid", "item_id", F.transform("t", lambda x: x["term"]).alias("terms"), F.array_distinct(rare).alias("anchors"))


def _code(pos: Column, term: Column) -> Column:
    return F.shiftleft(pos.cast("long"), 32).bitwiseOR(term)


def diagonals(index: DataFrame, items: DataFrame) -> DataFrame:
    """(row, iid, shift) where a rarest term stands at its place."""
    anchors = items.select("iid", F.explode("anchors").alias("q"), "terms")
    anchors = anchors.select("iid", "q", F.get("terms", F.col("q")).alias("term"))
    met = index.select("row", "pos", "term").join(broadcast_if_small(anchors, MAX_BROADCAST), "term")
    return met.select("row", "iid", (F.col("pos") - F.col("q")).alias("shift")).distinct()


def posting_lists(index: DataFrame, rows: DataFrame) -> DataFrame:
    """(row, block, codes): the postings of ``rows``, by blocks of positions.

    Dealt out before they are put together, some ``TASK_POSTINGS`` a task: a file of the index holds
    many times that, and gathering sorts all postings of a task in memory.
    """
    block = F.floor(F.col("pos") / BLOCK).cast("long")
    parts = max(index.count() // TASK_POSTINGS + 1, int(index.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    codes = (index.where(F.col("term") != END_TERM).join(rows, "row", "left_semi")
             .select("row", block.alias("block"), _code(F.col("pos"), F.col("term")).alias("code")))
    return codes.repartition(parts, "row", "block").groupBy("row", "block").agg(F.collect_list("code").alias("codes"))


def phrase_hits(index: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(row, iid, item_id, places): document positions inside an occurring window, by diagonal."""
    diag = written(diagonals(index, items), "diagonals")
    rows = broadcast_if_small(diag.select("row").distinct(), MAX_BROADCAST)
    lists = posting_lists(index, rows)
    wanted = diag.join(broadcast_if_small(items.select("iid", "terms"), 100_000), "iid")
    last = F.col("shift") + F.size("terms") - 1
    wanted = wanted.where(last >= 0).select("*", F.explode(F.sequence(
        F.floor(F.greatest("shift", F.lit(0)) / BLOCK).cast("long"), F.floor(last / BLOCK).cast("long"))).alias("block"))
    places = F.transform("terms", lambda t, q: F.when(F.col("shift") + q >= 0, _code(F.col("shift") + q, t)).otherwise(F.lit(-1).cast("long")))
    met = wanted.join(lists, ["row", "block"]).select("row", "iid", "shift", F.array_intersect(places, "codes").alias("met"))
    met = met.groupBy("row", "iid", "shift").agg(F.flatten(F.collect_list("met")).alias("met"))
    # 1 at each place of the item that the document meets; a window occurs where all its places are met
    met = met.join(broadcast_if_small(items.select("iid", "item_id", "terms"), 100_000), "iid")
    mask = F.array_join(F.transform(places, lambda c: F.when(F.array_contains("met", c), "1").otherwise("0")), "")
    met = met.select("row", "item_id", "shift", F.size("terms").alias("len"), mask.alias("mask"))
    width = F.least(F.lit(window), F.col("len"))
    found = F.filter(F.sequence(F.lit(0), F.col("len") - width),
                     lambda s: F.substring(F.col("mask"), s + 1, width) == F.repeat(F.lit("1"), width))
    spans = F.transform(found, lambda s: F.sequence(F.col("shift") + s, F.col("shift") + s + width - 1))
    hit = met.where(F.contains("mask", F.repeat(F.lit("1"), width)))
    return hit.select("row", "item_id", F.array_distinct(F.flatten(spans)).alias("places")).where(F.size("places") > 0)


def proximity_matches(index: DataFrame, items: DataFrame, window: int, slop: int) -> DataFrame:
    """(row, iid, shift, q): windows at item place q all of whose terms stand within ``slop`` of their places."""
    diag = diagonals(index, items)
    want = diag.join(items.select("iid", F.posexplode("terms").alias("q", "term")), "iid")
    near = want.select("*", F.explode(F.sequence(F.col("shift") + F.col("q") - slop, F.col("shift") + F.col("q") + slop)).alias("pos"))
    met = near.join(index.select("row", "pos", "term"), ["row", "pos", "term"], "left_semi").select("row", "iid", "shift", "q").distinct()
    size = items.select("iid", F.size("terms").alias("len"))
    width = F.least(F.lit(window), F.col("len"))
    first = F.greatest(F.col("q") - width + 1, F.lit(0))
    starts = (met.join(size, "iid").where(first <= F.least(F.col("q"), F.col("len") - width))
              .select("row", "iid", "shift", width.alias("w"), F.explode(F.sequence(first, F.least(F.col("q"), F.col("len") - width))).alias("s")))
    return starts.groupBy("row", "iid", "shift", "s").agg(F.count("*").alias("n"), F.max("w").alias("w")).where("n = w").select(
        "row", "iid", "shift", F.col("s").alias("q"))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col="doc_id", text_col="text",
                  item_col="item_id", item_text="text") -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items, contaminated) for every row of ``docs``."""
    items = items_of(benchmark, item_col, item_text)
    vocab = vocabulary(items)
    index = build_index(docs, vocab, id_col, text_col)
    numbered = written(numbered_items(items, vocab, index, window), "anchors")
    hits = phrase_hits(index, numbered, window).groupBy("row").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("places")))).cast("long").alias("n_hit"),
        F.array_sort(F.collect_set("item_id")).alias("items"))
    ends = index.where(F.col("term") == END_TERM).select("row", "doc_id", F.col("pos").cast("long").alias("n_words"))
    none = F.array().cast("array<string>")
    return (ends.join(hits, "row", "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                    F.size(F.coalesce("items", none)).cast("long").alias("n_items"), F.coalesce("items", none).alias("items"),
                    (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated")))
