"""Ids of shards: two bytes each, and none is cut silently."""

import numpy as np
import pyarrow as pa
import pytest

from assetqueue.llm import token_output as T


def test_two_bytes():
    ids = np.array([0, 7, 65_535], "<u4")
    assert np.frombuffer(T._two_bytes(ids.tobytes()), "<u2").tolist() == ids.tolist() and T._two_bytes(b"") == b""
    with pytest.raises(ValueError):
        T._two_bytes(np.array([70_000], "<u4").tobytes())


def test_new_words_are_learnt_in_one_call(monkeypatch):
    from assetqueue.llm.bpe import RankEncoder, default_path

    enc, calls = RankEncoder(default_path("byte_bpe_50k.tiktoken")), []
    words = ["alpha", "b2b", "don't", "naïve", "日本", "x,y", "7_000", "a" * 500, "\nline", "..."]
    want = {w: enc.whole(" " + w) for w in words if w[0] != "\n"}
    whole = enc.lib.encode_ordinary

    class Counted:
        def encode_ordinary(self, text):
            calls.append(text)
            return whole(text)

    enc.lib = Counted()
    enc.learn(words)
    assert len(calls) == 1 and {w: enc.later[w] for w in want if len(w) < 500} == {w: x for w, x in want.items() if len(w) < 500}
    assert len(calls) == 1 and "a" * 500 not in enc.later and "\nline" not in enc.later


def test_words_of_a_block_are_encoded_in_one_call():
    from assetqueue.llm.bpe import RankEncoder, default_path

    enc = RankEncoder(default_path("byte_bpe_50k.tiktoken"))
    texts = [None, "", "one two, one two.", "two\none,\n\n1. two!", "don't. don't", "é, é. x²; x²", "\n", "a ", " a", "tab\tone", "日本, 日本"] * 50
    want = [enc.whole(t or "") for t in texts]
    calls, whole = [], enc.whole
    enc.whole = lambda t: calls.append(t) or whole(t)
    assert enc.encode_many(pa.array(texts, pa.string())) == want and not {"one", "two", "two,"} & set(enc.later)
    assert len([t for t in calls if " one" in t]) == 1
    assert max(calls, key=len).count(" two") == 1
    assert enc.count_many(pa.array(texts, pa.string())).tolist() == [len(x) // 4 for x in want]
    assert enc.count_many(pa.array([], pa.string())).tolist() == []


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_counts_are_those_of_the_ids(name):
    from assetqueue.llm.bpe import Encoder, default_path

    enc, texts = Encoder(default_path(name)), pa.array([None, "", "a b.", "x  y", "12,\n.b", "<|endoftext|>", "Ünï, ünï!"])
    assert enc.count_many(texts).tolist() == [len(enc.whole(t or "")) // 4 for t in texts.to_pylist()]


def test_the_cache_of_words_is_bounded():
    """Rows of ever new words: the cache holds stems without their marks, and at most two generations of them."""
    from assetqueue.llm import bpe

    path = bpe.default_path("byte_bpe_50k.json")
    enc = bpe.encoder(path, 200)
    enc._reset()
    for block in range(20):
        texts = [" ".join(f"w{chr(97 + block)}{chr(97 + i)}{chr(97 + j)}{mark}" for mark in ("", ",", ".")) for i in range(10) for j in range(5)]
        assert enc.encode_many(pa.array(texts)) == [enc.whole(t) for t in texts]
        assert len(enc.later) <= 100 + 55 and len(enc.later.old) <= 100 + 55
    assert bpe.encoder(path) is enc and enc.cached == bpe.MAX_CACHED


def test_little_memory_gives_the_same_pieces(spark):
    from assetqueue.llm import packing

    docs = spark.createDataFrame([(i, f"{'some words, ' * (7 * i)}n{i}" if i % 9 else None) for i in range(300)], "doc_id long, text string")
    want = sorted(packing.pack(docs).collect())
    assert want and sorted(packing.pack(docs, cached=10, block_bytes=1000).collect()) == want
