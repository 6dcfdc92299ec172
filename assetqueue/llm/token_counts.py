"""Token counts with overlap resynchronisation for huge texts.

Texts up to ``chunk`` bytes are encoded whole. Longer ones are encoded as
overlapping chunks with offsets; two neighbours are spliced at a boundary that
both have in the overlap and that is proven stable: a space between two
non-spaces, where no piece of the vocabulary can reach across (checked on
loading: no piece has a space mark after another character). Where the overlap
has no such boundary it is widened, up to the rest of the text.

Cases: null and empty texts have 0 bytes and 0 tokens. Every row is counted for
itself (repeated rows, ids null or equal). Extra columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from assetqueue.llm.bpe import default_path, slices

CHUNK, OVERLAP, LIMIT = 1 << 16, 1 << 10, 4096
MARK = "▁"
_STABLE = re.compile(rb"(?<=[!-~]) (?=[!-~])")


class PieceCounter:
    def __init__(self, path: str):
        import sentencepiece

        self.lib = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = (self.lib.id_to_piece(i) for i in range(self.lib.get_piece_size()))
        self.proven = not any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces)

    def _begins(self, data: bytes, lo: int, hi: int) -> list:
        """Where the tokens of data[lo:hi] begin, as offsets in data."""
        return [lo + p.begin for p in self.lib.encode(data[lo:hi].decode(), return_type="proto").pieces]

    def count(self, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
        data = text.encode()
        if len(data) <= chunk or not self.proven:
            return len(self.lib.encode(text))

        def at_char(i):
            while i < len(data) and data[i] & 0xC0 == 0x80:
                i += 1
            return min(i, len(data))

        total, lo, skip, wide = 0, 0, 0, overlap
        while True:
            nxt = at_char(lo + chunk)
            hi = at_char(nxt + wide)
            begins = self._begins(data, lo, hi)
            if hi >= len(data):
                return total + sum(b >= skip for b in begins)
            ahead = at_char(hi + overlap)
            right, left = set(self._begins(data, nxt, ahead)), set(begins)
            splice = next((m.start() for m in _STABLE.finditer(data, nxt + 1, hi) if m.start() in left and m.start() in right), None)
            if splice is None:
                wide *= 2  # no common boundary: both neighbours are encoded further
                continue
            total += sum(skip <= b < splice for b in begins)
            lo, skip, wide = nxt, splice, overlap

    def counts(self, texts: list, chunk: int = CHUNK) -> list:
        short = iter(self.lib.encode([t for t in texts if len(t) <= chunk // 4], num_threads=1))
        return [len(next(short)) if len(t) <= chunk // 4 else self.count(t, chunk) for t in texts]


_counters: dict = {}


def token_counts(docs: DataFrame, id_col="doc_id", text_col="text", model: str | None = None,
                 limit: int = LIMIT, chunk: int = CHUNK) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row."""
    path = model or default_path("piece_bpe_32k.model")

    def run(batches):
        if path not in _counters:
            _counters[path] = PieceCounter(path)
        for batch in batches:
            for b in slices(batch, 64):
                texts = [t or "" for t in b.column(1).to_pylist()]
                n = pa.array(_counters[path].counts(texts, chunk), pa.int64())
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), n], names=["doc_id", "n_bytes", "n_tokens"])

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"),
                       F.octet_length(text).cast("long").alias("n_bytes"))
    return (rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
            .withColumn("over_limit", F.col("n_tokens") > limit))
