"""Training-order materialisation of token ids as fixed-stride binary shards.

Documents become token ids and an end id, cut into sequences of ``stride`` ids
(the last of a document padded). A keyed Feistel network over the next even
power of two, walked until it falls inside [0, n), is a permutation of the n
sequences: it gives each a global slot without sorting or a stored order.
Sequences are range-partitioned by slot; a task writes one shard, whose record
i lies at byte i * stride * width, so any slot is found by arithmetic and
reading resumes anywhere.

The first pass only counts the sequences of each input partition; the second
numbers them alike and places them. Shards are written under a temporary name
and renamed, so a task that runs again replaces its own file.

Cases: null and empty texts are the end id alone. Repeated rows are sequences
each for itself. An empty table has no shards and an empty result. Extra columns
are ignored.
"""

from __future__ import annotations

import os
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from assetqueue.llm.bpe import default_path, encoder, text_slices
from assetqueue.llm.common import shared_dir

STRIDE, SHARD_RECORDS, KEY, ROUNDS, END_ID, PAD_ID = 256, 1 << 15, 0x5EED, 6, 0, 0
BLOCK_BYTES = 1 << 23  # of text encoded at once: words of a block are encoded once each


def _round(x: np.ndarray, key: int, r: int) -> np.ndarray:
    x = (x ^ np.uint64((key * 0x9E3779B97F4A7C15 + r * 0xD1B54A32D192ED03) % (1 << 64))) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def slots(index: np.ndarray, n: int, key: int = KEY, inverse: bool = False) -> np.ndarray:
    """Slot of each sequence number in [0, n), or with ``inverse`` the number in each slot."""
    half = max(1, ((n - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    out = index.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):  # cycle-walking: again from where it left the range
        x = out[todo]
        left, right = x >> np.uint64(half), x & mask
        for r in reversed(range(ROUNDS)) if inverse else range(ROUNDS):
            if inverse:
                left, right = right ^ (_round(left, key, r) & mask), left
            else:
                left, right = right, left ^ (_round(right, key, r) & mask)
        out[todo] = (left << np.uint64(half)) | right
        todo = todo[out[todo] >= np.uint64(n)]
    return out.astype(np.int64)


def _sequences(blob, stride):
    """Records of two-byte ids: those of a document (four bytes each) and the end id."""
    blob = _two_bytes(blob + END_ID.to_bytes(4, "little"))
    return [blob[at: at + 2 * stride] for at in range(0, len(blob), 2 * stride)]


def _two_bytes(blob: bytes) -> bytes:
    """Four-byte ids as two-byte ones; a record has no room for larger ids."""
    ids = np.frombuffer(blob, "<u4")
    if len(ids) and ids.max() > 0xFFFF:
        raise ValueError(f"id {ids.max()} does not fit the two bytes of a record: this tokenizer's vocabulary is too large")
    return ids.astype("<u2").tobytes()


def _filesystem(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if ":" in path else (fs.LocalFileSystem(), path)


def read_records(path: str, first: int, count: int, stride: int = STRIDE) -> np.ndarray:
    """``count`` records of a shard from record ``first`` on, as rows of ids."""
    system, at = _filesystem(path)
    with system.open_input_file(at) as f:
        data = f.read_at(count * stride * 2, first * stride * 2)
    return np.frombuffer(data, "<u2").reshape(-1, stride)


def materialise(docs: DataFrame, out_dir: str, id_col="doc_id", text_col="text", tokenizer: str | None = None,
                stride: int = STRIDE, shard_records: int = SHARD_RECORDS, key: int = KEY) -> DataFrame:
    """Write the shards; one row per sequence: doc_id, start, n_ids, slot, shard, record, ids_crc32, path."""
    path = tokenizer or default_path("byte_bpe_50k.tiktoken")
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def count(batches):
        enc, n = encoder(path), 0
        for batch in batches:
            for b in text_slices(batch, max_bytes=BLOCK_BYTES):
                n += int((enc.count_many(b.column("text")) // stride + 1).sum())
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([n], pa.int64())], names=["part", "n"])

    counts = dict(docs.mapInArrow(count, "part long, n long").groupBy("part").agg(F.sum("n")).collect())
    bases, n = {}, 0
    for part in sorted(counts):
        bases[part] = n
        n += counts[part]

    def place(batches):
        enc, at = encoder(path), bases.get(TaskContext.get().partitionId(), 0)
        end = at + counts.get(TaskContext.get().partitionId(), 0)
        for batch in batches:
            for b in text_slices(batch, max_bytes=BLOCK_BYTES):
                doc, start, total, ids = [], [], [], []
                for d, blob in zip(b.column("doc_id").to_pylist(), enc.encode_many(b.column("text"))):
                    for i, s in enumerate(_sequences(blob, stride)):
                        doc.append(d)
                        start.append(i * stride)
                        total.append(len(s) // 2)
                        ids.append(s)
                slot = slots(np.arange(at, at + len(doc)), n, key)
                at += len(doc)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(slot), pa.array(doc, pa.int64()), pa.array(start, pa.int64()), pa.array(total, pa.int64()), pa.array(ids, pa.binary())],
                    names=["slot", "doc_id", "start", "n_ids", "ids"])
        if at != end:
            raise RuntimeError("the second pass found other rows in this partition than the first")

    def write(key_, t):
        shard = key_[0].as_py()
        t = t.sort_by("slot")
        pad = PAD_ID.to_bytes(2, "little")
        ids = t.column("ids").to_pylist()
        system, at = _filesystem(f"{out_dir}/shard-{shard:08d}.bin")
        system.create_dir(os.path.dirname(at), recursive=True)
        temp = f"{at}.{uuid.uuid4().hex}.tmp"
        with system.open_output_stream(temp) as f:
            for x in ids:
                f.write(x + pad * (stride - len(x) // 2))
        system.move(temp, at)
        # the digests come from the file as it stands
        with system.open_input_file(at) as f:
            crc = [zlib.crc32(f.read(2 * stride)[: len(x)]) for x in ids]
        n_rows = t.num_rows
        return pa.table([t.column("doc_id"), t.column("start"), t.column("n_ids"), t.column("slot"), pa.array([shard] * n_rows, pa.int64()),
                         pa.array(range(n_rows), pa.int64()), pa.array(crc, pa.int64()), pa.array([f"{out_dir}/shard-{shard:08d}.bin"] * n_rows)],
                        names=["doc_id", "start", "n_ids", "slot", "shard", "record", "ids_crc32", "path"])

    placed = docs.mapInArrow(place, "slot long, doc_id long, start long, n_ids long, ids binary")
    placed = placed.withColumn("shard", F.expr(f"slot div {shard_records}"))
    return placed.groupBy("shard").applyInArrow(
        write, "doc_id long, start long, n_ids long, slot long, shard long, record long, ids_crc32 long, path string")


def shard_dir(spark) -> str:
    return f"{shared_dir(spark)}/shards-{uuid.uuid4().hex}"
