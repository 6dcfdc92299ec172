"""Packing by minimum bin slack.

Documents become token ids plus an end id; each gives full windows and one
remaining tail. Within a bucket of documents, every window takes the longest
remaining tail, and a subset-sum over a bitset (one bit per reachable total)
finds the multiset of remaining lengths that comes closest to the capacity;
backtracking gives the count of each length, and the pattern repeats while the
counts last. Where the best total leaves more than ``max_slack`` free, one tail
is cut to fill the window.

Cases: null and empty texts are the end id alone. Equal documents, repeated
rows and rows with the same id are packed each for itself. Buckets hold about
``BUCKET_DOCS`` rows by a hash of id and text, a tail of at most a window each.
An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from assetqueue.llm.bpe import MAX_CACHED, default_path, encoder, text_slices
from assetqueue.llm.common import trimmed

WINDOW, END_ID, MAX_SLACK, BUCKET_DOCS = 1024, 0, 8, 4000

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
_CUT = "bucket long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary"


def best_fill(counts: dict, capacity: int) -> dict:
    """{length: how many} with the largest total <= capacity; bitset subset-sum, then backtracking."""
    mask, reach, steps = (1 << (capacity + 1)) - 1, 1, []
    for length in sorted((x for x in counts if x <= capacity), reverse=True):
        left, take = min(counts[length], capacity // length), 1
        while left > 0:
            take = min(take, left)
            new = (reach | (reach << (length * take))) & mask
            if new != reach:
                steps.append((length, take, reach))
                reach = new
            left -= take
            take *= 2
        if reach >> capacity & 1:
            break
    total, chosen = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            total -= length * take
            chosen[length] = chosen.get(length, 0) + take
    return chosen


def plan(tails: list, window: int = WINDOW, max_slack: int = MAX_SLACK) -> list:
    """Windows as lists of (row, start, length) from tails (row, start, length)."""
    by_len: dict = {}
    for row, start, length in tails:
        by_len.setdefault(length, []).append((row, start, length))
    out = []

    def pop(length):
        x = by_len[length].pop()
        if not by_len[length]:
            del by_len[length]
        return x

    while by_len:
        longest = max(by_len)
        counts = {k: len(v) - (k == longest) for k, v in by_len.items()}
        counts = {k: v for k, v in counts.items() if v}
        need = best_fill(counts, window - longest)
        need[longest] = need.get(longest, 0) + 1
        slack = window - sum(k * v for k, v in need.items())
        times = min(len(by_len[k]) // v for k, v in need.items()) if slack <= max_slack else 1
        for _ in range(times):
            out.append([pop(k) for k, v in need.items() for _ in range(v)])
        if slack > max_slack:
            over = [k for k in by_len if k > slack]
            if over:
                row, start, length = pop(min(over))
                out[-1].append((row, start, slack))
                by_len.setdefault(length - slack, []).append((row, start + slack, length - slack))
    return out


def pack(docs: DataFrame, id_col="doc_id", text_col="text", tokenizer: str | None = None,
         window: int = WINDOW, end_id: int = END_ID, max_slack: int = MAX_SLACK,
         cached: int = MAX_CACHED, block_bytes: int = 1 << 22) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A worker keeps the ids of ``cached`` words and encodes ``block_bytes`` of text at once: less of both takes less memory and more time.
    """
    path = tokenizer or default_path("byte_bpe_50k.json")
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    buckets = docs.select("doc_id").count() // BUCKET_DOCS + 1
    end = end_id.to_bytes(4, "little")

    def cut_up(batches):
        enc = encoder(path, cached)
        for batch in batches:
            for b in text_slices(batch, max_bytes=block_bytes):
                rows: list = [[] for _ in range(7)]
                buckets_, ids_ = (b.column(n).to_pylist() for n in ("bucket", "doc_id"))
                for bucket, doc, blob in zip(buckets_, ids_, enc.encode_many(b.column("text"))):
                    blob += end
                    n = len(blob) // 4
                    for at in range(0, n, window):
                        part = blob[4 * at: 4 * (at + window)]
                        m = len(part) // 4
                        for col, v in zip(rows, (bucket, doc, at, m, zlib.crc32(part), n, part if m < window else None)):
                            col.append(v)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in rows[:6]] + [pa.array(rows[6], pa.binary())],
                    names=["bucket", "doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"])
            batch = b = None  # not held while the next one is read

    def place(t):
        # an order by content: a task that runs again numbers its sequences alike
        t = t.sort_by([(c, "ascending") for c in ("doc_id", "start", "length", "ids_crc32")])
        bucket = t.column("bucket")[0].as_py()
        doc, start, length, crc, total, ids = (t.column(c).to_pylist() for c in
                                               ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"))
        base, seq, rows = bucket << 40, 0, [[] for _ in range(7)]

        def add(*values):
            for col, v in zip(rows, values):
                col.append(v)

        for i in range(len(doc)):
            if ids[i] is None:
                add(doc[i], start[i], length[i], crc[i], total[i], base + seq, 0)
                seq += 1
        for one in plan([(i, 0, length[i]) for i in range(len(doc)) if ids[i] is not None], window, max_slack):
            at = 0
            for i, s, n in one:
                c = crc[i] if n == length[i] else zlib.crc32(ids[i][4 * s: 4 * (s + n)])
                add(doc[i], start[i] + s, n, c, total[i], base + seq, at)
                at += n
            seq += 1
        return pa.table([pa.array(c, pa.int64()) for c in rows],
                        names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    # the bucket column keeps rows without an id apart by their text
    keyed = docs.select("doc_id", "text", F.pmod(F.xxhash64("doc_id", "text"), F.lit(buckets)).alias("bucket"))
    return keyed.mapInArrow(trimmed(cut_up), _CUT).groupBy("bucket").applyInArrow(place, PIECES)
