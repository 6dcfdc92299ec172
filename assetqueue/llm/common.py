"""Shared helpers: checkpoints, scratch tables, ASCII words and their hashes."""

from __future__ import annotations

import ctypes
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only where none is set (tests)."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="llm-ckpt-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Checkpoint in the shared folder: lineage ends, the files survive executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a scratch table into the shared folder and read it back (columnar, compressed)."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast hint only after counting the rows; beyond the bound Spark joins by shuffle."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def trimmed(run):
    """``run`` of ``mapInArrow``; at the end of a partition the worker, which idles on into the next stages, returns its free memory."""

    def then_trim(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
        if trim is not None:
            trim(0)

    return then_trim


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z and nothing else; pure-ASCII texts take the fast built-in."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


# ---- numpy side: words of a byte buffer and 64-bit hashes of them ------------------------------------

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_R = np.uint64(0x9E3779B97F4A7C15)
_RINV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict = {}


def _power_tables(n: int):
    if len(_powers.get("r", ())) < n:
        m = max(n, 1 << 16)
        for key, base in (("r", _R), ("i", _RINV)):
            p = np.full(m, base, dtype=np.uint64)
            p[0] = 1
            _powers[key] = np.multiply.accumulate(p)
    return _powers["r"], _powers["i"]


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hash_words(data: bytes, chunk: int = 1 << 19) -> tuple[np.ndarray, np.ndarray]:
    """(start offset, 64-bit hash) of each whitespace-separated word of ``data``.

    Polynomial prefix sums over chunks cut at white space, so memory is bounded
    by the chunk (or by the longest single word).
    """
    buf = np.frombuffer(data, dtype=np.uint8)
    offs, hashes, at = [], [], 0
    while at < len(buf):
        end = min(len(buf), at + chunk)
        if end < len(buf):  # back to the last white space, or forward to the next
            gap = np.flatnonzero(SPACE[buf[at:end]])
            if len(gap):
                end = at + int(gap[-1]) + 1
            else:
                while end < len(buf) and not SPACE[buf[end]]:
                    end += 1
        part = buf[at:end]
        edge = np.diff(np.concatenate(([0], (~SPACE[part]).view(np.int8), [0])))
        lo, hi = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        if len(lo):
            r, inv = _power_tables(len(part) + 1)
            total = np.concatenate(([np.uint64(0)], np.cumsum((part.astype(np.uint64) + np.uint64(1)) * r[: len(part)])))
            h = (total[hi] - total[lo]) * inv[lo]
            hashes.append(mix64(h + (hi - lo).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
            offs.append(lo + at)
        at = end
    if not offs:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    return np.concatenate(offs), np.concatenate(hashes)


def batch_words(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """Words of many texts at once: (hashes in order, bounds[i]:bounds[i+1] of text i).

    A-Z lower-cased; null and empty texts have no words.
    """
    raw = [b"" if t is None else t.encode("utf-8", "surrogatepass").lower() for t in texts]
    starts = np.concatenate(([0], np.cumsum([len(x) + 1 for x in raw]))) if raw else np.zeros(1, np.int64)
    offs, hashes = hash_words(b" ".join(raw))
    return hashes, np.searchsorted(offs, starts)
