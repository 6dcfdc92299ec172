"""Phrase collocations: weighted acyclic automata of n-gram counts.

Texts become shards of bounded size: distinct words with counts, and the words'
places. Words counted at least ``min_count`` times make the vocabulary, numbered in
the order of their hashes, which is the order of all automata; no phrase of that
count holds another word. Each shard sorts its n-grams and
builds a minimal acyclic transducer from them (``Counts``: a path is an n-gram,
the weight of its last arc is its count), cut into ranges of its prefixes. A
range takes the union of all shards' transducers and sums the weights. Pairs go
first; shards then hear their pairs' sums and send n-grams of 3 to 5 words all of
whose pairs are common. What is left in a range are the exact counts of its
common phrases, prefixes included. The rest of a phrase (its last words) lies in
another range: a transducer of the rests wanted is composed with the counts there.

A prefix's range is its place in the order of all n-grams, as words alone would
fill it: a common word spans several ranges (up to three words deep), and a pair
or phrase is one entry a shard, so no word, pair or passage is a hot key. All
messages are packed automata; nothing is broadcast or gathered on the driver.

Cases: a null text is empty, a null language ``und``. Very long texts are cut
between pieces. Repeated rows count each. Ties of a score: larger count, then
phrase. An empty table, or one without phrases of that count, gives an empty
result. Only id-free columns ``lang`` and ``text`` are read; extra ones are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from assetqueue.llm.common import LOWER, UPPER, hash_words, mix64, written

MIN_COUNT, MAX_WORDS, TOP, PERCENT = 100, 5, 2000, 100
SHARD_BYTES, RANGE_WORDS, HASH_RANGE_BYTES = 8_000_000, 1_000_000, 64_000_000
BREAKS = b".,;:!?\n\x0b\x0c\r"
_BREAK = np.zeros(256, bool)
_BREAK[list(BREAKS)] = True
_WORD = ~_BREAK
_WORD[[0x20, 0x09]] = False
_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())


# ---- packed arrays ------------------------------------------------------------------------------------


def pack(arrays) -> bytes:
    """Non-negative integer arrays, each in as few bytes an item as its largest needs, like bytes side by side, compressed."""
    out = [len(arrays).to_bytes(4, "little")]
    for x in arrays:
        x = np.asarray(x, np.int64)
        top = int(x.max()) if len(x) else 0
        size = next(s for s in (1, 2, 4, 8) if s == 8 or top < 1 << 8 * s)
        out += [bytes([size]), len(x).to_bytes(8, "little"), x.astype(f"<u{size}").view(np.uint8).reshape(-1, size).T.tobytes()]
    data = b"".join(out)
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def unpack(body: bytes) -> list:
    data = pa.decompress(body[8:], decompressed_size=int.from_bytes(body[:8], "little"), codec="zstd", asbytes=True)
    out, at = [], 4
    for _ in range(int.from_bytes(data[:4], "little")):
        size, n = data[at], int.from_bytes(data[at + 1: at + 9], "little")
        planes = np.frombuffer(data, np.uint8, n * size, at + 9).reshape(size, n)
        out.append(np.ascontiguousarray(planes.T).view(f"<u{size}").ravel().astype(np.int64))
        at += 9 + size * n
    return out


# ---- automata -----------------------------------------------------------------------------------------


def _spread(first, degree):
    """Arc numbers of states whose arcs start at ``first``, and the state each belongs to."""
    owner = np.repeat(np.arange(len(first)), degree)
    ahead = np.cumsum(degree) - degree
    return np.arange(len(owner)) - ahead[owner] + first[owner], owner


class Counts:
    """A deterministic acyclic transducer of n-grams; level d holds the arcs of the d-th word.

    ``levels[d]`` is (degree of each state, label, weight, target): labels ascend within a state,
    targets number the states of the next level.
    """

    def __init__(self, levels: list):
        self.levels = levels

    @classmethod
    def build(cls, rows: np.ndarray, weights: dict | None = None):
        """From sorted n-grams (one row each, ids from 1, 0 after the end); a row met again counts again.

        A row opens states after the words it shares with the row before it. ``weights[d]`` replaces
        the counts of level d, row by row.
        """
        levels, n = [], len(rows)
        fresh, parent = np.zeros(n, bool), np.zeros(n, np.int64)
        fresh[:1] = True
        states = 1
        for d in range(rows.shape[1]):
            fresh[1:] |= rows[1:, d] != rows[:-1, d]
            runs = np.flatnonzero(fresh)
            size = np.diff(np.append(runs, n))
            real = rows[runs, d] > 0
            at = runs[real]
            weight = weights[d][at] if weights and d in weights else size[real]
            levels.append((np.bincount(parent[at], minlength=states), rows[at, d] - 1, weight, np.arange(len(at))))
            opened = np.zeros(n, np.int64)
            opened[at] = 1
            parent = np.cumsum(opened) - 1
            states = len(at)
        return cls(levels).minimal()

    def minimal(self):
        """States of a level with the same arcs become one, from the last level back."""
        same, out = None, []
        for degree, label, weight, target in reversed(self.levels):
            target = np.zeros_like(target) if same is None else same[target]  # behind the last level is one state
            first = np.cumsum(degree) - degree
            owner = np.repeat(np.arange(len(degree)), degree)
            arc = mix64(label.astype(np.uint64) * np.uint64(3) + mix64(weight.astype(np.uint64) + mix64(target.astype(np.uint64) + np.uint64(7))))
            total = np.concatenate(([np.uint64(0)], np.cumsum(arc)))
            sign = total[first + degree] - total[first]
            _, pick, same = np.unique(mix64(sign + degree.astype(np.uint64)), return_index=True, return_inverse=True)
            order = np.argsort(pick)  # states keep the order of their first one
            pick, same = pick[order], np.argsort(order)[same]
            twin, within = pick[same], np.arange(len(label)) - first[owner]
            equal = (degree == degree[twin]).all()
            if equal:
                other = first[twin][owner] + within
                equal = all((x == x[other]).all() for x in (label, weight, target))
            if not equal:  # a clash of hashes: leave the level as it is
                pick, same = np.arange(len(degree)), np.arange(len(degree))
            arcs, _ = _spread(first[pick], degree[pick])
            out.append((degree[pick], label[arcs], weight[arcs], target[arcs]))
        return Counts(out[::-1])

    def paths(self):
        """Per length: (number of the path one word shorter, label, weight), in lexicographic order."""
        state, out = np.zeros(1, np.int64), []
        for degree, label, weight, target in self.levels:
            if not len(degree):
                break
            first = np.cumsum(degree) - degree
            arcs, owner = _spread(first[state], degree[state])
            out.append((owner, label[arcs], weight[arcs]))
            state = target[arcs]
        return out

    def arrays(self) -> list:
        return [x for level in self.levels for x in level]

    @classmethod
    def of(cls, arrays: list):
        return cls([tuple(arrays[i: i + 4]) for i in range(0, len(arrays), 4)])

    def pack(self) -> bytes:
        return pack(self.arrays())

    @classmethod
    def unpack(cls, body: bytes):
        return cls.of(unpack(body))


def union(sources: list, fixed: int):
    """Paths of the union, per length (shorter path, label, summed weight), and each source's path numbers.

    Weights of the first ``fixed`` levels are no counts but equal in all sources: they are kept.
    """
    where = [np.zeros(1, np.int64) for _ in sources]  # the merged path of each source path
    out, numbers, lists = [], [], [s.paths() for s in sources]
    for d in range(max((len(x) for x in lists), default=0)):
        live = [(i, x[d]) for i, x in enumerate(lists) if len(x) > d]
        parent = np.concatenate([where[i][x[0]] for i, x in live])
        label = np.concatenate([x[1] for _, x in live])
        weight = np.concatenate([x[2] for _, x in live])
        span = int(label.max()) + 1 if len(label) else 1
        key, first, inverse = np.unique(parent * span + label, return_index=True, return_inverse=True)
        if d < fixed:
            total = weight[first]
        else:
            total = np.zeros(len(key), np.int64)
            np.add.at(total, inverse, weight)
        out.append((key // span, key % span, total))
        ends = np.cumsum([len(x[1]) for _, x in live])
        parts = np.split(inverse, ends[:-1])
        where = [np.zeros(0, np.int64)] * len(sources)
        for (i, _), p in zip(live, parts):
            where[i] = p
        numbers.append(list(where))
    return out, numbers


def common(paths: list, min_count: int) -> Counts:
    """The transducer of the paths counted often enough; their prefixes are, too."""
    levels, kept, states = [], None, 1
    for parent, label, weight in paths:
        keep = weight >= min_count
        if kept is not None:
            keep &= kept[parent] >= 0
            parent = kept[parent]
        at = np.flatnonzero(keep)
        levels.append((np.bincount(parent[at], minlength=states), label[at], weight[at], np.arange(len(at))))
        kept = np.where(keep, np.cumsum(keep) - 1, -1)
        states = len(at)
    return Counts(levels).minimal()


def compose(query: Counts, counts: Counts) -> list:
    """For each path of ``query``, per length, its weight in ``counts`` (0: no such path)."""
    out, q_state, c_state = [], np.zeros(1, np.int64), np.zeros(1, np.int64)
    for d, (degree, label, _, target) in enumerate(query.levels):
        arcs, owner = _spread((np.cumsum(degree) - degree)[q_state], degree[q_state])
        q_state = target[arcs]
        found, at = np.zeros(len(arcs), bool), np.zeros(len(arcs), np.int64)
        if d < len(counts.levels) and len(counts.levels[d][1]):
            deg, lab, weight, to = counts.levels[d]
            span = int(max(lab.max(), label.max(initial=0))) + 1
            keys = np.repeat(np.arange(len(deg)), deg) * span + lab
            want = np.where(c_state[owner] >= 0, c_state[owner] * span + label[arcs], -1)
            at = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
            found = keys[at] == want
            out.append(np.where(found, weight[at], 0))
            c_state = np.where(found, to[at], -1)
        else:
            out.append(np.zeros(len(arcs), np.int64))
            c_state = np.full(len(arcs), -1)
    return out


# ---- shards -------------------------------------------------------------------------------------------


def _parts(raw: bytes):
    """A text in parts of bounded size, cut between pieces."""
    at = 0
    while len(raw) - at > SHARD_BYTES:
        end = max(raw.rfind(bytes([b]), at, at + SHARD_BYTES) for b in BREAKS)
        if end <= at:
            later = [e for e in (raw.find(bytes([b]), at + SHARD_BYTES) for b in BREAKS) if e >= 0]
            if not later:
                break
            end = min(later)
        yield raw[at:end]
        at = end
    yield raw[at:]


def words_of(raw: bytes):
    """(distinct words in the order of their hashes, the hashes, counts, the words' places as ids from 1 with 0 between pieces)."""
    buf = np.frombuffer(raw, np.uint8)
    word = _WORD[buf]
    edge = np.diff(np.concatenate(([0], word.view(np.int8), [0])))
    lo, size = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    size -= lo
    piece = np.cumsum(_BREAK[buf], dtype=np.int32)[lo]
    n = len(lo)
    arr = _binary(size, buf[word]).dictionary_encode()
    hashes = hash_words(b" ".join(arr.dictionary.to_pylist()))[1]
    order = np.argsort(hashes, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    ids = rank[arr.indices.to_numpy()]
    gaps = np.cumsum(np.diff(piece, prepend=piece[:1]) > 0)
    seq = np.zeros(n + (int(gaps[-1]) if n else 0), np.int32)
    seq[np.arange(n) + gaps] = ids + 1
    return arr.dictionary.take(pa.array(order)), hashes[order], np.bincount(ids, minlength=len(order)), seq


def _binary(sizes, data: np.ndarray) -> pa.Array:
    offsets = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=offsets[1:])
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _lettered(words: pa.Array, counts) -> list:
    """Words and their counts as integer arrays; ``_read`` turns them back."""
    return [counts, pc.binary_length(words).to_numpy(), np.frombuffer(b"".join(words.to_pylist()), np.uint8)]


def _read(bodies: list):
    """(all words, counts, number of words of each body)."""
    parts = [unpack(b) for b in bodies]
    sizes, letters = np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts]).astype(np.uint8)
    return _binary(sizes, letters), np.concatenate([p[0] for p in parts]), [len(p[0]) for p in parts]


_KEY = ["lang", "kind", "range"]
_MESSAGE = "lang string, n long, weight long, kind int, range long, shard long, body binary"
_ARROW = pa.schema([("lang", pa.string()), ("n", pa.int64()), ("weight", pa.int64()), ("kind", pa.int32()), ("range", pa.int64()),
                    ("shard", pa.int64()), ("body", pa.binary())])
STORED, WORDS, PAIRS, LONGER = 0, 1, 2, 3


def _rows(rows) -> pa.Table:
    cols = list(zip(*rows)) if rows else [[]] * len(_ARROW)
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _ARROW)], schema=_ARROW)


def _first(t: pa.Table, *names):
    return [t.column(c)[0].as_py() for c in names]


def _bodies(t: pa.Table):
    """Rows in an order given by content."""
    return sorted(zip(t.column("shard").to_pylist(), t.column("body").to_pylist()))


def _cuts(ranges):
    edges = np.flatnonzero(np.diff(ranges)) + 1
    return zip(np.concatenate(([0], edges)), np.append(edges, len(ranges))) if len(ranges) else ()


def shards(docs: DataFrame, ranges: int, lang_col="lang", text_col="text") -> DataFrame:
    """Documents of one task and language, a bounded number of bytes at a time: the words' places (``STORED``)
    and the distinct words with counts, by ranges of their hashes (``WORDS``)."""

    def run(batches):
        held, size, made = {}, {}, 0
        base = TaskContext.get().partitionId() << 32

        def shard(lang):
            words, hashes, counts, seq = words_of(b"\n".join(held.pop(lang)).translate(_LOWER))
            size.pop(lang)
            out = [(lang, int(counts.sum()), 0, STORED, 0, base + made, pack([seq]))]
            r = ((hashes >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)
            out += [(lang, 0, 0, WORDS, int(r[lo]), base + made, pack(_lettered(words[lo:hi], counts[lo:hi]))) for lo, hi in _cuts(r)]
            return from_table(_rows(out))

        def from_table(t):
            return t.combine_chunks().to_batches()[0]

        for b in batches:
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
                for part in _parts(text.encode("utf-8", "surrogatepass")):
                    held.setdefault(lang, []).append(part)
                    size[lang] = size.get(lang, 0) + len(part) + 1
                    if size[lang] >= SHARD_BYTES or sum(size.values()) >= 2 * SHARD_BYTES:
                        yield shard(max(size, key=size.get))
                        made += 1
        for lang in sorted(held):
            yield shard(lang)
            made += 1

    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text"))
    return rows.where(F.length("text") > 0).mapInArrow(run, _MESSAGE)


def _common_words(min_count):
    def run(t):
        """The common words of a range of hashes, numbered in order; each shard hears which of its words these are.

        An answer holds, for each word of the shard, its number from 1 or 0; then for the common ones their
        count and what is counted before them in the range.
        """
        lang, range_ = _first(t, "lang", "range")
        bodies = _bodies(t)
        words, counts, sizes = _read([b for _, b in bodies])
        arr = words.dictionary_encode()
        at = arr.indices.to_numpy()
        f = np.zeros(len(arr.dictionary), np.int64)
        np.add.at(f, at, counts)
        often = np.flatnonzero(f >= min_count)
        texts = arr.dictionary.take(pa.array(often)).to_pylist()
        hashes = hash_words(b" ".join(texts))[1].tolist()
        often = often[sorted(range(len(often)), key=lambda i: (hashes[i], texts[i]))]
        number, before = np.zeros(len(f), np.int64), np.zeros(len(f), np.int64)
        number[often] = np.arange(len(often)) + 1
        before[often] = np.cumsum(f[often]) - f[often]
        out = [(lang, len(often), int(f[often].sum()), WORDS, range_, -1, pack(_lettered(arr.dictionary.take(pa.array(often)), f[often])))]
        for (shard, _), own in zip(bodies, np.split(at, np.cumsum(sizes)[:-1])):
            known = own[number[own] > 0]
            out.append((lang, 0, 0, STORED, range_, shard, pack([number[own], f[known], before[known]])))
        return _rows(out)

    return run


def _listed(words: DataFrame) -> DataFrame:
    """(lang, id, word, f, at) from rows (lang, body, n0, f0)."""

    def run(batches):
        for b in batches:
            for lang, body, n0, f0 in zip(*(b.column(c).to_pylist() for c in ("lang", "body", "n0", "f0"))):
                texts, f, _ = _read([body])
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(f), pa.string()), pa.array(n0 + np.arange(len(f))), texts.cast(pa.binary()),
                                                  pa.array(f), pa.array(f0 + np.cumsum(f) - f)], names=["lang", "id", "word", "f", "at"])

    return words.select("lang", "body", "n0", "f0").mapInArrow(run, "lang string, id long, word binary, f long, at long")


# ---- rounds -------------------------------------------------------------------------------------------

def _range(weight, size, words, f, at):
    """Range of n-grams by their first two or three words (columns of ``words``: places in f and at)."""
    share = at[words[-1]] / weight
    for w in words[-2::-1]:
        share = (at[w] + f[w] * share) / weight
    return np.floor(share * weight / size).astype(np.int64)


def _encode(size):
    def run(left, right):
        """A shard's common words as vocabulary ids; its pairs' counts go out by range."""
        if not left.num_rows or not right.num_rows:
            return _rows([])
        lang, n, weight, shard, body = _first(left, "lang", "n", "weight", "shard", "body")
        heard = sorted(zip(*(right.column(c).to_pylist() for c in ("range", "n0", "f0", "body"))))
        heard = [(n0, f0, *unpack(b)) for _, n0, f0, b in heard]
        number = np.concatenate([x[2] for x in heard])
        ids = np.concatenate([x[0] + x[2][x[2] > 0] - 1 for x in heard])
        f, at = np.concatenate([x[3] for x in heard]), np.concatenate([x[1] + x[4] for x in heard])
        if not len(ids):
            return _rows([])
        order = np.argsort(ids)
        local = np.full(len(number) + 1, -1, np.int64)
        local[np.flatnonzero(number > 0)[order] + 1] = np.arange(len(ids))
        ids, f, at = ids[order], f[order], at[order]
        x = local[unpack(body)[0]]
        used = x >= 0
        pair = used[:-1] & used[1:]
        keep = np.zeros(len(x), bool)
        keep[:-1] |= pair
        keep[1:] |= pair
        gap = np.flatnonzero(keep & ~np.concatenate(([True], keep[:-1])))
        x = np.insert(x[keep], np.cumsum(keep)[gap] - 1, -1) + 1
        out = [(lang, n, weight, STORED, 0, shard, pack([x, ids, f, at]))]
        keys, counts = _pairs(x, len(ids))[:2]
        for lo, hi in _cuts(r := _range(weight, size, [keys // len(ids), keys % len(ids)], f, at)):
            w1, w2 = keys[lo:hi] // len(ids), keys[lo:hi] % len(ids)
            rows = np.column_stack((ids[w1], ids[w2])) + 1
            out.append((lang, n, weight, PAIRS, int(r[lo]), shard, Counts.build(rows, {0: f[w1], 1: counts[lo:hi]}).pack()))
        return _rows(out)

    return run


def _pairs(x, v):
    """(sorted distinct pairs as first * v + second, their counts, where they start, which pair is there)."""
    at = np.flatnonzero((x[:-1] > 0) & (x[1:] > 0))
    keys, inverse, counts = np.unique((x[at] - 1) * v + x[at + 1] - 1, return_inverse=True, return_counts=True)
    return keys, counts, at, inverse


def _sum(min_count, fixed, answer):
    def run(t):
        """Union of a range; its common phrases stay, and each shard hears the sums of its own pairs."""
        lang, n, weight, kind, range_ = _first(t, "lang", "n", "weight", "kind", "range")
        bodies = _bodies(t)
        paths, numbers = union([Counts.unpack(b) for _, b in bodies], fixed)
        out = [(lang, n, weight, kind, range_, -1, common(paths, min_count).pack())]
        if answer:
            total = np.where(paths[1][2] >= min_count, paths[1][2], 0)
            out += [(lang, n, weight, STORED, range_, shard, pack([total[own]])) for (shard, _), own in zip(bodies, numbers[1])]
        return _rows(out)

    return run


def _extend(min_count, size, max_words):
    def run(left, right):
        """A shard's longer n-grams, all pairs of which are common, by range."""
        if not left.num_rows or not right.num_rows:
            return _rows([])
        lang, n, weight, shard, body = _first(left, "lang", "n", "weight", "shard", "body")
        x, ids, f, at = unpack(body)
        v = len(ids)
        keys, _, where, inverse = _pairs(x, v)
        sums = np.concatenate([unpack(b)[0] for _, b in sorted(zip(right.column("range").to_pylist(), right.column("body").to_pylist()))])
        total = np.zeros(len(x) + max_words, np.int64)
        total[where] = sums[inverse]
        ok = total >= min_count
        start = np.flatnonzero(ok[:-1] & ok[1:])
        if max_words < 3 or not len(start):
            return _rows([])
        padded = np.concatenate((x, np.zeros(max_words, np.int64)))
        cols, live = [padded[start], padded[start + 1]], np.ones(len(start), bool)
        for k in range(2, max_words):
            live = live & ok[start + k - 1]
            cols.append(np.where(live, padded[start + k], 0))
        rows = np.column_stack(cols)
        order = np.lexsort(rows.T[::-1])
        rows, two = rows[order], total[start][order]
        r = _range(weight, size, [rows[:, k] - 1 for k in range(3)], f, at)
        out = []
        for lo, hi in _cuts(r):
            part = rows[lo:hi]
            one = f[part[:, 0] - 1]
            part = np.where(part > 0, ids[np.maximum(part, 1) - 1] + 1, 0)
            out.append((lang, n, weight, LONGER, int(r[lo]), shard, Counts.build(part, {0: one, 1: two[lo:hi]}).pack()))
        return _rows(out)

    return run


def _phrases(paths, least: int):
    """(n-grams of one length as rows, weights of their prefixes as columns) for each length from ``least``."""
    rows, weights = np.zeros((1, 0), np.int64), np.zeros((1, 0), np.int64)
    for parent, label, weight in paths:
        rows, weights = np.column_stack((rows[parent], label)), np.column_stack((weights[parent], weight))
        if rows.shape[1] >= least:
            yield rows, weights


def _least(kind: int) -> int:
    return 2 if kind == PAIRS else 3


def _wanted(phrases, ids, f, at, weight, size):
    """{(kind, range): transducer of the rests wanted there}."""
    by = {}
    for rows, _ in phrases:
        for k in range(1, rows.shape[1] - 1):
            rest = rows[:, k:]
            place = np.searchsorted(ids, rest)
            kind = PAIRS if rest.shape[1] == 2 else LONGER
            r = _range(weight, size, [place[:, i] for i in range(min(3, rest.shape[1]))], f, at)
            for x in np.unique(r).tolist():
                by.setdefault((kind, x), []).append(rest[r == x])
    out = {}
    for key, parts in by.items():
        rows = np.zeros((sum(map(len, parts)), max(p.shape[1] for p in parts)), np.int64)
        lo = 0
        for p in parts:
            rows[lo: lo + len(p), : p.shape[1]] = p + 1
            lo += len(p)
        out[key] = Counts.build(np.unique(rows, axis=0))
    return out


def _ask(size):
    def run(left, right):
        """The range's counts with what is known of its words (shard -1), and its questions to other ranges.

        A question carries who asks: ``shard`` numbers the asking range, twice, plus one for longer phrases.
        """
        if not left.num_rows or not right.num_rows:
            return _rows([])
        lang, n, weight, kind, range_, body = _first(left, "lang", "n", "weight", "kind", "range", "body")
        ids, f, at = (right.column(c).to_numpy() for c in ("id", "f", "at"))
        order = np.argsort(ids)
        ids, f, at = ids[order], f[order], at[order]
        out = [(lang, n, weight, kind, range_, -1, pack([ids, f, at] + Counts.unpack(body).arrays()))]
        phrases = _phrases(Counts.unpack(body).paths(), _least(kind))
        me = 2 * range_ + (kind == LONGER)
        out += [(lang, n, weight, k, r, me, q.pack()) for (k, r), q in _wanted(phrases, ids, f, at, weight, size).items()]
        return _rows(out)

    return run


def _split(body: bytes):
    """(ids, f, at) and the counts that ``_ask`` put together."""
    arrays = unpack(body)
    return arrays[:3], Counts.of(arrays[3:])


def _reply(left, right):
    """Answers each question by composing it with the counts here; the key turns back to who asks."""
    if not right.num_rows:
        return _rows([])
    lang, n, weight, kind, range_ = _first(right, "lang", "n", "weight", "kind", "range")
    counts = _split(left.column("body")[0].as_py())[1] if left.num_rows else Counts([])
    out = []
    for asker, body in _bodies(right):
        found = compose(Counts.unpack(body), counts)
        # who answers is numbered like who asks
        out.append((lang, n, weight, LONGER if asker % 2 else PAIRS, asker // 2, 2 * range_ + (kind == LONGER), pack(found)))
    return _rows(out)


_SCORED = "lang string, ids array<long>, a long, l long, r long, n long, score long"
_SCORED_ARROW = pa.schema([("lang", pa.string()), ("ids", pa.list_(pa.int64())), *((c, pa.int64()) for c in ("a", "l", "r", "n", "score"))])


def lowest_cut(a: int, lefts, rights, n: int):
    """(score, l, r) of the lowest-scoring cut, the first of equal ones; whole numbers of any size."""
    return min(((1000 * a * n // (x * y), k, x, y) for k, (x, y) in enumerate(zip(lefts, rights))))


def _score(size):
    def run(left, right):
        if not left.num_rows:
            return pa.Table.from_pylist([], schema=_SCORED_ARROW)
        lang, n, weight, kind, body = _first(left, "lang", "n", "weight", "kind", "body")
        (ids, f, at), counts = _split(body)
        phrases = list(_phrases(counts.paths(), _least(kind)))
        answers = dict(_bodies(right))
        found = {}
        for (k, r), query in _wanted(phrases, ids, f, at, weight, size).items():
            replies = unpack(answers[2 * r + (k == LONGER)])
            for (rows, _), w in zip(_phrases(query.paths(), 1), replies):
                if rows.shape[1] > 1:
                    found.update(zip(map(tuple, rows.tolist()), w.tolist()))
        one = dict(zip(ids.tolist(), f.tolist()))
        out = []
        for rows, weights in phrases:
            for p, w in zip(map(tuple, rows.tolist()), weights.tolist()):
                rights = [found[p[k:]] if len(p) - k > 1 else one[p[-1]] for k in range(1, len(p))]
                score, _, x, y = lowest_cut(w[-1], w[:-1], rights, n)
                out.append((lang, p, w[-1], x, y, n, score))
        cols = list(zip(*out)) if out else [[]] * len(_SCORED_ARROW)
        return pa.Table.from_arrays([pa.array(c, s.type) for c, s in zip(cols, _SCORED_ARROW)], schema=_SCORED_ARROW)

    return run


def _cogroup(left: DataFrame, right: DataFrame, keys, run, ddl: str) -> DataFrame:
    """Cogroup of tables that may share their origin: the right one's columns are made its own."""
    return left.groupBy(keys).cogroup(right.select([F.col(c).alias(c) for c in right.columns]).groupBy(keys)).applyInArrow(run, ddl)


def candidates(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, lang_col="lang", text_col="text") -> tuple:
    """(lang, ids, a, l, r, n, score) of every phrase counted at least ``min_count`` times, and the vocabulary."""
    size = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0
    cut = written(shards(docs, 1 + size // HASH_RANGE_BYTES, lang_col, text_col), "shards")
    words = written(cut.where(F.col("kind") == WORDS).groupBy("lang", "range").applyInArrow(_common_words(min_count), _MESSAGE), "words")
    # one small row for each language and range of hashes
    by = Window.partitionBy("lang")
    before = by.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    earlier = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    heads = words.where(F.col("kind") == WORDS).select("lang", "range", earlier("n").alias("n0"), earlier("weight").alias("f0"), F.sum("weight").over(by).alias("weight"))
    heads = written(heads.where("weight > 0"), "heads")
    vocab = written(_listed(words.where(F.col("kind") == WORDS).drop("n", "weight").join(heads, ["lang", "range"])), "vocabulary")
    answers = words.where(F.col("kind") == STORED).select("lang", "range", "shard", "body").join(heads.drop("weight"), ["lang", "range"])
    own = cut.where(F.col("kind") == STORED)
    langs = own.groupBy("lang").agg(F.sum("n").alias("n")).join(heads.select("lang", "weight").distinct(), "lang")
    own = own.select("lang", "shard", "body").join(langs, "lang")
    first = written(_cogroup(own, answers, ["shard"], _encode(RANGE_WORDS), _MESSAGE), "pairs")
    pairs = written(first.where(F.col("kind") == PAIRS).groupBy("lang", "range").applyInArrow(_sum(min_count, 1, True), _MESSAGE), "pair_sums")
    stored, sums = first.where(F.col("kind") == STORED), pairs.where(F.col("kind") == STORED)
    longer = _cogroup(stored, sums, ["shard"], _extend(min_count, RANGE_WORDS, max_words), _MESSAGE)
    longer = longer.groupBy("lang", "range").applyInArrow(_sum(min_count, 2, False), _MESSAGE)
    counts = written(pairs.where(F.col("kind") == PAIRS).union(longer), "counts")
    labels = _labels(counts).join(vocab.drop("word"), ["lang", "id"])
    asked = written(_cogroup(counts, labels, _KEY, _ask(RANGE_WORDS), _MESSAGE), "questions")
    tables, questions = asked.where("shard = -1"), asked.where("shard >= 0")
    replies = _cogroup(tables, questions, _KEY, _reply, _MESSAGE)
    return _cogroup(tables, replies, _KEY, _score(RANGE_WORDS), _SCORED), vocab


def _labels(counts: DataFrame) -> DataFrame:
    """(lang, kind, range, id): the words of each range's phrases."""
    schema = pa.schema([("lang", pa.string()), ("kind", pa.int32()), ("range", pa.int64()), ("id", pa.int64())])

    def run(batches):
        for b in batches:
            for lang, kind, range_, body in zip(*(b.column(c).to_pylist() for c in (*_KEY, "body"))):
                ids = np.unique(np.concatenate([x[1] for x in Counts.unpack(body).levels]))
                m = len(ids)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * m, pa.string()), pa.array([kind] * m, pa.int32()),
                                                  pa.array([range_] * m, pa.int64()), pa.array(ids)], schema=schema)

    return counts.select(*_KEY, "body").mapInArrow(run, "lang string, kind int, range long, id long")


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, top: int = TOP, percent: int = PERCENT,
                 lang_col="lang", text_col="text") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of each language.

    A phrase goes if a longer candidate that holds it has at least ``percent`` of its count.
    """
    found, vocab = candidates(docs, min_count, max_words, lang_col, text_col)
    found = written(found, "phrases")
    size = F.size("ids")
    inner = F.when(size > 2, F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda n: F.transform(
        F.sequence(F.lit(1), size - n + 1), lambda s: F.slice("ids", s, n)))))
    held = found.select("lang", F.explode(inner).alias("ids"), F.col("a").alias("over")).groupBy("lang", "ids").agg(F.max("over").alias("over"))
    kept = found.join(held, ["lang", "ids"], "left").where(F.col("over").isNull() | (100 * F.col("over") < percent * F.col("a"))).drop("over")
    by = Window.partitionBy("lang")
    best = kept.withColumn("k", F.rank().over(by.orderBy(F.desc("score"), F.desc("a")))).where(F.col("k") <= top).drop("k")
    words = best.select("*", F.posexplode("ids").alias("pos", "id")).join(vocab.select("lang", "id", F.col("word").cast("string").alias("word")), ["lang", "id"])
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "word"))), lambda x: x["word"]), " ")
    phrases = words.groupBy("lang", "ids", "a", "l", "r", "n", "score").agg(text.alias("phrase"))
    order = by.orderBy(F.desc("score"), F.desc("a"), F.col("phrase").cast("binary"))
    out = phrases.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return out.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
