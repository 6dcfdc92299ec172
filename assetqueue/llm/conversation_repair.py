"""Conversation structure repair: Wagner-Fischer alignment to the grammar ``(s?(ua)+)?``.

A turn is kept (0), given another role (2) or deleted (3; always, if blank or a
duplicate), and an empty turn may be inserted (2); a truncated turn that stays
costs 1 more. The alternating strings of all lengths are suffixes of one another,
so one table over (turns left, characters left) aligns the turns to each feasible
length. Its cells lie in an Ukkonen band: a greedy repair gives an incumbent cost,
and what that cost leaves for deletions and insertions bounds how far the
characters left may stray from the live turns left. Every length of the least cost
is traced back, smallest letter first, and the least audit wins.

The turns travel twice: first as flags and hashes (sorted by conversation and
turn, streamed, one row of counts and audit per conversation), then with their
texts behind their audit, streamed again. Texts of a conversation are never
gathered; its flags are (some 100 bytes a turn), since its audit is one value.

Cases: a null role or text counts as one space; null ids are one conversation.
Turns sort nulls first, equal ones by role and text hash (repeated rows stand
side by side and are duplicates). Long texts stream by Arrow batch. Rows with
``present`` false only name their conversation; one without other rows has zeros
and an empty audit. An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from assetqueue.llm.common import written

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
CLASSES = {"u": 0, "a": 1, "s": 2}
DEAD, CUT = 4, 8
LEGAL = {"su", "ua", "au"}
SPACES = " \t\n\x0b\x0c\r"
MAX_CELLS, CACHED_TURNS = 8_000_000, 64
INF = 1 << 28
MODULUS = 20


def damage(conversations: DataFrame) -> DataFrame:
    """The rows with planted faults, by crc32 of ``conv_id:turn``; a dropped turn leaves a row that is not present."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select("conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"),
                                (F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn"))) % MODULUS).alias("fault"))
    fault = F.col("fault")
    text = F.when(fault == 1, "").when(fault == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", F.when(fault == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                       (fault != 0).alias("present"), F.explode(copies).alias("copy")).drop("copy")


# ---- one conversation ---------------------------------------------------------------------------------


def greedy_cost(symbols: bytes) -> int:
    """The cost of some repair: mismatches are all given a role, or all answered by an insertion."""
    dead = sum(bool(x & DEAD) for x in symbols)
    best = DELETE * len(symbols)
    live = [x for x in symbols if not x & DEAD]
    for insert in (False, True):
        cost, want, rows = DELETE * dead, 0, live
        if rows and rows[0] & 3 == 2:
            cost, rows = cost + bool(rows[0] & CUT), rows[1:]
            if not rows:
                cost += 2 * INSERT
        for x in rows:
            cost += bool(x & CUT)
            if x & 3 == want:
                want ^= 1
            elif insert and x & 3 < 2:
                cost += INSERT
            else:
                cost, want = cost + REROLE, want ^ 1
        best = min(best, cost + INSERT * want)
    return best


class Table:
    """Costs of turning the last rows into the last r characters of ..uaua, in the band of an incumbent.

    ``B``: nothing but pairs is left to write; ``A``: the leading system turn is still to come.
    Row i holds r = live[i] - below + k at place k. Large tables keep every ``step``-th row.
    """

    def __init__(self, symbols: bytes):
        x = np.frombuffer(symbols, np.uint8)
        self.cls, self.dead, self.cut = x & 3, (x & DEAD) > 0, ((x & CUT) > 0).astype(int)
        self.n = len(x)
        self.live = np.concatenate((np.cumsum(~self.dead[::-1])[::-1], [0])).astype(int)
        slack = greedy_cost(symbols) - DELETE * int(self.dead.sum())
        self.below = slack // DELETE + 2
        self.width = self.below + slack // INSERT + 3
        self.k = np.arange(self.width)
        self.step = max(1, -(-self.n * self.width // MAX_CELLS)) if self.n else 1
        self.step = self.step if self.step == 1 else max(self.step, int(self.n ** 0.5))
        r = self.k - self.below
        row = (np.where(r >= 0, INSERT * r, INF), np.full(self.width, INF))
        self.kept = {self.n: row}
        for i in range(self.n - 1, -1, -1):
            row = self._row(i, row)
            if i % self.step == 0:
                self.kept[i] = row

    def _row(self, i, after):
        b, a = after
        if self.dead[i]:
            x, lead = b + DELETE, a + DELETE
        else:
            r = self.live[i] - self.below + self.k
            gone = np.append(b[1:], INF)
            x = np.minimum(gone + DELETE, b + np.where(self.cls[i] == (r & 1), KEEP, REROLE) + self.cut[i] * TRUNCATED)
            lead = np.append(a[1:], INF) + DELETE
            if self.cls[i] == 2:
                lead = np.minimum(lead, gone + self.cut[i] * TRUNCATED)
        x = np.minimum.accumulate(x - INSERT * self.k) + INSERT * self.k
        return np.minimum(x, INF), np.minimum(lead, INF)

    def lengths(self) -> tuple[int, list]:
        """The least cost and the (with system turn, characters) that reach it."""
        b, a = self.kept[0]
        r = self.live[0] - self.below + self.k
        pairs, system = (r >= 0) & (r % 2 == 0), (r >= 2) & (r % 2 == 0)
        best = int(min(b[pairs].min(initial=INF), a[system].min(initial=INF)))
        return best, ([(False, int(x)) for x in r[pairs & (b == best)]] + [(True, int(x)) for x in r[system & (a == best)]])

    def audits(self, starts: list) -> list:
        """The least audit of each start, block of rows by block of rows; those already beaten go."""
        walks = [(lead, r, []) for lead, r in starts]
        for lo in range(0, max(self.n, 1), self.step):
            hi = min(self.n, lo + self.step)
            rows = {hi: self.kept.get(hi)}
            if rows[hi] is None:
                rows[hi] = self.kept[self.n]
            for i in range(hi - 1, lo - 1, -1):
                rows[i] = self.kept[i] if i in self.kept else self._row(i, rows[i + 1])
            walks = [self._walk(rows, lo, hi, *w) for w in walks]
            if len(walks) > 1:
                texts = ["".join(w[2]) for w in walks]
                least = min(texts)
                walks = [w for w, t in zip(walks, texts) if t[: len(least)] <= least[: len(t)]]
        return ["".join(w[2]) for w in walks]

    def _walk(self, rows, i, hi, lead, r, out):
        def at(row, i, r):
            k = r - self.live[i] + self.below
            return row[k] if 0 <= k < self.width else INF

        while i < hi or (hi == self.n and r > 0):
            if lead:
                if at(rows[i + 1][1], i + 1, r) + DELETE == at(rows[i][1], i, r):
                    out.append("D")
                else:
                    out.append("K")
                    lead = False
                i += 1
                continue
            here = at(rows[i][0], i, r)
            if i < hi and at(rows[i + 1][0], i + 1, r) + DELETE == here:
                out.append("D")
                i += 1
            elif r > 0 and at(rows[i][0], i, r - 1) + INSERT == here:
                out.append("I")
                r -= 1
            else:
                out.append("K" if self.cls[i] == (r & 1) else "R")
                i, r = i + 1, r - 1
        return lead, r, out


def _align(symbols: bytes) -> tuple[int, str]:
    table = Table(symbols)
    cost, starts = table.lengths()
    return cost, min(table.audits(starts))


_cached = lru_cache(200_000)(_align)


def align(symbols: bytes) -> tuple[int, str]:
    """(cost, audit) of the cheapest repair; one byte a turn: class of its role, ``DEAD``, ``CUT``."""
    return (_cached if len(symbols) <= CACHED_TURNS else _align)(symbols)


# ---- all conversations --------------------------------------------------------------------------------

_AUDIT = "conv_id long, n_rows long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _summary(conv, rows) -> tuple:
    seen, symbols, turns = set(), bytearray(), set()
    blank = duplicate = truncated = illegal = 0
    before = None
    for turn, role, h1, h2, empty, open_ in rows:
        initial, key = role[:1], (role, h1, h2)
        x = CLASSES.get(initial, 3)
        if empty:
            blank, x = blank + 1, x | DEAD
        elif key in seen:
            duplicate, x = duplicate + 1, x | DEAD
        elif open_:
            truncated, x = truncated + 1, x | CUT
        seen.add(key)
        if before is not None and before + initial not in LEGAL:
            illegal += 1
        before = initial
        symbols.append(x)
        if turn is not None:
            turns.add(turn)
    cost, audit = align(bytes(symbols))
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return conv, len(symbols), gaps, blank, duplicate, truncated, illegal, cost, audit


def _batch(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string()}
    return pa.schema([(n, kinds[t]) for n, t in (f.split() for f in ddl.split(", "))])


def _hashed(turns: DataFrame) -> DataFrame:
    """Flags and hashes of each row; ``present`` is taken as true where it is missing."""
    present = F.coalesce("present", F.lit(True)) if "present" in turns.columns else F.lit(True)
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), spaced("role").alias("role"),
                        spaced("text").alias("text"), present.alias("present"))
    end = F.substring(F.rtrim(F.col("text"), F.lit(SPACES)), -1, 1)
    return rows.select("*", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2"), (end == "").alias("empty"),
                       (~end.isin(".", "!", "?")).alias("open"))


def audits(turns: DataFrame) -> DataFrame:
    """One row per conversation: n_rows, gaps, blank, duplicate, truncated, illegal, cost, audit."""
    schema = _arrow(_AUDIT)
    rows = _hashed(turns).drop("text").repartition("conv_id")
    rows = rows.sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "h1", "h2")

    def run(batches):
        conv, held, any_, out = None, [], False, []
        for b in batches:
            cols = [b.column(c).to_pylist() for c in ("conv_id", "present", "turn", "role", "h1", "h2", "empty", "open")]
            for c, present, *row in zip(*cols):
                if any_ and c != conv:
                    out.append(_summary(conv, held))
                    held = []
                conv, any_ = c, True
                if present:
                    held.append(row)
            if out:
                yield _batch(out, schema)
                out = []
        if any_:
            yield _batch([_summary(conv, held)], schema)

    return rows.mapInArrow(run, _AUDIT)


def _behind_audits(turns: DataFrame, found: DataFrame) -> DataFrame:
    """Each conversation's audit row, then its turns in order, together in one partition."""
    rows = _hashed(turns).where("present").select("conv_id", F.lit(1).alias("kind"), "turn", "role", "h1", "h2", "text")
    heads = found.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"),
                         F.lit(0).cast("long").alias("h1"), F.lit(0).cast("long").alias("h2"), F.col("audit").alias("text"))
    both = heads.union(rows).repartition("conv_id")
    return both.sortWithinPartitions("conv_id", "kind", F.col("turn").asc_nulls_first(), "role", "h1", "h2")


class _Edits:
    """Applies an audit to the turns that follow; yields (edit, role, text) for what stays."""

    def __init__(self, audit: str):
        self.audit, self.at, self.left = audit, 0, sum(e != "D" for e in audit)
        self.left -= self.left % 2  # the characters after a leading system turn

    def _pair_role(self):
        self.left -= 1
        return "assistant" if self.left % 2 == 0 else "user"

    def inserted(self):
        while self.audit[self.at: self.at + 1] == "I":
            self.at += 1
            yield "I", self._pair_role(), ""

    def turn(self, role, text):
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "D":
            return
        if edit == "K" and role[:1] == "s":
            yield "K", role, text
        else:
            wanted = self._pair_role()
            yield edit, (wanted if edit == "R" else role), text


def _events(batches):
    """(conv_id, position, edit, role, text) of the repaired turns; (conv_id, None, ..) opens a conversation."""
    conv, edits, at = None, None, 0
    for b in batches:
        for conv_, kind, role, text in zip(*(b.column(c).to_pylist() for c in ("conv_id", "kind", "role", "text"))):
            if kind == 0:
                if edits:
                    for e in edits.inserted():
                        yield (conv, at, *e)
                        at += 1
                conv, edits, at = conv_, _Edits(text), 0
                yield conv, None, None, None, None
            else:
                for e in edits.turn(role, text):
                    yield (conv, at, *e)
                    at += 1
    if edits:
        for e in edits.inserted():
            yield (conv, at, *e)
            at += 1


_TURN = "conv_id long, position long, edit string, role string, text string"


def repaired_turns(turns: DataFrame, found: DataFrame) -> DataFrame:
    """(conv_id, position, edit, role, text): the turns after the edits of ``found``, the result of ``audits``."""
    schema = _arrow(_TURN)

    def run(batches):
        out, size = [], 0
        for e in _events(batches):
            if e[1] is not None:
                out.append(e)
                size += len(e[4]) + 100
            if size > 4_000_000:
                yield _batch(out, schema)
                out, size = [], 0
        if out:
            yield _batch(out, schema)

    return _behind_audits(turns, found).mapInArrow(run, _TURN)


def repaired_digests(turns: DataFrame, found: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): digest of the repaired ``role:text`` lines, hashed as they stream by."""
    ddl = "conv_id long, repaired_sha256 string"
    schema = _arrow(ddl)

    def run(batches):
        conv, digest, out = None, None, []
        for c, position, _, role, text in _events(batches):
            if position is None:
                if digest:
                    out.append((conv, digest.hexdigest()))
                conv, digest = c, hashlib.sha256()
            else:
                digest.update(f"{chr(10) if position else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
            if len(out) >= 5000:
                yield _batch(out, schema)
                out = []
        if digest:
            out.append((conv, digest.hexdigest()))
        if out:
            yield _batch(out, schema)

    return _behind_audits(turns, found).mapInArrow(run, ddl)


def repair(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(audits, repaired turns) of a table conv_id, turn, role, text."""
    found = written(audits(turns), "audits")
    return found, repaired_turns(turns, found)
