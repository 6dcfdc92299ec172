"""Conversation repair against an exhaustive search, and its rows against hand-made cases."""

import hashlib
import random

import pytest

from assetqueue.llm import conversation_repair as C

SCHEMA = "conv_id long, turn long, role string, text string"


def by_hand(symbols):
    """Least (cost, audit) over all paths through the grammar: 0 empty, 1 after s, 2 after u, 3 after a."""
    best = {0: (0, "")}

    def closed(states):
        out = dict(states)
        for _ in range(3):
            for a, (cost, audit) in list(out.items()):
                b = 3 if a == 2 else 2
                out[b] = min(out.get(b, (10**9, "")), (cost + 2, audit + "I"))
        return out

    for x in symbols:
        after = {}

        def put(state, cost, audit):
            after[state] = min(after.get(state, (10**9, "")), (cost, audit))

        for a, (cost, audit) in closed(best).items():
            put(a, cost + 3, audit + "D")
            if not x & C.DEAD:
                extra, kind = bool(x & C.CUT), x & 3
                if a == 0 and kind == 2:
                    put(1, cost + extra, audit + "K")
                same = kind == (1 if a == 2 else 0)
                put(3 if a == 2 else 2, cost + extra + (0 if same else 2), audit + ("K" if same else "R"))
        best = after
    return min(v for k, v in closed(best).items() if k in (0, 3))


def random_symbols(rng, n):
    return bytes(rng.choice([0, 0, 1, 1, 2, 3]) | rng.choice([0, 0, 0, C.DEAD, C.CUT]) for _ in range(n))


def test_alignment_equals_search():
    rng = random.Random(4)
    cases = [b""] + [bytes([k]) for k in range(12)] + [random_symbols(rng, rng.randint(1, 14)) for _ in range(3000)]
    cases += [bytes([k]) * n for k in (0, 1, 2, 3, 4, 8) for n in (2, 3, 9)]
    for s in cases:
        assert C._align(s) == by_hand(s), s


def test_long_conversation_in_blocks(monkeypatch):
    rng = random.Random(5)
    cases = [random_symbols(rng, n) for n in (70, 200, 333)]
    want = [C._align(s) for s in cases]
    assert [by_hand(s)[0] for s in cases] == [c for c, _ in want] and want == [by_hand(s) for s in cases]
    monkeypatch.setattr(C, "MAX_CELLS", 500)
    assert [C._align(s) for s in cases] == want


def test_band_is_narrow():
    table = C.Table(bytes([0, 1] * 500 + [0, 0, 1]))
    assert table.width < 15 and table.lengths()[0] == 2


@pytest.fixture(scope="module")
def turns():
    long = "x" * 3_000_000 + "."
    return [(1, 0, "user", "Hi."), (1, 1, "assistant", "Yes."), (1, 1, "assistant", "Yes."), (1, 4, "user", "and then"),
            (2, None, "system", "Be good."), (2, None, "user", None), (None, 3, "user", "A."), (None, 4, None, "B!"),
            (3, 0, "assistant", long), (3, 1, "user", ""), (4, 7, "", "odd."), (4, 8, "user", "a?\n ")]


def test_rows(spark, turns):
    docs = spark.createDataFrame([(*r, "x", 1) for r in turns], SCHEMA + ", audit string, cost int")
    found, repaired = C.repair(docs)
    got = {r.conv_id: r.asDict() for r in found.collect()}
    first = got[1]
    assert (first["gaps"], first["duplicate"], first["truncated"], first["illegal"]) == (2, 1, 1, 1)
    assert (first["cost"], first["audit"]) == (6, "KKDD") and got[2]["audit"] in ("KDII", "DD") and got[2]["blank"] == 1
    assert got[None]["audit"] == "KR" and got[None]["gaps"] == 0
    out = {}
    for r in repaired.orderBy("conv_id", "position").collect():
        out.setdefault(r.conv_id, []).append((r.edit, r.role, r.text))
    assert out[1] == [("K", "user", "Hi."), ("K", "assistant", "Yes.")]
    assert out[None] == [("K", "user", "A."), ("R", "assistant", "B!")]
    assert [x[:2] for x in out[4]] == [("R", "user"), ("R", "assistant")]
    assert out[3][-1] == ("K", "assistant", turns[8][3]) and out[3][0] == ("I", "user", "")
    digests = {r.conv_id: r.repaired_sha256 for r in C.repaired_digests(docs, found).collect()}
    for k in got:
        text = "\n".join(f"{role}:{t}" for _, role, t in out.get(k, []))
        assert digests[k] == hashlib.sha256(text.encode()).hexdigest()


def test_damage_and_empty(spark):
    rows = [(i, t, "user", "a.b!c?") for i in range(30) for t in range(5)]
    docs = spark.createDataFrame(rows, SCHEMA)
    import zlib
    faults = {(i, t): zlib.crc32(f"{i}:{t}".encode()) % 20 for i, t, *_ in rows}
    out = C.damage(docs).collect()
    by = {}
    for r in out:
        by.setdefault((r.conv_id, r.turn), []).append((r.role, r.text, r.present))
    for k, f in faults.items():
        assert len(by[k]) == (2 if f == 3 else 1) and by[k][0][2] == (f != 0)
        assert by[k][0][1] == {1: "", 2: "abc"}.get(f, "a.b!c?")
    gone = spark.createDataFrame([(9, 1, "user", "x", False)], SCHEMA + ", present boolean")
    r = C.audits(gone).collect()[0]
    assert tuple(r)[1:] == (0, 0, 0, 0, 0, 0, 0, "") and C.repair(gone)[1].count() == 0
    assert C.audits(docs.limit(0)).count() == 0


def test_one_large_conversation(spark):
    rows = [(5, t, ("user", "assistant")[t % 2], f"turn {t}.") for t in range(3000)] + [(5, 1, "assistant", "turn 1.")] * 1000
    found, repaired = C.repair(spark.createDataFrame(rows, SCHEMA).repartition(7))
    r = found.collect()[0]
    assert (r.n_rows, r.duplicate, r.cost, r.audit.count("D")) == (4000, 1000, 3000, 1000)
    assert repaired.count() == 3000
