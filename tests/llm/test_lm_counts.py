"""Counts beyond four bytes arrive whole."""

import numpy as np
import pyarrow as pa

from assetqueue.llm import lm_scoring as lm


def test_sums_beyond_four_bytes():
    keys, big = lm._gaps(np.array([5, 9], np.uint64)), 3_000_000_000
    c = [lm._narrow(np.array([big, 1])), lm._narrow(np.array([big, 2]))]
    asked = pa.table({"block": [0, 1], "part": [0, 0], "keys": [keys, keys], "c": c, "w": [b"\1\1", b"\1\1"], "tokens": [0, 0]})
    out = lm._answers(None, asked)
    assert [lm._joined(out.slice(i, 1), "c").tolist() for i in (0, 1)] == [[2 * big, 3]] * 2
    assert lm._joined(out.slice(0, 1), "f").tolist() == [big, 1]
    assert lm._joined(pa.table({"part": [0], "c": [lm._narrow(np.array([2.0 ** 40, 7.0]))]}), "c").tolist() == [2 ** 40, 7]
