"""Bands and rows follow the threshold: the odds of a miss there are the same for every one."""

import numpy as np
import pytest

from assetqueue.llm import near_dup


@pytest.mark.parametrize("percent", [60, 70, 80, 85, 90, 95])
def test_pair_at_the_threshold_is_missed_once_in_two_million(percent):
    bands, rows = near_dup.banding(percent)
    assert bands * rows <= near_dup.K
    assert (1 - (percent / 100) ** rows) ** bands <= 4.4e-7


def test_signatures_have_these_bands():
    s = np.arange(1, 500, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    assert near_dup.banding(85) == (25, 5) and near_dup.banding(80) == (28, 4)
    assert [len(near_dup._signature(s, p)[0]) for p in (85, 80)] == [25, 28]
