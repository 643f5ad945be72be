"""Keys packed and unpacked, and where blocks' own rows go."""

import numpy as np
import pytest

from mergewell.llm.packing import aside, pack, pack_runs, unpack, unpack_runs


@pytest.mark.parametrize("tasks", [8, 40, 64, 200, 2048])
def test_own_rows_of_blocks_spread_over_all_tasks(tasks):
    got = [aside(p << 32 | k) for p in range(4 * tasks) for k in range(3)]
    assert max(got) < 0 and min(got) >= -(1 << 31) and len(set(got)) > 0.99 * len(got)
    assert np.bincount(np.array(got) % tasks, minlength=tasks).max() < 40  # 12 on average


def test_round_trips():
    keys = np.unique(np.random.default_rng(0).integers(0, 1 << 63, 1000, np.uint64))
    runs = np.repeat([5, -1, 7], [1, 400, 3])
    for x in (keys, keys[:0]):
        assert unpack(pack(x)).tolist() == x.tolist()
    for x in (runs, runs[:0]):
        assert unpack_runs(pack_runs(x)).tolist() == x.tolist()
