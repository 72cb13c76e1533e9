"""The local search of the packing ends only where no exchange helps."""

from itertools import combinations

import numpy as np
import pytest

from tickloom.llm import packing


def helps(bins, lengths, capacity):
    """Whether a move, 1:1, 2:1 or 1:2 exchange into an at least as full bin is left."""
    fill = [sum(lengths[b]) for b in bins]
    some = lambda b, most: [c for n in range(most + 1) for c in combinations(b, n)]
    for low, one in enumerate(bins):
        for to, two in enumerate(bins):
            if low == to or fill[to] < fill[low] or fill[to] == capacity:
                continue
            for out in some(one, 2)[1:]:
                for back in some(two, 2):
                    if len(out) == 2 and len(back) == 2 or len(out) == 2 and not back:
                        continue
                    gain = sum(lengths[i] for i in out) - sum(lengths[i] for i in back)
                    if 0 < gain <= capacity - fill[to]:
                        return True
    return False


@pytest.mark.parametrize("low, high, n", [(600, 900, 400), (450, 750, 300), (300, 2047, 200), (1, 700, 60)])
def test_no_exchange_is_left(low, high, n):
    lengths = np.random.default_rng(n).integers(low, high + 1, n)
    bins = packing.pack(lengths, 2048)
    assert sorted(sum(bins, [])) == list(range(n))
    assert max(lengths[b].sum() for b in bins) <= 2048
    assert len(bins) == -(-lengths.sum() // 2048) or not helps(bins, lengths, 2048)


def test_group_without_short_pieces():
    lengths = np.random.default_rng(3).integers(600, 901, 8192)
    bins = packing.pack(lengths, 2048)
    assert sorted(sum(bins, [])) == list(range(8192))
    assert len(packing.best_fit(lengths, 2048)) == 3524 and len(bins) <= 3430
