"""The n-gram join counts every link, not only those that connect."""

import random
from collections import Counter

import pytest

from tickloom.llm import ngram_join

from .conftest import prose
from .test_dedup import shingle_set


@pytest.mark.parametrize("block", [1024, 4])
def test_every_link_is_counted(frame, rows, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "SETS", 10)
    base, r = prose(9, 200, 10**6).split(), random.Random(9)
    family = []
    for k in range(14):
        words = list(base)
        for _ in range(k % 5):
            words[r.randrange(len(words))] = f"edit{k}"
        family.append((200 + k, " ".join(words), "a"))
    every = rows + family + family[:3] + [(300, family[1][1], "a"), (None, family[2][1], "a")]
    nodes = {(d, frozenset(shingle_set(t))) for d, t, _ in every if d is not None}
    near = lambda s, t: s and t and 100 * len(s & t) >= 90 * len(s | t)
    expected = Counter()
    for d, t, _ in every:
        own = frozenset(shingle_set(t))
        n = sum(bool(near(own, s)) for _, s in nodes)
        others = [s for _, s in nodes if s == own]
        expected[d, (n - 1 if others else None) if own else 0] += 1
    found = Counter((x.doc_id, x.n_links) for x in ngram_join.join(frame(every), width=3, share=90).collect())
    assert found == expected
    assert max(n or 0 for _, n in found) > 5
