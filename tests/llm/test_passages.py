"""Passages of over 50 words that rows share, against brute force."""

from collections import Counter, defaultdict

import pytest

from tickloom.llm import passages, repeats

from .conftest import prose


def shared_words(texts):
    texts = [(t or "").encode().split() for t in texts]
    holders = defaultdict(set)
    for k, words in enumerate(texts):
        for at in range(len(words) - 50):
            holders[tuple(words[at : at + 51])].add(k)
    out = []
    for words in texts:
        gone = set()
        for at in range(len(words) - 50):
            if len(holders[tuple(words[at : at + 51])]) > 1:
                gone.update(range(at, at + 51))
        out.append(len(gone))
    return out


@pytest.mark.parametrize("at_once", [1 << 20, 500])
def test_shared_passages(frame, rows, monkeypatch, at_once):
    monkeypatch.setattr(passages, "AT_ONCE", at_once)
    planted, fewer, own = prose(7, 51, 90), prose(8, 50, 90), prose(9, 60, 90)
    assert len(planted) < repeats.LENGTH  # too short to be removed
    more = [
        (100, f"{prose(300, 60)} {planted} {prose(400, 20)}", "a"),
        (101, f"{prose(301, 70)}\n{planted.replace(' ', chr(10), 9).replace(' ', '  ', 5)}", "a"),
        (102, f"{prose(302, 30)} {fewer} {prose(402, 30)}", "a"),
        (103, f"{prose(303, 30)} {fewer} {prose(403, 30)}", "a"),
        (104, f"{own} {prose(304, 30)} {own}", "a"),  # within one row only
        (None, f"{prose(305, 9)} {prose(405, 80)}", "a"),
        (None, f"{prose(306, 9)} {prose(405, 80)}", "a"),
        (106, "é " * 70, "a"),
        (107, "é " * 60, "a"),
    ]
    every = [r for r in rows if r[0] not in (4, 5)] + rows[4:7] + more
    found = repeats.remove_repeats(frame(every)).collect()
    expected = shared_words([t for _, t, _ in every])
    assert Counter((r.doc_id, r.n_bytes, r.n_shared_words) for r in found) == Counter(
        (d, len((t or "").encode()), n) for (d, t, _), n in zip(every, expected, strict=True)
    )
    told = {r.doc_id: r.n_shared_words for r in found}
    cut = {r.doc_id: r.n_removed for r in found}
    assert [told[k] for k in (100, 101, 102, 103, 104)] == [51, 51, 0, 0, 0]
    assert cut[100] == cut[101] == 0  # told, not removed


def test_every_window_is_in_one_segment(monkeypatch):
    monkeypatch.setattr(passages, "AT_ONCE", 2000)
    texts = [prose(k, n, 9).encode() for k, n in enumerate((0, 1, 50, 51, 52, 400, 51, 90))]
    texts += [b"a\n\tb " * 40, b"", b"x" * 500, b" \n" * 90]
    found = [
        (t, k)
        for text, first, last, *_ in passages.word_segments(texts)
        for t, a, b in zip(text, first, last, strict=True)
        for k in range(a, b + 1)
    ]
    assert sorted(found) == [(t, k) for t, x in enumerate(texts) for k in range(len(x.split()) - 50)]


def test_covered():
    assert passages.covered([]) == 0
    assert passages.covered([{"first": 10, "mask": 0b101}, {"first": 0, "mask": 1}]) == 63
    assert passages.covered([{"first": 200, "mask": 1}, {"first": 0, "mask": (1 << 44) - 1}]) == 145
