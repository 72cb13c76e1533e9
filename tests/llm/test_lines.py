"""Line dedup beyond plain documents: rows that share an id, boundaries, and runs without hashes."""

import random
from collections import Counter

import numpy as np
import pytest

from tickloom.llm import lines

from .conftest import prose


def passage(seed, n):
    return "\n".join(prose(seed + k, 12, 10**6) for k in range(n))


def test_rows_of_one_id_keep_their_own_lines(frame):
    shared, *own = (passage(1000 * k, 30) for k in range(6))
    docs = [(1, shared, "a")]
    for k, doc in enumerate((2, 2, None, None)):
        docs.append((doc, own[k], "a"))
        docs.append((doc, f"{shared}\n{own[4]} {k}", "a"))
    found = {r.text: r for r in lines.dedup_lines(frame(docs)).collect()}
    assert all(found[t].n_removed == 0 for t in own[:4])
    whole = sum(t.count("\n") + 1 for t in (shared, *own[:4]))
    assert sum(r.n_lines - r.n_removed for r in found.values()) >= whole
    assert sum(r.n_removed > 10 for r in found.values()) == 4


def without_runs(rows):
    """(doc_id, text, n_removed): pairs of lines looked up in all pairs before, no hashes."""
    seen, out = set(), Counter()
    for doc, text, _ in rows:
        raw = text.split("\n") if text else []
        gone = set()
        for k, pair in enumerate(zip(raw, raw[1:])):
            if pair in seen:
                gone |= {k, k + 1}
            seen.add(pair)
        kept = "\n".join(x for k, x in enumerate(raw) if k not in gone)
        out[doc, kept if gone else text, len(gone)] += 1
    return out


@pytest.mark.parametrize("size", [8, 1])
def test_runs_of_any_length_go(frame, size):
    r = random.Random(11)
    runs = {n: [passage(10**5 * n + 100 * k, n) for k in range(6)] for n in range(2, 11)}
    docs = [(0, None, "a"), (1, "", "a"), (2, "one line", "a"), (3, "one line", "a")]
    for doc in range(4, 40):
        parts = []
        for n in r.sample(range(2, 11), 3):
            parts += [passage(10**7 + 100 * (10 * doc + n), 3), r.choice(runs[n])]
        docs.append((doc, "\n".join(parts), "a"))
    docs += [(50, docs[10][1], "a"), (51, "x\nx\nx\nx", "a")]
    found = Counter((x.doc_id, x.text, x.n_removed) for x in lines.dedup_lines(frame(docs), size).collect())
    assert found == without_runs(docs)
    cut = {doc: n for doc, _, n in found}
    assert cut[50] == docs[10][1].count("\n") + 1 and sum(cut.values()) > 100
    assert lines.dedup_lines(frame([])).count() == 0


def hashed(raw):
    return np.array([lines._hash(x.encode()) for x in raw], dtype=np.uint64)


def chunks_of(raw, rules):
    first, last = lines.chunks(hashed(raw), np.zeros(len(raw), np.int64), rules)
    return list(zip(first.tolist(), last.tolist()))


def test_boundaries_resist_shifts():
    base = [f"line {k}" for k in range(200)]
    moved = ["new", *base[:100], "other", *base[100:]]
    for rules in range(1, 5):
        one, two = ({tuple(x[a : b + 1]) for a, b in chunks_of(x, rules)} for x in (base, moved))
        broken = {c for c in one if base[99] in c and base[100] in c}
        assert one - two == broken and one
    assert {(k, k + 1) for k in range(199)} <= set(chunks_of(base, 4))
    assert max(b - a for a, b in chunks_of(base, 4)) > 2
    two = [*base[:3], *base[:3]]  # of two texts: no chunk over their border
    first, last = lines.chunks(hashed(two), np.array([0, 0, 0, 1, 1, 1]))
    assert all((a < 3) == (b < 3) for a, b in zip(first.tolist(), last.tolist()))
    assert [len(x) for x in lines.chunks(hashed([]), np.zeros(0, np.int64))] == [0, 0]


@pytest.mark.parametrize("rules", [1, 2])
def test_fewer_rules_extend_what_they_find(frame, rules):
    r = random.Random(5)
    runs = [[f"r{k} {i}" for i in range(2 + k % 7)] for k in range(30)]
    docs = []
    for doc in range(40):
        raw = []
        for k in r.sample(range(30), 4):
            at = r.randrange(len(runs[k]) - 1)
            raw += [f"own {doc} {k}", *runs[k][at:]]
        docs.append((doc, "\n".join(raw), "a"))
    seen, expected = set(), {}
    for doc, text, _ in docs:
        raw, gone = text.split("\n"), set()
        at = chunks_of(raw, rules)
        windows = [(a, b) for a in range(len(raw)) for b in range(a + 1, len(raw))]
        for a, b in windows:
            if tuple(raw[a : b + 1]) in seen and any(a <= x and y <= b for x, y in at):
                gone |= set(range(a, b + 1))
        seen |= {tuple(raw[a : b + 1]) for a, b in windows}
        expected[doc] = "\n".join(x for k, x in enumerate(raw) if k not in gone)
    found = {x.doc_id: x.text for x in lines.dedup_lines(frame(docs), rules=rules).collect()}
    assert found == expected and sum(t != expected[d] for d, t, _ in docs) > 20


def test_long_text_of_equal_lines(frame):
    text = "\n".join(["same"] * 20_000 + ["other", "end"])
    found = {x.doc_id: x.n_removed for x in lines.dedup_lines(frame([(1, text, "a"), (2, text, "a")])).collect()}
    assert found == {1: 19_999, 2: 20_002}


def test_op4_cuts_short_runs(spark, tmp_path):
    from tickloom.llm import queries

    two = passage(77, 2)
    docs = [(k, f"{passage(1000 * k + 10**6, 3)}\n{two}\n{passage(1000 * k + 2 * 10**6, 3)}") for k in range(20)]
    spark.createDataFrame(docs, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op4_line_dedup(spark, str(tmp_path)).collect()
    assert {x.doc_id: x.n_removed for x in found} == {k: 2 * (k > 0) for k in range(20)}
