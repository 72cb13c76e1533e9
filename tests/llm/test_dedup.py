"""Line dedup, repeated strings, n-gram join, vectors and components against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm import components, embeddings, lines, ngram_join, repeats

from .conftest import prose


def least_labels(nodes, links):
    label = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    r = random.Random(seed)
    links = [(r.randrange(60), r.randrange(60)) for _ in range(25)]
    links += [(100 + k, 101 + k) for k in range(30)]  # a chain
    links += [(7, 200 + k) for k in range(20)] + [(3, 3)]  # a hub and a loop
    df = spark.createDataFrame([*links, (None, 5)], "a bigint, b bigint")
    found = {r.node: r.component for r in components.components(df).collect()}
    expected = least_labels({n for e in links for n in e}, links)
    assert found == {n: c for n, c in expected.items() if any(n in e and e[0] != e[1] for e in links)}
    assert components.components(df.limit(0)).count() == 0


def test_line_dedup(frame, rows):
    docs = frame(rows)
    found = lines.dedup_lines(docs)
    assert found.columns == [*docs.columns, "n_lines", "n_removed"]
    seen, expected = set(), Counter()
    for d, t, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        raw = t.split("\n") if t else []
        gone = {k + i for k, pair in enumerate(zip(raw, raw[1:])) if pair in seen for i in (0, 1)}
        seen |= set(zip(raw, raw[1:]))
        kept = "\n".join(x for k, x in enumerate(raw) if k not in gone)
        expected[d, kept if t else t, len(raw), len(gone)] += 1
    got = Counter((r.doc_id, r.text, r.n_lines, r.n_removed) for r in found.collect())
    assert got == expected
    cut = {d: gone for d, _, _, gone in got}
    assert cut[11] == 12 and cut[10] == 0  # boundaries held in spite of the line in front
    assert lines.dedup_lines(frame([])).count() == 0


def removed(texts):
    size = repeats.LENGTH
    counts = Counter(t[k : k + size] for t in texts for k in range(len(t) - size + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), dtype=bool)
        for k in range(len(t) - size + 1):
            if counts[t[k : k + size]] > 1:
                gone[k : k + size] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(np.int8)])) == 1).sum())
        kept = np.frombuffer(t, dtype=np.uint8)[~gone].tobytes()
        out.append((len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept))
    return out


@pytest.mark.parametrize("hot", [1000, 2])
def test_repeated_strings(frame, rows, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    passage, other = prose(7, 90), prose(8, 75)
    more = [
        (100 + k, f"{prose(300 + k, 60)} {passage} {prose(400 + k, 20)}", "a") for k in range(9)
    ]
    more += [
        (120, passage[:399], "a"),
        (121, passage[1:401], "a"),
        (122, other + passage[:100] + other, "a"),
        (123, "x" * 399, "a"),
        (124, "y" * 401, "a"),
        (125, "ab" * 400 + "c" + "ab" * 300, "a"),
    ]
    every = [r for r in rows if r[0] not in (4, 5)] + rows[4:7] + more
    found = repeats.remove_repeats(frame(every)).collect()
    expected = removed([(t or "").encode() for _, t, _ in every])
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept)) for r in found) == Counter(
        (d, *e) for (d, _, _), e in zip(every, expected, strict=True)
    )
    assert repeats.remove_repeats(frame([])).count() == 0


def shingle_set(text, width=3):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + width]) for k in range(len(words) - width + 1)}


@pytest.mark.parametrize(("block", "width", "share"), [(1024, 3, 90), (4, 3, 90), (4, 5, 80)])
def test_ngram_join(frame, rows, monkeypatch, block, width, share):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "UNIT", 500)
    monkeypatch.setattr(ngram_join, "WAITING", block)
    monkeypatch.setattr(ngram_join, "SETS", 10)
    base = prose(9, 200, 10**6).split()
    r = random.Random(9)
    family = []
    for k in range(14):
        words = list(base)
        for _ in range(k % 5):
            words[r.randrange(len(words))] = f"edit{k}"
        family.append((200 + k, " ".join(words), "a"))
    common = prose(10, 80, 10**6)
    shared = [(300 + k, f"{common} {prose(500 + k, 30, 10**6)}", "a") for k in range(12)]
    words = prose(11, 24, 10**6).split()
    ties = [(400 + k, " ".join(words[:n]), "a") for k, n in enumerate((24, 22, 20, 18))]
    every = rows + family + shared + ties
    found = ngram_join.join(frame(every), width, share).collect()
    sets = [shingle_set(t, width) for _, t, _ in every]
    exact = [100 * len(s & t) == share * len(s | t) for s in sets[-4:] for t in sets[-4:]]
    assert sum(exact) >= 2  # similarity right at the limit
    ids = [d for d, _, _ in every]
    links = [
        (ids[a], ids[b])
        for a in range(len(ids))
        for b in range(a)
        if ids[a] is not None and ids[b] is not None and sets[a] and sets[b]
        and 100 * len(sets[a] & sets[b]) >= share * len(sets[a] | sets[b])
    ]
    label = least_labels({d for d in ids if d is not None}, links)
    assert Counter((x.doc_id, x.n_shingles, x.component_id) for x in found) == Counter(
        (d, len(s), label.get(d)) for d, s in zip(ids, sets, strict=True)
    )
    assert ngram_join.join(frame([]), width, share).count() == 0


def test_tree_loses_no_pair():
    r = np.random.default_rng(5)
    n = 300
    c = r.poisson(4, (n, ngram_join.GROUPS)).astype(np.int32)
    c[100:200] = c[:100] + (r.random((100, ngram_join.GROUPS)) < 0.03)
    sizes = c.sum(1)
    x, y = ngram_join.surviving(*ngram_join.tree_pairs(np.arange(n), c, sizes, 90), c, sizes, 90)
    a, b = np.triu_indices(n, 1)
    a, b = ngram_join.surviving(a, b, c, sizes, 90)
    pairs = lambda p, q: {tuple(sorted(e)) for e in zip(p.tolist(), q.tolist(), strict=True)}
    assert pairs(x, y) == pairs(a, b) and len(a) >= 90
    x, y = ngram_join.tree_pairs(np.arange(100), c, sizes, 90, np.arange(100, n))
    assert {(k, k + 100) for k in range(100)} & pairs(a, b) <= pairs(x, y)


@pytest.mark.parametrize("block", [1024, 6])
def test_vectors(spark, monkeypatch, block):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    monkeypatch.setattr(embeddings, "UNIT", 40)
    r = np.random.default_rng(1)
    vectors = []
    for size in (1, 1, 1, 3, 12, 30):
        centre = r.normal(size=16)
        vectors += [centre + r.normal(size=16) * 0.1 for _ in range(size)]
    vectors += [vectors[-1]] * 5 + [vectors[0] * 3, -vectors[0]]
    vectors = [list(map(float, np.float32(v))) for v in vectors]
    odd = [None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [None] + [1.0] * 15, [1.0, 2.0], [2.0, 4.0]]
    every = [(k * 3 % 1000, v, 0, "x") for k, v in enumerate(vectors + odd)]
    schema = T.StructType(
        [
            T.StructField("vec_id", T.LongType()),
            T.StructField("embedding", T.ArrayType(T.FloatType())),
            T.StructField("label", T.IntegerType()),
            T.StructField("raw", T.StringType()),
        ]
    )
    df = spark.createDataFrame(every, schema)
    found = {x.vec_id: x for x in embeddings.near_duplicates(df, recall=0.9999).collect()}
    assert len(found) == len(every)
    valid = {d: np.array(v) for d, v, *_ in every if v and None not in v and np.isfinite(v).all() and any(v)}
    cosine = lambda a, b: a @ b / np.sqrt((a @ a) * (b @ b))
    links = [
        (a, b)
        for a in valid
        for b in valid
        if a < b and len(valid[a]) == len(valid[b]) and cosine(valid[a], valid[b]) >= 0.9
    ]
    assert len(links) > 100
    label = least_labels([d for d, *_ in every], links)
    degree = Counter(x for link in links for x in link)
    for d, *_ in every:
        assert (found[d].n_links, found[d].component_id) == (degree[d], label[d])
        assert found[d].kept == (label[d] == d)
    assert embeddings.near_duplicates(df.limit(0)).count() == 0
    nobody = embeddings.near_duplicates(df.withColumn("vec_id", F.lit(None).cast("long")))
    assert {(x.n_links, x.component_id, x.kept) for x in nobody.collect()} == {(0, None, False)}
