import random
import zlib

import numpy as np
import pytest

from tickloom.llm import packing


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.vocabulary_path())


def test_ids_are_the_tokenizers(tokenizer, rows):
    odd = [
        "a\x1cb!\x1c! c\x85d e\xa0f",
        "İstanbul ΣΑΣ ς x<|endoftext|>y <|startoftext|>",
        "é ́x don't 'LL 12345 ½² 日本語 テキスト ﬁ ǅ",
    ]
    texts = [t for _, t, _ in rows] + odd
    for text, ids in zip(texts, packing.encode(texts, packing.vocabulary_path()), strict=True):
        expected = tokenizer.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(ids, dtype="<u4").tolist() == expected


def test_round_trip(frame, rows, tokenizer):
    docs = frame(rows)
    pieces = packing.pack_documents(docs, capacity=256, group=16).toPandas()
    left = pieces.groupby(["sequence_id"])
    for _, sequence in left:
        sequence = sequence.sort_values("offset")
        assert (sequence["offset"] == sequence["length"].cumsum() - sequence["length"]).all()
        assert sequence["length"].sum() <= 256
    expected = []
    for doc, text, _ in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), 256):
            part = np.array(ids[k : k + 256], dtype="<u4")
            number = -1 if doc is None else doc
            expected.append((number, k // 256, k, len(part), zlib.crc32(part.tobytes())))
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    got = pieces[names].fillna(-1).astype("int64").itertuples(index=False, name=None)
    assert sorted(got) == sorted(expected)


def test_empty_table(frame):
    assert packing.pack_documents(frame([])).count() == 0


def test_search_beats_best_fit():
    r = random.Random(3)
    lengths = np.array([r.randint(600, 900) for _ in range(3000)])
    start = packing.best_fit(lengths, 2048)
    bins = packing.pack(lengths, 2048)
    assert sorted(sum(bins, [])) == list(range(3000))
    assert max(lengths[b].sum() for b in bins) <= 2048
    assert len(bins) < len(start)


def test_mixed_lengths_fill_up():
    r = random.Random(4)
    lengths = np.array([min(2047, int(r.lognormvariate(5.5, 1.2)) + 1) for _ in range(5000)])
    bins = packing.pack(lengths)
    assert len(bins) <= -(-lengths.sum() // 2048) + 1


def test_exchanges():
    fill = lambda bins, lengths: np.array([lengths[b].sum() for b in bins])
    for lengths, bins in (
        (np.array([5, 8]), [[0], [1]]),  # nothing fits
        (np.array([4, 6, 3, 2]), [[0], [1, 2]]),  # move or swap
        (np.array([3, 3, 5, 2]), [[0, 1], [2, 3]]),  # two for one
        (np.array([6, 4, 1, 3]), [[0], [1, 2, 3]]),
    ):
        before = (fill(bins, lengths) ** 2).sum()
        have = fill(bins, lengths)
        if packing._exchange(bins, have, int(np.argmin(have)), lengths, 10):
            assert (fill(bins, lengths) == have).all()
            assert (have**2).sum() > before
            assert have.max() <= 10
