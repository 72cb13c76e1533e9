"""Words are cut into pieces before the tokenizer sees them."""

import random

import numpy as np

from tickloom.llm import packing


class Counting:
    def __init__(self, tokenizer):
        self.tokenizer, self.asked = tokenizer, []

    def encode_batch_fast(self, texts, **options):
        self.asked += texts
        return self.tokenizer.encode_batch_fast(texts, **options)


def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.vocabulary_path())


def test_tokenizer_gets_each_piece_once(monkeypatch):
    counting = Counting(tokenizer())
    state = (counting, {}, {})
    monkeypatch.setattr(packing, "_encoder", lambda path: state)
    words = [f"{a}{n}{b}" for a in ("Ab", "cd!", "'s") for n in range(100, 600) for b in ("", "x,")]
    got = packing.encode([" ".join(words), None, " ".join(words[::-1])], packing.vocabulary_path())
    expected = counting.tokenizer.encode(" ".join(words), add_special_tokens=False).ids
    assert np.frombuffer(got[0], dtype="<u4").tolist() == expected
    assert got[1] == b"" and len(got[2]) == len(got[0])
    assert len(counting.asked) == len(set(counting.asked)) < 20 < len(words)


def test_odd_ascii(monkeypatch):
    plain = tokenizer()
    monkeypatch.setattr(packing, "AT_ONCE", 7)
    r = random.Random(8)
    parts = ["'", "'S", "s", "'re", "LL", "9", "<|", "|>", "<|endoftext|>", "\x00", "\x1c", "\x7f", "é", "!"]
    parts += ["\x85", "_", "<", "|", "~", "'ve", "D", "m"]
    texts = ["".join(r.choices(parts, k=r.randint(1, 9))) for _ in range(600)]
    texts = [" ".join(texts[k : k + 4]) + r.choice(["", "\n", "\t \v"]) for k in range(0, 600, 4)]
    texts += [None, "", " \f\r", " a", "a "]
    got = packing.encode(texts, packing.vocabulary_path())
    for text, ids in zip(texts, got, strict=True):
        expected = plain.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(ids, dtype="<u4").tolist() == expected, text
    assert packing.encode([], packing.vocabulary_path()) == []
    assert packing.encode([None], packing.vocabulary_path()) == [b""]
