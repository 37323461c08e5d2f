"""What a Python worker holds in packing and in the n-gram join."""

from __future__ import annotations

import tracemalloc
from types import SimpleNamespace

import numpy as np

from ledgerlens.llm import ngram_join, packing
from ledgerlens.llm.queries import tokenizer_path


def some_texts(n: int, words: int) -> list[str]:
    rng = np.random.default_rng(3)
    return [" ".join("".join(map(chr, rng.integers(97, 123, 6))) for _ in range(words)) for _ in range(n)]


def test_words_in_use_outlive_the_bounded_memory(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 500)
    coder = packing.WordEncoder(tokenizer_path())
    asked, real = [], coder.tokenizer

    def encode_batch_fast(texts, add_special_tokens):
        asked.extend(texts)
        return real.encode_batch_fast(texts, add_special_tokens=add_special_tokens)

    coder.tokenizer = SimpleNamespace(encode_batch_fast=encode_batch_fast)
    for text in some_texts(40, 100):
        text = f"{text} common, words."
        assert list(np.frombuffer(coder.encode([text])[0], dtype="<u4")) == real.encode(text, add_special_tokens=False).ids
        assert len(coder.first) + len(coder.rest) + sum(map(len, coder.before)) < 1500  # of 4,000
    assert sum(x.count(" common") for x in asked) == 1


def test_shingles_of_many_texts_need_little_memory():
    texts = some_texts(200, 30) * 100 + [None, "", "\n", "four words are few"]  # about 4 MB
    few = {}
    tracemalloc.start()
    for i, s in enumerate(ngram_join.shingle_sets(texts)):
        if i in (0, 199, 200, len(texts) - 4, len(texts) - 3, len(texts) - 1):
            few[i] = s
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert i == len(texts) - 1 and peak < 60_000_000
    for i, s in few.items():
        np.testing.assert_array_equal(s, next(ngram_join.shingle_sets([texts[i]])))
    assert [len(few[len(texts) - k]) for k in (4, 3, 1)] == [0, 0, 1]
