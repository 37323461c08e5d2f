"""Tokenizer calls of packing."""

from __future__ import annotations

from types import SimpleNamespace

import numpy as np
import pyarrow as pa

from ledgerlens.llm import packing
from ledgerlens.llm.queries import tokenizer_path


def some_texts(n: int, words: int) -> list[str]:
    rng = np.random.default_rng(3)
    return [" ".join("".join(map(chr, rng.integers(97, 123, 6))) for _ in range(words)) for _ in range(n)]


def test_new_words_are_encoded_many_at_once():
    coder = packing.WordEncoder(tokenizer_path())
    asked, real = [], coder.tokenizer

    def encode_batch_fast(texts, add_special_tokens):
        asked.extend(texts)
        return real.encode_batch_fast(texts, add_special_tokens=add_special_tokens)

    coder.tokenizer = SimpleNamespace(encode_batch_fast=encode_batch_fast)
    texts = some_texts(20, 100)
    texts += ["", " ", "été ñandú, x́y", "don't stop 12 a1, b:\nc", "a \n \n b", "\n", "\n a", "a\n\nb c", "x <|endoftext|> y", "one endoftext two", "\u3042\u3044 \u6f22\u5b57."]
    plain = [x.ids for x in real.encode_batch_fast(texts, add_special_tokens=False)]
    for _ in range(2):
        assert [list(np.frombuffer(b, dtype="<u4")) for b in coder.encode(texts)] == plain
    assert len(asked) < 150  # 2,000 new words
    # runs of rows are bounded by bytes; a longer row is one by itself
    batch = pa.record_batch([pa.array(range(5)), pa.array(["x" * 10, "", "y" * packing.BYTES_AT_ONCE, "z", "z"])], names=["doc_id", "text"])
    assert [r.num_rows for r in packing._runs(batch)] == [2, 1, 2]
