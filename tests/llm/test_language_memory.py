"""Memory of language scoring."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa

from ledgerlens.llm import language


class Rows:
    """A frame that keeps the function it is mapped with."""

    def __init__(self, *columns):
        self.columns, self.dtypes = list(columns), [(c, "string") for c in columns]

    def mapInArrow(self, function, schema):
        self.function = function
        return self

    def select(self, *columns):
        return self

    where = select


def some_texts(n: int, words: int) -> list[str]:
    rng = np.random.default_rng(3)
    return [" ".join("".join(map(chr, rng.integers(97, 123, 6))) for _ in range(words)) for _ in range(n)]


def test_scores_of_many_texts_need_little_memory():
    texts = some_texts(400, 20) * 20 + [None, "", "\n", "été à l'école"]  # about 1.1 MB
    batch = pa.record_batch([pa.array(texts, pa.string())], names=["text"])
    model = np.random.default_rng(5).random((5, 1 << language.BUCKET_BITS)).astype(np.float32)
    read = language.score(Rows("text"), "text", model).function
    tracemalloc.start()
    got = next(read([batch])).column("ll").to_pylist()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30_000_000
    for i in (0, 399, 400, 7999, 8000, 8001, 8002, 8003):
        data = (" " + (texts[i] or "").lower() + " ").encode()
        codes, _ = language.trigram_codes(np.frombuffer(data, dtype=np.uint8), np.array([len(data)]))
        if len(codes):
            np.testing.assert_allclose(got[i], model[:, codes].astype(float).sum(axis=1) * min(len(codes), language.EVIDENCE) / len(codes), rtol=1e-12)
        else:
            assert got[i] is None
