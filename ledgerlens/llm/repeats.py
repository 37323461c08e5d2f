"""Repeated passages removed, with a count-min prefilter over windows of words.

A window is ``width`` consecutive words of a document. Every word that lies in a window which also
starts earlier (smaller id, or the same document further up) is removed; windows are judged on the
input. The work has two passes over the windows, so that most of them are never sent whole:

1. Documents are packed into chunks (about ``CHUNK_WORDS`` words, zstd) that are dealt by chunk number
   and checkpointed; later steps read them in place, only answers travel. Windows get two 64-bit
   hashes from the 128-bit hashes of their words; one names a slice of the window space.
2. Sketch: a chunk sends 32 bits of every distinct window to the window's slice: its part of the
   slice's sketch, kept sparse. A slice adds up the parts of all chunks in two rows of counters; the
   smaller counter of a window is at least the number of chunks that hold it. The answer is one bit a
   window: counted twice or more. Slices are sized by the number of words, so the sketch grows with
   the input and no part of it is broadcast.
3. Exact: a chunk sends only the windows so estimated, once each (its own earliest), with 80 bits of
   hash, document id and place. Equal windows meet in one group, which answers with the places of all
   but the earliest. A window that no other chunk holds can't be missed: repeats inside a chunk are
   known there. A window that everyone holds counts once per chunk, so hot passages arrive summed up.
4. Chunks mark the words that those windows cover and write what is left.

Cases: null text has no words and yields an empty text; a null id stands after all others; rows of one
id count as documents in the order of a hash of their text; of identical rows one keeps its words;
texts of under ``width`` words have no window; a text of any length is one chunk's (never cut); an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import pinned, row_key, shuffle_partitions

WIDTH = 20
CHUNK_WORDS = 500_000
SLICE_WORDS = 2_000_000
ROWS = 2
KNOWN_WORDS = 500_000  # word hashes that a task remembers at once

_U = np.uint64
_rng = np.random.default_rng(20250311)
_STEP = _rng.integers(1, 1 << 63, (2, 256), dtype=np.uint64) * _U(2) + _U(1)


class _Words(dict):
    """Word -> number, with both halves of the word's 128-bit hash by number."""

    def __init__(self):
        super().__init__()
        self.low: list[int] = []
        self.high: list[int] = []

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_128_intdigest(word)
        self.low.append(h & 0xFFFFFFFFFFFFFFFF)
        self.high.append(h >> 64)
        self[word] = n = len(self.low) - 1
        return n


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def window_hashes(texts: list[bytes], width: int, known: _Words | None = None) -> tuple[np.ndarray, ...]:
    """(h1, h2, place, document) of every window; place is its first word's number in all ``texts``."""
    known = _Words() if known is None else known
    lengths = np.zeros(len(texts), dtype=np.int64)
    numbers = []
    for i, t in enumerate(texts):
        words = t.split()
        lengths[i] = len(words)
        numbers.append(np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=len(words)))
    number = np.concatenate(numbers) if numbers else np.zeros(0, dtype=np.int64)
    total = max(0, len(number) - width + 1)
    out = []
    for side, halves in enumerate((known.low, known.high)):
        word = np.array(halves, dtype=np.uint64)[number] if len(number) else np.zeros(0, dtype=np.uint64)
        rolled = np.zeros(total, dtype=np.uint64)
        for k in range(width):
            rolled += word[k:k + total] * (_STEP[side, k % 256] + _U(k // 256))
        out.append(_mix(rolled))
    ends = np.cumsum(lengths)
    document = np.repeat(np.arange(len(texts)), lengths)[:total]
    whole = np.arange(total) + width <= ends[document] if total else np.zeros(0, dtype=bool)
    place = np.flatnonzero(whole)
    return out[0][whole], out[1][whole], place, document[whole]


_CHUNK = "chunk long, words long, size long, payload binary, ends binary, ids binary, no_id binary, keys binary"


def _pack(docs: DataFrame, chunk_words: int) -> DataFrame:
    """Chunks of documents: their texts, ids and keys in the order (id, key)."""

    def flush(held: list[tuple], number: int, words: int) -> pa.RecordBatch:
        held.sort(key=lambda x: (x[0] is None, x[0] or 0, x[1]))
        body = b"".join(x[2] for x in held)
        column = [number, words, len(body), zstandard.ZstdCompressor(level=3).compress(body), np.cumsum([len(x[2]) for x in held], dtype=np.int64).tobytes(),
                  np.array([x[0] or 0 for x in held], dtype=np.int64).tobytes(), np.array([x[0] is None for x in held], dtype=np.uint8).tobytes(),
                  np.array([x[1] for x in held], dtype=np.int64).tobytes()]
        kinds = [pa.int64()] * 3 + [pa.binary()] * 5
        return pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(column, kinds, strict=True)], names=[x.split()[0] for x in _CHUNK.split(", ")])

    def pack(batches) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        held: list[tuple] = []
        words = 0
        for batch in batches:
            ids, keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary())
            for ident, key, text in zip(ids, keys, texts, strict=True):
                body = text.as_py()
                held.append((ident, key, body))
                words += len(body.split())
                if words >= chunk_words:
                    yield flush(held, number, words)
                    held, words, number = [], 0, number + 1
        if held:
            yield flush(held, number, words)

    return docs.mapInArrow(pack, _CHUNK)


def _array(table, column: str, kind: str, row: int = 0) -> np.ndarray:
    return np.frombuffer(table.column(column)[row].as_py(), dtype=kind)


def _texts(payload: bytes, size: int, ends: bytes) -> list[bytes]:
    body = zstandard.ZstdDecompressor().decompress(payload, max_output_size=size) if size else b""
    ends = np.frombuffer(ends, dtype=np.int64).tolist()
    return [body[lo:hi] for lo, hi in zip([0, *ends[:-1]], ends, strict=True)]


def _distinct(texts: list[bytes], width: int, slices: int, known: _Words | None = None):
    """Windows of a chunk by (slice, h1, h2, place): for each distinct one its slice, hashes, earliest
    place and document; and the places of its repeats within the chunk. Documents of a chunk stand in
    order, so the smallest place is the earliest."""
    h1, h2, place, document = window_hashes(texts, width, known)
    order = np.lexsort((h2, h1))  # stable: places stay ascending
    h1, h2, place, document = h1[order], h2[order], place[order], document[order]
    first = np.ones(len(h1), dtype=bool)
    first[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
    repeats = place[~first]
    h1, h2, place, document = h1[first], h2[first], place[first], document[first]
    which = ((h2 >> _U(32)) * _U(slices) >> _U(32)).astype(np.int64)
    order = np.argsort(which, kind="stable")
    return which[order], h1[order], h2[order], place[order], document[order], repeats


def _edges(which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    names, start = np.unique(which, return_index=True)
    return names, start, np.append(start, len(which))[1:]


def _sketch_parts(chunks: DataFrame, width: int, slices: int) -> DataFrame:
    """(slice, chunk, cells): 32 bits of each distinct window, by slice."""

    def emit(batches) -> Iterator[pa.RecordBatch]:
        known = _Words()
        for batch in batches:
            for row in range(batch.num_rows):
                if len(known) > KNOWN_WORDS:
                    known = _Words()
                c = {n: batch.column(n)[row].as_py() for n in ("chunk", "size", "payload", "ends")}
                which, h1, *_ = _distinct(_texts(c["payload"], c["size"], c["ends"]), width, slices, known)
                names, start, end = _edges(which)
                cells = (h1 >> _U(32)).astype(np.uint32)
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(np.full(len(names), c["chunk"]), pa.int64()),
                                                  pa.array([cells[lo:hi].tobytes() for lo, hi in zip(start, end, strict=True)], pa.binary())], names=["slice", "chunk", "cells"])

    return chunks.select("chunk", "size", "payload", "ends").mapInArrow(emit, "slice long, chunk long, cells binary")


def _estimate(parts: pa.Table) -> pa.Table:
    """One slice: merge the sketches of all chunks, then one bit a window: estimated in two chunks or more."""
    cells = [_array(parts, "cells", "u4", row) for row in range(parts.num_rows)]
    width = 1 << max(10, int(2 * sum(map(len, cells))).bit_length())

    def place(row: int, x: np.ndarray) -> np.ndarray:
        return (_mix(x.astype(np.uint64) + _STEP[0, row]) & _U(width - 1)).astype(np.int64)

    rows = []
    for row in range(ROWS):
        counters = np.zeros(width, dtype=np.uint32)
        for x in cells:
            np.add.at(counters, place(row, x), 1)
        rows.append(counters)
    bits = [np.packbits(np.minimum.reduce([rows[r][place(r, x)] for r in range(ROWS)]) > 1).tobytes() for x in cells]
    return pa.table({"to": parts.column("chunk"), "slice": parts.column("slice"), "bits": pa.array(bits, pa.binary())})


_CLAIM = "slice long, chunk long, h1 binary, h2 binary, place binary, runs binary, ids binary, no_id binary, keys binary"


def _claims(width: int, slices: int):
    def claims(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        """Windows of a chunk that the sketch counts twice or more, with their documents as runs; the
        row of slice -1 has the places of repeats within the chunk."""
        names = [x.split()[0] for x in _CLAIM.split(", ")]
        rows: list[tuple] = []
        if chunk.num_rows:
            c = {n: chunk.column(n)[0].as_py() for n in ("chunk", "size", "payload", "ends")}
            ids, no_id, keys = _array(chunk, "ids", "i8"), _array(chunk, "no_id", "u1"), _array(chunk, "keys", "i8")
            which, h1, h2, place, document, repeats = _distinct(_texts(c["payload"], c["size"], c["ends"]), width, slices)
            rows.append((-1, c["chunk"], b"", b"", np.sort(repeats).astype(np.uint32).tobytes(), b"", b"", b"", b""))
            at = dict(zip(answers.column("slice").to_pylist(), range(answers.num_rows), strict=True))
            for name, lo, hi in zip(*(x.tolist() for x in _edges(which)), strict=True):
                wanted = np.unpackbits(_array(answers, "bits", "u1", at[name]), count=hi - lo).astype(bool)
                sent = lo + np.flatnonzero(wanted)
                if not len(sent):
                    continue
                sent = sent[np.argsort(place[sent])]
                docs, runs = np.unique(document[sent], return_counts=True)
                rows.append((name, c["chunk"], h1[sent].tobytes(), (h2[sent] & _U(0xFFFF)).astype(np.uint16).tobytes(), place[sent].astype(np.uint32).tobytes(),
                             runs.astype(np.uint32).tobytes(), ids[docs].tobytes(), no_id[docs].tobytes(), keys[docs].tobytes()))
        columns = list(zip(*rows, strict=True)) or [()] * len(names)
        return pa.table([pa.array(x, pa.int64() if i < 2 else pa.binary()) for i, x in enumerate(columns)], names=names)

    return claims


def _later(claims: pa.Table) -> pa.Table:
    """One slice: places of every window but the earliest of its kind, by chunk."""
    chunks = np.array(claims.column("chunk").to_pylist(), dtype=np.int64)
    each = range(claims.num_rows)
    if claims.column("slice")[0].as_py() < 0:
        return pa.table({"to": claims.column("chunk"), "later": claims.column("place")})
    h1, h2, place = (np.concatenate([_array(claims, c, k, r) for r in each]) for c, k in (("h1", "u8"), ("h2", "u2"), ("place", "u4")))
    runs = np.concatenate([_array(claims, "runs", "u4", r) for r in each])
    run_rows = np.repeat(np.arange(len(chunks)), [len(_array(claims, "runs", "u4", r)) for r in each])
    ids, no_id, keys = (np.concatenate([_array(claims, c, k, r) for r in each]) for c, k in (("ids", "i8"), ("no_id", "u1"), ("keys", "i8")))
    # rank of every run in the order (id, key, chunk); places of a run ascend
    order = np.lexsort((chunks[run_rows], keys, ids, no_id))
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    rank, row = np.repeat(rank, runs), np.repeat(run_rows, runs)
    order = np.lexsort((rank, h2, h1))
    h1, h2, place, row = h1[order], h2[order], place[order], row[order]
    again = np.zeros(len(h1), dtype=bool)
    again[1:] = (h1[1:] == h1[:-1]) & (h2[1:] == h2[:-1])
    row, place = row[again], place[again]
    order = np.argsort(row, kind="stable")
    row, place = row[order], place[order]
    names, start, end = _edges(row)
    return pa.table({"to": pa.array(chunks[names], pa.int64()), "later": pa.array([place[lo:hi].tobytes() for lo, hi in zip(start, end, strict=True)], pa.binary())})


def _strip(width: int):
    def strip(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        """Documents of a chunk without the words that repeated windows cover."""
        if not chunk.num_rows:
            return pa.table({"doc_id": pa.array([], pa.int64()), "n_words": pa.array([], pa.int64()), "n_removed": pa.array([], pa.int64()), "kept": pa.array([], pa.string())})
        texts = _texts(*(chunk.column(n)[0].as_py() for n in ("payload", "size", "ends")))
        total = chunk.column("words")[0].as_py()
        change = np.zeros(total + width + 1, dtype=np.int32)
        for row in range(answers.num_rows):
            place = _array(answers, "later", "u4", row).astype(np.int64)
            change[place] += 1  # a place comes once per answer
            change[place + width] -= 1
        gone = np.cumsum(change)[:total] > 0
        ids = [None if no else i for i, no in zip(_array(chunk, "ids", "i8").tolist(), _array(chunk, "no_id", "u1"), strict=True)]
        sizes, removed, kept, at = [], [], [], 0
        for t in texts:
            words = t.split()
            mask = gone[at:at + len(words)]
            at += len(words)
            sizes.append(len(words))
            removed.append(int(mask.sum()))
            kept.append(b" ".join([words[i] for i in np.flatnonzero(~mask).tolist()] if removed[-1] else words))
        return pa.table({"doc_id": pa.array(ids, pa.int64()), "n_words": pa.array(sizes, pa.int64()), "n_removed": pa.array(removed, pa.int64()),
                         "kept": pa.array(kept, pa.binary()).cast(pa.string())})

    return strip


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH, chunk_words: int = CHUNK_WORDS,
                   slice_words: int = SLICE_WORDS) -> DataFrame:
    """doc_id, n_words, n_removed and kept (the words left, joined by blanks) of every row."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), row_key(F.col(doc_id), F.col(text)).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    places = shuffle_partitions(docs.sparkSession)
    chunks = pinned(_pack(rows, chunk_words).repartition(places, "chunk"))
    total = chunks.agg(F.sum("words").alias("s")).first()["s"] or 0
    slices = int(max(1, -(-total // slice_words)))
    estimated = _sketch_parts(chunks, width, slices).groupBy("slice").applyInArrow(_estimate, "to long, slice long, bits binary")
    claims = chunks.groupBy("chunk").cogroup(estimated.groupBy("to")).applyInArrow(_claims(width, slices), _CLAIM)
    # the places of repeats within a chunk (slice -1) go to a group of their own
    alone = F.when(F.col("slice") < 0, F.col("chunk")).otherwise(F.lit(-1))
    later = claims.withColumn("alone", alone).groupBy("slice", "alone").applyInArrow(_later, "to long, later binary")
    return chunks.groupBy("chunk").cogroup(later.groupBy("to")).applyInArrow(_strip(width), "doc_id long, n_words long, n_removed long, kept string")
