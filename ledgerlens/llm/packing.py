"""Best-two-fit packing of token sequences.

Tokens: texts are cut at single blanks between words, where the byte-level tokenizer always starts
a new piece, so each distinct word is encoded once per worker and looked up once per run of texts; texts with
other white space around a blank, or with an added token of the tokenizer in them, are encoded whole. Documents longer than a sequence are cut into
full pieces, the first of which may be shorter.

Packing: how a bin is filled depends only on which lengths are left, not on which documents have
them. So the lengths are counted (one number per length, at most ``capacity`` of them), and the
algorithm runs on these counts: fill greedily with the longest piece that fits, then replace the
bin's smallest piece by two unpacked ones that fill the gap more tightly, as long as that works;
the same filling is repeated as often as the counts allow in one step. The plan's size depends on
the number of lengths, not of documents. Pieces get their rank among equal lengths from counts per
task, and the plan turns (length, rank) into sequence and offset.

Cases: null text is empty and gives one piece with the end id alone; repeated rows are packed one by
one; ties in length are ranked in reading order of the tasks; an empty table gives no pieces.
"""

from __future__ import annotations

import sys
import types
import zlib
from array import array
from collections.abc import Iterator
from itertools import islice
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import pinned

CAPACITY = 1024
END_ID = 2
#: words after which a Python worker starts anew; those found till then are kept until it does so again
REMEMBERED = 300_000
#: of texts that are cut at once
BYTES_AT_ONCE = 1 << 22
#: words encoded as one text
JOINED = 200
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task long, nth long"


class WordEncoder:
    """Text -> ids as little-endian unsigned 32-bit bytes, with a memory of words."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        self.blank = np.zeros(max(vocabulary.values()) + 1, dtype=bool)  # tokens that begin with a blank
        self.blank[[i for token, i in vocabulary.items() if token.startswith("\u0120")]] = True
        self.first: dict[str, bytes] = {}
        self.rest: dict[str, bytes] = {}
        self.before: tuple[dict[str, bytes], dict[str, bytes]] = ({}, {})  # what first and rest held before they started anew

    def ids(self, texts: list[str]) -> list[bytes]:
        """Letters after a blank are encoded many at once: the tokenizer starts anew at each blank, and tokens
        that begin with one show where."""
        letters = [i for i, t in enumerate(texts) if t[:1] == " " and t[1:].isalpha()]
        out: list[bytes | None] = [None] * len(texts)
        runs = [letters[lo:lo + JOINED] for lo in range(0, len(letters), JOINED)]
        joined = ["".join(map(texts.__getitem__, run)) for run in runs]
        for run, text, x in zip(runs, joined, self.tokenizer.encode_batch_fast(joined, add_special_tokens=False), strict=True):
            found = np.array(x.ids, dtype=np.uint32)
            at = (4 * np.flatnonzero(self.blank[found])).tolist()
            if len(at) == len(run) and not any(a in text for a in self.added):
                body = found.tobytes()
                for i, lo, hi in zip(run, at, [*at[1:], len(body)], strict=True):
                    out[i] = body[lo:hi]
        alone = [i for i, ids in enumerate(out) if ids is None]
        for i, x in zip(alone, self.tokenizer.encode_batch_fast([texts[i] for i in alone], add_special_tokens=False), strict=True):
            out[i] = array("I", x.ids).tobytes()
        return out

    def learn(self, first: set[str], rest: set[str]) -> None:
        """Remember new words: ``first`` as they stand, ``rest`` with the blank before them. Words
        made of lines, or of letters and marks after them, are put together from their parts, which
        the tokenizer never joins. Words with white space at an end are not remembered."""
        if len(self.first) + len(self.rest) > REMEMBERED:
            self.before, self.first, self.rest = (self.first, self.rest), {}, {}
        for memory, old, wanted in ((self.first, self.before[0], first), (self.rest, self.before[1], rest)):
            memory.update((w, old[w]) for w in wanted if w in old)
        first, rest = first.difference(self.first), rest.difference(self.rest)
        after = set(filter(str.isalpha, rest))
        start, odd = set(first), rest.difference(after)
        marked: tuple[list[str], ...] = ([], [], [])  # word of rest, its letters, the marks after them
        made: tuple[list, ...] = ([], [], [])  # word of rest, number of its parts, all parts: the first after a blank
        for word in odd:
            stem = word.rstrip(MARKS)
            if stem.isalpha():
                marked[0].append(word)
                marked[1].append(stem)
                marked[2].append(word[len(stem):])
                continue
            parts = _parts_of(word)
            if len(parts) > 1:
                made[0].append(word)
                made[1].append(len(parts))
                made[2].extend(parts)
                after.add(parts[0])
                start.update(parts[1:])
            else:
                after.add(word)
        after.update(marked[1])
        start.update(marked[2])
        for memory, words, lead in ((self.first, start, ""), (self.rest, after, " ")):
            known = [w for w in words.difference(memory) if w.isalpha() or w.strip() == w != "" or w == "\n"]
            memory.update(zip(known, self.ids([lead + w for w in known]), strict=True))
        letters, marks = map(self.rest.__getitem__, marked[1]), map(self.first.__getitem__, marked[2])
        self.rest.update(zip(marked[0], map(add, letters, marks), strict=True))
        parts = iter(made[2])
        for word, n in zip(*made[:2], strict=True):
            self.rest[word] = b"".join([self.rest[next(parts)], *map(self.first.__getitem__, islice(parts, n - 1))])

    def encode(self, texts: pa.Array | list[str]) -> list[bytes]:
        """Each distinct word of the texts is looked up once."""
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        split = pc.split_pattern(column, " ")
        coded = split.flatten().dictionary_encode()
        words, at = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy()
        ends = np.cumsum(pc.list_value_length(split).to_numpy())  # every text has a word, if an empty one
        begins = ends - np.diff(ends, prepend=0)
        firsts = [words[i] for i in at[begins].tolist()]
        inside = np.ones(len(at), dtype=bool)
        inside[begins] = False
        used = np.bincount(at[inside], minlength=len(words)) > 0
        first, rest = list(map(self.first.get, firsts)), list(map(self.rest.get, words))
        new = [i for i in np.flatnonzero(used).tolist() if rest[i] is None]
        self.learn({w for w, ids in zip(firsts, first, strict=True) if ids is None}, {words[i] for i in new})
        for i in new:
            rest[i] = self.rest.get(words[i])
        first = [self.first.get(w) if ids is None else ids for w, ids in zip(firsts, first, strict=True)]
        # a blank next to other white space is no cut; an added token may reach over blanks
        loose = np.array([ids is None or w == "\n" for w, ids in zip(words, rest, strict=True)], dtype=bool)[at]
        loose[begins] = [ids is None or w == "\n" for w, ids in zip(firsts, first, strict=True)]
        whole = np.logical_or.reduceat(loose, begins) if len(begins) else loose
        for added in self.added:
            whole |= pc.match_substring(column, added).to_numpy(zero_copy_only=False)
        out = [b"" if w else b"".join([ids, *map(rest.__getitem__, at[lo + 1:hi].tolist())])
               for w, ids, lo, hi in zip(whole.tolist(), first, begins.tolist(), ends.tolist(), strict=True)]
        for i in np.flatnonzero(whole).tolist():
            out[i] = self.ids([column[i].as_py()])[0]
        return out


def _loose(word: str) -> bool:
    """Empty, or with white space at an end: the text can't be cut there."""
    return not word or word[0].isspace() or word[-1].isspace()


MARKS = ".,;:!?#*$%&|<>()-"


def _parts_of(word: str) -> list[str]:
    """Lines with the breaks between them, letters and the marks after them; one part if unsure."""
    if "\n" not in word:
        stem = word.rstrip(MARKS)
        return [stem, word[len(stem):]] if len(stem) < len(word) and stem.isalpha() else [word]
    lines = word.split("\n")
    if any(map(_loose, lines)):
        return [word]
    out = _parts_of(lines[0])
    for line in lines[1:]:
        out += ["\n", line] if line.isalpha() else ["\n", *_parts_of(line)]
    return out


def encoder(path: str) -> WordEncoder:
    """One per worker process, kept over tasks."""
    kept = sys.modules.setdefault("_word_encoders", types.ModuleType("_word_encoders"))
    if path not in kept.__dict__:
        kept.__dict__[path] = WordEncoder(path)
    return kept.__dict__[path]


def _runs(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows with at most ``BYTES_AT_ONCE`` of text, or a single one."""
    ends = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False), dtype=np.int64)
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + BYTES_AT_ONCE, "right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, doc_id: str = "doc_id",
           text: str = "text", keep_ids: bool = False) -> DataFrame:
    """One row per piece; ``nth`` numbers the pieces of one length in one task. With ``keep_ids``
    the ids come along as little-endian unsigned 32-bit bytes."""
    end = int(end_id).to_bytes(4, "little")

    def cut(batches) -> Iterator[pa.RecordBatch]:
        import os

        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        task, seen, coder = TaskContext.get().partitionId(), np.zeros(capacity + 1, dtype=np.int64), encoder(path)
        names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth", "ids"][:8 if keep_ids else 7]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        for batch in batches:
            for part in _runs(batch):
                rows: list[tuple] = []
                for ident, body in zip(part.column(0).to_pylist(), coder.encode(part.column(1)), strict=True):
                    body += end
                    total, start = len(body) // 4, 0
                    stop = total % capacity or capacity
                    number = 0
                    while start < total:
                        ids = body[4 * start:4 * stop]
                        size = stop - start
                        rows.append((ident, number, start, size, zlib.crc32(ids), task, int(seen[size]), ids))
                        seen[size] += 1
                        start, stop, number = stop, stop + capacity, number + 1
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(columns[i], kinds[i]) for i in range(len(names))], names=names)

    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return narrow.mapInArrow(cut, PIECES + (", ids binary" if keep_ids else ""))


def fill_one(counts: np.ndarray, capacity: int) -> dict[int, int]:
    """How many pieces of each length the next bin takes."""
    need: dict[int, int] = {}
    gap = capacity
    left = counts.copy()

    def take(size: int, number: int = 1) -> None:
        need[size] = need.get(size, 0) + number
        left[size] -= number

    while gap > 0 and len(fit := np.flatnonzero(left[:gap + 1] > 0)):
        size = int(fit[-1])
        number = min(int(left[size]), gap // size)
        take(size, number)
        gap -= number * size
    while gap > 0 and need:
        small = min(need)
        pair = best_pair(left, gap + small)
        if pair is None or sum(pair) <= small:
            break
        need[small] -= 1
        if not need[small]:
            del need[small]
        for size in pair:
            take(size)
        left[small] += 1
        gap += small - sum(pair)
    return need


def best_pair(left: np.ndarray, room: int) -> tuple[int, int] | None:
    """Two unpacked lengths with the largest sum up to ``room``."""
    sizes = np.flatnonzero(left[:room + 1] > 0)
    if not len(sizes):
        return None
    other = np.searchsorted(sizes, room - sizes, "right") - 1  # the largest partner of each
    ok = (other >= 0)
    partner = np.where(ok, sizes[np.maximum(other, 0)], 0)
    same = ok & (partner == sizes) & (left[sizes] < 2)
    other = np.where(same, other - 1, other)
    ok &= other >= 0
    if not ok.any():
        return None
    sums = np.where(ok, sizes + sizes[np.maximum(other, 0)], -1)
    best = int(np.argmax(sums))
    return int(sizes[best]), int(sizes[other[best]])


def plan_bins(counts: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Rows (length, first rank, sequence, per sequence, offset): ranks from the first one on fill
    the sequences from ``sequence`` on, ``per sequence`` pieces each, beginning at ``offset``."""
    left = np.zeros(capacity + 1, dtype=np.int64)
    for size, n in counts.items():
        left[size] = n
    used = np.zeros(capacity + 1, dtype=np.int64)
    rows, sequence = [], 0
    while left.any():
        need = fill_one(left, capacity)
        times = min(int(left[size]) // number for size, number in need.items())
        offset = 0
        for size, number in sorted(need.items(), reverse=True):
            rows.append((size, int(used[size]), sequence, number, offset))
            used[size] += times * number
            left[size] -= times * number
            offset += size * number
        sequence += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def place(ranked: DataFrame, plan: np.ndarray) -> DataFrame:
    """Adds sequence_id and offset to rows with (length, rank). The plan goes along with the code:
    its size is bounded by the number of lengths."""
    key = plan[:, 0] * (1 << 44) + plan[:, 1]

    def look_up(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            at = plan[np.searchsorted(key, size * (1 << 44) + rank, "right") - 1]
            behind = rank - at[:, 1]
            arrays = [batch.column(n) for n in batch.schema.names if n != "rank"]
            names = [n for n in batch.schema.names if n != "rank"]
            yield pa.RecordBatch.from_arrays(
                [*arrays, pa.array(at[:, 2] + behind // at[:, 3]), pa.array(at[:, 4] + behind % at[:, 3] * size)],
                names=[*names, "sequence_id", "offset"])

    schema = ", ".join(f"{n} {k}" for n, k in ranked.dtypes if n != "rank") + ", sequence_id long, offset long"
    return ranked.mapInArrow(look_up, schema)


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, doc_id: str = "doc_id",
         text: str = "text", keep_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids) per piece."""
    cut = pinned(pieces(docs, path, capacity, end_id, doc_id, text, keep_ids))
    per_task = cut.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    before = per_task.select(
        F.col("task").alias("t"), F.col("length").alias("l"),
        F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("before"))
    # at most ``capacity`` rows
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    ranked = (cut.join(before, (F.col("task") == F.col("t")) & (F.col("length") == F.col("l")))
              .withColumn("rank", (F.col("before") + F.col("nth")).cast("long")).drop("t", "l", "before", "task", "nth"))
    return place(ranked, plan_bins(counts, capacity))


def write_sequences(packed: DataFrame, path: str, capacity: int = CAPACITY) -> None:
    """Packed sequences as Parquet: sequence_id and the ids of its pieces in order (binary). A
    sequence gathers at most ``capacity`` ids."""
    (packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
     .select("sequence_id", F.expr("aggregate(parts, X'', (a, p) -> concat(a, p.ids))").alias("ids"))
     .write.parquet(path))
