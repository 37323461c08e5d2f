"""Spelling variants by search schemes on suffix-rank intervals (bidirectional FM-index).

Words: maximal runs of ``[A-Za-z\\u00C0-\\u00FF]``, A-Z lower-cased, of at least 5 code points and 3
occurrences. Two words are near if one inserted, deleted or replaced code point turns one into the
other. A word's form is its near word of largest n (ties: smallest) if that has at least twice the
word's n; following forms leads to the root.

Search: a word is cut in two halves, and a near word keeps one of them. The scheme has two searches:
match the second half exactly against word ends and extend to the left across the first half with one
error; match the first half exactly against word beginnings and extend to the right. The index holds
the delimited vocabulary in both directions: the sorted words and the sorted mirror images, each
with the BWT of its suffix order and the rank of every (letter, row); extending to the right is
extending the mirror image to the left. An interval of suffix ranks is extended by a letter with
one binary search per bound; extending by the delimiter gives the number of the whole word. Replaced
letters look for words of the same length, inserted ones for words one longer; deletions are those
pairs turned round.

Distribution: a query and all words that it can meet on one side share the length sought and the end
(or beginning) that every match keeps, so index shards are dealt by the hash of both: every shard
holds words and the queries that can match there, nothing is compared with a whole vocabulary. Shards
are sized by the number of words. A group (length, end) of more than ``SHARD_WORDS`` words is cut into
pieces by hash and its queries go to every piece. Pieces are built and searched on whole arrays.

Cases: null text has no words; a null id counts as an empty string before the colon; repeated rows
count one by one; ``\\u00D7`` and ``\\u00F7`` lie in the run's range and count as letters; words of any
length are kept whole; ties go to the smallest word; an empty table or vocabulary gives no rows;
other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import pinned, shuffle_partitions

MIN_LETTERS = 5
MIN_COUNT = 3
ODD = 97  # a run whose checksum this divides loses a letter
SHARD_WORDS = 50_000
FLUSH_WORDS = 200_000
EXPAND = 1 << 20  # rows of intervals that one step enumerates at once
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_RUN = re.compile(rb"(?:[a-z]+|\xc3[\x80-\xbf])+")  # UTF-8 of U+00C0 to U+00FF is C3 80 to C3 BF


def _shortened(run: bytes, h: int) -> bytes:
    letters = run.decode()
    at = h % len(letters)
    return (letters[:at] + letters[at + 1:]).encode()


def count_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n) of all runs, those with a checksum divisible by ``ODD`` without one letter."""

    def emit(batches) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()).cast(pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

        crc32 = zlib.crc32
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())
            for ident, body in zip(ids, texts, strict=True):
                start = crc32(f"{ident}:".encode())
                own = Counter(_RUN.findall(body.as_py().translate(_LOWER)))
                for run in [run for run in own if crc32(run, start) % ODD == 0]:
                    n = own.pop(run)
                    counts[_shortened(run, crc32(run, start))] += n  # not into own: its checksum is settled
                counts.update(own)
                if len(counts) > FLUSH_WORDS:
                    yield flush()
                    counts = Counter()
        if counts:
            yield flush()

    rows = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.coalesce(F.col(text), F.lit("")))
    return rows.mapInArrow(emit, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


class SuffixRanks:
    """FM-index of strings without byte 0, sorted and distinct: BWT of the suffixes of the strings, each
    ended by a delimiter of its own, ordered as the strings are."""

    def __init__(self, strings: list[bytes]):
        text = np.frombuffer(b"\0".join([*strings, b""]), dtype=np.uint8)
        self.count, n = len(strings), len(text)
        self.stride = n + 1
        ends = text == 0
        rank = np.where(ends, np.cumsum(ends) - 1, self.count + text.astype(np.int64))
        step, places = 1, np.arange(n)
        while True:  # prefix doubling; a suffix is told apart by its delimiter at the latest
            after = rank[np.minimum(places + step, n - 1)]
            key = np.where(rank < self.count, rank * (n + 256), rank * (n + 256) + after)
            order = np.argsort(key, kind="stable")
            new = np.ones(n, dtype=np.int64)
            new[1:] = key[order[1:]] != key[order[:-1]]
            rank = np.empty(n, dtype=np.int64)
            rank[order] = np.cumsum(new) - 1
            if rank[order[-1]] == n - 1:
                break
            step *= 2
        self.bwt = text[order - 1]
        rows = np.argsort(self.bwt, kind="stable")
        self.ranks = self.bwt[rows].astype(np.int64) * self.stride + rows
        self.letters = np.unique(self.bwt[self.bwt > 0])

    def extend(self, letter: np.ndarray, row: np.ndarray) -> np.ndarray:
        """First row, among suffixes that begin with the letter, whose rest is ranked at ``row`` or above."""
        return np.searchsorted(self.ranks, letter.astype(np.int64) * self.stride + row)

    def branches(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(interval, letter) for every letter that stands before a suffix of the interval."""
        if not len(low):
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint8)
        wide = high - low > len(self.letters)
        at = np.flatnonzero(wide)
        found = [(np.repeat(at, len(self.letters)), np.tile(self.letters, len(at)))]
        at = np.flatnonzero(~wide)
        size = (high - low)[at]
        for part in np.split(np.arange(len(at)), np.flatnonzero(np.diff(np.cumsum(size) // EXPAND)) + 1):
            own = np.repeat(at[part], size[part])
            row = np.arange(len(own)) - np.repeat(np.cumsum(size[part]) - size[part], size[part]) + low[own]
            pairs = np.unique(own.astype(np.int64) * 256 + self.bwt[row])
            pairs = pairs[pairs % 256 > 0]
            found.append((pairs // 256, (pairs % 256).astype(np.uint8)))
        return np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])


def one_error(index: SuffixRanks, queries: np.ndarray, exact: int, longer: bool) -> tuple[np.ndarray, np.ndarray]:
    """(query, string) pairs with one replaced letter (or, if ``longer``, one letter more in the string)
    outside the last ``exact`` letters. ``queries``: one row of letters per query, of equal length."""
    length = queries.shape[1]
    who = np.arange(len(queries))
    low, high = np.zeros(len(who), dtype=np.int64), np.full(len(who), index.count, dtype=np.int64)
    bad_who, bad_low, bad_high = (np.zeros(0, dtype=np.int64) for _ in range(3))

    def step(who, low, high, letter):
        low, high = index.extend(letter, low), index.extend(letter, high)
        some = low < high
        return who[some], low[some], high[some]

    for done in range(length + 1):
        more = done < length
        if done >= exact and len(who) and (more or longer):
            state, letter = index.branches(low, high)
            if not longer:
                other = letter != queries[who[state], length - 1 - done]
                state, letter = state[other], letter[other]
            new = step(who[state], low[state], high[state], letter)
        else:
            new = None
        if more:
            # a replaced letter takes the place of the query's own, an inserted one stands before it
            if longer and new:
                bad_who, bad_low, bad_high = (np.concatenate(x) for x in zip((bad_who, bad_low, bad_high), new, strict=True))
            bad_who, bad_low, bad_high = step(bad_who, bad_low, bad_high, queries[bad_who, length - 1 - done])
            who, low, high = step(who, low, high, queries[who, length - 1 - done])
            if longer:
                new = None
        if new:
            bad_who, bad_low, bad_high = (np.concatenate(x) for x in zip((bad_who, bad_low, bad_high), new, strict=True))
    end = np.zeros(len(bad_who), dtype=np.uint8)
    bad_who, bad_low, _ = step(bad_who, bad_low, bad_high, end)
    pairs = np.unique(bad_who * (index.count + 1) + bad_low)
    return pairs // (index.count + 1), pairs % (index.count + 1)


def _search(shard: pa.Table) -> pa.Table:
    """Near pairs of one side and shard, from its words (target null) and its queries."""
    mirrored = shard.column("side")[0].as_py() == 1
    turn = -1 if mirrored else 1
    words, counts, targets = (shard.column(c).to_pylist() for c in ("word", "n", "target"))
    held = sorted({(w.encode("latin-1")[::turn], n) for w, n, t in zip(words, counts, targets, strict=True) if t is None})
    asked: dict[tuple[int, int], list[tuple[bytes, int]]] = {}
    # pieces of one group may meet in a shard; a query is asked once there and finds the words of both
    for w, n, t in sorted({x for x in zip(words, counts, targets, strict=True) if x[2] is not None}):
        asked.setdefault((len(w), t), []).append((w.encode("latin-1")[::turn], n))
    out: list[tuple[bytes, bytes, int]] = []
    if held and asked:
        index = SuffixRanks([w for w, _ in held])
        for (length, target), queries in asked.items():
            first_half = length // 2
            letters = np.frombuffer(b"".join(w for w, _ in queries), dtype=np.uint8).reshape(len(queries), length)
            exact = first_half if mirrored else length - first_half
            for q, s in zip(*(x.tolist() for x in one_error(index, letters, exact, target > length)), strict=True):
                (word, n), (near, near_n) = queries[q], held[s]
                word, near = word[::turn], near[::turn]
                if target == length:
                    out.append((word, near, near_n))
                elif mirrored or near[:first_half] != word[:first_half]:  # else the other side finds it
                    out += [(word, near, near_n), (near, word, n)]
    columns = list(zip(*out, strict=True)) or [()] * 3
    return pa.table([pa.array([x.decode("latin-1") for x in c], pa.string()) for c in columns[:2]] + [pa.array(columns[2], pa.int64())], names=["word", "near", "near_n"])


def near_words(words: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(word, near, near_n), both ways, each pair once, of the distinct ``words`` (word, n)."""
    total = words.count()
    shards = int(max(shuffle_partitions(words.sparkSession), -(-total // shard_words)))
    size = F.length("word")

    def entries(side: int, target: Column, query: bool) -> DataFrame:
        # letters at this end (side 0) or beginning that every match of a query for this length keeps
        keep = F.floor((target if side == 0 else target - 1) / 2).cast("int")
        end = F.right("word", keep) if side == 0 else F.left("word", keep)
        return words.select("word", "n", F.lit(side).alias("side"), target.cast("int").alias("sought"), end.alias("end"), F.lit(query).alias("query"))

    held = entries(0, size, False).unionByName(entries(1, size, False))
    asked = entries(0, size, True)
    for side, more in ((0, 1), (1, 0), (1, 1)):
        asked = asked.unionByName(entries(side, size + more, True))
    group = ["side", "sought", "end"]
    large = (held.groupBy(*group).agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > shard_words)
             .select(*group, F.ceil(F.col("m") / shard_words).cast("int").alias("pieces")))
    rows = held.unionByName(asked).join(large, group, "left").withColumn("pieces", F.coalesce("pieces", F.lit(1)))
    rows = rows.withColumn("piece", F.explode(F.when(F.col("query"), F.sequence(F.lit(0), F.col("pieces") - 1))
                                              .otherwise(F.array(F.pmod(F.hash("word"), F.col("pieces"))))))
    rows = rows.select(F.pmod(F.xxhash64(*group, "piece"), F.lit(shards)).cast("int").alias("shard"), "side", "word", "n",
                       F.when(F.col("query"), F.col("sought")).alias("target"))
    return rows.groupBy("shard", "side").applyInArrow(_search, "word string, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): the end of every chain. n doubles with each form, so chains are
    short and end; every round doubles the distance, and is checkpointed."""
    now = pinned(forms.select("word", F.col("form").alias("root")))
    while True:
        further = now.select(F.col("word").alias("at"), F.col("root").alias("on"))
        new = pinned(now.join(further, F.col("root") == F.col("at"), "left")
                     .select("word", F.coalesce("on", "root").alias("root"), F.col("on").isNotNull().alias("moved")))
        moved = new.where("moved").limit(1).count()
        now = new.select("word", "root")
        if not moved:
            return now


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT,
             shard_words: int = SHARD_WORDS) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word."""
    counted = count_words(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")))
    words = pinned(counted.where((F.length("word") >= min_letters) & (F.col("n") >= min_count)))
    near = near_words(words, shard_words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))).alias("best"))
    best_n = -F.col("best.less")
    named = pinned(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(best_n >= 2 * F.col("n"), F.col("best.near")).alias("form"), F.when(best_n >= 2 * F.col("n"), best_n).alias("form_n")))
    ends = roots(named.where("form is not null"))
    return named.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
