import math
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest

from ledgerlens.llm import mixing, ngram_join, shards
from llm_helpers import make_docs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_components(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        least[find(i)].append(d)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [x for x in least[find(i)] if x is not None] if sets[i] else [d]
        out.append((d, len(sets[i]), min(ids) if ids and ids != [None] else None))
    return sorted(out, key=str)


def test_components_match_brute_force(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.component_ids(docs).collect()]
    assert sorted(got, key=str) == brute_components(rows)


def test_chains_of_near_copies_match_brute_force(spark):
    """A chain of texts each of which is near only to its neighbours, beside a shared passage."""
    words = [f"w{i}" for i in range(400)]
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, " ".join(words[i * 12:i * 12 + 120])) for i in range(20)]
    rows += [(100 + i, passage + " " + " ".join(f"u{i}x{j}" for j in range(40))) for i in range(30)]
    rows += [(200 + i, passage + f" tail{i}") for i in range(20)]
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.component_ids(make_docs(spark, rows)).collect()]
    assert sorted(got, key=str) == brute_components(rows)


def test_join_of_empty_table_and_dedupe(spark, docs):
    assert ngram_join.component_ids(make_docs(spark, [])).count() == 0
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    groups = {c for d, n, c in brute_components(rows) if n}
    got = [r for r in kept.select("doc_id", "text").collect()]
    assert sum(bool(shingles(r.text)) for r in got) == len(groups)
    assert sum(not shingles(r.text) for r in got) == sum(not shingles(t) for _, t in rows)


def test_prefix_choice_keeps_enough_tokens():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 7, 40, 400):
        for shared in (0, n // 3, n):
            dfs = np.sort(rng.integers(2, 50, shared))
            l, length = ngram_join.choose_prefix(n, dfs)
            if l:
                assert 1 <= l <= ngram_join.needed(n)
                assert length == n - math.ceil(0.75 * n) + l - (n - shared) <= shared
            else:
                assert n - math.ceil(0.75 * n) + 1 <= n - shared


def test_shards_have_equal_bytes_and_gapless_slots(spark, docs):
    got = shards.assign_shards(docs, 5).collect()
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = sorted(((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in rows), key=str)
    assert sorted(((r.doc_id, r["size"], r.text_crc32) for r in got), key=str) == want
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(5))
    assert shards.assign_shards(make_docs(spark, []), 5).count() == 0


@pytest.mark.parametrize("copies", [0, 3000])
def test_shards_split_hot_copies(spark, copies):
    rows = [(i, f"text number {i} " * (i % 7 + 1)) for i in range(4000)] + [(10_000 + i, "one hot text of copies") for i in range(copies)]
    got = shards.assign_shards(make_docs(spark, rows), 8, tolerance=0.01).groupBy("shard").sum("size").collect()
    sizes = [r[1] for r in got]
    assert len(sizes) == 8 and max(sizes) - min(sizes) <= 0.02 * sum(sizes) / 8 + 2 * 200


def test_written_shards_hold_every_row(spark, docs, tmp_path):
    shards.write_shards(docs, str(tmp_path / "out"), 3)
    back = spark.read.parquet(str(tmp_path / "out")).select("row.*")
    assert back.columns == docs.columns and back.exceptAll(docs).count() == 0 == docs.exceptAll(back).count()


def targets(sizes, weights=(5, 2, 1)):
    names = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    capped, total = set(), Fraction(3, 2) * sum(sizes.values())
    while True:
        free = [s for s in names if s not in capped]
        rest = total - sum(2 * sizes[s] for s in capped)
        share = {s: rest * w[s] / sum(w[x] for x in free) for s in free}
        above = {s for s in free if share[s] > 2 * sizes[s]}
        if not above:
            return {s: float(share.get(s, 2 * sizes[s])) for s in names}
        capped |= above


def test_mix_reaches_targets(spark, docs):
    plan = mixing.mix_plan(docs).collect()
    rows = [(r.doc_id, r.text, r.source) for r in docs.select("doc_id", "text", "source").collect()]
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(WORD.findall(t or ""))
    want = targets(sizes)
    assert sorted(((r.doc_id, r["size"], r.source) for r in plan), key=str) == sorted(((d, len(WORD.findall(t or "")), s) for d, t, s in rows), key=str)
    taken = Counter()
    for r in plan:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source])
        assert 0 <= r.copies <= 2
        taken[r.source] += r.copies * r["size"]
    longest = max(len(WORD.findall(t or "")) for _, t, _ in rows)
    assert all(abs(taken[s] - want[s]) <= longest for s in want)
    assert sorted(map(str, mixing.mix_plan(docs).collect())) == sorted(map(str, plan))


def test_mix_repeats_rows_as_planned(spark, docs):
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    plan = Counter()
    for r in mixing.mix_plan(docs).collect():
        plan[r.doc_id, r["size"]] += r.copies
    got = Counter((r.doc_id, len(WORD.findall(r.text or ""))) for r in mixed.collect())
    assert got == Counter({k: v for k, v in plan.items() if v})
    assert mixing.mix(make_docs(spark, [])).count() == 0
