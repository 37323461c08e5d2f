"""Source divergence, spelling variants and repeated passages against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import divergence, repeats, spelling
from llm_helpers import make_docs, prose

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


# ------------------------------------------------------------------ source divergence
def divergence_by_hand(rows, min_docs, top):
    term = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
    groups, held = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        words = term.findall((text or "").translate(LOWER))
        groups[lang or "", source or ""].update(words)
        held[lang or ""].update(set(words))
    out = set()
    for lang in {l for l, _ in groups}:
        own = {s: c for (l, s), c in groups.items() if l == lang}
        kept = [t for t, n in held[lang].items() if n >= min_docs]
        v, total = len(kept), sum(own.values(), Counter())

        def p(counts, kept=kept, v=v):
            n = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 5) // (n + 5 * v) for t in kept}

        q = p(total)
        for s, counts in own.items():
            mine = p(counts)
            pairs = [(o, sum(abs(mine[t] - x) for t, x in p(c).items())) for o, c in own.items() if o != s]
            terms = [(t, mine[t] - q[t]) for t in kept if counts[t] and mine[t] > q[t]]
            for part, items, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out |= {(lang, s, part, i, value, rank) for rank, (i, value) in enumerate(items[:most], 1)}
    return out


@pytest.mark.parametrize("top", [3, 50])
def test_divergence_matches_brute_force(spark, texts, top):
    rng = random.Random(3)
    rows = [(t, ["en", "de", None][i % 3], ["a", "b", None, "c", "@src"][i % 5]) for i, t in enumerate(texts)]
    rows += [(prose(rng, 60, 60, lang), lang, rng.choice("aabx")) for lang in ("en", "de") for _ in range(30)]
    rows += [rows[4], rows[4], (None, "zz", "only"), ("", "", ""), ("Ünïcode ünïcode ÜBER", "en", "b")] * 4
    docs = make_docs(spark, [(i, *r) for i, r in enumerate(rows)])
    got = divergence.audit(docs, min_docs=4, top=top).collect()
    assert len(got) == len({tuple(r) for r in got})
    assert {tuple(r) for r in got} == divergence_by_hand(rows, 4, top)


def test_divergence_merges_equal_values_of_different_cells(spark):
    # many ties: every term occurs once or twice in either source
    rows = [("alpha beta gamma delta", "en", "a"), ("alpha beta epsilon", "en", "b"), ("zeta eta theta alpha", "en", "a"), ("iota kappa", "en", "c")]
    got = {tuple(r) for r in divergence.audit(make_docs(spark, [(i, *r) for i, r in enumerate(rows)]), min_docs=1, top=4).collect()}
    assert got == divergence_by_hand(rows, 1, 4)


def test_divergence_of_an_empty_table_and_of_one_source(spark):
    docs = make_docs(spark, [(1, "one two", "en", "a")])
    assert divergence.audit(docs.limit(0)).count() == 0
    assert divergence.audit(docs).count() == 0  # one source, no kept term
    pair = divergence.audit(make_docs(spark, [(1, "one", "en", "a"), (2, None, "en", None)])).collect()
    assert {tuple(r) for r in pair} == {("en", "a", "pair", "", 0, 1), ("en", "", "pair", "a", 0, 1)}


def test_divergence_flushes_give_the_same(spark, texts, monkeypatch):
    docs = make_docs(spark, [(i, t, "en", "ab"[i % 2]) for i, t in enumerate(texts)])
    whole = {tuple(r) for r in divergence.audit(docs, min_docs=2).collect()}
    monkeypatch.setattr(divergence, "FLUSH_TERMS", 3)
    assert {tuple(r) for r in divergence.audit(docs, min_docs=2).collect()} == whole


# ------------------------------------------------------------------ spelling variants
def counted_by_hand(rows):
    n = Counter()
    for ident, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if ident is None else ident}:{run}".encode())
            n[run[:h % len(run)] + run[h % len(run) + 1:] if h % 97 == 0 else run] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def near_by_hand(words):
    near = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            shorter = w[:i] + w[i + 1:]
            if shorter in words:
                near[w].add(shorter)
                near[shorter].add(w)
    for a in words:
        for b in words:
            if len(a) == len(b) and sum(x != y for x, y in zip(a, b, strict=True)) == 1:
                near[a].add(b)
    return near


def variants_by_hand(rows):
    n = counted_by_hand(rows)
    near = near_by_hand(n)
    form = {}
    for w, m in n.items():
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * m else None
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def spelling_rows(texts):
    rng = random.Random(9)
    base = ["".join(rng.choice("abé") for _ in range(rng.randrange(4, 9))) for _ in range(60)]
    base += ["letter", "lettre", "leter", "letters", "lettér", "aaaaa", "aaaaaa", "aaaaaaa", "aabaa", "étéété", "éteété", "×÷×÷×", "x" * 400, "x" * 401]
    rows = [(i * 3, t) for i, t in enumerate(texts)]
    rows += [(i, " ".join(rng.choices(base, [1 + 40 // (k + 1) for k in range(len(base))], k=120))) for i in range(40)]
    rows.append((77, "planet " * 60 + "planat " * 20 + "plamat " * 5))  # a chain of forms
    return rows + [rows[2], rows[2], (None, texts[3]), (None, "Letter LETTER letterĀletter"), (5, None), (6, "")]


@pytest.mark.parametrize("shard_words", [50_000, 7])
def test_variants_match_brute_force(spark, texts, shard_words):
    rows = spelling_rows(texts)
    got = spelling.variants(make_docs(spark, rows), shard_words=shard_words).collect()
    want = variants_by_hand(rows)
    assert len(got) == len(want)
    assert {tuple(r) for r in got} == want
    assert any(r.form and r.root != r.form for r in got)


def test_no_words_no_variants(spark):
    docs = make_docs(spark, [(1, "few words here"), (2, None)])
    assert spelling.variants(docs).count() == 0 and spelling.variants(docs.limit(0)).count() == 0


def test_suffix_ranks_extend_like_a_scan():
    rng = random.Random(1)
    strings = sorted({bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 7))) for _ in range(80)})
    index = spelling.SuffixRanks(strings)
    for pattern in {s[k:] for s in strings for k in range(len(s))} | {b"abcabcabc"}:
        low, high = np.array([0]), np.array([index.count])
        for letter in reversed(pattern):
            c = np.array([letter])
            low, high = index.extend(c, low), index.extend(c, high)
        assert (high - low)[0] == sum(s.endswith(pattern) for s in strings)
        end = np.array([0])
        found = range(int(index.extend(end, low)[0]), int(index.extend(end, high)[0]))
        assert [strings[i] for i in found] == [s for s in strings if s == pattern]


# ------------------------------------------------------------------ repeated passages
def stripped_by_hand(rows, width):
    """Rows (doc_id, text) with distinct ids, in id order."""
    seen, out = set(), []
    for ident, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        words = [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]
        gone = set()
        for i in range(len(words) - width + 1):
            key = tuple(words[i:i + width])
            if key in seen:
                gone.update(range(i, i + width))
            seen.add(key)
        out.append((ident, len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)))
    return out


def repeat_rows(texts):
    rng = random.Random(21)
    rows = [(1000 - i, t) for i, t in enumerate(texts)]
    passage = prose(rng, 55, 3000)
    rows += [(i, prose(rng, 30, 3000) + " " + passage + " " + prose(rng, 25, 3000)) for i in range(1, 20)]
    rows += [(30 + i, " ".join(passage.split()[i:i + 20 + i % 3])) for i in range(12)]
    return rows + [(60, (passage + "\n") * 3), (None, passage), (61, " ".join(passage.split()[:19]))]


@pytest.mark.parametrize(("chunk_words", "slice_words"), [(500_000, 2_000_000), (300, 900), (1, 5000)])
def test_repeats_match_brute_force(spark, texts, chunk_words, slice_words):
    rows = repeat_rows(texts)
    got = repeats.remove_repeats(make_docs(spark, rows), chunk_words=chunk_words, slice_words=slice_words).collect()
    assert sorted(map(tuple, got), key=str) == sorted(stripped_by_hand(rows, 20), key=str)
    assert sum(r.n_removed for r in got) > 1000


def test_repeated_rows_keep_their_words_once(spark):
    rng = random.Random(2)
    a, b = prose(rng, 50, 3000), prose(rng, 30, 3000)
    rows = [(5, a), (5, a), (5, a), (9, b), (9, a), (7, None), (7, "short text"), (7, "short text"), (None, b), (None, b)]
    for chunk_words in (500_000, 1):
        got = repeats.remove_repeats(make_docs(spark, rows), chunk_words=chunk_words).collect()
        assert Counter(tuple(r) for r in got) == Counter({(5, 50, 0, a): 1, (5, 50, 50, ""): 2, (9, 30, 0, b): 1, (9, 50, 50, ""): 1, (7, 0, 0, ""): 1,
                                                          (7, 2, 0, "short text"): 2, (None, 30, 30, ""): 2})


def test_repeats_in_an_empty_table_and_other_widths(spark, texts):
    docs = make_docs(spark, [(i, t) for i, t in enumerate(texts)])
    assert repeats.remove_repeats(docs.limit(0)).count() == 0
    for width in (1, 3):
        got = repeats.remove_repeats(docs, width=width).collect()
        assert sorted(map(tuple, got), key=str) == sorted(stripped_by_hand(list(enumerate(texts)), width), key=str)


def test_sketch_never_counts_too_little(spark):
    """Windows that two chunks hold are always estimated repeated; most others are not."""
    import pyarrow as pa

    rng = np.random.default_rng(4)
    parts = [np.unique(rng.integers(0, 1 << 32, 4000, dtype=np.uint32)) for _ in range(6)]
    parts[4] = np.unique(np.concatenate([parts[4], parts[0][:500]]))
    table = pa.table({"slice": pa.array([0] * 6, pa.int64()), "chunk": pa.array(range(6), pa.int64()), "cells": pa.array([p.tobytes() for p in parts], pa.binary())})
    answers = repeats._estimate(table).column("bits").to_pylist()
    many = Counter(np.concatenate(parts).tolist())
    wrong = 0
    for p, bits in zip(parts, answers, strict=True):
        said = np.unpackbits(np.frombuffer(bits, dtype=np.uint8), count=len(p)).astype(bool)
        true = np.array([many[x] > 1 for x in p.tolist()])
        assert not (true & ~said).any()
        wrong += int((said & ~true).sum())
    assert wrong < 0.35 * sum(map(len, parts))


def test_digest_of_what_is_left(spark, texts):
    got = repeats.remove_repeats(make_docs(spark, [(1, texts[4])])).select(F.sha2("kept", 256).alias("d")).first()
    assert got.d == hashlib.sha256(" ".join(texts[4].split()).encode()).hexdigest()
