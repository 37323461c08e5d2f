"""Fingerprints, quality statistics, packing and language ID against brute force or held-out rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import regex
import tokenizers

from ledgerlens.llm import language, packing, quality, spots
from ledgerlens.llm.queries import tokenizer_path
from llm_helpers import make_docs, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def own_ids(texts):
    """Rows of distinct ids, with the odd texts of all tests."""
    return [(i * 7, t) for i, t in enumerate(texts)]


def brute_chains(text):
    words = regex.findall(r"[\p{L}\p{N}]+", (text or "").lower())
    anchors = set(spots.ANCHORS)
    content = [(words[i - 1] if i and words[i - 1] in anchors else None, w) for i, w in enumerate(words) if w not in anchors]
    if not content:  # common words alone
        return {(None, a, b) for a, b in zip(words, words[1:], strict=False)} or {(None, w, "") for w in words}
    found, reached = set(), set()  # reached: words in some signature
    for i, (anchor, w) in enumerate(content):
        if anchor or not (i and content[i - 1][0]):
            following = content[i + 1][1] if i + 1 < len(content) else ""
            if anchor or following or i not in reached:
                found.add((anchor, w, following))
                reached |= {i, i + 1}
    return found


def brute_likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_spot_signatures_match_brute_force(spark, own_ids):
    got = {r.doc_id: r for r in spots.edited_likeness(make_docs(spark, own_ids)).collect()}
    rows = sorted(((d, t or "") for d, t in own_ids), reverse=True)
    assert len(got) == len(rows)
    for k, (d, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        r = got[d]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert r.near_edited == pytest.approx(brute_likeness(brute_chains(text), brute_chains(edited)))
        assert r.near_next == pytest.approx(brute_likeness(brute_chains(text), brute_chains(following)))
        assert len(r.fingerprint) == spots.DIGITS * len(brute_chains(text))


def test_spot_signatures_of_empty_and_single_tables(spark):
    assert spots.edited_likeness(make_docs(spark, [])).count() == 0
    r, = spots.edited_likeness(make_docs(spark, [(1, "the cat sat on the mat here")])).collect()
    assert r.near_next == 1.0


def test_similar_pairs_match_brute_force(spark):
    rng = random.Random(3)
    base = [prose(rng, 80, 2000).split() for _ in range(4)]
    rows = []
    for i in range(60):
        words = list(base[i % 4])
        for j in rng.sample(range(80), i % 9):
            words[j] = f"edit{i}x{j}"
        rows.append((i, " ".join(words)))
    members, links = spots.similar_pairs(make_docs(spark, rows))
    of = {r["class"]: r.doc_id for r in members.collect()}
    same = {r.doc_id: r["class"] for r in members.collect()}
    found = {frozenset((of[r.a], of[r.b])) for r in links.collect()}
    sets = {d: brute_chains(t) for d, t in rows}
    wanted = {frozenset((of[same[a]], of[same[b]])) for a in sets for b in sets
              if same[a] != same[b] and brute_likeness(sets[a], sets[b]) >= 0.75}
    assert found == wanted


def brute_base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {i + j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))


def test_quality_statistics_match_brute_force(spark, own_ids):
    rng = random.Random(9)
    loops = [(1000 + i, " ".join(rng.choice("abcde") for _ in range(n))) for i, n in enumerate((3, 10, 60, 200, 900))]
    rows = own_ids + loops
    labels = spark.createDataFrame([], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.judge(make_docs(spark, rows), labels).collect()}
    for d, text in rows:
        r, base = got[d], brute_base(text)
        assert tuple(r[c] for c in quality.BASE) == base
        assert r.base_failed == (base[0] < 50 or 100 * base[4] > 50 * base[0])
        assert r.kept == (not r.base_failed)  # nothing was learned


def test_learned_list_separates_held_out_rows(spark):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(400):
        bad = i % 3 == 0
        words = prose(rng, 80).split()
        if bad:
            words = [w.upper() + "!!" if rng.random() < 0.5 else w for w in words]
        rows.append((i, " ".join(words)))
        labels.append((i, 0 if bad else 1))
    known = spark.createDataFrame([*labels[:300], (None, 1), (5, None), (10_000, 0)], "doc_id long, quality int")
    kept = {r.doc_id for r in quality.judge(make_docs(spark, rows), known).where("kept").select("doc_id").collect()}
    right = sum((i in kept) == (i % 3 != 0) for i in range(300, 400))
    assert right >= 95


def test_packing_matches_whole_text_encoding(spark, own_ids):
    tokenizer = tokenizers.Tokenizer.from_file(tokenizer_path())
    wanted = {d: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for d, t in own_ids}
    pieces = packing.pack(make_docs(spark, own_ids), tokenizer_path()).collect()
    by_doc, bins = defaultdict(list), defaultdict(list)
    for r in pieces:
        by_doc[r.doc_id].append(r)
        bins[r.sequence_id].append((r.offset, r.length))
    assert set(by_doc) == set(wanted)
    for d, ids in wanted.items():
        own = sorted(by_doc[d], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(-(-len(ids) // 1024)))
        assert all(r.length == 1024 for r in own[1:])
        at = 0
        for r in own:
            assert r.start == at
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at:at + r.length], dtype="<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(bins) <= -(-sum(map(len, wanted.values())) // 1024) + 1


def test_bins_hold_each_piece_once():
    rng = random.Random(2)
    counts = Counter(rng.randint(1, 60) for _ in range(700))
    plan = packing.plan_bins(dict(counts), 60)
    held, fill = Counter(), Counter()
    for size in counts:
        own = [r for r in plan.tolist() if r[0] == size]
        for r, until in zip(own, [*(x[1] for x in own[1:]), counts[size]], strict=True):
            for rank in range(r[1], until):
                held[size] += 1
                fill[r[2] + (rank - r[1]) // r[3]] += size
    assert held == counts
    assert max(fill.values()) <= 60
    rooms = []  # first fit, longest first
    for size in sorted(counts.elements(), reverse=True):
        at = next((i for i, room in enumerate(rooms) if room >= size), None)
        if at is None:
            rooms.append(60 - size)
        else:
            rooms[at] -= size
    assert len(fill) <= len(rooms)


def test_language_of_held_out_documents(spark):
    rng = random.Random(8)
    rows = [(i, prose(rng, 60, lang=language.LANGUAGES[i % 4]), language.LANGUAGES[i % 4]) for i in range(240)]
    model = language.train(make_docs(spark, rows[:160]))
    held_out = [(d, t, None) for d, t, _ in rows[160:]] + [(900, None, None), (901, "", None), (902, "§§§ 123", "xx")]
    got = {r.doc_id: r.language for r in language.identify_documents(make_docs(spark, held_out), model).collect()}
    assert len(got) == len(held_out)
    assert sum(got[d] == lang for d, _, lang in rows[160:]) >= 76
    assert language.identify_documents(make_docs(spark, []), model).count() == 0
