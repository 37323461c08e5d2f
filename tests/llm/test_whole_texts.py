"""Texts of which no part may be left out of a fingerprint."""

import pytest

from ledgerlens.llm import spots
from llm_helpers import make_docs


def test_texts_without_anchors_are_fingerprinted_whole(spark):
    first = " | ".join(f"cell{i}" for i in range(200))
    other = "cell0 | cell1 | " + " | ".join(f"item{i}" for i in range(198))
    rows = [(1, first), (2, other), (3, "the of and the"), (4, "solo"), (5, "")]
    got = {r.doc_id: r for r in spots.edited_likeness(make_docs(spark, rows)).collect()}
    assert got[1].fingerprint != got[2].fingerprint
    assert len(got[1].fingerprint) == spots.DIGITS * 199
    assert got[2].near_next == pytest.approx(1 / 397)  # only (cell0, cell1) in common
    assert got[2].near_edited < 0.6  # its second half was replaced
    assert len(got[3].fingerprint) == spots.DIGITS * 3  # the of, of and, and the
    assert len(got[4].fingerprint) == spots.DIGITS
    assert got[5].fingerprint == "" and got[5].near_next == 0


def test_few_common_words_do_not_stand_for_a_whole_table(spark):
    first = "the red fox | " + " | ".join(f"cell{i}" for i in range(500))
    other = "the red fox | " + " | ".join(f"item{i}" for i in range(500))
    got = {r.doc_id: r for r in spots.edited_likeness(make_docs(spark, [(1, first), (2, other)])).collect()}
    assert got[1].fingerprint != got[2].fingerprint and got[2].near_next < 0.01 and got[2].near_edited < 0.6
    # one chain, then 250 pairs whose first word no chain reaches
    assert len(got[1].fingerprint) == spots.DIGITS * 500
