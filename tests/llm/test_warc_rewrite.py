"""Rewriting archives keeps every record once, with its own text."""

import hashlib
from collections import Counter

from ledgerlens.llm import warc


def sha1(text):
    return hashlib.sha1(text.encode()).hexdigest()


def rewritten(spark, tmp_path, records, least_bytes):
    schema = "page_id long, url string, payload string, payload_digest string, record_type string, refers_to long"
    source, target = str(tmp_path / "source"), str(tmp_path / "target")
    warc.write_archives(spark.createDataFrame(records, schema), source)
    warc.rewrite(spark, source, target, least_bytes)
    return Counter((r.page_id, r.record_type, r.refers_to, r.payload_digest, r.payload) for r in warc.read_archives(spark, target).collect())


def response(i, text):
    return (i, f"http://a/{i}", text, sha1(text), "response", None)


def revisit(i, text, of):
    return (i, f"http://a/{i}", None, sha1(text), "revisit", of)


def test_rewrite_keeps_rows_texts_and_lost_revisits(spark, tmp_path):
    big, other = "b" * 40, "o" * 40
    records = [response(9, big), response(9, big), response(9, big), response(9, other), revisit(1, big, 9), revisit(2, big, 9),
               revisit(3, other, 9), revisit(4, "gone", 77), revisit(None, big, 9), response(8, other)]
    got = rewritten(spark, tmp_path, records, 10)
    b, o = sha1(big), sha1(other)
    assert got == Counter({(9, "response", None, b, big): 3, (9, "response", None, o, other): 1, (1, "revisit", 9, b, None): 1,
                           (2, "revisit", 9, b, None): 1, (3, "revisit", 9, o, None): 1, (4, "revisit", 77, sha1("gone"), None): 1,
                           (None, "revisit", 9, b, None): 1, (8, "revisit", 9, o, None): 1})


def test_rewrite_gives_small_revisits_their_own_text(spark, tmp_path):
    records = [response(9, "small"), response(9, "small"), response(9, "least"), revisit(1, "small", 9), revisit(2, "least", 9), revisit(10, "least", 9)]
    got = rewritten(spark, tmp_path, records, 1000)
    s, t = sha1("small"), sha1("least")
    assert got == Counter({(9, "response", None, s, "small"): 2, (9, "response", None, t, "least"): 1, (1, "response", None, s, "small"): 1,
                           (2, "response", None, t, "least"): 1, (10, "response", None, t, "least"): 1})
