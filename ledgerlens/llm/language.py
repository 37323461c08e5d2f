"""Language identification by Bayesian evidence fusion.

Evidence, combined in log space per language: (1) the likelihood of the text under byte-trigram
models, counted over all labelled documents; (2) the declared markup language; (3) the address
suffix; (4) the prior of the host, smoothed towards its parent domain, which is smoothed towards
the whole collection. (2) to (4) come from grouped sums of text-only beliefs, so no table of them is
written by hand; a row's own belief is taken out of its host's prior. One more class, ``und``,
stands for bytes that follow no model (uniform trigrams).

Text likelihoods are tempered: a text counts as at most ``EVIDENCE`` independent trigrams, else long
texts would silence all other evidence. Models and all scores use every byte of every text.

Cases: a null or blank text gives no text evidence and the other evidence decides; null declared
language, suffix or host give none; without any evidence the row is ``und``; unknown labels in
training are ignored; equal rows get equal results; an empty table gives an empty result.
"""

from __future__ import annotations

import html as html_lib
import re
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import keep_keys, pinned, row_key
from ledgerlens.llm.url_rules import url_host

LANGUAGES = ("en", "de", "fr", "es")
UNKNOWN = "und"
BUCKET_BITS = 14
EVIDENCE = 200.0
#: pseudo-rows with which a parent speaks for a child (host, domain) and a marginal for a cell
HOST_WEIGHT, CELL_WEIGHT = 10.0, 2.0
UNKNOWN_PRIOR = 0.01
ACCEPT = 0.5
#: of the texts counted at once (a byte takes about 60 while it is), and rows decoded at once
PART_BYTES = 1 << 18
ROWS_AT_ONCE = 256

_HIDDEN = re.compile(r"(?is)<(script|style|nav|footer|template)\b.*?</\1\s*>|<!--.*?-->")
_TAG = re.compile(r"(?s)<[^>]*>")


def visible_text(markup: str) -> str:
    return html_lib.unescape(_TAG.sub(" ", _HIDDEN.sub(" ", markup)))


def _decoded(column: pa.Array) -> Iterator[str | None]:
    """The values, a few rows at a time: a whole batch of texts is never held twice."""
    for lo in range(0, len(column), ROWS_AT_ONCE):
        yield from column.slice(lo, ROWS_AT_ONCE).to_pylist()


def _parts(texts: Iterable[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bytes, end of each text in them) for runs of whole texts."""
    held: list[bytes] = []
    size = 0
    for t in texts:
        held.append(b" " + t.lower().encode() + b" ")
        size += len(held[-1])
        if size >= PART_BYTES:
            yield np.frombuffer(b"".join(held), dtype=np.uint8), np.cumsum([len(x) for x in held])
            held, size = [], 0
    if held:
        yield np.frombuffer(b"".join(held), dtype=np.uint8), np.cumsum([len(x) for x in held])


_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[:97] = 32
_PLAIN[123:128] = 32  # letters of ASCII and all bytes above stay


def trigram_codes(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each trigram and the number of the text it lies in; runs of other characters than
    letters count as one blank, and trigrams inside them are left out."""
    b = _PLAIN[data]
    own = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    keep = np.ones(len(b), dtype=bool)
    keep[1:] = ~((b[1:] == 32) & (b[:-1] == 32) & (own[1:] == own[:-1]))
    b, own = b[keep].astype(np.uint32), own[keep]
    if len(b) < 3:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    codes = ((b[:-2] * 65599 + b[1:-1]) * 65599 + b[2:]) * np.uint32(2654435769) >> np.uint32(32 - BUCKET_BITS)
    inside = own[:-2] == own[2:]
    return codes[inside].astype(np.int64), own[:-2][inside]


def train(docs: DataFrame, text: str = "text", label: str = "lang", languages: Sequence[str] = LANGUAGES) -> np.ndarray:
    """Log likelihood of each trigram bucket under each language, then under ``und``. Counts cover
    all labelled rows; what reaches the driver is the model: languages x 2^BUCKET_BITS numbers."""
    names = list(languages)

    def count(batches) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(names), 1 << BUCKET_BITS), dtype=np.int64)
        for batch in batches:
            kinds = batch.column(0)
            for k, name in enumerate(names):
                for data, ends in _parts(_decoded(batch.column(1).filter(pc.equal(kinds, name)))):
                    total[k] += np.bincount(trigram_codes(data, ends)[0], minlength=1 << BUCKET_BITS)
        k, bucket = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(bucket, pa.int32()), pa.array(total[k, bucket])],
                                         names=["k", "bucket", "n"])

    rows = docs.select(F.col(label).alias("l"), F.col(text).alias("t")).where(F.col("l").isin(names) & F.col("t").isNotNull())
    counts = rows.mapInArrow(count, "k int, bucket int, n long").groupBy("k", "bucket").agg(F.sum("n").alias("n")).collect()
    table = np.full((len(names) + 1, 1 << BUCKET_BITS), 0.5)
    for r in counts:
        table[r["k"], r["bucket"]] += r["n"]
    table[-1] = 1.0
    return np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32)


def score(rows: DataFrame, text: str, model: np.ndarray, markup: bool = False) -> DataFrame:
    """Replaces column ``text`` by ``ll`` (tempered log likelihood under each class, or null for a
    text without trigrams). The other columns pass through unchanged."""
    others = [c for c in rows.columns if c != text]

    def read(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = (visible_text(t or "") if markup else t or "" for t in _decoded(batch.column(text)))
            sums, n = [], []
            for data, ends in _parts(texts):
                codes, own = trigram_codes(data, ends)
                sums.append(np.stack([np.bincount(own, weights=table[codes], minlength=len(ends)) for table in model], axis=1))
                n.append(np.bincount(own, minlength=len(ends)))
            ll, n = np.concatenate(sums), np.concatenate(n)
            ll *= (np.minimum(n, EVIDENCE) / np.maximum(n, 1))[:, None]
            values = [x if k else None for x, k in zip(ll.tolist(), n.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), pa.array(values, pa.list_(pa.float64()))],
                                             names=[*others, "ll"])

    schema = "".join(f"`{n}` {k}, " for n, k in rows.dtypes if n != text) + "ll array<double>"
    return rows.mapInArrow(read, schema)


def _beliefs(logs: Sequence[Column]) -> list[Column]:
    top = F.greatest(*logs)
    powers = [F.exp(x - top) for x in logs]
    total = sum(powers[1:], powers[0])
    return [x / total for x in powers]


def fuse(scored: DataFrame, languages: Sequence[str] = LANGUAGES) -> DataFrame:
    """scored: ll, declared, suffix, host (all may be null) and other columns. Adds language (the
    best class), confidence (its share), text_language and accepted."""
    names = [*languages, UNKNOWN]
    base = [(1 - UNKNOWN_PRIOR) / len(languages)] * len(languages) + [UNKNOWN_PRIOR]
    only_text = _beliefs([F.coalesce(F.get("ll", F.lit(i)), F.lit(0.0)) + float(np.log(base[i])) for i in range(len(names))])
    d = scored.withColumns({f"_t{i}": p for i, p in enumerate(only_text)})
    d = d.withColumn("_domain", F.when(F.size(F.split("host", r"\.")) > 1, F.substring_index("host", ".", -2)))
    d = pinned(d.withColumn("_known", F.col("ll").isNotNull()).drop("ll"))
    sums = [F.coalesce(F.sum(F.when(F.col("_known"), F.col(f"_t{i}"))), F.lit(0.0)) for i in range(len(names))]
    whole = d.agg(*[s.alias(f"s{i}") for i, s in enumerate(sums)]).first()
    total = sum(whole)
    world = [(s + CELL_WEIGHT * b) / (total + CELL_WEIGHT) for s, b in zip(whole, base, strict=True)]

    def grouped(key: str, tag: str) -> DataFrame:
        """Sums of beliefs per value: a row per value, combined on the map side."""
        return (d.where(F.col(key).isNotNull()).groupBy(F.col(key).alias(f"{tag}_key"))
                .agg(*[s.alias(f"{tag}{i}") for i, s in enumerate(sums)]))

    tags = {"declared": "_e", "suffix": "_x", "host": "_h", "_domain": "_d"}
    for key, tag in tags.items():
        d = d.join(grouped(key, tag), F.col(key) == F.col(f"{tag}_key"), "left")

    def held(tag: str, i: int) -> Column:
        """The value's sum without the row's own belief."""
        own = F.when(F.col("_known"), F.col(f"_t{i}")).otherwise(0.0)
        return F.greatest(F.coalesce(F.col(f"{tag}{i}"), F.lit(0.0)) - own, F.lit(0.0))

    def held_all(tag: str) -> Column:
        return sum((held(tag, i) for i in range(1, len(names))), held(tag, 0))

    logs = []
    for i in range(len(names)):
        domain = F.when(F.col("_d_key").isNull(), F.lit(world[i])).otherwise(
            (held("_d", i) + HOST_WEIGHT * world[i]) / (held_all("_d") + HOST_WEIGHT))
        host = F.when(F.col("_h_key").isNull(), domain).otherwise(
            (held("_h", i) + HOST_WEIGHT * domain) / (held_all("_h") + HOST_WEIGHT))
        log = F.log(host)
        for tag in ("_e", "_x"):  # P(value | language) against P(value)
            share = held_all(tag) / max(total, 1.0)
            given = (held(tag, i) + CELL_WEIGHT * share) / (float(whole[i]) + CELL_WEIGHT)
            log = log + F.when(F.col(f"{tag}_key").isNull() | (held_all(tag) <= 0), F.lit(0.0)).otherwise(F.log(given / share))
        # text likelihood = text-only belief over its prior
        logs.append(log + F.when(F.col("_known"), F.log(F.greatest(F.col(f"_t{i}"), F.lit(1e-300)) / base[i])).otherwise(0.0))
    d = d.withColumns({f"_l{i}": x for i, x in enumerate(logs)})
    d = d.withColumns({f"_p{i}": p for i, p in enumerate(_beliefs([F.col(f"_l{i}") for i in range(len(names))]))})

    def best(prefix: str) -> Column:
        top = F.greatest(*[F.col(f"{prefix}{i}") for i in range(len(names))])
        out = F.lit(names[-1])
        for i in reversed(range(len(names) - 1)):
            out = F.when(F.col(f"{prefix}{i}") >= top, F.lit(names[i])).otherwise(out)
        return out

    seen = F.col("_known") | F.col("_e_key").isNotNull() | F.col("_x_key").isNotNull() | F.col("_h_key").isNotNull()
    d = d.withColumns({
        "language": F.when(seen, best("_p")).otherwise(F.lit(UNKNOWN)),
        "confidence": F.when(seen, F.greatest(*[F.col(f"_p{i}") for i in range(len(names))])).otherwise(F.lit(0.0)),
        "text_language": F.when(F.col("_known"), best("_t"))})
    d = d.withColumn("accepted", (F.col("language") != UNKNOWN) & (F.col("confidence") >= ACCEPT))
    return d.drop(*[c for c in d.columns if re.fullmatch(r"_[a-z]\d*|_[a-z]_key|_domain", c)])


def primary_tag(declared: Column) -> Column:
    """``en`` of ``EN-us``; null if there is none."""
    return F.nullif(F.lower(F.regexp_extract(declared, r"^\s*([A-Za-z]{2,3})(?![A-Za-z])", 1)), F.lit(""))


def identify_pages(pages: DataFrame, model: np.ndarray, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, host, declared, suffix, language, confidence, text_language, accepted per page."""
    host = F.nullif(F.regexp_replace(url_host(F.col(url)), r"^[^@]*@|:\d*$", ""), F.lit(""))
    head = F.regexp_extract(F.col(html), r"""(?is)<html\b[^>]*?\blang\s*=\s*["']?([^"'\s>]+)""", 1)
    rows = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), primary_tag(head).alias("declared"),
                        F.col(html).alias("text"))
    rows = rows.withColumn("suffix", F.nullif(F.substring_index("host", ".", -1), F.lit("")))
    return fuse(score(rows, "text", model, markup=True)).drop("_known")


def identify_documents(docs: DataFrame, model: np.ndarray, doc_id: str = "doc_id", text: str = "text", declared: str = "lang",
                       host: str = "source") -> DataFrame:
    """Like ``identify_pages`` for plain texts; ``key`` is a hash of id and text."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), row_key(F.col(doc_id), F.col(text)).alias("key"), F.col(host).alias("host"),
                       primary_tag(F.col(declared)).alias("declared"), F.lit(None).cast("string").alias("suffix"), F.col(text).alias("text"))
    return fuse(score(rows, "text", model)).drop("_known")


def keep_identified(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", declared: str = "lang", host: str = "source") -> DataFrame:
    """The rows whose language is identified, with all their columns; rows without text go."""
    model = train(docs, text, declared)
    # pinned, else the filter would be pushed into, and multiply, the nested expressions of the beliefs
    decided = pinned(identify_documents(docs, model, doc_id, text, declared, host)).where("accepted and text_language is not null")
    return keep_keys(docs, decided.select("key"), doc_id, text)
