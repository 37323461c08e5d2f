"""Which sources of a language write differently: divergence of term frequencies by count-cell ranking.

Terms are the runs of letters (ASCII letters, lower-cased, and every character from U+0080 on). A
language keeps the terms that at least ``min_docs`` of its documents hold. Smoothed frequencies are
whole numbers: p = 1 + floor(10^9 (count + 5) / (N + 5 V)) with N occurrences of the V kept terms.

Counting: each task counts the terms of its batches per (language, source) and sends a term once per
flush, with occurrences and documents, so a frequent term or a hot source reaches the shuffle already
summed. One exchange by (language, term) serves the sums per source, per language and the filter.

Ranking: f depends on a term's two counts alone. Terms fall into cells of equal (group count,
language count); f is evaluated once per cell, equal values merge, and the running sum of the cells'
sizes tells which values reach the wanted ranks. Only the terms of those cells are fetched again and
put into UTF-8 order within a value. Pairs of sources use cells of (count here, count there): terms
that both hold are joined by term; terms that one holds, or neither, follow from histograms of counts,
so no row is made for an absent term.

Cases: null text, lang or source count as ''; a group without terms still has its pairs; a language
without kept terms has pairs of value 0 and no terms; a language with one source has no pairs; equal
rows count one by one; ties are ordered by the item's UTF-8 bytes; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import pinned

MIN_DOCS = 30
TOP = 50
FLUSH_TERMS = 200_000
# every byte that is no letter of a term becomes a blank; in UTF-8, bytes from 0x80 on belong to characters from U+0080 on
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_GROUP_MARK = "@"  # no letter of a term: marks the row that says a group occurs


def _count_terms(docs: DataFrame) -> DataFrame:
    """(lang, source, term, c, d): occurrences and documents per task, and a marker row per group."""
    schema = "lang string, source string, term string, c long, d long"

    def flush(counts: dict) -> pa.RecordBatch:
        rows = [(lang, source, term, n, held[term]) for (lang, source), (seen, held) in counts.items() for term, n in seen.items()]
        rows += [(lang, source, _GROUP_MARK.encode() + source, 0, 0) for lang, source in counts]
        columns = list(zip(*rows, strict=True))
        text = [pa.array(c, pa.binary()).cast(pa.string()) for c in columns[:3]]
        return pa.RecordBatch.from_arrays([*text, *(pa.array(c, pa.int64()) for c in columns[3:])], names=["lang", "source", "term", "c", "d"])

    def count(batches) -> Iterator[pa.RecordBatch]:
        counts: dict = {}
        size = 0
        for batch in batches:
            langs, sources, texts = (batch.column(i).cast(pa.binary()) for i in range(3))
            for lang, source, text in zip(langs.to_pylist(), sources.to_pylist(), texts, strict=True):
                seen, held = counts.setdefault((lang, source), (Counter(), Counter()))
                own = Counter(text.as_py().translate(_LETTERS).split())
                size -= len(seen)
                seen.update(own)
                held.update(own.keys())
                size += len(seen)
                if size > FLUSH_TERMS:
                    yield flush(counts)
                    counts, size = {}, 0
        if counts:
            yield flush(counts)

    return docs.mapInArrow(count, schema)


def frequency(count: Column, n: Column, v: Column) -> Column:
    """1 + floor(10^9 (count + 5) / (n + 5 v)), in whole numbers."""
    above = F.lit(10**9).cast("decimal(10,0)") * (count + 5).cast("decimal(20,0)")
    below = F.greatest(n + 5 * v, F.lit(1)).cast("decimal(20,0)")
    return (F.floor((above - F.pmod(above, below)) / below) + 1).cast("long")


def term_counts(docs: DataFrame, min_docs: int = MIN_DOCS, lang: str = "lang", source: str = "source",
                text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(kept, groups). kept: lang, source, term, c (here), total (in the language), for kept terms that
    occur. groups: lang, source, n, terms (sum and number of those), lang_n, v (of the language)."""
    def read(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(""))

    part = _count_terms(docs.select(read(lang).alias("lang"), read(source).alias("source"), read(text).alias("text")))
    counted = part.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("c").alias("c"), F.sum("d").alias("d"))
    of_term = Window.partitionBy("lang", "term")
    rows = pinned(counted.select("lang", "term", "source", "c", F.sum("c").over(of_term).alias("total"), F.sum("d").over(of_term).alias("docs"),
                                 (F.row_number().over(of_term.orderBy("source")) == 1).cast("long").alias("first"))
                  .where((F.col("docs") >= min_docs) | F.startswith("term", F.lit(_GROUP_MARK))))
    marks = F.startswith("term", F.lit(_GROUP_MARK))
    kept = rows.where(~marks)
    sums = kept.groupBy("lang", "source").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("terms"))
    langs = kept.groupBy("lang").agg(F.sum("c").alias("lang_n"), F.sum("first").alias("v"))
    groups = (rows.where(marks).select("lang", "source").join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
              .select("lang", "source", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n", "terms", "lang_n", "v"))))
    return kept.select("lang", "source", "term", "c", "total"), pinned(groups)


def top_terms(kept: DataFrame, groups: DataFrame, top: int = TOP) -> DataFrame:
    """lang, source, item, q, value, rank: kept terms that a group uses more than its language does."""
    cells = kept.groupBy("lang", "source", "c", "total").agg(F.count(F.lit(1)).alias("m"))
    cells = cells.join(groups, ["lang", "source"])
    p, q = frequency(F.col("c"), F.col("n"), F.col("v")), frequency(F.col("total"), F.col("lang_n"), F.col("v"))
    cells = cells.select("lang", "source", "c", "total", "m", q.alias("q"), (p - q).alias("value")).where("value > 0")
    merged = cells.groupBy("lang", "source", "value").agg(F.sum("m").alias("m"))
    falling = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    # every value has a term at least, so ``top`` values of a group suffice
    first = merged.withColumn("place", F.row_number().over(falling)).where(F.col("place") <= top)
    before = F.coalesce(F.sum("m").over(falling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    wanted = first.withColumn("before", before).where(F.col("before") < top).select("lang", "source", "value", "before")
    chosen = cells.join(wanted, ["lang", "source", "value"]).select("lang", "source", "c", "total", "q", "value", "before")
    number = F.row_number().over(Window.partitionBy("lang", "source", "value", "before").orderBy("term"))
    return (kept.join(chosen, ["lang", "source", "c", "total"]).withColumn("number", number).where(F.col("number") <= top)
            .withColumn("rank", (F.col("before") + F.col("number")).cast("int")).where(F.col("rank") <= top)
            .select("lang", "source", F.col("term").alias("item"), "q", "value", "rank"))


def source_pairs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item, value, rank: the other sources of the language by summed difference over all
    kept terms. With p(c) here, r(c) there and p0, r0 for absent terms, the sum over all V terms is
    (V - terms here - terms there) |p0 - r0| + sum |p(c) - r0| + sum |p0 - r(c)|, each over the terms
    that occur, plus over terms in both |p(c) - r(d)| - |p(c) - r0| - |p0 - r(d)| + |p0 - r0|."""
    absent = groups.withColumn("p0", frequency(F.lit(0), F.col("n"), F.col("v")))
    a = absent.select("lang", F.col("source").alias("a"), F.col("n").alias("na"), "v", F.col("terms").alias("ta"), F.col("p0").alias("pa"))
    b = absent.select("lang", F.col("source").alias("b"), F.col("n").alias("nb"), F.col("terms").alias("tb"), F.col("p0").alias("pb"))
    both = pinned(a.join(b, "lang").where("a < b"))
    key = ["lang", "a", "b"]
    neither = both.select(*key, ((F.col("v") - F.col("ta") - F.col("tb")) * F.abs(F.col("pa") - F.col("pb"))).alias("value"))
    cells = pinned(kept.groupBy("lang", "source", "c").agg(F.count(F.lit(1)).alias("m"))
                   .join(groups.select("lang", "source", "n", "v"), ["lang", "source"])
                   .select("lang", "source", "m", frequency(F.col("c"), F.col("n"), F.col("v")).alias("p")))

    def one_side(side: str, other: str) -> DataFrame:
        held = cells.select("lang", F.col("source").alias(side), "m", "p")
        return both.join(held, ["lang", side]).select(*key, (F.col("m") * F.abs(F.col("p") - F.col("p" + other))).alias("value"))

    left = kept.select("lang", "term", F.col("source").alias("a"), F.col("c").alias("ca"))
    right = kept.select("lang", "term", F.col("source").alias("b"), F.col("c").alias("cb"))
    joint = (left.join(right, ["lang", "term"]).where("a < b").groupBy("lang", "a", "b", "ca", "cb").agg(F.count(F.lit(1)).alias("m"))
             .join(both, key))
    p, r = frequency(F.col("ca"), F.col("na"), F.col("v")), frequency(F.col("cb"), F.col("nb"), F.col("v"))
    change = F.abs(p - r) - F.abs(p - F.col("pb")) - F.abs(F.col("pa") - r) + F.abs(F.col("pa") - F.col("pb"))
    shared = joint.select(*key, (F.col("m") * change).alias("value"))
    sums = neither.unionByName(one_side("a", "b")).unionByName(one_side("b", "a")).unionByName(shared).groupBy(*key).agg(F.sum("value").alias("value"))
    turned = sums.select("lang", F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                                                   F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("x"), "value")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return turned.select("lang", "x.source", "x.item", "value").select("lang", "source", "item", "value", rank.cast("int").alias("rank"))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank."""
    kept, groups = term_counts(docs, min_docs)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return (source_pairs(kept, groups).withColumn("part", F.lit("pair")).select(*columns)
            .unionByName(top_terms(kept, groups, top).withColumn("part", F.lit("term")).select(*columns)))
