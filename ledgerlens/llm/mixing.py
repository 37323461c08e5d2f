"""Mixing sources to target weights by systematic sampling, on DataFrame operations only.

Targets: the sources, by code point with null last, weigh 5, 2, 1 and so on again; they share a
multiple (1.5) of all words by weight, no source above twice its own words. With the sources sorted
by (cap / weight), the level at which the shares stop rising follows from two running sums over one
row per source.

Copies: every document of a source expects the same number of copies, target / source size, at most
2. Documents stand in order of size (ties by a hash of the id); position i covers the interval
[i * step, (i + 1) * step) plus one offset of the source, and the document is emitted once per whole
number in it. The order of size makes the sample systematic in size, so a source's words come near
its target. Positions come from range partitions and running totals (``ordered_positions``), never
from a window over a source. Intervals use integers (step in units of 2^-24), so a document gets at
most 2 copies and reruns agree.

Cases: null text has size 0; documents of size 0 may be drawn and take no words; a source without
words has target 0; equal rows count one by one; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import pinned, word_count
from ledgerlens.operators.sequence import ordered_positions

UNIT = 1 << 24
SEED = "mix"


def source_targets(sized: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, most: int = 2) -> DataFrame:
    """source_rank, source, source_size, target from rows with (source, size); one row per source."""
    sizes = sized.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"), F.count(F.lit(1)).alias("source_rows"))
    ranked = ordered_positions(sizes, [F.col("source").isNull(), F.col("source")], out="source_rank", partitions=4)
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("source_rank") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumns({"weight": weight.cast("long"), "cap": F.col("source_size") * most})
    by_level = [F.col("cap") / F.col("weight"), F.col("source_rank")]
    ranked = ordered_positions(ranked, by_level, weight="cap", out="cap_before", partitions=4)
    ranked = pinned(ordered_positions(ranked, by_level, weight="weight", out="weight_before", partitions=4))
    total = ranked.agg(F.sum("source_size").alias("s"), F.sum("weight").alias("w")).first()
    if not total["w"]:
        return ranked.withColumn("target", F.lit(0.0))
    level = (F.lit(share) * F.lit(int(total["s"])) - F.col("cap_before")) / (F.lit(int(total["w"])) - F.col("weight_before"))
    free = ranked.where(F.col("cap") / F.col("weight") > level).agg(F.min_by(level, F.struct(*[c.alias(f"k{i}") for i, c in enumerate(by_level)]))).first()[0]
    cap = F.col("cap").cast("double")
    return ranked.withColumn("target", cap if free is None else F.least(cap, F.lit(float(free)) * F.col("weight")))


def copies_of(position: Column, step: Column, offset: Column) -> Column:
    """Whole numbers in [position * step + offset, (position + 1) * step + offset), in units of UNIT."""
    at = position * step + offset
    return (F.shiftright(at + step, 24) - F.shiftright(at, 24)).cast("long")


def mix_plan(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, most: int = 2, seed: str = SEED,
             doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Per document: doc_id, size, source, source_size, target and copies (0 to ``most``)."""
    sized = pinned(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"),
                               word_count(F.col(text)).alias("size")))
    targets = source_targets(sized, weights, share, most)
    step = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") * UNIT)).otherwise(0).cast("long")
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce("source", F.lit("null")))), 1, 6), 16, 10).cast("long")
    targets = targets.select("source", "source_rank", "source_size", "target", step.alias("step"), offset.alias("offset"))
    # the join on source is split by AQE where one source is hot; the target side has one row a source
    with_source = (sized.withColumnRenamed("source", "of").join(targets, F.col("of").eqNullSafe(F.col("source"))).drop("of"))
    order = ["size", F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))), "doc_id"]
    placed = ordered_positions(with_source, order, group=["source_rank"], out="position")
    return placed.select("doc_id", "size", "source", "source_size", "target",
                         copies_of(F.col("position"), F.col("step"), F.col("offset")).alias("copies"))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **plan) -> DataFrame:
    """The mixed corpus: all columns of ``docs``, every row as often as the plan says. Rows that
    agree in id, source and size (repeated rows) divide their copies among themselves."""
    def key(i, s, z):
        return F.xxhash64(F.coalesce(i.cast("string"), F.lit("\x00")), F.coalesce(s.cast("string"), F.lit("\x00")), z)

    counts = (mix_plan(docs, doc_id=doc_id, text=text, source=source, **plan)
              .groupBy(key(F.col("doc_id"), F.col("source"), F.col("size")).alias("k"))
              .agg(F.sum("copies").alias("c"), F.count(F.lit(1)).alias("m")).where("c > 0"))
    rows = docs.select(F.struct("*").alias("row"), key(F.col(doc_id), F.col(source), word_count(F.col(text))).alias("k"))
    number = F.row_number().over(Window.partitionBy("k").orderBy("k"))
    share = F.floor(F.col("c") / F.col("m")) + (F.col("number") <= F.col("c") % F.col("m")).cast("int")
    return (rows.join(counts, "k").withColumn("number", number).withColumn("share", share.cast("int")).where("share > 0")
            .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("share")))).select("row.*"))
