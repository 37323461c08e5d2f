"""Quality rules as a learned decision list, on DataFrame operations only.

Statistics of every whole text are built-in expressions. Rules are learned from labelled rows by
sequential covering: labelled statistics are cut at quantiles; a rule grows one threshold condition
at a time, by FOIL gain over all thresholds of all statistics, on two thirds of the rows; it is
pruned to the prefix of its conditions that is most precise on the other third; rows it covers are
set aside, and the next rule is grown, until no rule reaches the asked precision. Each step is one
grouped count; only counts per (statistic, threshold) reach the driver. The ordered rules become a
Spark conditional expression.

Words repeated in three-word windows: windows are hashed (64 bits), sorted, and equal neighbours
give the repeated ones; their positions in order tell how many words they cover together.

Cases: null text counts as empty; a text without words fails the base rules; labels that are null
or have no document teach nothing; without labels, or if no rule is precise, the list is empty and
the base rules alone decide; equal rows get equal results; empty tables are allowed.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import BLANKS, keep_keys, pinned, row_key, words

SYMBOLS = "#*$%&|<>"
FEATURES = ["n_words", "mean_word", "symbol_share", "dup_line_share", "repeat_share", "upper_share", "mark_share", "distinct_share"]
QUANTILES = 64
#: repeated windows up to which positions are found by comparing; beyond, by sorting; same result
FEW = 24
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _without(text: Column, marks: str) -> Column:
    for m in marks:
        text = F.replace(text, F.lit(m), F.lit(""))
    return text


def with_stats(rows: DataFrame, text: str) -> DataFrame:
    """Adds the BASE counts and FEATURES to ``rows``; ``text`` is a column that gives way to them."""
    d = rows.withColumn(text, F.coalesce(F.col(text), F.lit("")))
    d = d.withColumn("_w", words(F.col(text)))
    d = d.withColumn("_lines", F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != ""))
    t, w = F.col(text), F.col("_w")
    d = d.withColumns({
        "n_words": F.size(w).cast("long"), "word_chars": F.length(F.array_join(w, "")).cast("long"),
        "n_symbols": (F.length(t) - F.length(_without(t, SYMBOLS))).cast("long"),
        "_marks": F.length(t) - F.length(_without(t, "!?")),
        "_upper": F.length(t) - F.length(F.regexp_replace(t, r"\p{Lu}+", "")),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "_n_lines": F.size("_lines"), "_n_distinct": F.size(F.array_distinct(w)),
        "_g": F.transform(F.slice(w, F.lit(1), F.greatest(F.size(w) - 2, F.lit(0))),
                          lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))})
    d = d.drop(text, "_w", "_lines").withColumn("_s", F.sort_array("_g"))
    s = F.col("_s")
    d = d.withColumn("_again", F.array_distinct(F.filter(s, lambda x, i: x == F.get(s, i - 1)))).drop("_s")
    g, again = F.col("_g"), F.col("_again")
    d = d.withColumn("_ranked", F.when(F.size(again) > FEW, F.sort_array(
        F.transform(g, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    r = F.col("_ranked")
    compared = F.filter(F.sequence(F.lit(0), F.size(g) - 1), lambda i: F.array_contains(again, F.get(g, i)))
    by_order = F.sort_array(F.transform(
        F.filter(r, lambda x, i: x["h"].eqNullSafe(F.get(r, i - 1)["h"]) | x["h"].eqNullSafe(F.get(r, i + 1)["h"])),
        lambda x: x["i"]))
    starts = F.when(F.size(again) > FEW, by_order).otherwise(compared)
    covered = F.aggregate(starts, F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
                          lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n")),
                          lambda a: a["n"])
    d = d.withColumn("n_repeat_words", F.when(F.size(again) == 0, F.lit(0)).otherwise(covered).cast("long"))

    def share(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))

    return d.withColumns({
        "mean_word": share("word_chars", "n_words"), "symbol_share": share("n_symbols", "n_words"),
        "dup_line_share": share("n_dup_lines", "_n_lines"), "repeat_share": share("n_repeat_words", "n_words"),
        "upper_share": share("_upper", "word_chars"), "mark_share": share("_marks", "n_words"),
        "distinct_share": share("_n_distinct", "n_words"),
    }).drop("_g", "_again", "_ranked", "_marks", "_upper", "_n_lines", "_n_distinct")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    threshold: float

    def column(self) -> Column:
        c = F.col(self.feature)
        return c >= F.lit(self.threshold) if self.at_least else c < F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<'} {self.threshold:.6g}"


def _all(conditions: Sequence[Condition]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c.column()
    return out


def _gain(p: float, n: float, p0: float, n0: float) -> float:
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p > 0 else 0.0


def learn(labelled: DataFrame, features: Sequence[str] = tuple(FEATURES), bad: str = "bad", key: str = "doc_id",
          max_rules: int = 12, max_conditions: int = 3, least_covered: int = 5, precision: float = 0.8,
          quantiles: int = QUANTILES) -> list[list[Condition]]:
    """Ordered rules that recognise rows with ``bad`` = 1."""
    steps = [i / quantiles for i in range(1, quantiles)]
    cuts = labelled.agg(*[F.percentile_approx(F.col(f).cast("double"), steps, 10_000).alias(f) for f in features]).first()
    thresholds = {f: sorted({float(x) for x in cuts[f] or []}) for f in features}

    def bin_of(f: str) -> Column:
        edges = F.array(*[F.lit(x) for x in thresholds[f]]) if thresholds[f] else F.array().cast("array<double>")
        return F.size(F.filter(edges, lambda e: e <= F.col(f).cast("double")))

    rows = pinned(labelled.select(F.col(bad).cast("int").alias("bad"), (F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(3)) < 2).alias("grow"),
                                  *[F.col(f).cast("double").alias(f) for f in features],
                                  F.array(*[bin_of(f) for f in features]).alias("bins")))
    rules: list[list[Condition]] = []
    while len(rules) < max_rules:
        conditions: list[Condition] = []
        grown = rows.where("grow")
        while len(conditions) < max_conditions:
            counts = (grown.select("bad", F.posexplode("bins").alias("f", "b")).groupBy("f", "b")
                      .agg(F.sum("bad").alias("p"), F.count(F.lit(1)).alias("n")).collect())
            p0 = sum(r["p"] for r in counts if r["f"] == 0)
            n0 = sum(r["n"] for r in counts if r["f"] == 0) - p0
            if not p0 or not n0:
                break
            best, chosen = 1e-9, None
            for k, f in enumerate(features):
                own = {r["b"]: (r["p"], r["n"] - r["p"]) for r in counts if r["f"] == k}
                p = n = 0
                for b, edge in enumerate(thresholds[f]):  # below the edge; the rest is at or above it
                    p, n = p + own.get(b, (0, 0))[0], n + own.get(b, (0, 0))[1]
                    for at_least, (x, y) in ((False, (p, n)), (True, (p0 - p, n0 - n))):
                        if x + y >= least_covered and (g := _gain(x, y, p0, n0)) > best:
                            best, chosen = g, Condition(f, at_least, edge)
            if chosen is None:
                break
            conditions.append(chosen)
            grown = grown.where(chosen.column())
        if not conditions:
            break
        heads = [_all(conditions[:i + 1]) for i in range(len(conditions))]
        sums = [F.sum(F.when(h, c)).alias(f"{n}{i}") for i, h in enumerate(heads)
                for n, c in (("p", F.col("bad")), ("n", 1 - F.col("bad")))]
        found = rows.where("not grow").agg(*sums).first()
        worth = [(((found[f"p{i}"] or 0) - (found[f"n{i}"] or 0)) / max(1, (found[f"p{i}"] or 0) + (found[f"n{i}"] or 0)), -i)
                 for i in range(len(heads))]
        value, least = max(worth)
        if value < 2 * precision - 1:
            break
        rule = conditions[:1 - least]
        rules.append(rule)
        rows = rows.where(~_all(rule))
    return rules


def rule_number(rules: Sequence[Sequence[Condition]]) -> Column:
    """Number (from 1) of the first rule that fires, null if none does."""
    out = None
    for i, rule in enumerate(rules, 1):
        out = F.when(_all(rule), F.lit(i)) if out is None else out.when(_all(rule), F.lit(i))
    return F.lit(None).cast("int") if out is None else out.cast("int")


def labelled_stats(stats: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    named = labels.select(F.col("doc_id").alias("of"), (1 - F.col(label)).alias("bad")).where("of is not null and bad is not null")
    return stats.join(named, F.col("doc_id") == F.col("of")).drop("of")


def judge(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, BASE, FEATURES, base_failed, rule (of the learned list) and kept for every row."""
    stats = pinned(with_stats(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_t")), "_t"))
    rules = learn(labelled_stats(stats, labels))
    out = stats.withColumns({"base_failed": base_failed(), "rule": rule_number(rules)})
    return out.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def keep_good(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the base rules and the learned list keep, with all their columns.
    Statistics are computed once, without the texts; the rows follow by their key."""
    stats = pinned(with_stats(docs.select(F.col(doc_id).alias("doc_id"), row_key(F.col(doc_id), F.col(text)).alias("key"),
                                          F.col(text).alias("_t")), "_t"))
    rules = learn(labelled_stats(stats, labels))
    kept = stats.where(~base_failed() & rule_number(rules).isNull())
    return keep_keys(docs, kept.select("key"), doc_id, text)
