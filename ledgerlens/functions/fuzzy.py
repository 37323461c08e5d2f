"""Fuzzy vocabulary mapping (PRJ5): token-sort ratio against a standard vocabulary, with a
synonym table as fallback.

The ratio is the Indel similarity 100·2·LCS/(|a|+|b|) on whitespace tokens sorted and re-joined
(case kept). It runs in an Arrow-batched pandas UDF on (distinct value, term) pairs; the
vocabulary is a short fixed list exploded per value, so no join of two data-sized sides occurs.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The standard column vocabulary.
STANDARD_COLUMNS = ["date", "region", "product", "quantity", "profit"]


def _lcs(a: str, b: str) -> int:
    if len(a) < len(b):
        a, b = b, a
    prev = [0] * (len(b) + 1)
    for ch in a:
        cur = [0]
        for j, cb in enumerate(b):
            cur.append(prev[j] + 1 if ch == cb else max(prev[j + 1], cur[j]))
        prev = cur
    return prev[-1]


def token_sort_ratio(a: str, b: str) -> float:
    sa, sb = " ".join(sorted(a.split())), " ".join(sorted(b.split()))
    if not sa and not sb:
        return 100.0
    return 100.0 * 2 * _lcs(sa, sb) / (len(sa) + len(sb))


@F.pandas_udf(T.DoubleType())
def token_sort_ratio_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([token_sort_ratio(x or "", y or "") for x, y in zip(a, b)], dtype="float64")


def vocabulary_mapping(candidates: DataFrame, col: str, vocabulary: Sequence[str] = STANDARD_COLUMNS,
                       threshold: float = 80.0, synonyms: DataFrame | None = None) -> DataFrame:
    """(value, term, score): for every term, the best-scoring distinct value when its score
    reaches ``threshold`` (ties → smallest value), else the smallest value listed as a synonym
    of the term in ``synonyms`` (columns term, synonym; compared lower-cased)."""
    vals = candidates.select(F.col(col).cast("string").alias("value")).where(F.col("value").isNotNull()).distinct()
    pairs = vals.select("value", F.explode(F.array(*[F.lit(t) for t in vocabulary])).alias("term"))
    scored = pairs.withColumn("score", token_sort_ratio_udf(F.col("term"), F.col("value")))
    best = scored.groupBy("term").agg(F.min_by(F.struct("value", "score"), F.struct(-F.col("score"), F.col("value"))).alias("b"))
    best = best.select("term", F.col("b.value").alias("value"), F.col("b.score").alias("score"))
    hit = best.where(F.col("score") >= threshold)
    if synonyms is None:
        return hit
    missing = best.where(F.col("score") < threshold).select("term")
    syn = synonyms.select("term", F.lower("synonym").alias("_syn"))
    fb = (vals.withColumn("_syn", F.lower(F.regexp_replace("value", "_", " ")))
          .join(syn, "_syn").join(missing, "term")
          .groupBy("term").agg(F.min("value").alias("value")).withColumn("score", F.lit(None).cast("double")))
    return hit.unionByName(fb)


def normalize_columns(df: DataFrame, vocabulary: Sequence[str] = STANDARD_COLUMNS, threshold: float = 80.0,
                      synonyms: DataFrame | None = None) -> DataFrame:
    """Rename headers to the standard vocabulary (headers form a one-column table)."""
    spark = SparkSession.getActiveSession()
    headers = spark.createDataFrame([(c,) for c in df.columns], "h string")
    mapping = {r["value"]: r["term"] for r in vocabulary_mapping(headers, "h", vocabulary, threshold, synonyms).collect()}
    return df.withColumnsRenamed(mapping)


def normalize_values(df: DataFrame, col: str, out: str, vocabulary: Sequence[str], threshold: float = 80.0,
                     synonyms: DataFrame | None = None) -> DataFrame:
    """Map each value of a string column to its best vocabulary term (ties: the smaller term), or by
    its synonym where no term reaches the threshold; NULL when unmapped. One row per input row."""
    vals = df.select(F.col(col).cast("string").alias("value")).where(F.col("value").isNotNull()).distinct()
    pairs = vals.select("value", F.explode(F.array(*[F.lit(t) for t in vocabulary])).alias("term"))
    scored = pairs.withColumn("score", token_sort_ratio_udf(F.col("term"), F.col("value")))
    m = (scored.groupBy("value").agg(F.min_by(F.struct("term", "score"), F.struct(-F.col("score"), F.col("term"))).alias("b"))
         .select(F.col("value").alias("_v"), F.when(F.col("b.score") >= threshold, F.col("b.term")).alias(out)))
    if synonyms is not None:
        syn = (synonyms.where(F.col("term").isin(list(vocabulary))).groupBy(F.lower("synonym").alias("_syn")).agg(F.min("term").alias("_st")))
        m = (m.join(syn, F.lower(F.regexp_replace("_v", "_", " ")) == F.col("_syn"), "left")
             .select("_v", F.coalesce(F.col(out), F.col("_st")).alias(out)))
    return df.join(m, df[col].cast("string") == m["_v"], "left").drop("_v")
