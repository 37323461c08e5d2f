"""Deterministic train/test split and fold assignment (SPL1, VAL1 folds).

A row's side depends only on its key and the seed, so the split is stable under re-execution
and executor loss (no ``rand()`` whose stream depends on partitioning)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# multipliers of the integer-key form (primes), fixed so that the oracle can reproduce it
KEY_MULTIPLIERS = (1000003, 7919, 104729, 13)


def bucket_of(keys: Sequence[str], seed: int = 42, buckets: int = 100, integer_keys: bool = False):
    """0..buckets-1 per row: ``xxhash64`` of the keys and seed, or, for integer keys, a
    modular form ``(Σ m_i·k_i + seed) mod buckets`` that SQL engines can reproduce."""
    if integer_keys:
        acc = F.lit(seed).cast("long")
        for i, k in enumerate(keys):
            acc = acc + F.col(k).cast("long") * F.lit(KEY_MULTIPLIERS[i % len(KEY_MULTIPLIERS)])
        return F.pmod(acc, F.lit(buckets))
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys], F.lit(seed)), F.lit(buckets))


def with_split(df: DataFrame, keys: Sequence[str], test_size: float = 0.2, seed: int = 42, integer_keys: bool = False,
               out: str = "is_test") -> DataFrame:
    return df.withColumn(out, (bucket_of(keys, seed, 100, integer_keys) < int(round(test_size * 100))).cast("int"))


def train_test_split(df: DataFrame, keys: Sequence[str], test_size: float = 0.2, seed: int = 42,
                     integer_keys: bool = False) -> tuple[DataFrame, DataFrame]:
    flagged = with_split(df, keys, test_size, seed, integer_keys, "_is_test")
    return (flagged.where(F.col("_is_test") == 0).drop("_is_test"),
            flagged.where(F.col("_is_test") == 1).drop("_is_test"))


def with_contiguous_folds(df: DataFrame, pos: str, n: int, k: int = 5, out: str = "fold") -> DataFrame:
    """Unshuffled k-fold: the first n % k folds get one extra row (``floor`` sizes otherwise),
    as an unshuffled KFold assigns them, from a dense 0-based position ``pos``."""
    base, extra = divmod(n, k)
    big = extra * (base + 1)
    p = F.col(pos)
    fold = F.when(p < big, F.floor(p / (base + 1))).otherwise(F.lit(extra) + F.floor((p - big) / max(base, 1)))
    return df.withColumn(out, fold.cast("int"))
