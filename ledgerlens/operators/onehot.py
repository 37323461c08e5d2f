"""One-hot encoding with vocabularies as tables (ENC6-ENC8, SCL5): values get slots by a join, rows get
sparse entries; no list of values passes through the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.operators.sequence import ordered_positions


def fit_onehot(df: DataFrame, cols: Sequence[str], drop_first: bool = False) -> DataFrame:
    """(column, value, slot): slots count through the columns in the given order and each column's values in
    their order; missing values have none. ``drop_first``: nor has the first value of a column."""
    cols = list(cols)
    pairs = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("number"), F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                                          for i, c in enumerate(cols)])).alias("s")).select("s.*")
    coded = ordered_positions(pairs.where(F.col("value").isNotNull()).distinct(), ["value"], group=["number", "column"], out="code")
    if drop_first:
        coded = coded.where("code > 0").withColumn("code", F.col("code") - 1)
    sizes = coded.groupBy("number").agg(F.count(F.lit(1)).alias("size"))  # one row per column
    before = F.coalesce(F.sum("size").over(Window.orderBy("number").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (coded.join(sizes.select("number", before.alias("before")), "number")
            .select("column", "value", (F.col("before") + F.col("code")).cast("long").alias("slot")))


def onehot_entries(df: DataFrame, vocabulary: DataFrame, cols: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """(keep..., column, slot): one row per row and column whose value has a slot. Unseen, missing and
    dropped values have no entry. A frequent value is one row of the vocabulary, so AQE splits its side."""
    long = df.select(*keep, F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])).alias("s"))
    return long.select(*keep, "s.column", "s.value").join(vocabulary, ["column", "value"]).select(*keep, "column", "slot")


def onehot_slots(df: DataFrame, vocabulary: DataFrame, cols: Sequence[str], out: str = "slots") -> DataFrame:
    """All columns and the ascending slots of the row, one join per column."""
    d = df
    for i, c in enumerate(cols):
        own = vocabulary.where(F.col("column") == c).select(F.col("value").alias(f"_v{i}"), F.col("slot").alias(f"_s{i}"))
        d = d.join(own, F.col(c).cast("string") == F.col(f"_v{i}"), "left").drop(f"_v{i}")
    return (d.withColumn(out, F.array_sort(F.filter(F.array(*[F.col(f"_s{i}") for i in range(len(cols))]), lambda s: s.isNotNull())))
            .drop(*[f"_s{i}" for i in range(len(cols))]))


def fit_slot_scales(entries: DataFrame, rows: int) -> DataFrame:
    """(slot, scale) without centring: the population standard deviation of a 0/1 column, 1 where that is 0."""
    share = F.count(F.lit(1)) / F.lit(float(rows))
    return entries.groupBy("slot").agg(share.alias("p")).select("slot", F.when(F.col("p") < 1, F.sqrt(F.col("p") * (1 - F.col("p")))).otherwise(1.0).alias("scale"))
