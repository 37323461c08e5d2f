"""Windows over a total order on its own range partitions, with edge rows instead of blocks.

``sequenced`` range-partitions the rows on the order once and numbers them (partition number in the high
bits), so a row's partition can be read off its number. ``edge_window`` evaluates frames that look back
at most ``halo`` rows: each range partition (or, per key, each piece of a key) gets copies of the last
rows before it. Without a key the pieces are the range partitions. With a key, only keys with more rows
than a mean partition are cut, by range partition; there are fewer of them than partitions. All others
are one piece each. The copies come from the last ``halo`` rows of every piece, a table bounded by
partitions x halo rows (per cut key), so no step reads the rows twice. Rows without a key stay where they
are in the order, in pieces by range partition, and get NULL in the new columns.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.session import ensure_checkpoint_dir

PARTITION_BITS = 33  # of ``monotonically_increasing_id``


def sequenced(df: DataFrame, order: Sequence[str | Column], out: str, partitions: int | None = None) -> DataFrame:
    """Add ``out``: a unique number that ascends in ``order``. The rows are checkpointed, so it is stable."""
    ensure_checkpoint_dir(df.sparkSession)
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
            .withColumn(out, F.monotonically_increasing_id()).checkpoint(eager=True))


def range_partition(pos: str) -> Column:
    return F.shiftright(F.col(pos), PARTITION_BITS).cast("int")


def large_keys(source: DataFrame, key: str, pos: str) -> DataFrame:
    """Keys of more rows than a mean range partition, so fewer than there are partitions."""
    counts = source.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.max(range_partition(pos)).alias("_p"))
    whole = counts.agg(F.sum("_n").alias("n"), F.max("_p").alias("p")).first()
    mean = (whole["n"] or 0) / ((whole["p"] or 0) + 1)
    return counts.where(F.col("_n") > mean).select(F.col(key).alias("_large"))


def edge_window(rows: DataFrame, pos: str, halo: int, uses: Sequence[str], columns: Callable[[Window], dict[str, Column]],
                key: str | None = None, source: DataFrame | None = None) -> DataFrame:
    """``rows`` with ``columns(w)``, where ``w`` orders by ``pos`` (within ``key``) and frames reach back at
    most ``halo`` rows of the columns ``uses``. ``source``: where key, pos and ``uses`` can be read cheaply."""
    source = rows if source is None else source
    group = [key] if key else []
    narrow = source.select(*group, pos, *[c for c in uses if c not in group])
    if key:
        large = large_keys(narrow, key, pos).checkpoint(eager=True)  # fewer rows than partitions
        narrow = narrow.join(F.broadcast(large), F.col(key) == F.col("_large"), "left_semi")
        rows = rows.join(F.broadcast(large), F.col(key) == F.col("_large"), "left")
        cut = F.col("_large").isNotNull() | F.col(key).isNull()
        rows = rows.withColumn("_piece", F.when(cut, range_partition(pos)).otherwise(F.lit(-1))).drop("_large")
    else:
        rows = rows.withColumn("_piece", range_partition(pos))
    last = Window.partitionBy(*group, "_piece").orderBy(F.desc(pos))
    tails = (narrow.withColumn("_piece", range_partition(pos)).withColumn("_back", F.row_number().over(last))
             .where(F.col("_back") <= halo).drop("_back"))
    along = Window.partitionBy(*(group or [F.lit(0)])).orderBy(pos)
    opens = F.coalesce(F.lag("_piece", 1).over(along) != F.col("_piece"), F.lit(True))
    tails = tails.withColumn("_opens", F.when(opens, F.col("_piece")))
    # a tail row is an edge of the pieces that open within the next ``halo`` tail rows
    tails = tails.withColumn("_to", F.collect_set("_opens").over(along.rowsBetween(1, halo)))
    edges = tails.withColumn("_piece", F.explode("_to")).drop("_opens", "_to").withColumn("_edge", F.lit(True))
    both = rows.withColumn("_edge", F.lit(False)).unionByName(edges, allowMissingColumns=True)
    w = Window.partitionBy(*group, "_piece").orderBy(pos)
    keyed = (lambda c: F.when(F.col(key).isNotNull(), c)) if key else (lambda c: c)
    return (both.select("*", *[keyed(c).alias(name) for name, c in columns(w).items()])
            .where(~F.col("_edge")).drop("_piece", "_edge"))


def fill_forward(df: DataFrame, pos: str, cols: Sequence[str], fill=0.0) -> DataFrame:
    """Last known value of each column in ``pos`` order (NaN counts as missing), then ``fill``: within the
    range partition, plus the last known value of earlier ones from a table of one row per partition.
    ``df`` is read twice."""
    if not cols:
        return df
    floating = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}
    d = df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast("double")) for c in cols if c in floating}).withColumn("_part", range_partition(pos))
    lasts = d.groupBy("_part").agg(*[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(pos))).alias(f"_l_{c}") for c in cols])
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carry = lasts.select(F.col("_part").alias("_of"), *[F.last(f"_l_{c}", ignorenulls=True).over(before).alias(f"_c_{c}") for c in cols])
    within = Window.partitionBy("_part").orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    filled = {c: F.coalesce(F.last(F.col(c), ignorenulls=True).over(within), F.col(f"_c_{c}"), F.lit(fill)) for c in cols}
    # one row per range partition
    return d.join(F.broadcast(carry), F.col("_part") == F.col("_of")).withColumns(filled).drop("_part", "_of", *[f"_c_{c}" for c in cols])
