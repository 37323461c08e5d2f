"""Dense positions in a total order without a single-task window (row frames: ``edges``).

``ordered_positions`` numbers rows (or (value, count) rows) in a total order: the rows are
range-partitioned on the order, a reliable checkpoint pins the partitioning, per-partition
totals give offsets (a table with one row per partition and group), and a window partitioned
by (partition, group) numbers rows inside each piece. A hot group is split across range
partitions, so no task ever holds more than one range partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.session import ensure_checkpoint_dir


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def ordered_positions(df: DataFrame, order: Sequence[str | Column], group: Sequence[str] = (),
                      weight: str | None = None, out: str = "_pos", partitions: int | None = None) -> DataFrame:
    """Add ``out`` = number (or total ``weight``) of rows strictly before each row within its
    ``group`` in ``order``. With unique order keys and no weight this is a dense 0-based index."""
    group = list(group)
    ensure_checkpoint_dir(df.sparkSession)
    n = partitions or shuffle_partitions(df)
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    ranged = (df.repartitionByRange(n, *[F.col(g) for g in group], *order_cols)
              .withColumn("_rp", F.spark_partition_id()))
    ranged = ranged.checkpoint(eager=True)
    wcol = F.col(weight) if weight else F.lit(1)
    totals = ranged.groupBy("_rp", *group).agg(F.sum(wcol).cast("long").alias("_tot"))
    wo = (Window.partitionBy(*group) if group else Window.partitionBy()).orderBy("_rp").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_rp", *group, F.coalesce(F.sum("_tot").over(wo), F.lit(0)).cast("long").alias("_off"))
    wi = Window.partitionBy("_rp", *group).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, -1)
    inner = F.coalesce(F.sum(wcol).over(wi), F.lit(0)).cast("long")
    # without groups one row per range partition
    return (ranged.join(offsets if group else F.broadcast(offsets), ["_rp", *group])
            .withColumn(out, F.col("_off") + inner)
            .drop("_rp", "_off"))
