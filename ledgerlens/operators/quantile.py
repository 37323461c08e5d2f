"""Exact grouped quantiles (linear interpolation, as pandas/numpy) without gathering a group.

Spark's exact ``percentile`` keeps every distinct value of a group in one aggregation buffer. Groups of
up to ``GROUP_ROWS`` rows use it, in one aggregation. Larger ones are selected in bounded pieces:

1. A mergeable sketch encloses the wanted ranks (``floor`` and ``ceil`` of ``p (n - 1)``) per group and
   probability by two values; one pass counts the rows below exactly and keeps the values between,
   counted per distinct value.
2. While the largest candidate set exceeds ``rows_per_task``, a sketch cuts it into ``fanout`` value
   buckets; exact bucket counts locate the bucket holding each wanted rank, and only that bucket stays
   a candidate. Equal values always fall in the same bucket, so ranks stay exact.
3. A cumulative count over a window partitioned by (group, target) picks the value at the wanted rank.

The rows (group, value) are read from the input once and stored; distinct values of large groups are
never materialised whole. Every window and buffer is bounded, and only single rows reach the driver.
NULL and NaN values are skipped (pandas ``quantile``); rows with a NULL group key form no group.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.session import ensure_checkpoint_dir
from ledgerlens.session import stored as stored_rows

DEFAULT_ROWS_PER_TASK = 4_000_000
GROUP_ROWS = 250_000


def _prob_name(p: float) -> str:
    return "q" + (f"{p:.6f}".rstrip("0").rstrip(".").replace(".", "_"))


def group_quantiles(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (),
                    names: Sequence[str] | None = None, method: str = "exact",
                    rows_per_task: int = DEFAULT_ROWS_PER_TASK, fanout: int = 64,
                    accuracy: int = 10000, with_count: bool = False, group_rows: int = GROUP_ROWS, stored: bool = False) -> DataFrame:
    """Quantiles of ``value`` per group ``by`` → one row per group, one column per prob.

    ``method='approx'`` uses ``percentile_approx`` only (one pass, bounded memory, rank error
    ≤ n/accuracy); ``'exact'`` matches pandas ``quantile`` (linear interpolation). ``group_rows``: rows
    up to which a group is one aggregation buffer. ``stored``: ``df`` can be read again cheaply.
    """
    by = list(by)
    probs = [float(p) for p in probs]
    names = list(names) if names else [_prob_name(p) for p in probs]
    base = df.select(*by, F.col(value).cast("double").alias("_v"))
    base = base.where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    for k in by:
        base = base.where(F.col(k).isNotNull())

    if method == "approx":
        agg = base.groupBy(*by).agg(F.percentile_approx("_v", probs, accuracy).alias("_qs"),
                                    F.count("_v").alias("_n"))
        cols = [F.col("_qs")[i].alias(n) for i, n in enumerate(names)]
        if with_count:
            cols.append(F.col("_n").alias("n"))
        return agg.select(*by, *cols)
    if method != "exact":
        raise ValueError(f"unknown quantile method {method!r}")

    # the only read of the input; small groups need no more than one aggregation
    base = base if stored else stored_rows(base)
    sizes = base.groupBy(*by).agg(F.count("_v").alias("_n"))
    n_max = sizes.agg(F.max("_n")).first()[0] or 0
    if n_max <= min(group_rows, rows_per_task):
        return _small_groups(base, by, probs, names, with_count)
    if by:
        # at most rows / group_rows groups
        large = sizes.where(F.col("_n") > group_rows).select(*by).checkpoint(eager=True)
        if large.count() < sizes.count():
            rest = _small_groups(base.join(F.broadcast(large), by, "left_anti"), by, probs, names, with_count)
            return rest.unionByName(group_quantiles(base.join(F.broadcast(large), by, "left_semi"), "_v", probs, by, names, method, rows_per_task, fanout, accuracy,
                                                    with_count, group_rows, stored=True))
    return _large_groups(base, by, probs, names, rows_per_task, fanout, accuracy, with_count)


def _small_groups(base: DataFrame, by: list[str], probs: list[float], names: list[str], with_count: bool) -> DataFrame:
    """Spark's exact percentile: its buffer holds the distinct values of one group."""
    agg = base.groupBy(*by).agg(F.percentile("_v", F.array(*[F.lit(p) for p in probs])).alias("_qs"), F.count("_v").alias("_n"))
    cols = [F.get("_qs", F.lit(i)).alias(n) for i, n in enumerate(names)]
    return agg.select(*by, *cols, *([F.col("_n").alias("n")] if with_count else []))


def _large_groups(base: DataFrame, by: list[str], probs: list[float], names: list[str], rows_per_task: int, fanout: int, accuracy: int,
                  with_count: bool, sketched: bool = True) -> DataFrame:
    """Ranks by exact counts between boundaries. A sketch gives, per group and probability, two values
    that enclose the wanted ranks; one pass counts the rows below and keeps only the values between, and
    the rounds below narrow those further. Where a sketch erred, all values of the groups are counted."""
    stats = base.groupBy(*by).agg(F.count("_v").alias("_n")).checkpoint(eager=True)
    if sketched:
        margin = 4.0 / accuracy
        around = [x for p in probs for x in (max(0.0, p - margin), min(1.0, p + margin))]
        # read by both steps below
        found = base.groupBy(*by).agg(F.percentile_approx("_v", around, accuracy).alias("_cuts")).checkpoint(eager=True)
        rows = _join_small(base, F.broadcast(found), by)  # one row per large group
        low, high = [F.get("_cuts", F.lit(2 * i)) for i in range(len(probs))], [F.get("_cuts", F.lit(2 * i + 1)) for i in range(len(probs))]
        between = [(F.col("_v") >= a) & (F.col("_v") <= b) for a, b in zip(low, high)]
        inside = F.filter(F.array(*[F.when(c, F.lit(i)) for i, c in enumerate(between)]), lambda x: x.isNotNull())
        below = rows.groupBy(*by).agg(*[F.sum((F.col("_v") < a).cast("long")).alias(f"_b{i}") for i, a in enumerate(low)])
        cand = rows.where(reduce(or_, between)).select(*by, "_v", F.explode(inside).alias("_p")).groupBy(*by, "_p", "_v").agg(F.count(F.lit(1)).alias("_c"))
        # both ranks of a probability lie in its interval
        cand = cand.select(*by, F.explode(F.array(2 * F.col("_p"), 2 * F.col("_p") + 1)).alias("_t"), "_v", "_c").checkpoint(eager=True)
        start = F.explode(F.array(*[F.struct(F.lit(t).alias("_t"), F.col(f"_b{t // 2}").alias("_below")) for t in range(2 * len(probs))]))
        below = below.select(*by, start.alias("_s")).select(*by, "_s._t", "_s._below")
        result = _pick(cand, stats, below, by, probs, names, rows_per_task, fanout, accuracy, with_count)
        checked = result.checkpoint(eager=True)
        if not checked.where(F.expr(" OR ".join(f"`{n}` IS NULL" for n in names))).limit(1).count():
            return checked
    counted = base.groupBy(*by, "_v").agg(F.count("_v").alias("_c")).checkpoint(eager=True)
    return _pick(counted, stats, None, by, probs, names, rows_per_task, fanout, accuracy, with_count)


def _pick(counted: DataFrame, stats: DataFrame, below: DataFrame | None, by: list[str], probs: list[float], names: list[str], rows_per_task: int,
          fanout: int, accuracy: int, with_count: bool) -> DataFrame:
    """Values at the wanted ranks among candidates (by, [_t,] _v, _c), of which ``below`` rows are smaller."""
    per_target = below is not None
    counted = counted.where(F.col("_v").isNotNull())
    n_max = counted.groupBy(*by, *(["_t"] if per_target else [])).agg(F.count(F.lit(1)).alias("_d")).agg(F.max("_d")).first()[0] or 0

    # wanted ranks: target 2i = floor(p(n-1)), 2i+1 = ceil(p(n-1))
    rank_structs = []
    for i, p in enumerate(probs):
        pos = F.lit(p) * (F.col("_n") - 1)
        rank_structs.append(F.struct(F.lit(2 * i).alias("t"), F.floor(pos).cast("long").alias("r")))
        rank_structs.append(F.struct(F.lit(2 * i + 1).alias("t"), F.ceil(pos).cast("long").alias("r")))
    targets = (stats.select(*by, F.explode(F.array(*rank_structs)).alias("_tr"))
               .select(*by, F.col("_tr.t").alias("_t"), F.col("_tr.r").alias("_r"), F.lit(0).cast("long").alias("_below")))
    if per_target:
        targets = targets.drop("_below").join(below, [*by, "_t"])

    cand = counted       # (by, [_t,] _v, _c)
    size = n_max
    cut_fracs = [i / fanout for i in range(1, fanout)]
    while size > rows_per_task:
        grp = by + (["_t"] if per_target else [])
        sketch = cand.groupBy(*grp).agg(F.percentile_approx("_v", cut_fracs, accuracy).alias("_cuts"))
        bucketed = _join_small(cand, F.broadcast(sketch), grp)
        bucketed = bucketed.withColumn("_b", F.size(F.filter("_cuts", lambda c: c < F.col("_v")))).drop("_cuts")
        bstats = bucketed.groupBy(*grp, "_b").agg(F.sum("_c").cast("long").alias("_cnt"), F.count(F.lit(1)).alias("_d"))
        w = Window.partitionBy(*grp).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1) if grp \
            else Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
        bstats = bstats.withColumn("_start", F.coalesce(F.sum("_cnt").over(w), F.lit(0)).cast("long"))
        on = by + (["_t"] if per_target else [])
        picked = _join_small(targets, bstats, on).where(
            (F.col("_below") + F.col("_start") <= F.col("_r")) &
            (F.col("_r") < F.col("_below") + F.col("_start") + F.col("_cnt")))
        targets = picked.select(*by, "_t", "_r", (F.col("_below") + F.col("_start")).alias("_below"), "_b", "_cnt", "_d")
        size = targets.agg(F.max("_d")).first()[0] or 0
        keep = targets.select(*by, "_t", "_b")
        cand = _join_small(bucketed, F.broadcast(keep), by + (["_t", "_b"] if per_target else ["_b"])).select(*by, "_t", "_v", "_c")
        targets = targets.select(*by, "_t", "_r", "_below")
        # each round keeps ~1/fanout of the candidates: materialise them (and the small target
        # table) so the next round does not re-derive them from the source
        ensure_checkpoint_dir(cand.sparkSession)
        cand, targets = cand.checkpoint(eager=True), targets.checkpoint(eager=True)
        per_target = True

    grp = by + (["_t"] if per_target else [])
    vc = cand.select(*grp, "_v", "_c")
    w = (Window.partitionBy(*grp) if grp else Window.partitionBy()).orderBy("_v")
    vc = vc.withColumn("_cum", F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    hit = _join_small(vc, F.broadcast(targets), grp).where(
        (F.col("_below") + F.col("_cum") - F.col("_c") <= F.col("_r")) & (F.col("_r") < F.col("_below") + F.col("_cum")))
    picked = hit.select(*by, "_t", F.col("_v").alias("_val"))
    wide = picked.groupBy(*by).agg(*[F.max(F.when(F.col("_t") == t, F.col("_val"))).alias(f"_x{t}")
                                     for t in range(2 * len(probs))])
    res = _join_small(stats, wide, by, how="left")
    cols = []
    for i, (p, nm) in enumerate(zip(probs, names)):
        pos = F.lit(p) * (F.col("_n") - 1)
        frac = pos - F.floor(pos)
        lo, hi = F.col(f"_x{2 * i}"), F.col(f"_x{2 * i + 1}")
        cols.append((lo + (hi - lo) * frac).alias(nm))
    if with_count:
        cols.append(F.col("_n").alias("n"))
    return res.select(*by, *cols)


def _join_small(big: DataFrame, small: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``on``; with no key the small side has exactly one row per the caller's
    construction, so a keyed join on a constant column is used instead of a cross product."""
    if on:
        return big.join(small, on, how)
    return (big.withColumn("_one", F.lit(1)).join(small.withColumn("_one", F.lit(1)), "_one", how).drop("_one"))


def quantiles(df: DataFrame, value: str, probs: Sequence[float], method: str = "exact", **kw) -> list[float | None]:
    """Global quantiles of one column as driver-side scalars (a 1-row profile)."""
    row = group_quantiles(df, value, probs, (), names=[f"_p{i}" for i in range(len(probs))], method=method, **kw).first()
    if row is None:
        return [None] * len(probs)
    return [row[f"_p{i}"] for i in range(len(probs))]


def column_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], method: str = "exact", **kw) -> dict[str, list]:
    """Quantiles of many columns in one computation: the columns are stacked into
    (column, value) and the column name becomes the group key. Returns {column: [q...]}
    (a profile bounded by the number of columns)."""
    cols = list(cols)
    if not cols:
        return {}
    stacked = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("_col"), F.col(c).cast("double").alias("_val"))
                                            for c in cols])).alias("_s")).select("_s._col", "_s._val")
    names = [f"_p{i}" for i in range(len(probs))]
    rows = group_quantiles(stacked, "_val", probs, ["_col"], names=names, method=method, **kw).collect()
    out = {c: [None] * len(probs) for c in cols}
    for r in rows:
        out[r["_col"]] = [r[n] for n in names]
    return out
