"""Gradient boosting on histograms (MDL3, MDL4): leaf-wise trees with L1/L2 penalties, many models in
one pass over the data.

``bin_table`` codes every feature as at most 255 bins (0: missing) and stores blocks of rows once, as
Parquet below the shared folder. ``fit_many`` then grows the trees of all models together: a model
is a target, a set of parameters and the rows it learns from (all but one fold, or the first rows of
them). Per step one Spark job reads the blocks, routes rows through the trees grown so far, sums
gradients and Hessians per (model, open leaf, feature, bin) inside each task, merges the tasks' sums
per (model, leaf) after one exchange, and finds the best split there. The driver receives one row per
open leaf, never data. k folds, two targets or several trials cost the jobs of one model.

Leaves are split in the order of their gain until ``num_leaves``. The gain of a leaf does not depend
on other leaves, so a step evaluates the children of every leaf that could still be chosen (the best
ones that fit the number of leaves left), and the order is replayed on what is known; the result is
the tree of one split at a time. Without ``num_leaves`` all leaves are split down to ``max_depth``.

Gain: score(G_l, H_l) + score(G_r, H_r) - score(G, H) with score = T(G)^2 / (H + reg_lambda) and T the
soft threshold by reg_alpha; leaf value: -learning_rate T(G) / (H + reg_lambda). Missing values go to
the side of larger gain. Ties go to the first feature, the lowest bin. Row and column draws depend on
(seed, round, block) alone, and sums are merged in a fixed order, so reruns agree.

Categorical columns count as one 0/1 column per value, without making them: a value's code is kept, its
sums are sparse and merge in ranges of codes, and a split sends one value to the right. Vocabularies
(column, value, code) are tables; a fitted model keeps the values that its trees name.

Leaves of at most ``LOCAL_ROWS`` rows need no more passes: their rows (bins, gradients) go to one task
each, which finishes the subtree by the same rules. Small tables thus take one job a tree, large ones
one per level until leaves are small (the job of a level also sends the rows of its small leaves); what
is sent is bounded by the number of leaves.

Models that learn from at most ``LOCAL_ROWS`` rows grow all their trees so, in one job: each of a few
tasks gets the coded rows and some of the models.

Running margins are stored with the blocks every ``REFRESH`` rounds; the table of the rounds before is
then removed.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from itertools import groupby
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.operators.sequence import ordered_positions
from ledgerlens.session import ensure_checkpoint_dir

MAX_BINS = 255
REFRESH = 4
SEED = 42
LEAST_GAIN = 1e-9
DEEPEST = 64
LOCAL_ROWS = 1 << 16
BLOCK_ROWS = 1 << 17  # rows of a table that go whole to the tasks which make models of few of them

# Default parameters of the two booster configurations and of the stand-alone booster.
FAMILY_DEFAULTS = {
    "xgb": {"n_estimators": 100, "max_depth": 6, "learning_rate": 0.1, "subsample": 0.8, "colsample_bytree": 0.8,
            "reg_alpha": 0.0, "reg_lambda": 1.0, "min_child_weight": 1.0, "min_child_samples": 0, "num_leaves": None, "subsample_freq": 1},
    "lgbm": {"n_estimators": 100, "max_depth": 6, "learning_rate": 0.1, "subsample": 0.8, "colsample_bytree": 0.8,
             "reg_alpha": 0.0, "reg_lambda": 0.0, "min_child_weight": 1e-3, "min_child_samples": 20, "num_leaves": 31, "subsample_freq": 0},
    "boosted": {"n_estimators": 300, "max_depth": 8, "learning_rate": 0.05, "subsample": 1.0, "colsample_bytree": 1.0,
                "reg_alpha": 0.0, "reg_lambda": 1.0, "min_child_weight": 1.0, "min_child_samples": 0, "num_leaves": None, "subsample_freq": 1},
}
NO_EFFECT = ("n_jobs", "verbose", "random_state")


class BadParameters(ValueError):
    """Parameters that no model can be fitted with."""


def resolve(family: str, params: dict | None = None) -> dict:
    """Defaults of the family, overridden; the drawn share of rows counts only where the family draws rows
    (``subsample_freq`` > 0), as published."""
    if family not in FAMILY_DEFAULTS:
        raise BadParameters(f"unknown family {family}")
    given = {k: v for k, v in (params or {}).items() if k not in NO_EFFECT}
    unknown = set(given) - set(FAMILY_DEFAULTS[family])
    if unknown:
        raise BadParameters(f"unknown parameters {sorted(unknown)}")
    p = {**FAMILY_DEFAULTS[family], **given}
    p["max_depth"] = DEEPEST if p["max_depth"] is None or p["max_depth"] <= 0 else int(p["max_depth"])
    p["n_estimators"] = int(p["n_estimators"])
    if p["n_estimators"] < 1 or p["learning_rate"] <= 0 or not 0 < p["subsample"] <= 1 or not 0 < p["colsample_bytree"] <= 1 \
            or p["reg_alpha"] < 0 or p["reg_lambda"] < 0 or (p["num_leaves"] is not None and p["num_leaves"] < 2):
        raise BadParameters(f"parameters out of range: {p}")
    return p


@dataclass(frozen=True)
class Spec:
    """One model: ``fold`` is left out of training (None: nothing is), ``rows`` keeps the first so many
    training rows in position order."""
    family: str = "xgb"
    params: dict = field(default_factory=dict)
    target: str = "label"
    fold: int | None = None
    rows: int | None = None
    objective: str = "regression"
    seed: int = SEED


@dataclass
class BinnedTable:
    blocks: DataFrame  # block, n, x, y, fold, pos
    features: list[str]
    cuts: list[np.ndarray]  # upper bounds (inclusive) of bins 1, 2, ... of each feature but the last
    targets: list[str]
    folds: dict[int, tuple[int, int]]  # fold -> (smallest position, rows)
    rows: int
    categories: list[str] = field(default_factory=list)
    values: list[int] = field(default_factory=list)  # number of codes of each
    vocabulary: DataFrame | None = None  # column, value, code
    first_code: int = 0  # 1: the first value of a column has no 0/1 column

    @property
    def columns(self) -> int:
        """Columns with every value as a column of its own."""
        return len(self.features) + sum(max(0, v - self.first_code) for v in self.values)

    @property
    def bins(self) -> np.ndarray:
        return np.array([len(c) + 2 for c in self.cuts], dtype=np.int64)


_BLOCK = "block long, n int, x binary, codes binary, y binary, fold binary, pos binary"
CODES = 1 << 16  # codes whose sums are merged together
_NAMES = [c.split()[0] for c in _BLOCK.split(", ")]


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def find_cuts(df: DataFrame, features: Sequence[str], max_bins: int = MAX_BINS) -> list[np.ndarray]:
    """Bin bounds per feature: all distinct values where they fit, else quantiles (at most
    ``max_bins`` - 1 values per feature reach the driver)."""
    if not features:
        return []
    value = [F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in features]
    probs = [i / (max_bins - 1) for i in range(1, max_bins - 1)]
    distinct = df.agg(*[F.approx_count_distinct(v).alias(f"d{i}") for i, v in enumerate(value)]).first()
    few = [i for i in range(len(features)) if distinct[f"d{i}"] <= max_bins // 2]
    # every feature's sketches are merged by a task of its own
    each = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("i"), v.alias("v")) for i, v in enumerate(value)])).alias("s")).select("s.*")
    some = F.col("i").isin(few)
    found = {r["i"]: r for r in each.groupBy("i").agg(F.array_sort(F.collect_set(F.when(some, F.col("v")))).alias("s"),
             F.percentile_approx(F.when(~some, F.col("v")), probs, 100_000 if max_bins > 100 else 10_000).alias("q")).collect()}
    cuts = []
    for i in range(len(features)):
        values = found[i]["s" if i in few else "q"] if i in found else []
        values = np.unique(np.array([v for v in values or []], dtype=float))
        cuts.append(values[:-1] if i in few else values)  # beyond the last bound lies the last bin
    return cuts


def vocabularies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, code): codes count from 0 in the order of the values, missing values have none."""
    pairs = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])).alias("s")).select("s.*")
    coded = ordered_positions(pairs.where(F.col("value").isNotNull()).distinct(), ["value"], group=["column"], out="code")
    return coded.select("column", "value", F.col("code").cast("int").alias("code"))


def bin_table(df: DataFrame, features: Sequence[str], targets: Sequence[str], fold: str | None = None, pos: str | None = None,
              max_bins: int = MAX_BINS, cuts: list[np.ndarray] | None = None, parts: int | None = None, categories: Sequence[str] = (),
              drop_first: bool = False) -> BinnedTable:
    """Code and store the rows; rows without any target value stay out of the models of that target.
    ``categories``: string columns; ``drop_first``: their first value has no column of its own."""
    spark = df.sparkSession
    features, targets, categories = list(features), list(targets), list(categories)
    cuts = find_cuts(df, features, max_bins) if cuts is None else cuts
    nf, nt, nc = len(features), len(targets), len(categories)
    vocabulary, values, coded = None, [], df
    if categories:
        path = shared_path(spark, "vocabulary")
        vocabularies(df, categories).write.parquet(path)
        vocabulary = spark.read.schema("column string, value string, code int").parquet(path)
        sizes = {r["column"]: r["n"] for r in vocabulary.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}
        values = [int(sizes.get(c, 0)) for c in categories]
        for i, c in enumerate(categories):
            own = vocabulary.where(F.col("column") == c).select(F.col("value").alias(f"__v{i}"), F.col("code").alias(f"__c{i}"))
            coded = coded.join(own, F.col(c).cast("string") == F.col(f"__v{i}"), "left").drop(f"__v{i}")
    rows = coded.select(*[F.col(c).cast("double") for c in features], *[F.col(c).cast("double") for c in targets],
                        *[F.coalesce(f"__c{i}", F.lit(-1)) for i in range(nc)],
                        (F.col(fold).cast("int") if fold else F.lit(-1)).alias("__fold"), (F.col(pos).cast("long") if pos else F.lit(-1).cast("long")).alias("__pos"))

    def code(batches) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            column = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(nf + nt + nc + 2)]
            x = np.zeros((nf, batch.num_rows), dtype=np.uint8)
            for f in range(nf):
                v = column[f].astype(float)
                known = ~np.isnan(v)
                x[f, known] = 1 + np.searchsorted(cuts[f], v[known], side="left")
            y = np.stack([v.astype(float) for v in column[nf:nf + nt]]) if nt else np.zeros((0, batch.num_rows))
            codes = np.stack([v.astype(np.int32) for v in column[nf + nt:nf + nt + nc]]) if nc else np.zeros((0, batch.num_rows), dtype=np.int32)
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([batch.num_rows], pa.int32()),
                                              *(pa.array([v.tobytes()], pa.binary()) for v in (x, codes, y, column[-2].astype(np.int32), column[-1].astype(np.int64)))], names=_NAMES)
            number += 1

    # every pass over the blocks is as parallel as they are many; small inputs would lie in one
    parts = parts or max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), spark.sparkContext.defaultParallelism)
    rows = rows.repartition(parts)
    path = shared_path(spark, "binned")
    rows.mapInArrow(code, _BLOCK).write.parquet(path)
    blocks = spark.read.schema(_BLOCK).parquet(path)

    def bounds(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for which, place in zip(batch.column("fold").to_pylist(), batch.column("pos").to_pylist(), strict=True):
                which, place = np.frombuffer(which, dtype=np.int32), np.frombuffer(place, dtype=np.int64)
                names = np.unique(which)
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array([int(place[which == f].min()) for f in names], pa.int64()),
                                                  pa.array([int((which == f).sum()) for f in names], pa.int64())], names=["f", "lo", "c"])

    found = blocks.select("fold", "pos").mapInArrow(bounds, "f int, lo long, c long").groupBy("f").agg(F.min("lo").alias("lo"), F.sum("c").alias("c")).collect()
    return BinnedTable(blocks, features, cuts, targets, {r["f"]: (r["lo"], r["c"]) for r in found}, sum(r["c"] for r in found),
                       categories, values, vocabulary, int(drop_first))


# ------------------------------------------------------------------ trees
class Tree:
    """Nodes as parallel lists; feature -1: leaf. ``bin``: largest bin that goes left, or for a value of a
    category -1 less its code: that value goes right."""

    def __init__(self):
        self.feature, self.bin, self.left, self.right, self.missing_left, self.depth = [-1], [0], [0], [0], [False], [0]
        self.split: list[dict | None] = [None]  # best split found, {} when there is none, None before it is known
        self.sums: list[tuple[float, float]] = [(0.0, 0.0)]
        self.rows: list[float] = [math.inf]  # at most so many drawn rows

    def grow(self, node: int) -> None:
        s = self.split[node]
        self.feature[node], self.bin[node], self.missing_left[node] = s["feature"], s["bin"], s["missing_left"]
        for side in ("left", "right"):
            getattr(self, side)[node] = len(self.feature)
            for column, value in (("feature", -1), ("bin", 0), ("left", 0), ("right", 0), ("missing_left", False), ("depth", self.depth[node] + 1), ("split", None)):
                getattr(self, column).append(value)
            g, h = s["gl"], s["hl"]
            self.sums.append((g, h) if side == "left" else (s["g"] - g, s["h"] - h))
            self.rows.append(s["cl"] if side == "left" else s["c"] - s["cl"])

    def arrays(self) -> tuple[np.ndarray, ...]:
        return Nodes((np.array(self.feature), np.array(self.bin), np.array(self.left), np.array(self.right), np.array(self.missing_left)))

    def choose(self, leaves: int | None, deepest: int) -> list[int]:
        """Nodes that are split, best gain first, among what is known."""
        open_, chosen = [0], []
        while open_ and (leaves is None or len(chosen) + 1 < leaves):
            best = max((n for n in open_ if self.split[n] and self.depth[n] < deepest), key=lambda n: (self.split[n]["gain"], -n), default=None)
            if best is None:
                break
            open_.remove(best)
            chosen.append(best)
            if self.feature[best] >= 0:
                open_ += [self.left[best], self.right[best]]
        return chosen


TOP = 6  # levels of a tree that are routed at once: at most 64 exits


class Nodes(tuple):
    """Arrays of a tree's nodes (feature, bin, left, right, missing_left). For rows on their way down, ``TOP`` levels
    at a time are kept as masks of exits (from left to right): a bin of a feature leaves out the exits on the left of
    every node that sends it to the right, so a row's exit is the lowest one that all its bins leave in."""

    def stages(self) -> list[tuple]:
        """Per ``TOP`` levels: group of each node where they begin (-1: a leaf, or not there), masks of (feature; group,
        bin), masks of categories (feature; codes ascending; code, group), first exit of each group, nodes of the exits."""
        if "_stages" not in self.__dict__:
            feature, bins, left, right, missing_left = (v.tolist() for v in self)
            self._stages, roots = [], [0]
            while roots:
                out: list[list[int]] = [[] for _ in roots]
                spans: list[tuple[int, int, int]] = []

                def walk(node: int, depth: int, group: int, out=out, spans=spans) -> None:
                    if feature[node] < 0 or depth == TOP:
                        out[group].append(node)
                        return
                    begin = len(out[group])
                    walk(left[node], depth + 1, group)
                    spans.append((group, node, (1 << len(out[group])) - (1 << begin)))
                    walk(right[node], depth + 1, group)

                for group, root in enumerate(roots):
                    walk(root, 0, group)
                most = max(map(len, out))
                kind = np.uint16 if most <= 16 else np.uint32 if most <= 32 else np.uint64
                by_bin: dict[int, np.ndarray] = {}
                by_code: dict[int, dict[int, np.ndarray]] = {}
                for group, node, gone in spans:
                    f, b, keep = feature[node], bins[node], ~kind(gone)
                    if b < 0:
                        by_code.setdefault(f, {}).setdefault(-1 - b, np.full(len(roots), ~kind(0)))[group] &= keep
                        continue
                    if f not in by_bin:
                        by_bin[f] = np.full((len(roots), 256), ~kind(0))
                    by_bin[f][group, b + 1:] &= keep
                    if not missing_left[node]:
                        by_bin[f][group, 0] &= keep
                group_of = np.full(len(feature), -1, dtype=np.int64)
                group_of[roots] = np.arange(len(roots))
                codes = [(f, np.array(sorted(m)), np.stack([m[c] for c in sorted(m)])) for f, m in by_code.items()]
                first = np.cumsum([0, *map(len, out)])[:-1]
                exits = [n for o in out for n in o]
                self._stages.append((group_of, [(f, t.ravel()) for f, t in by_bin.items()], codes, first, np.array(exits, dtype=np.int64), kind))
                roots = [n for n in exits if feature[n] >= 0]
        return self._stages


def _exit(x: np.ndarray, rows: np.ndarray | None, node: np.ndarray | None, stage: tuple) -> np.ndarray:
    """Exit of a stage that ``rows`` (None: all, from the root) reach from ``node``."""
    group_of, by_bin, by_code, first, exits, kind = stage
    group = None if rows is None else group_of.take(node)
    kept = np.full(x.shape[1] if rows is None else len(rows), ~kind(0))
    begin = None if rows is None else group * 256
    for f, table in by_bin:
        kept &= table.take(x[f] if rows is None else begin + x[f].take(rows), mode="clip")
    for f, codes, masks in by_code:
        value = x[f] if rows is None else x[f].take(rows)
        at = np.minimum(np.searchsorted(codes, value), len(codes) - 1)
        hit = np.flatnonzero(codes[at] == value)
        kept[hit] &= masks[at[hit], 0 if rows is None else group[hit]]
    at = np.bitwise_count((kept & -kept) - kind(1))
    return exits.take(at if rows is None else first.take(group) + at)


def route(x: np.ndarray, tree: tuple[np.ndarray, ...], depth: int) -> np.ndarray:
    """Node that each row (column of ``x``) reaches."""
    tree = tree if isinstance(tree, Nodes) else Nodes(tree)
    stages = tree.stages()
    node = _exit(x, None, None, stages[0])
    for stage in stages[1:]:
        moved = np.flatnonzero(stage[0].take(node) >= 0)
        node[moved] = _exit(x, moved, node.take(moved), stage)
    return node


def step_down(x: np.ndarray, tree: tuple[np.ndarray, ...], node: np.ndarray) -> np.ndarray:
    """Move rows from nodes that are split to their children; all other rows stay."""
    feature, bins, left, right, missing_left = tree
    moved = np.flatnonzero(feature.take(node) >= 0)
    here = node.take(moved)
    v, b = x.ravel().take(feature.take(here) * x.shape[1] + moved), bins.take(here)
    goes_left = np.where(v == 0, missing_left.take(here), v <= b)
    if len(b) and b.min() < 0:
        goes_left = np.where(b < 0, v != -1 - b, goes_left)
    node = node.copy()
    node[moved] = np.where(goes_left, left.take(here), right.take(here))
    return node


@dataclass
class Booster:
    """A fitted model: base margin and trees as lists of nodes (``NODE``); the last features are ``categories``
    columns of strings."""
    features: list[str]
    base: float
    objective: str
    trees: list[dict[str, list]]
    params: dict
    categories: int = 0

    def numeric(self) -> list[str]:
        return self.features[:len(self.features) - self.categories]

    def value_numbers(self) -> list[dict[str, int]]:
        """Per category the values that trees name, numbered."""
        names: list[dict[str, int]] = [{} for _ in range(self.categories)]
        nf = len(self.features) - self.categories
        for t in self.trees:
            for f, v in zip(t["feature"], t["category"], strict=True):
                if v is not None:
                    names[f - nf].setdefault(v, len(names[f - nf]))
        return names

    def importances(self) -> dict[str, float]:
        """Share of the total gain per feature; in a forest every tree counts alike."""
        gain = dict.fromkeys(self.features, 0.0)
        for t in self.trees:
            whole = (sum(t["gain"]) or 1.0) if self.objective == "forest" else 1.0
            for f, g in zip(t["feature"], t["gain"], strict=True):
                if f >= 0:
                    gain[self.features[f]] += g / whole
        total = sum(gain.values())
        return {f: g / total if total else 0.0 for f, g in gain.items()}

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Margins after all trees, of rows given as columns: raw values of the numeric features, then numbers
        of the categories' values (-1: a value that no tree names)."""
        return self.coded_margin(self.coded(x))

    def _coded_trees(self) -> tuple[list[np.ndarray], list[tuple]]:
        """Thresholds of each numeric feature, and the trees on numbers of theirs (and of the categories' values)."""
        if "_arrays" not in self.__dict__:  # made once per process, for scoring many times
            names, nf = self.value_numbers(), len(self.features) - self.categories
            used: list[set[float]] = [set() for _ in range(nf)]
            for t in self.trees:
                for f, b in zip(t["feature"], t["threshold"], strict=True):
                    if 0 <= f < nf:
                        used[f].add(b)
            bounds = [np.array(sorted(u), dtype=float) for u in used]
            trees = []
            for t in self.trees:
                bins = [-1 - names[f - nf][v] if v is not None else 1 + int(np.searchsorted(bounds[f], b)) if f >= 0 else 0
                        for f, v, b in zip(t["feature"], t["category"], t["threshold"], strict=True)]
                nodes = Nodes((np.array(t["feature"]), np.array(bins), np.array(t["left"]), np.array(t["right"]), np.array(t["missing_left"], dtype=bool)))
                trees.append((nodes, int(max(t["depth"])), np.array(t["value"], dtype=float)))
            self._arrays = bounds, trees
        return self._arrays

    def coded(self, x: np.ndarray) -> np.ndarray:
        """Rows given as raw values of the numeric features and numbers of the categories' values, in numbers of the
        model's thresholds (0: missing)."""
        out = np.zeros(x.shape, dtype=np.int32)
        for f, bounds in enumerate(self._coded_trees()[0]):
            known = ~np.isnan(x[f])
            out[f, known] = 1 + np.searchsorted(bounds, x[f, known], side="left")
        for f in range(len(self.features) - self.categories, len(x)):
            out[f] = x[f]
        return out

    def coded_margin(self, x: np.ndarray) -> np.ndarray:
        return _add_trees(np.full(x.shape[1], self.base), x, self._coded_trees()[1])

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """All columns and the prediction (class probability for the binary objective)."""
        names, objective, values, nf = self.features, self.objective, self.value_numbers(), len(self.features) - self.categories
        own = [f"__x{i}" for i in range(len(names))]
        rows = df.select("*", *[F.col(c).cast("double" if i < nf else "string").alias(o) for i, (c, o) in enumerate(zip(names, own, strict=True))])
        schema = T.StructType([*df.schema.fields, T.StructField(out, T.DoubleType())])
        width = len(df.columns)

        def score(batches) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = np.zeros((len(names), batch.num_rows))
                for i in range(len(names)):
                    column = batch.column(width + i)
                    if i < nf:
                        x[i] = column.to_numpy(zero_copy_only=False).astype(float)
                    else:
                        number = values[i - nf]
                        x[i] = [number.get(v, -1) for v in column.to_pylist()]
                m = self.margin(x)
                m = 1 / (1 + np.exp(-m)) if objective == "binary" else m
                yield pa.RecordBatch.from_arrays([*batch.columns[:width], pa.array(m, pa.float64())], names=schema.names)

        return rows.mapInArrow(score, schema)

    def nodes(self, spark: SparkSession) -> DataFrame:
        """The model as a table, one row per node; row (-1, -1) has the base margin."""
        rows = [(-1, -1, -1, "", self.base, -1, None, -1, -1, False, 0.0, 0.0)]
        for number, t in enumerate(self.trees):
            for i, f in enumerate(t["feature"]):
                rows.append((number, i, t["depth"][i], self.features[f] if f >= 0 else "", t["threshold"][i], t["code"][i], t["category"][i], t["left"][i],
                             t["right"][i], bool(t["missing_left"][i]), t["value"][i], t["gain"][i]))
        return spark.createDataFrame(rows, "tree int, node int, depth int, feature string, threshold double, code int, category string, left int, right int, "
                                           "missing_left boolean, value double, gain double")

    def save(self, spark: SparkSession, path: str) -> None:
        meta = json.dumps({"features": self.features, "objective": self.objective, "params": self.params, "categories": self.categories})
        self.nodes(spark).withColumn("meta", F.when(F.col("tree") < 0, F.lit(meta))).coalesce(1).write.parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Booster:
        rows = sorted(spark.read.parquet(path).collect(), key=lambda r: (r["tree"], r["node"]))
        meta = json.loads(rows[0]["meta"])
        at = {f: i for i, f in enumerate(meta["features"])}
        trees: list[dict[str, list]] = []
        for r in rows[1:]:
            if r["node"] == 0:
                trees.append({k: [] for k in NODE})
            for k in trees[-1]:
                trees[-1][k].append(at.get(r[k], -1) if k == "feature" else r[k])
        return cls(meta["features"], rows[0]["threshold"], meta["objective"], trees, meta["params"], meta["categories"])


# ------------------------------------------------------------------ fitting
def _soft(g: np.ndarray, alpha: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0.0)


def _score(g, h, p: dict):
    return _soft(g, p["reg_alpha"]) ** 2 / np.maximum(h + p["reg_lambda"], 1e-16)


def best_splits(g: np.ndarray, h: np.ndarray, c: np.ndarray, starts: np.ndarray, sizes: np.ndarray, p: dict) -> dict[str, np.ndarray]:
    """Best split of every leaf (row) from its sums per bin (features side by side, bin 0 of each: missing).
    gain 0: no split; ``slot``: number of the feature among those given."""
    one = slice(starts[0], starts[0] + sizes[0])
    total_g, total_h, total_c = (v[:, one].sum(axis=1, keepdims=True) for v in (g, h, c))
    own, first = np.repeat(np.arange(len(starts)), sizes), np.repeat(starts, sizes)
    at = np.arange(g.shape[1])
    usable = (at > first) & (at < first + np.repeat(sizes, sizes) - 1)  # neither the missing bin nor the last one

    def left(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        running = np.cumsum(v, axis=1)
        return running - running[:, first], v[:, first]

    (gl, gm), (hl, hm), (cl, cm) = left(g), left(h), left(c)
    parent = _score(total_g, total_h, p)
    rows = np.arange(len(g))
    out = {"g": total_g[:, 0], "h": total_h[:, 0], "c": total_c[:, 0], "gain": np.zeros(len(g)), "slot": np.zeros(len(g), dtype=np.int64),
           "bin": np.zeros(len(g), dtype=np.int64), "missing_left": np.zeros(len(g), dtype=bool), "gl": np.zeros(len(g)), "hl": np.zeros(len(g)), "cl": np.zeros(len(g))}
    for missing_left in (False, True):
        if missing_left and not cm.any():
            break
        a, b, n = (gl + gm, hl + hm, cl + cm) if missing_left else (gl, hl, cl)
        fits = (usable & (n > 0) & (n < total_c) & (n >= p["min_child_samples"]) & (total_c - n >= p["min_child_samples"])
                & (b >= p["min_child_weight"]) & (total_h - b >= p["min_child_weight"]) & (total_c >= p.get("min_samples_split", 0)))
        if missing_left:
            fits &= cm > 0
        gain = np.where(fits, _score(a, b, p) + _score(total_g - a, total_h - b, p) - parent, -np.inf)
        i = np.argmax(gain, axis=1)
        better = np.flatnonzero(gain[rows, i] > np.maximum(LEAST_GAIN, out["gain"]))
        i = i[better]
        for k, v in (("gain", gain[better, i]), ("slot", own[i]), ("bin", i - first[i]), ("missing_left", missing_left), ("gl", a[better, i]), ("hl", b[better, i]), ("cl", n[better, i])):
            out[k][better] = v
    return out


FOUND = "model int, node int, gain double, feature int, bin int, missing_left boolean, gl double, hl double, cl double, g double, h double, c double"


def found_table(model: int, nodes: np.ndarray, feature: np.ndarray, best: dict[str, np.ndarray]) -> pa.Table:
    columns = {"model": np.full(len(nodes), model), "node": nodes, **best, "feature": feature}
    kinds = {"int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_()}
    fields = [f.split() for f in FOUND.split(", ")]
    return pa.table([pa.array(columns[n]).cast(kinds[k]) for n, k in fields], names=[n for n, _ in fields])


def take_splits(found: DataFrame, trees: dict[int, Tree]) -> None:
    """Record the best of the splits found per leaf."""
    record_splits(found.toArrow().to_pylist(), trees)


def record_splits(found: list[dict], trees: dict[int, Tree]) -> None:
    """The largest gain per leaf counts; of equal ones the first feature, the first bin or value."""
    for r in sorted(found, key=lambda r: (r["model"], r["node"], -r["gain"], r["feature"], -r["bin"] if r["bin"] < 0 else r["bin"])):
        tree, node = trees[r["model"]], r["node"]
        if tree.split[node] is None:
            tree.split[node] = r if r["gain"] > 0 else {}
            if node == 0:
                tree.sums[0] = (r["g"], r["h"])


class _Model:
    def __init__(self, spec: Spec, table: BinnedTable):
        self.spec, self.p = spec, resolve(spec.family, spec.params)
        if spec.objective not in ("regression", "binary"):
            raise BadParameters(f"unknown objective {spec.objective}")
        if spec.target not in table.targets:
            raise BadParameters(f"no target {spec.target}")
        self.target = table.targets.index(spec.target)
        self.base, self.rows = 0.0, math.inf
        self.trees: list[tuple] = []  # (arrays, depth, values) of finished trees
        self.kept: list[dict] = []
        self.tree: Tree | None = None
        self.columns = np.arange(len(table.features))

    def state(self) -> dict:
        """What tasks need: trees since the stored margin, and the tree that is growing."""
        return {"p": self.p, "target": self.target, "fold": self.spec.fold, "rows": self.spec.rows, "objective": self.spec.objective, "seed": self.spec.seed}


def _block(batch: pa.RecordBatch, row: int, nf: int, nt: int) -> tuple:
    """block, n, x (bins of the features, then codes of the categories), y, fold, pos."""
    value = {k: batch.column(k)[row].as_py() for k in _NAMES}
    n = value["n"]
    x = np.frombuffer(value["x"], dtype=np.uint8).reshape(nf, n)
    if value["codes"]:
        x = np.concatenate([x.astype(np.int32), np.frombuffer(value["codes"], dtype=np.int32).reshape(-1, n)])
    return (value["block"], n, x, np.frombuffer(value["y"], dtype=float).reshape(nt, n), np.frombuffer(value["fold"], dtype=np.int32), np.frombuffer(value["pos"], dtype=np.int64))


def _learns(m: dict, y: np.ndarray, which: np.ndarray, place: np.ndarray, folds: dict) -> np.ndarray:
    """Rows that a model is trained on."""
    use = ~np.isnan(y)
    if m["fold"] is not None:
        use &= which != m["fold"]
    if m["rows"] is not None:
        lo, c = folds.get(m["fold"], (0, 0))
        use &= np.where(place < lo, place, place - c) < m["rows"]
    return use


def _gradient(m: dict, y: np.ndarray, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
    if m["objective"] == "binary":
        chance = 1 / (1 + np.exp(-margin))
        return chance - y, chance * (1 - chance)
    return margin - y, None


def _add_trees(margin: np.ndarray, x: np.ndarray, trees: list[tuple]) -> np.ndarray:
    for arrays, depth, values in trees:
        margin = margin + values[route(x, arrays, depth)]
    return margin


def fit_many(table: BinnedTable, specs: Sequence[Spec], refresh: int = REFRESH) -> list[Booster]:
    """Fit all models together; a model of fewer rounds drops out when it is done. Forests (family "rf")
    are fitted together among themselves."""
    if not specs:
        return []
    if any(s.family == "rf" for s in specs):
        from ledgerlens.modeling.forest import fit_forests

        forests = iter(fit_forests(table, [s for s in specs if s.family == "rf"]))
        boosters = iter(fit_many(table, [s for s in specs if s.family != "rf"], refresh))
        return [next(forests if s.family == "rf" else boosters) for s in specs]
    spark = table.blocks.sparkSession
    models = [_Model(s, table) for s in specs]
    nf, nt, folds = len(table.features), len(table.targets), table.folds
    sizes = table.bins
    static = [m.state() for m in models]

    def sums(batches) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(static), 2))
        for batch in batches:
            for row in range(batch.num_rows):
                _, _, _, y, which, place = _block(batch, row, nf, nt)
                for k, m in enumerate(static):
                    use = _learns(m, y[m["target"]], which, place, folds)
                    total[k] += use.sum(), y[m["target"]][use].sum()
        yield pa.RecordBatch.from_arrays([pa.array(range(len(static)), pa.int32()), pa.array(total[:, 0]), pa.array(total[:, 1])], names=["model", "n", "s"])

    for r in table.blocks.mapInArrow(sums, "model int, n double, s double").groupBy("model").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect():
        m = models[r["model"]]
        if not r["n"]:
            raise BadParameters("a model has no rows to learn from")
        mean = r["s"] / r["n"]
        m.base = mean if m.spec.objective == "regression" else float(np.log(max(mean, 1e-12) / max(1 - mean, 1e-12)))
        m.rows = r["n"]

    whole = {k: m for k, m in enumerate(models) if min(table.rows, m.spec.rows or table.rows) <= LOCAL_ROWS and table.rows <= BLOCK_ROWS}
    if whole:
        for k, kept in _whole_models(table, whole, static).items():
            models[k].kept = kept
    bases = [m.base for m in models]
    frame, path, since = table.blocks, None, 0
    rounds = max(m.p["n_estimators"] for m in models)

    def margins(batch: pa.RecordBatch, row: int, n: int, stored: bool) -> np.ndarray:
        if stored:
            return np.frombuffer(batch.column("margin")[row].as_py(), dtype=float).reshape(len(static), n)
        return np.repeat(np.array(bases)[:, None], n, axis=1)

    for turn in range(rounds):
        live = [k for k, m in enumerate(models) if turn < m.p["n_estimators"] and k not in whole]
        if not live:
            break
        for k in live:
            m = models[k]
            m.tree = Tree()
            m.tree.rows[0] = m.rows
            m.columns = _columns(static[k], turn, nf)
        open_ = {k: [0] for k in live}
        while open_ and (nf or table.values):
            growing = {k: (models[k].tree.arrays(), max(models[k].tree.depth), nodes, models[k].columns, models[k].trees[since:]) for k, nodes in open_.items()}
            few = {k: {n for n in nodes if models[k].tree.rows[n] <= LOCAL_ROWS} for k, nodes in open_.items()}
            shape = (static, sizes, folds, nf, nt, turn, path is not None, margins, table.values, table.first_code)
            # whole trees of several models share the rows of a task
            if from_root := {k: g for k, g in growing.items() if 0 in few[k]}:
                take_subtrees(_whole_trees(frame, from_root, *shape).toArrow().to_pylist(), {k: models[k].tree for k in from_root})
            if others := {k: g for k, g in growing.items() if k not in from_root}:
                found = _evaluate(frame, others, few, *shape).toArrow().to_pylist()
                record_splits([r for r in found if r["turn"] < 0], {k: models[k].tree for k in others})
                take_subtrees([r for r in found if r["turn"] >= 0], {k: models[k].tree for k in others})
            following = {}
            for k in open_:
                tree, p = models[k].tree, models[k].p
                for node in open_[k]:  # leaves without rows drawn have no split
                    tree.split[node] = {} if tree.split[node] is None else tree.split[node]
                wanted = [n for n in tree.choose(p["num_leaves"], p["max_depth"]) if tree.feature[n] < 0]
                for node in wanted:
                    tree.grow(node)
                # children at the last depth need no histogram
                nodes = [c for n in wanted for c in (tree.left[n], tree.right[n]) if tree.depth[c] < p["max_depth"]]
                if nodes:
                    following[k] = nodes
            open_ = following
        for k in live:
            _finish(models[k], table)
        if turn + 1 < rounds and turn + 1 - since >= refresh:
            old, path = path, shared_path(spark, "margins")
            _with_margins(frame, [m.trees[since:] for m in models], nf, nt, old is not None, margins).write.parquet(path)
            frame, since = spark.read.schema(_BLOCK + ", margin binary").parquet(path), turn + 1
            if old:
                remove_path(spark, old)
    if path:
        remove_path(spark, path)
    for m in models:
        name_values(table, m.kept)
    return [Booster([*table.features, *table.categories], m.base, m.spec.objective, m.kept, m.p, len(table.categories)) for m in models]


NODES = 128  # open leaves whose sums travel together
ROWS_HELD = 2_000_000  # rows whose values are summed up at once


def histogram_rows(held: dict[int, tuple[np.ndarray, ...]], task: int) -> Iterator[pa.RecordBatch]:
    """Rows (model, piece, task, g, c, h) of the sums that a task holds per model: [leaves x cells]."""
    for k, sums in held.items():
        for piece in range(0, len(sums[0]), NODES):
            part = [np.ascontiguousarray(v[piece:piece + NODES]).tobytes() for v in sums]
            yield histogram_row(k, piece, task, part)


HISTOGRAM = "model int, piece int, task long, g binary, c binary, h binary, keys binary, totals binary"
KINDS = [pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 5]
ROWS = 1 << 30  # piece of a leaf whose rows are sent, less its node: block as the task, bins and codes as c


def histogram_row(model: int, piece: int, task: int, sums: Sequence[bytes], keys: bytes | None = None, totals: bytes | None = None) -> pa.RecordBatch:
    column = [model, piece, task, *sums, *([None] * (3 - len(sums))), keys, totals]
    names = [f.split()[0] for f in HISTOGRAM.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([c], KINDS[i]) for i, c in enumerate(column)], names=names)


def value_rows(model: int, task: int, nodes: int, category: int, values: int, leaf: np.ndarray, codes: np.ndarray, weights: Sequence[np.ndarray | None],
               wanted: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Sparse sums per (leaf, value) of one category, by range of codes (piece -1 less its number), with the
    sums of whole leaves. ``weights``: g, None for counts, and h if it is not the count."""
    totals = np.stack([np.bincount(leaf, w, nodes) for w in weights]).tobytes()
    key, code = leaf[wanted] * np.int64(values) + codes[wanted], codes[wanted]
    which = code // CODES
    for part in range(-(-values // CODES)):
        here = which == part if values > CODES else slice(None)
        if nodes * values <= max(1 << 16, 4 * len(key)):  # no more cells than rows, about: count without sorting
            size = nodes * values
            counts = np.bincount(key[here], minlength=size)
            keys = np.flatnonzero(counts)
            each = [(counts if w is None else np.bincount(key[here], w[wanted][here], size))[keys].astype(float).tobytes() for w in weights]
            yield histogram_row(model, -1 - (part * MAX_CATEGORIES + category), task, each, keys.astype(np.int64).tobytes(), totals)
            continue
        keys, at = np.unique(key[here], return_inverse=True)
        sums = [np.bincount(at, None if w is None else w[wanted][here], len(keys)).astype(float).tobytes() for w in weights]
        yield histogram_row(model, -1 - (part * MAX_CATEGORIES + category), task, sums, keys.tobytes(), totals)


MAX_CATEGORIES = 4096  # categorical columns of one table


def best_values(parts: pa.Table, values: Sequence[int], p: dict) -> tuple[int, int, np.ndarray, dict[str, np.ndarray]]:
    """Model, category, leaves and the best value of the category's code range in each leaf."""
    order = np.argsort(parts.column("task").to_numpy()).tolist()
    category = (-1 - parts.column("piece")[0].as_py()) % MAX_CATEGORIES

    def whole(name: str, kind) -> np.ndarray:
        return np.concatenate([np.frombuffer(parts.column(name)[i].as_py(), dtype=kind) for i in order])

    each = [n for n in ("g", "c", "h") if parts.column(n)[0].as_py() is not None]
    totals = np.sum([np.frombuffer(parts.column("totals")[i].as_py(), dtype=float).reshape(len(each), -1) for i in order], axis=0)
    totals = dict(zip(each, totals, strict=True))
    keys, at = np.unique(whole("keys", np.int64), return_inverse=True)
    sums = {n: np.bincount(at, whole(n, float), len(keys)) for n in each}
    for d in (totals, sums):
        d.setdefault("h", d["c"])
    leaf, code = keys // values[category], keys % values[category]
    left = {n: totals[n][leaf] - sums[n] for n in ("g", "c", "h")}
    least = p["min_child_samples"]
    fits = ((left["c"] > 0) & (sums["c"] > 0) & (left["c"] >= least) & (sums["c"] >= least) & (left["h"] >= p["min_child_weight"])
            & (sums["h"] >= p["min_child_weight"]) & (totals["c"][leaf] >= p.get("min_samples_split", 0)))
    gain = np.where(fits, _score(left["g"], left["h"], p) + _score(sums["g"], sums["h"], p) - _score(totals["g"], totals["h"], p)[leaf], 0.0)
    order_ = np.lexsort((code, -gain, leaf))
    leaves, first = np.unique(leaf[order_], return_index=True)
    i = order_[first]
    good = np.where(gain[i] > LEAST_GAIN, gain[i], 0.0)
    return parts.column("model")[0].as_py(), category, leaves, {
        "gain": good, "bin": -1 - code[i], "missing_left": np.ones(len(i), dtype=bool), "gl": left["g"][i], "hl": left["h"][i],
        "cl": left["c"][i], "g": totals["g"][leaves], "h": totals["h"][leaves], "c": totals["c"][leaves]}


def drawn_values(seed: int, turn: int, category: int, codes: np.ndarray, share: float) -> np.ndarray:
    """Values that a tree may split on: a share of the codes, by hash."""
    h = (codes.astype(np.uint64) + np.uint64((seed * 1_000_003 + turn) * 4099 + category + 1)) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(11)).astype(float) / (1 << 53) < share


def merged(parts: pa.Table, width: int) -> tuple[int, int, np.ndarray, np.ndarray, np.ndarray]:
    """Model, first leaf and the sums of all tasks, added in the order of the tasks."""
    order = np.argsort(parts.column("task").to_numpy()).tolist()
    sums = {}
    for name in ("g", "c", "h"):
        column = parts.column(name)
        if column[0].as_py() is not None:
            total = np.frombuffer(column[order[0]].as_py(), dtype=float).copy()
            for i in order[1:]:
                total += np.frombuffer(column[i].as_py(), dtype=float)
            sums[name] = total.reshape(-1, width)
    return parts.column("model")[0].as_py(), parts.column("piece")[0].as_py(), sums["g"], sums.get("h", sums["c"]), sums["c"]


GROUPS = 8  # tasks that share the models whose trees are made whole


def _whole_trees(frame, growing, static, sizes, folds, nf, nt, turn, stored, margins, values, first_code) -> DataFrame:
    """All splits of models that grow from the root by few rows: the coded rows go once to each group of models, with
    the gradients of each (NaN: the row is not drawn)."""
    groups = [sorted(growing)[i::min(GROUPS, len(growing))] for i in range(min(GROUPS, len(growing)))]
    logistic = any(static[k]["objective"] == "binary" for k in growing)
    names = ["part", "block", "n", "x", "g", "h"]

    def send(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                block, n, x, y, which, place = _block(batch, row, nf, nt)
                margin = margins(batch, row, n, stored)
                for part, own in enumerate(groups):
                    g, h = np.full((len(own), n), np.nan), np.full((len(own), n), np.nan) if logistic else None
                    for i, k in enumerate(own):
                        at = np.flatnonzero(_drawn(static[k], y, which, place, folds, block, turn))
                        target = y[static[k]["target"]][at]
                        g[i, at], second = _gradient(static[k], target, _add_trees(margin[k][at], x[:, at], growing[k][4]))
                        if second is not None:
                            h[i, at] = second
                    packed = x[:nf].astype(np.uint8).tobytes() + x[nf:].astype(np.int32).tobytes()
                    column = [part, block, n, packed, g.tobytes(), None if h is None else h.tobytes()]
                    kinds = [pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array([v], kind) for v, kind in zip(column, kinds, strict=True)], names=names)

    def finish(parts: pa.Table) -> pa.Table:
        own = groups[parts.column("part")[0].as_py()]
        order = np.argsort(parts.column("block").to_numpy()).tolist()
        size = [parts.column("n")[i].as_py() for i in order]
        raw = [parts.column("x")[i].as_py() for i in order]
        x = np.concatenate([np.frombuffer(r, dtype=np.uint8, count=nf * n).reshape(nf, n) for r, n in zip(raw, size, strict=True)], axis=1)
        if values:
            codes = [np.frombuffer(r, dtype=np.int32, offset=nf * n).reshape(-1, n) for r, n in zip(raw, size, strict=True)]
            x = np.concatenate([x.astype(np.int32), np.concatenate(codes, axis=1)])

        def whole(name: str) -> np.ndarray:
            return np.concatenate([np.frombuffer(parts.column(name)[i].as_py(), dtype=float).reshape(len(own), n) for i, n in zip(order, size, strict=True)], axis=1)

        g, h = whole("g"), whole("h") if logistic else None
        rows = []
        for i, k in enumerate(own):
            at = np.flatnonzero(~np.isnan(g[i]))
            if len(at):
                second = h[i, at] if static[k]["objective"] == "binary" else None
                found = finish_subtree(x[:, at], g[i, at], second, static[k], growing[k][3], sizes, nf, values, first_code, turn, static[k]["p"]["max_depth"])
                rows += [{**f, "model": k, "node": 0, "turn": t} for t, f in enumerate(found)]
        return subtree_table(rows)

    return (frame.mapInArrow(send, "part int, block long, n int, x binary, g binary, h binary")
            .groupBy("part").applyInArrow(finish, SUBTREE))


def subtree_table(rows: list[dict]) -> pa.Table:
    kinds = {"int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_()}
    fields = [f.split() for f in SUBTREE.split(", ")]
    return pa.table([pa.array([r[n] for r in rows], kinds[t]) for n, t in fields], names=[n for n, _ in fields])


def _drawn(m: dict, y: np.ndarray, which: np.ndarray, place: np.ndarray, folds: dict, block: int, turn: int) -> np.ndarray:
    """Rows that a round of a model learns from."""
    use = _learns(m, y[m["target"]], which, place, folds)
    if m["p"]["subsample"] < 1 and m["p"]["subsample_freq"]:
        use &= np.random.default_rng([m["seed"], turn, block]).random(len(use)) < m["p"]["subsample"]
    return use


def _open_rows(batch, row, growing, static, folds, nf, nt, turn, stored, margins) -> Iterator[tuple]:
    """(block, model, leaf, x, g, h) of a block's drawn rows that lie in open leaves."""
    block, n, x, y, which, place = _block(batch, row, nf, nt)
    margin = margins(batch, row, n, stored)
    for k, (arrays, depth, nodes, _, trees) in growing.items():
        m = static[k]
        target, use = y[m["target"]], _drawn(m, y, which, place, folds, block, turn)
        slot = np.full(len(arrays[0]), -1)
        slot[nodes] = np.arange(len(nodes))
        at = np.flatnonzero(use)
        own = x.take(at, axis=1)
        leaf = slot.take(route(own, arrays, depth))
        if (here := np.flatnonzero(leaf >= 0)).size < len(at):
            at, own, leaf = at[here], own.take(here, axis=1), leaf[here]
        yield block, k, leaf, own, *_gradient(m, target[at], _add_trees(margin[k][at], own, trees))


def add_cells(leaf: np.ndarray, x: np.ndarray, columns: np.ndarray, offsets: np.ndarray, width: int, weights: Sequence, sums: Sequence[np.ndarray]) -> None:
    """Add weights (None: counts) of rows to the sums [leaves x width] per leaf, feature and bin."""
    for f, offset, end in zip(columns, offsets, [*offsets[1:], width], strict=True):
        size = int(end - offset)
        key = leaf * size + x[f]
        for total, weight in zip(sums, weights, strict=False):
            total[:, offset:end] += np.bincount(key, weight, len(total) * size).reshape(-1, size)


def _evaluate(frame, growing, few, static, sizes, folds, nf, nt, turn, stored, margins, values, first_code) -> DataFrame:
    """Best split of every open leaf of the growing trees (turn -1), and all splits below those in ``few``, whose rows
    go to one task each: (turn, at) numbers the splits of a leaf and the node of the subtree that is split; split
    t makes the nodes 2 t + 1 and 2 t + 2."""
    offsets = {k: np.cumsum(sizes[g[3]]) - sizes[g[3]] for k, g in growing.items()}
    width = {k: int(sizes[g[3]].sum()) for k, g in growing.items()}
    large = {k: [n for n in g[2] if n not in few[k]] for k, g in growing.items()}
    growing = {k: (a, d, [*large[k], *sorted(few[k])], c, t) for k, (a, d, _, c, t) in growing.items()}
    depth_of = {k: {n: _depth(growing[k][0], n) for n in few[k]} for k in growing}

    def histograms(batches) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        held: dict[int, tuple[np.ndarray, ...]] = {}
        rows: dict[int, list[tuple]] = {}  # model -> leaf, codes, gradients of its blocks
        for batch in batches:
            for row in range(batch.num_rows):
                for block, k, leaf, x, g, h in _open_rows(batch, row, growing, static, folds, nf, nt, turn, stored, margins):
                    if few[k]:
                        yield from leaf_rows(block, k, leaf, x, g, h)
                        at = np.flatnonzero(leaf < len(large[k]))
                        leaf, x, g, h = leaf[at], x.take(at, axis=1), g[at], None if h is None else h[at]
                    if not large[k]:
                        continue
                    if k not in held:
                        held[k] = tuple(np.zeros((len(large[k]), width[k])) for _ in range(3 if static[k]["objective"] == "binary" else 2))
                    add_cells(leaf, x, growing[k][3], offsets[k], width[k], (g, None, h), held[k])
                    if values:
                        rows.setdefault(k, []).append((leaf, x[nf:], g, h))
                        if sum(len(r[0]) for r in rows[k]) > ROWS_HELD:
                            yield from value_sums(k, rows.pop(k), task)
        yield from histogram_rows(held, task) if nf else ()
        for k in list(rows):
            yield from value_sums(k, rows.pop(k), task)

    def leaf_rows(block: int, k: int, leaf: np.ndarray, x: np.ndarray, g: np.ndarray, h: np.ndarray | None) -> Iterator[pa.RecordBatch]:
        at = np.argsort(leaf, kind="stable")[int((leaf < len(large[k])).sum()):]
        if not len(at):
            return
        leaves, begin = np.unique(leaf[at], return_index=True)
        own, piece = x.take(at, axis=1), [slice(a, b) for a, b in zip(begin, [*begin[1:], len(at)], strict=True)]
        column = [[k] * len(piece), [ROWS + growing[k][2][i] for i in leaves], [block] * len(piece), *([v[at[i]].tobytes() if v is not None else None for i in piece] for v in (g, None, h)),
                  [None] * len(piece), [None] * len(piece)]
        column[4] = [own[:, i].tobytes() for i in piece]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(column, KINDS, strict=True)], names=[f.split()[0] for f in HISTOGRAM.split(", ")])

    def value_sums(k: int, parts: list[tuple], task: int) -> Iterator[pa.RecordBatch]:
        leaf, codes, g = (np.concatenate([r[i] for r in parts], axis=-1) for i in range(3))
        h = [np.concatenate([r[3] for r in parts])] if parts[0][3] is not None else []
        m = static[k]
        for j, n in enumerate(values):
            wanted = codes[j] >= first_code
            if m["p"]["colsample_bytree"] < 1:
                wanted &= drawn_values(m["seed"], turn, j, codes[j], m["p"]["colsample_bytree"])
            yield from value_rows(k, task, len(large[k]), j, n, leaf, codes[j], [g, None, *h], np.flatnonzero(wanted))

    def search(parts: pa.Table) -> pa.Table:
        k, piece = parts.column("model")[0].as_py(), parts.column("piece")[0].as_py()
        if piece >= ROWS:
            return finish(parts, k, piece - ROWS)
        if piece < 0:
            k, category, leaves, best = best_values(parts, values, static[k]["p"])
            return of_turn(found_table(k, np.array(large[k])[leaves], np.full(len(leaves), nf + category), best))
        k, piece, g, h, c = merged(parts, width[k])
        best = best_splits(g, h, c, offsets[k], sizes[growing[k][3]], static[k]["p"])
        return of_turn(found_table(k, np.array(large[k][piece:piece + len(g)]), growing[k][3][best["slot"]], best))

    def of_turn(found: pa.Table) -> pa.Table:
        none = pa.array(np.full(len(found), -1, dtype=np.int32))
        return found.add_column(2, "turn", none).add_column(3, "at", none)

    def finish(parts: pa.Table, k: int, node: int) -> pa.Table:
        m = static[k]
        order = np.argsort(parts.column("task").to_numpy()).tolist()
        kind = np.int32 if values else np.uint8
        x = np.concatenate([np.frombuffer(parts.column("c")[i].as_py(), dtype=kind).reshape(nf + len(values), -1) for i in order], axis=1)
        g = np.concatenate([np.frombuffer(parts.column("g")[i].as_py(), dtype=float) for i in order])
        h = np.concatenate([np.frombuffer(parts.column("h")[i].as_py(), dtype=float) for i in order]) if m["objective"] == "binary" else None
        found = finish_subtree(x, g, h, m, growing[k][3], sizes, nf, values, first_code, turn, m["p"]["max_depth"] - depth_of[k][node])
        return subtree_table([{**f, "model": k, "node": node, "turn": t} for t, f in enumerate(found)])

    return frame.mapInArrow(histograms, HISTOGRAM).groupBy("model", "piece").applyInArrow(search, SUBTREE)


NODE = ("feature", "threshold", "code", "category", "left", "right", "missing_left", "value", "gain", "depth")


def threshold_of(table: BinnedTable, feature: int, last_bin: int) -> float:
    """Bin b of a feature ends at its bound b - 1."""
    return float(table.cuts[feature][last_bin - 1]) if 0 <= feature < len(table.features) else 0.0


def name_values(table: BinnedTable, trees: Sequence[dict[str, list]]) -> None:
    """Fill in the values that the trees' categorical splits stand for (as many as there are splits)."""
    nf = len(table.features)
    used = sorted({(table.categories[f - nf], c) for t in trees for f, c in zip(t["feature"], t["code"], strict=True) if c >= 0})
    if not used:
        return
    spark = table.blocks.sparkSession
    wanted = spark.createDataFrame(used, "column string, code int")
    value = {(r["column"], r["code"]): r["value"] for r in table.vocabulary.join(wanted, ["column", "code"], "left_semi").collect()}
    for t in trees:
        t["category"] = [value[table.categories[f - nf], c] if c >= 0 else None for f, c in zip(t["feature"], t["code"], strict=True)]


SUBTREE = "model int, node int, turn int, at int, " + FOUND.split(", ", 2)[2]


def _depth(arrays: tuple[np.ndarray, ...], node: int) -> int:
    depth = 0
    while node:
        node = int(np.flatnonzero(((arrays[2] == node) | (arrays[3] == node)) & (arrays[0] >= 0))[0])
        depth += 1
    return depth


def finish_subtree(x, g, h, m, columns, sizes, nf, values, first_code, turn, deepest) -> list[dict]:
    """Splits of a subtree in the order in which its nodes were made; the first row is its root even where
    nothing is split (gain 0)."""
    p, tree = m["p"], Tree()
    width, offsets = int(sizes[columns].sum()), np.cumsum(sizes[columns]) - sizes[columns]
    weights = (g, None, h) if h is not None else (g, None)
    open_, made = [0], []
    node_of = np.zeros(len(g), dtype=np.int64)
    while open_:
        slot = np.full(len(tree.feature), -1)
        slot[open_] = np.arange(len(open_))
        at = np.flatnonzero(slot[node_of] >= 0)
        leaf, own = slot[node_of[at]], x[:, at]
        tables = []
        if nf and width:
            sums = [np.zeros((len(open_), width)) for _ in weights]
            add_cells(leaf, own, columns, offsets, width, [None if w is None else w[at] for w in weights], sums)
            best = best_splits(sums[0], sums[-1] if h is not None else sums[1], sums[1], offsets, sizes[columns], p)
            tables.append(found_table(0, np.array(open_), columns[best["slot"]], best))
        for j, n in enumerate(values):
            codes = own[nf + j]
            wanted = codes >= first_code
            if p["colsample_bytree"] < 1:
                wanted &= drawn_values(m["seed"], turn, j, codes, p["colsample_bytree"])
            rows = list(value_rows(0, 0, len(open_), j, n, leaf, codes, [None if w is None else w[at] for w in weights], np.flatnonzero(wanted)))
            for part in rows:
                _, _, leaves, best = best_values(pa.Table.from_batches([part]), values, p)
                tables.append(found_table(0, np.array(open_)[leaves], np.full(len(leaves), nf + j), best))
        record_splits(pa.concat_tables(tables).to_pylist() if tables else [], {0: tree})
        for node in open_:
            tree.split[node] = tree.split[node] or {}
        wanted = [n for n in tree.choose(p["num_leaves"], deepest) if tree.feature[n] < 0]
        for node in wanted:
            made.append(node)
            tree.grow(node)
        node_of = step_down(x, tree.arrays(), node_of) if wanted else node_of
        open_ = [c for n in wanted for c in (tree.left[n], tree.right[n]) if tree.depth[c] < deepest]
    out = [{**tree.split[n], "at": n} for n in made]
    nothing = {"gain": 0.0, "feature": 0, "bin": 0, "missing_left": False, "gl": 0.0, "hl": 0.0, "cl": 0.0}
    return out or [{**nothing, "at": 0, "g": float(g.sum()), "h": float(len(g) if h is None else h.sum()), "c": float(len(g))}]


def take_subtrees(found: list[dict], trees: dict[int, Tree]) -> None:
    """Record and grow the splits of finished subtrees."""
    for (k, node), rows in groupby(sorted(found, key=lambda r: (r["model"], r["node"], r["turn"])), key=lambda r: (r["model"], r["node"])):
        grow_found(list(rows), trees[k], node)


def grow_found(rows: list[dict], tree: Tree, root: int) -> None:
    """Add the splits of a finished subtree, in the order in which they were made."""
    at = {0: root}
    for turn, r in enumerate(rows):
        node = at[r["at"]]
        if node == 0:
            tree.sums[0] = (r["g"], r["h"])
        tree.split[node] = r if r["gain"] > 0 else {}
        if r["gain"] > 0:
            tree.grow(node)
            for side, number in ((tree.left, 2 * turn + 1), (tree.right, 2 * turn + 2)):
                at[number] = side[node]
                tree.split[side[node]] = {}


def _whole_models(table: BinnedTable, models: dict[int, _Model], static: list[dict]) -> dict[int, list[dict[str, list]]]:
    """All trees of models that learn from few rows: the coded rows go once to each group of models."""
    groups = [sorted(models)[i::min(GROUPS, len(models))] for i in range(min(GROUPS, len(models)))]
    nf, nt, folds, sizes, values, first_code = len(table.features), len(table.targets), table.folds, table.bins, table.values, table.first_code
    shape = SimpleNamespace(cuts=table.cuts, features=table.features)
    bases = {k: m.base for k, m in models.items()}

    def send(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in range(len(groups)):
                yield pa.RecordBatch.from_arrays([pa.array([part] * batch.num_rows, pa.int32()), *(batch.column(c) for c in _NAMES)], names=["part", *_NAMES])

    def finish(parts: pa.Table) -> pa.Table:
        own = groups[parts.column("part")[0].as_py()]
        batches = parts.combine_chunks().to_batches()
        blocks = sorted((_block(b, i, nf, nt) for b in batches for i in range(b.num_rows)), key=lambda b: b[0])
        x, y = (np.concatenate([b[i] for b in blocks], axis=1) for i in (2, 3))
        which, place = (np.concatenate([b[i] for b in blocks]) for i in (4, 5))
        out = []
        for k in own:
            m = static[k]
            p, target, learns = m["p"], y[m["target"]], _learns(m, y[m["target"]], which, place, folds)
            model = SimpleNamespace(p=p, tree=None, kept=[], trees=[])
            margin = np.full(x.shape[1], bases[k])
            for turn in range(p["n_estimators"]):
                use = learns
                if p["subsample"] < 1 and p["subsample_freq"]:
                    use = learns & (np.concatenate([np.random.default_rng([m["seed"], turn, b[0]]).random(b[1]) for b in blocks]) < p["subsample"])
                at = np.flatnonzero(use)
                model.tree = Tree()
                if len(at):
                    g, h = _gradient(m, target[at], margin[at])
                    grow_found(finish_subtree(x[:, at], g, h, m, _columns(m, turn, nf), sizes, nf, values, first_code, turn, p["max_depth"]), model.tree, 0)
                model.tree.split[0] = model.tree.split[0] or {}
                _finish(model, shape)
                margin = _add_trees(margin, x, model.trees[-1:])
            out.append((k, json.dumps(model.kept)))
        return pa.table({"model": pa.array([k for k, _ in out], pa.int32()), "trees": pa.array([t for _, t in out], pa.string())})

    rows = (table.blocks.mapInArrow(send, "part int, " + _BLOCK).groupBy("part").applyInArrow(finish, "model int, trees string").collect())
    return {r["model"]: json.loads(r["trees"]) for r in rows}


def _columns(m: dict, turn: int, nf: int) -> np.ndarray:
    """Numeric features that a round draws."""
    share = max(1, int(m["p"]["colsample_bytree"] * nf + 1e-9))
    return np.sort(np.random.default_rng([m["seed"], turn]).choice(nf, share, replace=False)) if nf else np.arange(0)


def _finish(m: _Model, table: BinnedTable) -> None:
    """Keep the chosen splits of the grown tree, with thresholds and leaf values."""
    tree, p = m.tree, m.p
    chosen = set(tree.choose(p["num_leaves"], p["max_depth"]))
    out: dict[str, list] = {k: [] for k in NODE}
    bins: list[int] = []
    todo = [(0, -1, "")]
    while todo:
        node, parent, side = todo.pop(0)
        here = len(out["feature"])
        if parent >= 0:
            out[side][parent] = here
        split = node in chosen
        g, h = tree.sums[node]
        value = 0.0 if split else float(-p["learning_rate"] * _soft(np.float64(g), p["reg_alpha"]) / max(h + p["reg_lambda"], 1e-16))
        f = tree.feature[node] if split else -1
        bins.append(tree.bin[node] if split else 0)
        for k, v in (("feature", f), ("threshold", threshold_of(table, f, tree.bin[node])), ("code", -1 - tree.bin[node] if f >= len(table.features) else -1),
                     ("category", None), ("left", 0), ("right", 0),
                     ("missing_left", bool(tree.missing_left[node]) if split else False), ("value", value),
                     ("gain", tree.split[node]["gain"] if split else 0.0), ("depth", tree.depth[node])):
            out[k].append(v)
        if split:
            todo += [(tree.left[node], here, "left"), (tree.right[node], here, "right")]
    m.kept.append(out)
    arrays = Nodes((np.array(out["feature"]), np.array(bins), np.array(out["left"]), np.array(out["right"]), np.array(out["missing_left"])))
    m.trees.append((arrays, max(out["depth"]), np.array(out["value"])))
    m.tree = None


def _with_margins(frame, trees, nf, nt, stored, margins) -> DataFrame:
    def update(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = []
            for row in range(batch.num_rows):
                _, n, x, *_ = _block(batch, row, nf, nt)
                old = margins(batch, row, n, stored)
                new.append(np.stack([_add_trees(old[k], x, t) for k, t in enumerate(trees)]).tobytes())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in _NAMES), pa.array(new, pa.binary())], names=[*_NAMES, "margin"])

    return frame.mapInArrow(update, _BLOCK + ", margin binary")


# ------------------------------------------------------------------ scores
def staged_scores(table: BinnedTable, specs: Sequence[Spec], models: Sequence[Booster], stages: Sequence[int] | None = None) -> DataFrame:
    """model, stage, part ('train': rows it learned from, 'test': rows of its fold), n, r2, mae, rmse after
    ``stages`` rounds (all rounds without); one pass over the blocks, sums per model and stage."""
    nf, nt, folds = len(table.features), len(table.targets), table.folds
    static = [{"target": table.targets.index(s.target), "fold": s.fold, "rows": s.rows, "objective": m.objective} for s, m in zip(specs, models, strict=True)]
    coded = [_coded(m, table) for m in models]
    size = [len(m.trees) for m in models]
    bases = [m.base for m in models]
    # sums of squares are taken about a typical prediction
    means = [m.base if m.objective != "forest" else sum(t["value"][-1] for t in m.trees) for m in models]
    wanted = [sorted({s for s in stages if s <= len(m.trees)} if stages else {len(m.trees)}) for m in models]

    def sums(batches) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int, str], np.ndarray] = {}
        for batch in batches:
            for row in range(batch.num_rows):
                _, n, x, y, which, place = _block(batch, row, nf, nt)
                for k, m in enumerate(static):
                    target = y[m["target"]]
                    parts = {"train": np.flatnonzero(_learns(m, target, which, place, folds))}
                    if m["fold"] is not None:
                        parts["test"] = np.flatnonzero(~np.isnan(target) & (which == m["fold"]))
                    margin = np.full(n, bases[k])
                    for number, one in enumerate(coded[k], 1):
                        margin = _add_trees(margin, x, [one])
                        if number not in wanted[k]:
                            continue
                        guess = 1 / (1 + np.exp(-margin)) if m["objective"] == "binary" else margin
                        if m["objective"] == "forest":  # the mean of the first trees
                            guess = margin * (size[k] / number)
                        for part, at in parts.items():
                            e, d = target[at] - guess[at], target[at] - means[k]
                            add = np.array([len(at), (e * e).sum(), np.abs(e).sum(), d.sum(), (d * d).sum()])
                            total[k, number, part] = total.get((k, number, part), 0) + add
        if total:
            rows = [(*key, *v.tolist()) for key, v in total.items()]
            columns = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), pa.array(columns[2]),
                                              *(pa.array(c, pa.float64()) for c in columns[3:])], names=["model", "stage", "part", "n", "sse", "sae", "sd", "sdd"])

    raw = table.blocks.mapInArrow(sums, "model int, stage int, part string, n double, sse double, sae double, sd double, sdd double")
    return _scored(raw, ["model", "stage", "part"])


def combined_scores(table: BinnedTable, specs: Sequence[Spec], groups: Sequence[Sequence[Booster]], weights: Sequence[float]) -> DataFrame:
    """model, part, n, r2, mae, rmse of the weighted mean of each group of models; ``specs`` say which rows a
    group learned from. One pass over the blocks, sums leave the tasks."""
    nf, nt, folds = len(table.features), len(table.targets), table.folds
    static = [{"target": table.targets.index(s.target), "fold": s.fold, "rows": s.rows} for s in specs]
    coded = [[(m.base, _coded(m, table)) for m in group] for group in groups]
    share = [w / sum(weights) for w in weights]
    means = [sum(w * (m.base if m.objective != "forest" else sum(t["value"][-1] for t in m.trees)) for w, m in zip(share, group, strict=True)) for group in groups]

    def sums(batches) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, str], np.ndarray] = {}
        for batch in batches:
            for row in range(batch.num_rows):
                _, n, x, y, which, place = _block(batch, row, nf, nt)
                for k, m in enumerate(static):
                    target = y[m["target"]]
                    parts = {"train": np.flatnonzero(_learns(m, target, which, place, folds))}
                    if m["fold"] is not None:
                        parts["test"] = np.flatnonzero(~np.isnan(target) & (which == m["fold"]))
                    at = np.concatenate(list(parts.values()))
                    guess = sum(w * _add_trees(np.full(len(at), base), x[:, at], trees) for w, (base, trees) in zip(share, coded[k], strict=True))
                    begin = 0
                    for part, own in parts.items():
                        e, d = target[own] - guess[begin:begin + len(own)], target[own] - means[k]
                        begin += len(own)
                        total[k, part] = total.get((k, part), 0) + np.array([len(own), (e * e).sum(), np.abs(e).sum(), d.sum(), (d * d).sum()])
        if total:
            columns = list(zip(*[(*key, *v.tolist()) for key, v in total.items()], strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1]), *(pa.array(c, pa.float64()) for c in columns[2:])],
                                             names=["model", "part", "n", "sse", "sae", "sd", "sdd"])

    raw = table.blocks.mapInArrow(sums, "model int, part string, n double, sse double, sae double, sd double, sdd double")
    return _scored(raw, ["model", "part"])


def _scored(raw: DataFrame, by: Sequence[str]) -> DataFrame:
    raw = raw.groupBy(*by).agg(*[F.sum(c).alias(c) for c in ("n", "sse", "sae", "sd", "sdd")])
    spread = F.col("sdd") - F.col("sd") * F.col("sd") / F.col("n")
    r2 = F.when(spread > 0, 1 - F.col("sse") / spread).otherwise(F.when(F.col("sse") == 0, 1.0).otherwise(0.0))
    return raw.where("n > 0").select(*by, F.col("n").cast("long").alias("n"), r2.alias("r2"), (F.col("sae") / F.col("n")).alias("mae"), F.sqrt(F.col("sse") / F.col("n")).alias("rmse"))


def _coded(model: Booster, table: BinnedTable) -> list[tuple]:
    """Trees on bin numbers of the table."""
    out = []
    for t in model.trees:
        bins = np.array([-1 - c if c >= 0 else 1 + int(np.searchsorted(table.cuts[f], x)) if f >= 0 else 0
                         for f, c, x in zip(t["feature"], t["code"], t["threshold"], strict=True)])
        nodes = Nodes((np.array(t["feature"]), bins, np.array(t["left"]), np.array(t["right"]), np.array(t["missing_left"])))
        out.append((nodes, max(t["depth"]), np.array(t["value"])))
    return out
