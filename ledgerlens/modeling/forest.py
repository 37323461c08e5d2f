"""Random forests on the binned blocks of ``boosting.bin_table`` (MDL1, MDL2).

All trees grow level by level, those of several forests (folds, targets, trials) together. A step takes
open leaves of as many trees as ``CELLS`` histogram cells allow, so a task's memory is bounded whatever
the number of trees; sums travel as in boosting, the driver receives one row per open leaf. Forests that learn from at most ``LOCAL_ROWS`` rows are made in one
pass: their rows go to a few tasks, each of which makes some of the trees. Rows are
drawn with replacement by Poisson(1) weights from (seed, tree, block); every leaf draws its own
``max_features`` columns from (seed, tree, node), where every value of a category is a column; only the
sums of drawn columns are made. Histograms use at most ``COARSE`` bins a feature: those of the table, or
equal runs of them.

A leaf's value is its mean (for a 0/1 target: the class probability; the gain is then half the Gini
gain). Least rows of a leaf and of a split count drawn rows. The result is a ``Booster`` whose trees add
up to the mean over trees, so scoring, staged scores, saving and importances are shared.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from ledgerlens.modeling import boosting
from ledgerlens.modeling.boosting import (FOUND, HISTOGRAM, BadParameters, BinnedTable, Booster, Spec, Tree, _block, _learns, _score, best_splits,
                                          found_table, histogram_row, merged, name_values, route, step_down, take_splits, threshold_of)

COARSE = 64
CELLS = 3_000_000  # of one step
TREE_CELLS = 1_000_000  # of one tree in it
GROUPS = 8  # tasks that share the trees of a forest on few rows
DEEPEST = 30

# Default parameters of the forest.
FOREST_DEFAULTS = {"n_estimators": 100, "max_depth": 10, "min_samples_split": 5, "min_samples_leaf": 2, "max_features": "sqrt"}


def resolve(params: dict | None) -> dict:
    given = {k: v for k, v in (params or {}).items() if k not in ("n_jobs", "verbose", "random_state")}
    if set(given) - set(FOREST_DEFAULTS):
        raise BadParameters(f"unknown parameters {sorted(set(given) - set(FOREST_DEFAULTS))}")
    p = {**FOREST_DEFAULTS, **given}
    p["n_estimators"] = int(p["n_estimators"])
    p["max_depth"] = DEEPEST if p["max_depth"] is None else min(DEEPEST, int(p["max_depth"]))
    if p["n_estimators"] < 1 or p["max_depth"] < 1 or p["min_samples_leaf"] < 1 or p["min_samples_split"] < 2:
        raise BadParameters(f"parameters out of range: {p}")
    share_of(p["max_features"], 10)
    return p


def share_of(max_features, n: int) -> int:
    if max_features in ("sqrt", "auto"):
        return max(1, int(math.sqrt(n)))
    if max_features == "log2":
        return max(1, int(math.log2(n)))
    if max_features is None:
        return n
    if isinstance(max_features, bool) or not isinstance(max_features, (int, float)) or max_features <= 0:
        raise BadParameters(f"max_features {max_features}")
    return min(n, int(max_features)) if isinstance(max_features, int) else max(1, min(n, int(max_features * n)))


def _coarse(table: BinnedTable) -> tuple[np.ndarray, list[np.ndarray]]:
    """Bin -> coarse bin per feature, and the last bin of every coarse bin."""
    to = np.zeros((len(table.features), 256), dtype=np.uint8)
    last = []
    for f, n in enumerate(table.bins - 1):  # value bins 1..n
        bins = np.arange(1, n + 1)
        group = bins if n < COARSE else 1 + (bins - 1) * (COARSE - 1) // n
        to[f, 1:n + 1] = group
        last.append(np.concatenate(([0], np.flatnonzero(np.append(group[1:] != group[:-1], True)) + 1)))  # 0: missing
    return to, last


def fit_forests(table: BinnedTable, specs: Sequence[Spec]) -> list[Booster]:
    """Fit all forests together."""
    params = [resolve(s.params) for s in specs]
    for s in specs:
        if s.target not in table.targets:
            raise BadParameters(f"no target {s.target}")
    nf, nt, folds, total = len(table.features), len(table.targets), table.folds, table.columns
    to, last = _coarse(table)
    width = int(max(map(len, last), default=1))
    share = [share_of(p["max_features"], total) if total else 0 for p in params]
    static = [{"target": table.targets.index(s.target), "fold": s.fold, "rows": s.rows, "seed": s.seed, "share": share[k],
               "p": {"reg_alpha": 0.0, "reg_lambda": 0.0, "min_child_weight": 0.0, "min_child_samples": p["min_samples_leaf"],
                     "min_samples_split": p["min_samples_split"]}} for k, (s, p) in enumerate(zip(specs, params, strict=True))]
    per_leaf = [max(1, int(s * (1 + nf / total * width))) if total else 1 for s in share]
    shape = {"nf": nf, "width": width, "values": table.values, "first_code": table.first_code, "total": total, "to": to, "last": last}
    # tree number (over all forests) -> forest, number within it
    names = [(k, t) for k, p in enumerate(params) for t in range(p["n_estimators"])]
    trees = {i: Tree() for i in range(len(names))}
    # no fold, or no number of first rows, makes a forest learn from more than the table
    few = {i: v for i, v in enumerate(names) if min(table.rows, specs[v[0]].rows or table.rows) <= boosting.LOCAL_ROWS}
    if few:
        trees |= _whole_trees(table, few, static, shape, nt, params)
    open_ = {i: [0] for i in trees if i not in few}
    while open_ and total:
        todo, open_ = open_, {}
        while todo:
            batch: dict[int, list[int]] = {}
            cells = 0
            for i in list(todo):
                leaf_cells = per_leaf[names[i][0]]
                most = max(1, TREE_CELLS // leaf_cells)
                if batch and cells + min(len(todo[i]), most) * leaf_cells > CELLS:
                    break
                batch[i], rest = todo[i][:most], todo[i][most:]
                cells += len(batch[i]) * leaf_cells
                if rest:
                    todo[i] = rest
                    break
                del todo[i]
            _grow(table, batch, trees, names, static, shape, nt)
            for i, nodes in batch.items():
                tree, p = trees[i], params[names[i][0]]
                for node in nodes:
                    tree.split[node] = tree.split[node] or {}
                    if tree.split[node]:
                        tree.grow(node)
                        if tree.depth[node] + 1 < p["max_depth"]:
                            open_.setdefault(i, []).extend((tree.left[node], tree.right[node]))
    out = []
    for k, (spec, p) in enumerate(zip(specs, params, strict=True)):
        kept = [_finished(trees[i], table, last, p["n_estimators"]) for i, (forest, _) in enumerate(names) if forest == k]
        name_values(table, kept)
        out.append(Booster([*table.features, *table.categories], 0.0, "forest", kept, {**p, "family": "rf"}, len(table.categories)))
    return out


@dataclass
class _Slots:
    """Columns drawn by the open leaves of a tree. Numeric ones: leaf by leaf, ascending; values: per
    category the sorted keys leaf x values + code."""
    feature: np.ndarray  # of each numeric slot
    leaf: np.ndarray
    begin: np.ndarray  # first numeric slot of each leaf, and one more
    keys: list[np.ndarray]

    @property
    def value_slots(self) -> int:
        return sum(map(len, self.keys))


def _hashed(seed: int, number: int, nodes: Sequence[int], width: int) -> np.ndarray:
    """[leaves x width] 64-bit numbers of (seed, tree, node, column)."""
    at = (np.uint64((seed * 1_000_003 + number) & 0xFFFFFFFF) << np.uint64(32)) + np.array(nodes, dtype=np.uint64)
    h = (at[:, None] * np.uint64(0x9E3779B97F4A7C15)) ^ (np.arange(width, dtype=np.uint64)[None, :] * np.uint64(0xD6E8FEB86659FD93))
    for k in (30, 27, 31):
        h = (h ^ (h >> np.uint64(k))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def _draw(shape: dict, seed: int, number: int, nodes: Sequence[int], share: int) -> _Slots:
    """The columns of each leaf: the first ``share`` of a random order; of more than 512 columns, the first
    ``share`` different ones of twice as many draws."""
    nf, first, total = shape["nf"], shape["first_code"], shape["total"]
    begins = np.cumsum([nf, *[max(0, v - first) for v in shape["values"]]])
    if total <= 512:
        columns = np.sort(np.argsort(_hashed(seed, number, nodes, total), axis=1)[:, :share], axis=1)
        keep = np.ones(columns.shape, dtype=bool)
    else:
        drawn = (_hashed(seed, number, nodes, 2 * share) >> np.uint64(11)) % np.uint64(total)
        order = np.argsort(drawn, axis=1, kind="stable")
        ranked = np.take_along_axis(drawn, order, axis=1)
        again = np.zeros(drawn.shape, dtype=bool)
        np.put_along_axis(again, order[:, 1:], ranked[:, 1:] == ranked[:, :-1], axis=1)
        take = ~again & (np.cumsum(~again, axis=1) <= share)
        keep = np.take_along_axis(take, order, axis=1)
        columns = ranked.astype(np.int64)
    leaf = np.repeat(np.arange(len(nodes)), keep.sum(axis=1))
    column = columns[keep]
    numeric = column < nf
    keys = []
    for j, v in enumerate(shape["values"]):
        own = (column >= begins[j]) & (column < begins[j + 1])
        keys.append(leaf[own].astype(np.int64) * v + column[own] - begins[j] + first)  # ascending, as leaves and columns are
    return _Slots(column[numeric], leaf[numeric], np.searchsorted(leaf[numeric], np.arange(len(nodes) + 1)), keys)


def _keys(shape: dict, slot: _Slots, leaf: np.ndarray, x: np.ndarray, coarse: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cells (of the numeric slots, of the drawn values, and of whole leaves, one behind the other) that rows add to,
    and which of ``rows`` adds to each. ``leaf``: of each row; ``rows``: their columns in ``x`` and ``coarse``."""
    width, nf, values = shape["width"], shape["nf"], shape["values"]
    cells, at = len(slot.feature) * width, []
    count = np.diff(slot.begin)
    all_, flat = np.arange(len(leaf)), coarse.ravel()
    for j in range(int(count.max(initial=0))):
        some = all_ if count.min() > j else np.flatnonzero(count[leaf] > j)
        number = slot.begin.take(leaf.take(some)) + j
        at.append((some, number * width + flat.take(slot.feature.take(number) * coarse.shape[1] + rows.take(some))))
    for j, keys in enumerate(slot.keys):
        if len(keys):
            code = x[nf + j].take(rows)
            key = leaf * np.int64(values[j]) + code
            place = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            some = np.flatnonzero((keys[place] == key) & (code >= 0))
            at.append((some, cells + place[some]))
        cells += len(keys)
    at.append((all_, cells + leaf))
    return np.concatenate([key for _, key in at]), np.concatenate([some for some, _ in at])


def _size(shape: dict, slot: _Slots, leaves: int) -> int:
    return len(slot.feature) * shape["width"] + slot.value_slots + leaves


def _best(shape: dict, slot: _Slots, leaves: int, g: np.ndarray, c: np.ndarray, p: dict) -> dict[str, np.ndarray]:
    """Best split per leaf (``leaf``) from the cells of ``_sums``."""
    width, nf, values, last = shape["width"], shape["nf"], shape["values"], shape["last"]
    cells, drawn = len(slot.feature) * width, slot.value_slots
    total_g, total_c = g[cells + drawn:], c[cells + drawn:]
    empty = np.zeros(0)
    found = [(empty.astype(int), empty.astype(int), empty, empty.astype(int), empty.astype(bool), empty, empty, empty)]
    if cells:
        one, cnt = g[:cells].reshape(-1, width), c[:cells].reshape(-1, width)
        best = best_splits(one, cnt, cnt, np.zeros(1, dtype=np.int64), np.array([width]), p)
        # a coarse bin ends at the last of its bins
        bins = np.array([last[f][b] if b else 0 for f, b in zip(slot.feature, best["bin"], strict=True)], dtype=np.int64)
        found.append((slot.leaf, slot.feature, best["gain"], bins, best["missing_left"], best["gl"], best["hl"], best["cl"]))
    at = cells
    for j, keys in enumerate(slot.keys):
        leaf, code = keys // max(1, values[j]), keys % max(1, values[j])
        rg, rc = g[at:at + len(keys)], c[at:at + len(keys)]
        lg, lc = total_g[leaf] - rg, total_c[leaf] - rc
        fits = (np.minimum(lc, rc) >= max(1, p["min_child_samples"])) & (total_c[leaf] >= p["min_samples_split"])
        gain = np.where(fits, _score(lg, lc, p) + _score(rg, rc, p) - _score(total_g, total_c, p)[leaf], 0.0)
        gain = np.where(gain > 1e-9, gain, 0.0)
        found.append((leaf, np.full(len(keys), nf + j), gain, -1 - code, np.ones(len(keys), dtype=bool), lg, lc, lc))
        at += len(keys)
    leaf, feature, gain, bins, missing_left, gl, hl, cl = (np.concatenate(v) for v in zip(*found, strict=True))
    order = np.lexsort((np.abs(bins), feature, -gain, leaf))
    leaves, first = np.unique(leaf[order], return_index=True)
    at = order[first]
    return {"leaf": leaves, "feature": feature[at], "gain": gain[at], "bin": bins[at], "missing_left": missing_left[at], "gl": gl[at], "hl": hl[at], "cl": cl[at],
            "g": total_g[leaves], "h": total_c[leaves], "c": total_c[leaves]}


def _tree_rows(m: dict, number: int, block: int, n: int, learns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows that a tree draws, and how often."""
    weight = np.random.default_rng([m["seed"], 2, number, block]).poisson(1.0, n)
    at = np.flatnonzero(learns & (weight > 0))
    return at, weight[at].astype(float)


def _grow(table, batch, trees, names, static, shape, nt) -> None:
    growing = {i: (trees[i].arrays(), max(trees[i].depth), nodes) for i, nodes in batch.items()}
    nf, folds, to = shape["nf"], table.folds, shape["to"]

    def slots(i: int) -> _Slots:
        m = static[names[i][0]]
        return _draw(shape, m["seed"], names[i][1], growing[i][2], m["share"])

    def histograms(batches) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        drawn = {i: slots(i) for i in growing}
        held: dict[int, list[np.ndarray]] = {}
        waiting: dict[int, list[tuple]] = {i: [] for i in growing}  # cells and weights, fewer than there are cells

        def add(i: int) -> None:
            if waiting[i]:
                key, *weights = (np.concatenate(v) for v in zip(*waiting[i], strict=True))
                for total, w in zip(held[i], weights, strict=True):
                    total += np.bincount(key, w, len(total))
                waiting[i] = []

        for rows in batches:
            for row in range(rows.num_rows):
                block, n, x, y, which, place = _block(rows, row, nf, nt)
                coarse = _coded_coarse(to, x, nf)
                learns: dict[int, np.ndarray] = {}
                for i, (arrays, depth, nodes) in growing.items():
                    k, number = names[i]
                    m = static[k]
                    if k not in learns:
                        learns[k] = _learns(m, y[m["target"]], which, place, folds)
                    at, w = _tree_rows(m, number, block, n, learns[k])
                    slot = np.full(len(arrays[0]), -1)
                    slot[nodes] = np.arange(len(nodes))
                    leaf = slot.take(route(x.take(at, axis=1), arrays, depth))
                    if (here := np.flatnonzero(leaf >= 0)).size < len(at):
                        at, w, leaf = at[here], w[here], leaf[here]
                    key, which = _keys(shape, drawn[i], leaf, x, coarse, at)
                    if i not in held:
                        held[i] = [np.zeros(_size(shape, drawn[i], len(nodes))) for _ in range(2)]
                    waiting[i].append((key, (-w * y[m["target"]].take(at)).take(which), w.take(which)))
                    if sum(len(v[0]) for v in waiting[i]) >= len(held[i][0]):
                        add(i)
        for i, both in held.items():
            add(i)
            yield histogram_row(i, 0, TaskContext.get().partitionId(), [v.tobytes() for v in both])

    def search(parts: pa.Table) -> pa.Table:
        i = parts.column("model")[0].as_py()
        slot, nodes = slots(i), np.array(growing[i][2])
        i, _, g, _, c = merged(parts, _size(shape, slot, len(nodes)))
        best = _best(shape, slot, len(nodes), g[0], c[0], static[names[i][0]]["p"])
        return found_table(i, nodes[best.pop("leaf")], best.pop("feature"), best)

    take_splits(table.blocks.mapInArrow(histograms, HISTOGRAM).groupBy("model", "piece").applyInArrow(search, FOUND), {i: trees[i] for i in batch})


def _coded_coarse(to: np.ndarray, x: np.ndarray, nf: int) -> np.ndarray:
    return np.stack([to[f][x[f]] for f in range(nf)]) if nf else np.zeros((0, x.shape[1]), dtype=np.uint8)


def _whole_trees(table, names, static, shape, nt, params) -> dict[int, Tree]:
    """Trees of forests that learn from few rows: the rows go once to each of ``GROUPS`` tasks a forest, and a
    task makes its share of the trees, level by level by the same rules."""
    nf, folds, to, wide = shape["nf"], table.folds, shape["to"], len(shape["values"]) > 0
    forests = sorted({k for k, _ in names.values()})

    def send(batches) -> Iterator[pa.RecordBatch]:
        columns = ["forest", "part", "block", "n", "rows", "x", "y"]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
        for batch in batches:
            for row in range(batch.num_rows):
                block, n, x, y, which, place = _block(batch, row, nf, nt)
                for k in forests:
                    m = static[k]
                    at = np.flatnonzero(_learns(m, y[m["target"]], which, place, folds))
                    own = [at.astype(np.int32).tobytes(), np.ascontiguousarray(x[:, at]).tobytes(), y[m["target"]][at].tobytes()]
                    for part in range(min(GROUPS, params[k]["n_estimators"])):
                        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip([k, part, block, n, *own], kinds, strict=True)], names=columns)

    def make(parts: pa.Table) -> pa.Table:
        k, part = parts.column("forest")[0].as_py(), parts.column("part")[0].as_py()
        m, p = static[k], params[k]
        order = np.argsort(parts.column("block").to_numpy()).tolist()
        kind = np.int32 if wide else np.uint8
        rows = [np.frombuffer(parts.column("rows")[i].as_py(), dtype=np.int32) for i in order]
        x = np.concatenate([np.frombuffer(parts.column("x")[i].as_py(), dtype=kind).reshape(nf + len(shape["values"]), -1) for i in order], axis=1)
        y = np.concatenate([np.frombuffer(parts.column("y")[i].as_py(), dtype=float) for i in order])
        begins = np.cumsum([0, *map(len, rows)])
        blocks = [(parts.column("block")[i].as_py(), parts.column("n")[i].as_py()) for i in order]
        coarse = _coded_coarse(to, x, nf)
        numbers, made = [], []
        for i, (forest, number) in names.items():
            if forest != k or number % min(GROUPS, p["n_estimators"]) != part:
                continue
            at, w = [], []
            for (block, n), own, begin in zip(blocks, rows, begins, strict=False):
                weight = np.random.default_rng([m["seed"], 2, number, block]).poisson(1.0, n)[own]
                at.append(begin + np.flatnonzero(weight > 0))
                w.append(weight[weight > 0].astype(float))
            at, w = np.concatenate(at), np.concatenate(w)
            numbers.append(i)
            made.append(json.dumps(_one_tree(shape, m, p, number, x[:, at], coarse[:, at], y[at], w)))
        return pa.table({"tree": pa.array(numbers, pa.int32()), "made": pa.array(made, pa.string())})

    found = (table.blocks.mapInArrow(send, "forest int, part int, block long, n int, rows binary, x binary, y binary")
             .groupBy("forest", "part").applyInArrow(make, "tree int, made string").collect())
    out = {i: Tree() for i in names}
    for r in found:
        for key, value in json.loads(r["made"]).items():
            setattr(out[r["tree"]], key, value)
    return out


def _one_tree(shape: dict, m: dict, p: dict, number: int, x: np.ndarray, coarse: np.ndarray, y: np.ndarray, w: np.ndarray) -> dict[str, list]:
    tree, open_ = Tree(), [0]
    node_of = np.zeros(len(w), dtype=np.int64)
    g = -w * y
    tree.sums[0] = (float(g.sum()), float(w.sum()))
    while open_ and shape["total"]:
        slot = np.full(len(tree.feature), -1)
        slot[open_] = np.arange(len(open_))
        leaf = slot[node_of]
        at = np.flatnonzero(leaf >= 0)
        drawn = _draw(shape, m["seed"], number, open_, m["share"])
        key, which = _keys(shape, drawn, leaf[at], x, coarse, at)
        sums = [np.bincount(key, v[at][which], _size(shape, drawn, len(open_))) for v in (g, w)]
        best = _best(shape, drawn, len(open_), sums[0], sums[1], m["p"])
        nodes, open_ = open_, []
        for k in np.flatnonzero(best["gain"] > 0).tolist():
            node = nodes[best["leaf"][k]]
            tree.split[node] = {n: best[n][k].item() for n in ("gain", "feature", "bin", "missing_left", "gl", "hl", "cl", "g", "h", "c")}
            tree.grow(node)
            if tree.depth[node] + 1 < p["max_depth"]:
                open_ += [tree.left[node], tree.right[node]]
        node_of = step_down(x, tree.arrays(), node_of)
    tree.split = [s or {} for s in tree.split]
    return {k: getattr(tree, k) for k in ("feature", "bin", "left", "right", "missing_left", "depth", "split", "sums", "rows")}


def _finished(tree: Tree, table: BinnedTable, last: list[np.ndarray], number: int) -> dict[str, list]:
    inner = [f >= 0 for f in tree.feature]
    return {"feature": list(tree.feature), "threshold": [threshold_of(table, f, b) for f, b in zip(tree.feature, tree.bin, strict=True)],
            "code": [-1 - b if f >= len(table.features) else -1 for f, b in zip(tree.feature, tree.bin, strict=True)], "category": [None] * len(inner),
            "left": list(tree.left), "right": list(tree.right), "missing_left": [bool(v) for v in tree.missing_left],
            "value": [0.0 if split or not h else float(-g / h / number) for (g, h), split in zip(tree.sums, inner, strict=True)],
            "gain": [s["gain"] if split else 0.0 for s, split in zip(tree.split, inner, strict=True)], "depth": list(tree.depth)}
