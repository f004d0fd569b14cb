"""Random forest for many rows: the rows are binned once, then each level of all trees is one pass of array kernels.

The algorithm is that of spark.ml's RandomForestClassifier: quantile bins, Poisson bags, a draw of features per node,
Gini gain, categories ordered by their weight of class 1, and leaves of one parent that predict alike made one.  The
fitted model is spark.ml's; of its nodes ``rawCount`` is kept (else -1) only where a least number of rows asks for it.  Bags and draws come from other generators, so trees differ from those of spark.ml as they
do between two seeds; they depend on how the rows are dealt over files, not on tasks or retries.
"""

from __future__ import annotations

import math
import pickle
import sys

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from . import tables

cloudpickle.register_pickle_by_value(sys.modules[__name__])   # tasks need numpy and pyarrow, not this package

BLOCK_ROWS = 32_768          # rows of one block of bins
SKETCH_ROWS, SKETCH_POINTS = 131_072, 512
PASS_BYTES = 96 << 20        # sums that a task holds in a pass; more trees or nodes take more passes
BAG_STEPS = 1 << 16          # a row's number of copies in a bag is drawn in steps of this


class BinnedForest(RandomForestClassifier):
    """RandomForestClassifier whose usual case (two classes, Gini, bags, drawn features) is fitted by array kernels."""

    def _fit(self, dataset: DataFrame):
        weight = F.col(self.getWeightCol()).cast("double") if self.isDefined("weightCol") and self.getWeightCol() else F.lit(1.0)
        rows = dataset.select(vector_to_array(self.getFeaturesCol()).alias("x"),
                              F.col(self.getLabelCol()).cast("double").alias("y"), weight.alias("w"))
        usual = (self.getBootstrap() and self.getImpurity() == "gini" and self.getFeatureSubsetStrategy() == "auto"
                 and self.getMinWeightFractionPerNode() == 0 and self.getMaxBins() <= 128 and self.getMaxDepth() > 0)
        if usual:
            least, most, odd = rows.agg(F.min("y"), F.max("y"), F.count_if(
                F.expr("coalesce(y NOT IN (0D, 1D) OR isnan(w) OR w < 0 OR w = double('infinity'), true)"))).first()
            usual = most == 1 and not odd
        first = dataset.select(self.getFeaturesCol()).first() if usual else None
        if first is None or first[0] is None:
            return super()._fit(dataset)       # other cases, and the errors that spark.ml has for them
        attrs = dataset.schema[self.getFeaturesCol()].metadata.get("ml_attr", {}).get("attrs", {})
        arity = np.zeros(first[0].size, int)   # 0: continuous
        for a in attrs.get("nominal", []) + attrs.get("binary", []):
            arity[a["idx"]] = len(a["vals"]) if "vals" in a else a.get("num_vals", 2 if a in attrs.get("binary", []) else 0)
        if arity.max() > self.getMaxBins():
            return super()._fit(dataset)
        trees = _grow(rows, arity, self.getNumTrees(), self.getMaxDepth(), self.getMaxBins(), self.getMinInstancesPerNode(),
                      self.getMinInfoGain(), self.getSubsamplingRate(), self.getSeed() % (1 << 64))
        return self._model(dataset.sparkSession, trees, arity)

    def _model(self, spark, trees, arity) -> RandomForestClassificationModel:
        """spark.ml's model of these nodes: a model of the same parameters is saved, its nodes are replaced."""
        cols = [self.getFeaturesCol(), self.getLabelCol()] + ([self.getWeightCol()] if self.isDefined("weightCol") and self.getWeightCol() else [])
        zero = Vectors.dense([0.0] * len(arity))
        path = scratch_path(spark, "forest")
        super()._fit(spark.createDataFrame([(zero, 0.0, 1.0)[:len(cols)], (zero, 1.0, 1.0)[:len(cols)]], cols)).save(path)
        nodes = [(t, *n) for t, tree in enumerate(trees) for n in _preorder(tree, arity)]
        split = pa.struct([("featureIndex", pa.int32()), ("leftCategoriesOrThreshold", pa.list_(pa.float64())), ("numCategories", pa.int32())])
        kinds = [("id", pa.int32()), ("prediction", pa.float64()), ("impurity", pa.float64()), ("impurityStats", pa.list_(pa.float64())),
                 ("rawCount", pa.int64()), ("gain", pa.float64()), ("leftChild", pa.int32()), ("rightChild", pa.int32()), ("split", split)]
        ids, *parts = zip(*nodes)
        data = pa.StructArray.from_arrays([pa.array(v, kind) for v, (_, kind) in zip(parts, kinds)], names=[n for n, _ in kinds])
        table = pa.table({"treeID": pa.array(ids, pa.int32()), "nodeData": data})
        spark.createDataFrame(table).write.mode("overwrite").parquet(f"{path}/data")
        return RandomForestClassificationModel.load(path)


# ------------------------------------------------------------------ bins
def _matrix(column, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _points(values, weights):
    """Distinct values in order, each with its weight."""
    order = np.argsort(values, kind="stable")
    v, w = values[order], weights[order]
    start = np.flatnonzero(np.r_[True, v[1:] != v[:-1]])
    return v[start], np.add.reduceat(w, start)


def _sketched(batches, width: int):
    """Per feature the distinct values of some rows with their weights; of many values those at even steps of the weight,
    each with the weight down to the one before."""
    def flush(xs, ws):
        x, w = np.concatenate(xs), np.concatenate(ws)
        if not np.isfinite(x).all():
            raise ValueError("the features hold NaN or infinity")
        for f in range(width):
            v, c = _points(x[:, f], w)
            if v.size > SKETCH_POINTS:
                run = c.cumsum()
                at = np.unique(np.r_[np.searchsorted(run, run[-1] * np.arange(1, SKETCH_POINTS) / SKETCH_POINTS), v.size - 1])
                v, c = v[at], np.diff(run[at], prepend=0.0)
            yield pa.record_batch({"f": pa.array([f], pa.int32()), "v": pa.array([v.tobytes()]), "c": pa.array([c.tobytes()])})

    xs, ws, n = [], [], 0
    for b in batches:
        xs.append(_matrix(b.column(0), width))
        ws.append(b.column(2).to_numpy(zero_copy_only=False))
        n += b.num_rows
        if n >= SKETCH_ROWS:
            yield from flush(xs, ws)
            xs, ws, n = [], [], 0
    if n:
        yield from flush(xs, ws)


def _thresholds(v, c, bins: int) -> np.ndarray:
    """Split candidates of one feature: between all values if they are few, else nearest to even steps of the weight."""
    mid = (v[1:] + v[:-1]) / 2
    if v.size <= bins:
        return mid
    run = c.cumsum()
    out, target = [], run[-1] / bins
    for k in range(1, v.size):
        if abs(run[k - 1] - target) < abs(run[k] - target):
            out.append(mid[k - 1])
            target += run[-1] / bins
    return np.array(out[:bins - 1])


def _cut(table: pa.Table, bins: int) -> pa.Table:
    v, c = (np.concatenate([np.frombuffer(x, float) for x in table[k].to_pylist()]) for k in ("v", "c"))
    return pa.table({"f": table["f"][:1], "cuts": pa.array([_thresholds(*_points(v, c), bins).tobytes()], pa.binary())})


def _packed(batches, cuts: list, arity):
    """Blocks of rows: per row and feature 2 * bin + class as a byte, and the row's weight."""
    width, ctx = len(arity), TaskContext.get()
    block = ctx.partitionId() << 33
    held, n = [], 0

    def out():
        nonlocal block, held, n
        x, w = (np.concatenate(p) for p in zip(*held))
        for at in range(0, n - n % BLOCK_ROWS or n, BLOCK_ROWS):
            end = min(n, at + BLOCK_ROWS)
            yield pa.record_batch({"block": pa.array([block], pa.int64()), "x": pa.array([x[at:end].tobytes()], pa.binary()),
                                   "w": pa.array([w[at:end].tobytes()], pa.binary())})
            block += 1
        held, n = ([(x[end:], w[end:])], n - end) if end < n else ([], 0)

    for b in batches:
        rows, x = _matrix(b.column(0), width), np.empty((b.num_rows, width), np.uint8)
        for f in range(width):
            x[:, f] = rows[:, f] if arity[f] else np.searchsorted(cuts[f], rows[:, f], side="left")
        x = x * 2 + b.column(1).to_numpy(zero_copy_only=False).astype(np.uint8)[:, None]
        held.append((x, b.column(2).to_numpy(zero_copy_only=False)))
        n += b.num_rows
        if n >= BLOCK_ROWS:
            yield from out()
    if n:
        yield from out()


# ------------------------------------------------------------------ one level
def _bag(rate: float) -> np.ndarray:
    """Copies of a row in a bag by a 16-bit draw: Poisson(rate)."""
    term, run = math.exp(-rate), []
    for k in range(1, 64):
        run.append((run[-1] if run else 0.0) + term)
        term *= rate / k
    return np.searchsorted(run, (np.arange(BAG_STEPS) + 0.5) / BAG_STEPS).astype(np.uint8)


def _sums(batches, level, width: int, wide: int, seed: int, rate: float, counted: bool):
    """Per tree and open node, drawn feature and (bin, class): the weight of the bagged rows, and their number if ``counted``."""
    trees, bag = pickle.loads(level.value), _bag(rate)
    sums = {t: np.zeros((1 + counted, f.shape[1], f.shape[0] * wide)) for t, (_, f) in trees.items()}
    for b in batches:
        for block, xs, ws in zip(*(b.column(k) for k in range(3))):
            x, w = np.frombuffer(xs.as_buffer(), np.uint8), np.frombuffer(ws.as_buffer(), float)
            for t, (path, drawn) in trees.items():
                rng = np.random.Generator(np.random.SFC64([seed, t, block.as_py()]))
                copies = bag[rng.integers(0, BAG_STEPS, w.size, dtype=np.uint16)]
                rows = np.flatnonzero(copies)
                at, node = rows * width, np.zeros(rows.size, np.int64)
                for feature, into, closed in path:
                    node = into.take(node * wide + x.take(at + feature.take(node)))
                    if closed:
                        kept = np.flatnonzero(node >= 0)
                        rows, at, node = rows.take(kept), at.take(kept), node.take(kept)
                c = copies.take(rows)
                weights, base = (w.take(rows) * c, c)[:1 + counted], node * wide
                for k in range(drawn.shape[1]):
                    key = base + x.take(at + drawn[:, k].take(node))
                    for s, v in zip(sums[t], weights):
                        s[k] += np.bincount(key, weights=v, minlength=s.shape[1])
    part = TaskContext.get().partitionId()
    for t, s in sums.items():
        yield pa.record_batch({"tree": pa.array([t], pa.int32()), "part": pa.array([part], pa.int64()), "sums": pa.array([s.tobytes()], pa.binary())})


def _impurity(s, n):
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(n > 0, 1 - ((s / n[..., None]) ** 2).sum(-1), 0.0)


def best_splits(sums, drawn, arity, min_rows: int, min_gain: float):
    """The best split of every node: (gain, drawn feature, first bins in order that go left, order of the bins, weights and
    number left and right).  ``sums``: (weight[, number]) x drawn feature x node x bin x class."""
    h, nodes, many = sums[0], np.arange(drawn.shape[0]), sums.shape[3]
    place = np.broadcast_to(np.arange(many), h.shape[:3]).copy()         # of a bin in the order
    named = arity[drawn.T] > 0
    if named.any():
        of = sums[:, named]
        order = np.argsort(np.where(of[0].sum(-1) > 0, of[0, ..., 1], np.inf), axis=1, kind="stable")   # as spark.ml orders them
        sums = sums.copy()
        sums[:, named] = np.take_along_axis(of, order[None, :, :, None], 2)
        own = np.empty_like(order)
        np.put_along_axis(own, order, np.broadcast_to(np.arange(many), order.shape), 1)
        place[named] = own
    left = sums.cumsum(3)[:, :, :, :-1]
    right = sums[:, :, :, ::-1].cumsum(3)[:, :, :, ::-1][:, :, :, 1:]
    wl, wr = left[0].sum(-1), right[0].sum(-1)
    whole = left[0, 0, :, 0] + right[0, 0, :, 0]                          # node x class
    all_w = whole.sum(-1)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = _impurity(whole, all_w)[None, :, None] - (wl * _impurity(left[0], wl) + wr * _impurity(right[0], wr)) / all_w[None, :, None]
    ok = (wl > 0) & (wr > 0) & (gain >= min_gain)
    if len(sums) > 1:
        ok &= (left[1].sum(-1) >= min_rows) & (right[1].sum(-1) >= min_rows)
    gain = np.where(ok, gain, -np.inf).transpose(1, 0, 2).reshape(len(nodes), -1)
    best = gain.argmax(1)
    k, s = best // (many - 1), best % (many - 1)
    numbers = [p[1, k, nodes, s].sum(-1) if len(sums) > 1 else np.full(len(nodes), -1.0) for p in (left, right)]
    return gain[nodes, best], k, s, place[k, nodes], left[0, k, nodes, s], right[0, k, nodes, s], *numbers, whole


def _chosen(batches, level, arity, wide: int, counted: bool, min_rows: int, min_gain: float):
    """Adds up the tasks' sums of each tree (they come in order) and picks the splits."""
    trees, now, total = pickle.loads(level.value), None, None

    def out():
        drawn = trees[now][1]
        found = best_splits(total.reshape(1 + counted, drawn.shape[1], drawn.shape[0], wide // 2, 2), drawn, arity, min_rows, min_gain)
        return pa.record_batch({"tree": pa.array([now], pa.int32()), "found": pa.array([pickle.dumps(found)], pa.binary())})

    for b in batches:
        for tree, sums in zip(b.column(0).to_pylist(), b.column(2)):
            s = np.frombuffer(sums.as_buffer(), float)
            if tree != now:
                if now is not None:
                    yield out()
                now, total = tree, s.copy()
            else:
                total += s
    if now is not None:
        yield out()


# ------------------------------------------------------------------ trees
def _node(stats, number):
    return {"stats": stats, "number": int(number), "gain": -1.0, "split": None}


def _grow(rows: DataFrame, arity, n_trees: int, depth: int, bins: int, min_rows: int, min_gain: float, rate: float, seed: int) -> list:
    spark, width = rows.sparkSession, len(arity)
    sketch = rows.mapInArrow(lambda it: _sketched(it, width), "f int, v binary, c binary")
    found = sketch.groupBy("f").applyInArrow(lambda t: _cut(t, bins), "f int, cuts binary").collect()      # a row per feature
    cuts = [c for _, c in sorted((r["f"], np.frombuffer(r["cuts"], float)) for r in found)]
    bins = max([2, arity.max(), *(c.size + 1 for c, a in zip(cuts, arity) if not a)])
    wide = 2 * int(bins)
    tasks = 2 * spark.sparkContext.defaultParallelism
    blocks = tables.stored_blocks(rows.mapInArrow(lambda it: _packed(it, cuts, arity), "block long, x binary, w binary"), "forest_bins", tasks)
    counted = min_rows > 1

    m = width if n_trees == 1 else math.ceil(math.sqrt(width))
    roots, paths, open_ = [None] * n_trees, [[] for _ in range(n_trees)], [[None] for _ in range(n_trees)]
    for d in range(depth):
        drawn = {t: np.random.default_rng([seed, t, d]).random((len(o), width)).argsort(1)[:, :m] for t, o in enumerate(open_) if o}
        if not drawn:
            break
        groups, room = [], 0
        for t, f in drawn.items():
            size = f.size * wide * 8 * (1 + counted)
            if not groups or size > room:
                groups, room = [*groups, []], PASS_BYTES
            groups[-1].append(t)
            room -= size
        for group in groups:
            level = spark.sparkContext.broadcast(pickle.dumps({t: (paths[t], drawn[t]) for t in group}))
            sums = blocks.mapInArrow(lambda it: _sums(it, level, width, wide, seed, rate, counted), "tree int, part long, sums binary")  # noqa: B023
            got = sums.repartition(tasks, "tree").sortWithinPartitions("tree", "part").mapInArrow(
                lambda it: _chosen(it, level, arity, wide, counted, min_rows, min_gain), "tree int, found binary").collect()  # noqa: B023
            level.unpersist()
            for t, found in got:                       # a row per tree
                _apply(t, pickle.loads(found), drawn[t], arity, cuts, wide, d + 1 == depth, roots, paths, open_)
    return roots


def _apply(t, found, drawn, arity, cuts, wide, last, roots, paths, open_) -> None:
    """Splits the open nodes of a tree, or leaves them as leaves; what stays open is numbered for the next level."""
    gain, k, s, place, left, right, n_left, n_right, whole = found
    into, feature, nxt = np.full((len(gain), wide), -1, np.int64), drawn[np.arange(len(gain)), k], []
    if roots[t] is None:
        roots[t] = open_[t][0] = _node(whole[0], n_left[0] + n_right[0] if n_left[0] >= 0 else -1)
    for i, node in enumerate(open_[t]):
        if not gain[i] > 0:
            continue
        f = int(feature[i])
        goes = place[i] > s[i]                          # by bin: to the right
        limit = [float(c) for c in np.flatnonzero(~goes) if c < arity[f]] if arity[f] else [float(cuts[f][s[i]])]
        node |= {"gain": float(gain[i]), "split": (f, limit)}
        node["children"] = [_node(left[i], n_left[i]), _node(right[i], n_right[i])]
        for side, child in enumerate(node["children"]):
            if not last and min(child["stats"]) > 0:     # a child of one class is a leaf
                into[i, np.repeat(goes == bool(side), 2)] = len(nxt)
                nxt.append(child)
    paths[t].append((feature, into.ravel(), bool((into < 0).any())))
    open_[t] = nxt


def _preorder(root, arity) -> list:
    """The nodes as spark.ml stores them."""
    def prune(node):
        if node["split"]:
            a, b = (prune(c) for c in node["children"])
            if not a["split"] and not b["split"] and np.argmax(a["stats"]) == np.argmax(b["stats"]):
                node |= {"split": None, "gain": -1.0}
        return node

    out = []

    def walk(node):
        me = len(out)
        out.append(None)
        down = [walk(c) for c in node["children"]] if node["split"] else [-1, -1]
        f, limit = node["split"] or (-1, [])
        split = {"featureIndex": f, "leftCategoriesOrThreshold": limit, "numCategories": int(arity[f]) if f >= 0 and arity[f] else -1}
        stats = np.asarray(node["stats"], float)
        out[me] = (me, float(np.argmax(stats)), float(_impurity(stats, stats.sum())), stats.tolist(), node["number"], node["gain"], *down, split)
        return me

    walk(prune(root))
    return out
