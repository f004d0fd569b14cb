"""Multilayer perceptron for many rows: the assembled rows are stored once in blocks, a pass over them is matrix products.

Layers, loss and starting weights are those of spark.ml's MultilayerPerceptronClassifier (sigmoid layers, softmax, mean
cross-entropy), and so are the optimiser (L-BFGS with ten corrections and a strong Wolfe line search) and the fitted model.
"""

from __future__ import annotations

import math
import pickle
import sys

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tables

cloudpickle.register_pickle_by_value(sys.modules[__name__])   # tasks need numpy and pyarrow, not this package

BLOCK_ROWS = 4096
STEP_ROWS = 512              # rows whose layers fit into a core's cache
MOST_PARTS = 64              # tasks whose sums are added up on the driver; those of more are added by tasks
CORRECTIONS = 10
ARMIJO, CURVATURE, LINE_STEPS = 1e-4, 0.9, 10


# ------------------------------------------------------------------ blocks
def columns_packed(x) -> bytes:
    """The columns of a matrix without loss: those of at most 256 values as a byte per row and the values."""
    cols = []
    for col in x.T:
        values, code = np.unique(col, return_inverse=True) if np.unique(col[:512]).size <= 256 else (col, None)
        cols.append((values, code.astype(np.uint8)) if values.size <= 256 and code is not None else (np.ascontiguousarray(col), None))
    return pickle.dumps(cols, protocol=5)


def columns_unpacked(data) -> np.ndarray:
    cols = pickle.loads(data)
    out = np.empty((len(cols), len(cols[0][0] if cols[0][1] is None else cols[0][1])))
    for row, (values, code) in zip(out, cols):
        if code is None:
            row[:] = values
        else:
            values.take(code, out=row, mode="clip")
    return out.T


def _packed(batches, width: int):
    held, n = [], 0

    def out():
        nonlocal held, n
        x, y, w = (np.concatenate(p) for p in zip(*held))
        for at in range(0, n - n % BLOCK_ROWS or n, BLOCK_ROWS):
            end = min(n, at + BLOCK_ROWS)
            yield pa.record_batch({k: pa.array([v], pa.binary()) for k, v in (
                ("x", columns_packed(x[at:end])), ("y", y[at:end].tobytes()), ("w", w[at:end].tobytes()))})
        held, n = ([(x[end:], y[end:], w[end:])], n - end) if end < n else ([], 0)

    for b in batches:
        x = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
        y = b.column(1).to_numpy(zero_copy_only=False)
        if not ((y >= 0) & (y <= 255) & (y == np.floor(y))).all():       # nor NaN, which stands for null
            raise ValueError("a label is no class number")
        held.append((x, y.astype(np.uint8), b.column(2).to_numpy(zero_copy_only=False)))
        n += b.num_rows
        if n >= BLOCK_ROWS:
            yield from out()
    if n:
        yield from out()


def stored_blocks(prepared: DataFrame, width: int, weight: str | None = None) -> DataFrame:
    """``features``, ``target`` and the weight (1 without) in blocks."""
    rows = prepared.select(vector_to_array("features").alias("x"), F.col("target").cast("double").alias("y"),
                           (F.col(weight) if weight else F.lit(1.0)).cast("double").alias("w"))
    return tables.stored_blocks(rows.mapInArrow(lambda it: _packed(it, width), "x binary, y binary, w binary"), "perceptron_blocks")


# ------------------------------------------------------------------ one pass
def _layers(weights, sizes):
    """(inputs x outputs, bias) per layer, views of the flat weights in spark.ml's order."""
    at = 0
    for a, b in zip(sizes, sizes[1:]):
        yield weights[at:at + a * b].reshape(a, b), weights[at + a * b:at + a * b + b]
        at += (a + 1) * b


def block_loss(weights, sizes, x, y, w, slope: bool):
    """Weighted sum of -log p(label), and its gradient."""
    layers, acts = list(_layers(weights, sizes)), [x]
    for k, (m, bias) in enumerate(layers):
        z = acts[-1] @ m
        z += bias
        if k + 1 < len(layers):          # the sigmoid, as tanh
            z *= 0.5
            np.tanh(z, out=z)
            z += 1.0
            z *= 0.5
        acts.append(z)
    z = acts[-1]
    z -= z.max(1, keepdims=True)
    of = z[np.arange(y.size), y]
    np.exp(z, out=z)
    whole = z.sum(1)
    loss = float(((np.log(whole) - of) * w).sum())
    if not slope:
        return loss, None
    z /= whole[:, None]
    z[np.arange(y.size), y] -= 1.0
    z *= w[:, None]
    out, delta = np.empty_like(weights), z
    grads = list(_layers(out, sizes))
    for k in range(len(layers) - 1, -1, -1):
        grads[k][0][:] = acts[k].T @ delta
        grads[k][1][:] = delta.sum(0)
        if k:
            delta = delta @ layers[k][0].T
            delta *= acts[k]
            delta *= 1.0 - acts[k]
    return loss, out


def _pass(batches, state, sizes, slope: bool):
    weights, loss, grad, n = pickle.loads(state.value), 0.0, 0.0, 0.0
    for b in batches:
        for xs, ys, ws in zip(*(b.column(k) for k in range(3))):
            x, y, w = columns_unpacked(xs.as_buffer()), np.frombuffer(ys.as_buffer(), np.uint8), np.frombuffer(ws.as_buffer(), float)
            n += float(w.sum())
            for at in range(0, y.size, STEP_ROWS):
                own = slice(at, at + STEP_ROWS)
                more, g = block_loss(weights, sizes, x[own], y[own], w[own], slope)
                loss += more
                if slope:
                    grad = grad + g
    yield _part(TaskContext.get().partitionId(), loss, n, grad)


def _part(part, loss, n, grad):
    return pa.record_batch({"part": pa.array([part], pa.int64()), "loss": pa.array([loss]), "n": pa.array([n]),
                            "grad": pa.array([np.atleast_1d(grad).astype(float).tobytes()], pa.binary())})


def _added(batches):
    rows = [(r["part"], r["loss"], r["n"], np.frombuffer(r["grad"], float)) for b in batches for r in b.to_pylist()]
    if rows:
        yield _part(min(r[0] for r in rows), *_total(rows))


def _total(rows):
    """Sums in the order of the parts, so that they do not depend on which task ended first."""
    loss, n, grad = 0.0, 0.0, np.zeros(max((r[3].size for r in rows), default=1))
    for _, more, count, g in sorted(rows, key=lambda r: r[0]):
        loss, n, grad = loss + more, n + count, grad + (g if g.size == grad.size else 0.0)
    return loss, n, grad


class Loss:
    """Mean loss over stored blocks, and its gradient."""

    def __init__(self, blocks: DataFrame, sizes):
        self.blocks, self.sizes = blocks, list(sizes)
        self.parts = blocks.rdd.getNumPartitions()

    def __call__(self, weights, slope: bool = True):
        sizes, sc = self.sizes, self.blocks.sparkSession.sparkContext
        state = sc.broadcast(pickle.dumps(weights))
        kind = "part long, loss double, n double, grad binary"
        out = self.blocks.mapInArrow(lambda it: _pass(it, state, sizes, slope), kind)
        if self.parts > MOST_PARTS:
            few = math.isqrt(self.parts)
            out = out.repartition(few, F.col("part") % few).mapInArrow(_added, kind)
        loss, n, grad = _total([(r["part"], r["loss"], r["n"], np.frombuffer(r["grad"], float)) for r in out.collect()])
        state.unpersist()
        return (loss / n, grad / n) if n else (float("inf"), grad)


# ------------------------------------------------------------------ the optimiser
class _Failed(Exception):
    """No step meets the conditions."""


def _between(low, high):
    """Minimum of the cubic through two points (step, loss, slope), not too near to either."""
    (t0, f0, d0), (t1, f1, d1) = sorted((low[:3], high[:3]))
    mid = d0 + d1 - 3 * (f0 - f1) / (t0 - t1)
    with np.errstate(invalid="ignore", divide="ignore"):
        root = np.sqrt(mid * mid - d0 * d1)
        t = t1 - (t1 - t0) * (d1 + root - mid) / (d1 - d0 + 2 * root)
    least, most = t0 + 0.1 * (t1 - t0), t0 + 0.9 * (t1 - t0)
    return least if t < least else most if t > most else t


def _line_search(at, f0: float, d0: float, t: float):
    """The first point (step, loss, slope, gradient) that meets the strong Wolfe conditions; steps as in Breeze, which spark.ml uses."""
    if d0 > 0:
        raise _Failed("no descent")

    def falls(c):
        return c[1] <= f0 + ARMIJO * c[0] * d0

    def flat(c):
        return abs(c[2]) <= CURVATURE * abs(d0)

    def zoom(low, high):
        for _ in range(LINE_STEPS):
            c = at(_between(low, high))
            if not falls(c) or c[1] >= low[1]:
                high = c
            else:
                if flat(c):
                    return c
                if c[2] * (high[0] - low[0]) >= 0:
                    high = low
                low = c
        raise _Failed("zoom")

    low = (0.0, f0, d0, None)
    for k in range(LINE_STEPS):
        c = at(t)
        if not math.isfinite(c[1]):
            t /= 2
            continue
        if not falls(c) or (k and c[1] >= low[1]):
            return zoom(low, c)
        if flat(c):
            return c
        if c[2] >= 0:
            return zoom(c, low)
        low, t = c, t * 1.5
    raise _Failed("steps")


def minimise(loss, x, iterations: int, tol: float = 1e-6, state=None):
    """L-BFGS as in Breeze: (weights, state) after at most ``iterations``; with the state a later call goes on where this one ended.

    The state is the loss and gradient at the weights and the corrections."""
    f, g, pairs = state or (*loss(x), [])
    first, past, failed, done = f, [math.inf], False, 0
    while done < iterations and np.linalg.norm(g) > max(tol * abs(f), 1e-8):
        d, kept = -g, []
        for s, y, r in reversed(pairs):
            kept.append(r * (s @ d))
            d = d - kept[-1] * y
        if pairs:
            s, y, r = pairs[-1]
            d = d / (r * (y @ y))
        for (s, y, r), a in zip(pairs, reversed(kept)):
            d = d + s * (a - r * (y @ d))

        def at(t, x=x, d=d):
            value, grad = loss(x + t * d)
            return t, value, float(grad @ d), grad
        try:
            t, value, _, new = _line_search(at, f, float(g @ d), 1.0 if done or pairs else 1.0 / np.linalg.norm(d))
            if t * np.linalg.norm(g) < 1e-10:
                raise _Failed("small")
        except _Failed:
            if failed:
                break
            failed, pairs = True, []         # once more along the gradient
            continue
        s, y, failed, done = t * d, new - g, False, done + 1
        pairs = [*pairs, (s, y, 1.0 / (s @ y))][-CORRECTIONS:]
        x, f, g, past = x + s, value, new, [*past, value][-20:]
        if abs(f - max(past)) <= tol * first:
            break
    return x, (f, g, pairs)


def train(mlp, train_blocks: DataFrame, held_blocks: DataFrame | None, max_iter: int, step: int, patience: int, tolerance: float):
    """spark.ml's model of the best step, and the validation loss of every step; of the last iteration without ``held_blocks``."""
    sizes, one = mlp.getLayers(), _tiny(mlp, train_blocks)
    loss, state = Loss(train_blocks, sizes), None
    weights = mlp.copy({mlp.maxIter: 0}).fit(one).weights.toArray()           # spark.ml's start for the seed
    if held_blocks is None:
        return fitted(mlp, minimise(loss, weights, max_iter, mlp.getTol())[0], one, max_iter), []
    held = Loss(held_blocks, sizes)
    best, least, idle, losses, done = None, float("inf"), 0, [], 0
    while done < max_iter and idle < patience:
        now = min(step, max_iter - done)
        weights, state = minimise(loss, weights, now, mlp.getTol(), state)   # with its corrections: a new start takes more passes
        done += now
        losses.append(held(weights, slope=False)[0])
        if best is None or losses[-1] < least - tolerance:
            best, least, idle = weights, losses[-1], 0
        else:
            idle += 1
    return fitted(mlp, best, one, step), losses


def _tiny(mlp, blocks):
    from pyspark.ml.linalg import Vectors
    spark = blocks.sparkSession
    return spark.createDataFrame([(Vectors.dense([0.0] * mlp.getLayers()[0]), 0.0)], [mlp.getFeaturesCol(), mlp.getLabelCol()])


def fitted(mlp, weights, one, iterations: int):
    """spark.ml's model with these weights: no iteration from them."""
    from pyspark.ml.linalg import Vectors
    model = mlp.copy({mlp.maxIter: 0, mlp.initialWeights: Vectors.dense(weights)}).fit(one)
    return model._set(maxIter=iterations)
