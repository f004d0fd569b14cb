"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

    score = sigmoid(b + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j)

The pairwise sum is 0.5 * sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2), so a
document costs time linear in its distinct words.  The fit runs in numpy on a
bounded number of labelled rows (``Params.max_rows``); features and scores
are computed by the executors over whole texts.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Shared, space_words

UPPER = bytes(range(65, 91))
LOWER = bytes(range(97, 123))
DIGITS = bytes(range(48, 58))
SPACES = b" \t\n\r\x0b\x0c"
SYMBOLS = b"#*$%&|<>{}[]\\^~_=+@/"
MARKS = b".,;:!?'\"()-"


@dataclass(frozen=True)
class Params:
    """Size and fit of the machine; ``max_rows`` bounds the labelled rows it is fitted on."""

    words: int = 1 << 13
    bins: int = 12
    rank: int = 8
    max_rows: int = 6000
    epochs: int = 8
    batch: int = 64
    rate: float = 0.08
    l2: float = 1e-4
    seed: int = 7


def statistics(text: str, words: list[bytes], n_chars: int | None) -> list[float]:
    """Structure of the whole text, each between 0 and 1, then the declared length (metadata)."""
    data = text.encode()
    size, n = max(len(data), 1), max(len(words), 1)

    def share(chars: bytes) -> float:
        return 1 - len(data.translate(None, chars)) / size if data else 0.0
    lines = [x for x in data.split(b"\n") if x.strip()]
    letters = max(share(UPPER) + share(LOWER), 1e-9)
    lengths = list(map(len, words)) or [0]
    return [
        min(math.log1p(len(words)) / 12, 1.0),
        share(UPPER) / letters,
        share(DIGITS),
        share(SPACES),
        share(SYMBOLS),
        share(MARKS),
        sum(map(eq, words, words[1:])) / n,
        len(set(words)) / n,
        len(set(zip(words, words[1:]))) / n,
        1 - len(set(lines)) / max(len(lines), 1),
        min(len(lines) / n, 1.0),
        min(sum(lengths) / n / 20, 1.0),
        min(max(lengths) / 64, 1.0),
        min(math.log1p(max(n_chars, 0)) / 16, 1.0) if n_chars is not None else 0.0,
    ]


N_STATS = 14


def features(text: str | None, n_chars: int | None, p: Params) -> tuple[np.ndarray, np.ndarray]:
    """Sparse features: hashed words (L2-normalised log counts), then each statistic as two shared bins."""
    text = text or ""
    words = space_words(text, lower=True)
    counts = Counter(words)
    stats = statistics(text, words, n_chars)
    crc = zlib.crc32
    idx = np.fromiter((crc(w) % p.words for w in counts), np.int64, len(counts))
    val = np.log1p(np.fromiter(counts.values(), np.float64, len(counts)))
    if len(val):
        val /= math.sqrt(float(val @ val))
    # a value between two bin centres belongs to both in proportion: piecewise linear in the statistic
    at = np.array(stats) * (p.bins - 1)
    low = np.minimum(at.astype(np.int64), p.bins - 2)
    part = at - low
    base = p.words + np.arange(N_STATS) * p.bins + low
    return np.concatenate([idx, base, base + 1]), np.concatenate([val, 0.5 * (1 - part), 0.5 * part])


@dataclass
class Machine:
    params: Params
    bias: float
    w: np.ndarray
    v: np.ndarray

    def margin(self, idx: np.ndarray, val: np.ndarray) -> float:
        vx = self.v[idx] * val[:, None]
        s = vx.sum(axis=0)
        return float(self.bias + self.w[idx] @ val + 0.5 * (s @ s - (vx * vx).sum()))

    def score(self, text: str | None, n_chars: int | None) -> float:
        return 1 / (1 + math.exp(-max(min(self.margin(*features(text, n_chars, self.params)), 30.0), -30.0)))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, p: Params) -> Machine:
    """Logistic loss by Adagrad over shuffled rows, classes weighted alike.

    Without rows of both classes there is nothing to learn: the scores are then
    the share of label 1 (0.5 without any row), whatever the text.
    """
    size = p.words + N_STATS * p.bins
    rng = np.random.default_rng(p.seed)
    n, ones = len(rows), int(np.sum(labels))
    if not 0 < ones < n:
        share = (ones + 0.5) / (n + 1)
        return Machine(p, math.log(share / (1 - share)), np.zeros(size), np.zeros((size, p.rank)))
    m = Machine(p, 0.0, np.zeros(size), rng.normal(0, 0.05, (size, p.rank)))
    weight = {1: n / (2 * ones), 0: n / (2 * (n - ones))}
    gw, gv, gb = np.full(size, 1e-2), np.full((size, p.rank), 1e-2), 1e-2
    for _ in range(p.epochs):
        order = rng.permutation(n)
        for start in range(0, n, p.batch):
            pick = order[start:start + p.batch]
            idx = np.concatenate([rows[i][0] for i in pick])
            val = np.concatenate([rows[i][1] for i in pick])
            doc = np.repeat(np.arange(len(pick)), [len(rows[i][0]) for i in pick])
            vx = m.v[idx] * val[:, None]
            s = np.zeros((len(pick), p.rank))
            np.add.at(s, doc, vx)
            lin = np.bincount(doc, m.w[idx] * val, len(pick))
            sq = np.bincount(doc, (vx * vx).sum(axis=1), len(pick))
            z = np.clip(m.bias + lin + 0.5 * ((s * s).sum(axis=1) - sq), -30, 30)
            y = labels[pick]
            g = (1 / (1 + np.exp(-z)) - y) * np.where(y == 1, weight[1], weight[0]) / len(pick)
            uniq, back = np.unique(idx, return_inverse=True)
            dw = np.bincount(back, g[doc] * val, len(uniq)) + p.l2 * m.w[uniq]
            dv_rows = (g[doc] * val)[:, None] * (s[doc] - vx)
            dv = np.stack([np.bincount(back, dv_rows[:, f], len(uniq)) for f in range(p.rank)], axis=1)
            dv += p.l2 * m.v[uniq]
            gw[uniq] += dw * dw
            gv[uniq] += dv * dv
            gb += g.sum() ** 2
            m.w[uniq] -= p.rate * dw / np.sqrt(gw[uniq])
            m.v[uniq] -= p.rate * dv / np.sqrt(gv[uniq])
            m.bias -= p.rate * g.sum() / math.sqrt(gb)
    return m


def held_out(doc_id: str = "doc_id"):
    """Rows whose label is never learnt: crc32(doc_id as text) mod 3 = 1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def _inputs(docs: DataFrame):
    n = F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")
    return F.col("doc_id").cast("long").alias("doc_id"), F.col("text"), n.alias("n_chars")


def train(docs: DataFrame, labels: DataFrame, p: Params = Params(), target: str = "quality") -> Machine:
    """Fit on at most ``p.max_rows`` labelled documents that are not held out.

    They are those with the smallest hash of doc_id, so every rerun takes the
    same ones.  A doc_id labelled twice counts as label 0 if any row says so;
    null ids and labels are left out; of rows repeating a doc_id one is taken.
    """
    picked = (labels.filter(F.col("doc_id").isNotNull() & F.col(target).isNotNull() & ~held_out())
              .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(target).alias("label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(p.max_rows))

    def run(batches):
        for b in batches:
            made = [features(t, n, p) for t, n in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(3), pa.array([i.astype("<i4").tobytes() for i, _ in made], pa.binary()),
                 pa.array([v.astype("<f4").tobytes() for _, v in made], pa.binary())],
                names=["doc_id", "label", "idx", "val"])

    # the labelled ids are bounded by max_rows, so broadcasting them is too
    rows = (docs.select(*_inputs(docs)).join(F.broadcast(picked), "doc_id")
            .select("doc_id", "text", "n_chars", F.col("label").cast("int").alias("label"))
            .mapInArrow(run, "doc_id long, label int, idx binary, val binary")
            .toPandas().sort_values(["doc_id", "idx"]).drop_duplicates("doc_id"))
    made = [(np.frombuffer(i, "<i4").astype(np.int64), np.frombuffer(v, "<f4").astype(np.float64))
            for i, v in zip(rows["idx"], rows["val"])]
    return fit(made, (rows["label"].to_numpy() == 1).astype(int), p)


def _scored(docs: DataFrame, machine: Machine, keep: list[str]) -> DataFrame:
    """``keep`` columns renamed to k0, k1, ... with ``score``: no clash whatever they are called."""
    shared = Shared(docs.sparkSession, machine)
    names = [f"k{i}" for i in range(len(keep))]
    taken = docs.select(*[F.col(c).alias(k) for k, c in zip(names, keep)],
                        *[c.alias(f"x{i}") for i, c in enumerate(_inputs(docs)[1:])])
    kinds = {f.name: f.dataType.simpleString() for f in taken.schema.fields}

    def run(batches):
        m = shared.value
        for b in batches:
            texts, lengths = b.column(len(names)), b.column(len(names) + 1).to_pylist()
            scores = [m.score(t.as_py(), n) for t, n in zip(texts, lengths)]
            yield pa.RecordBatch.from_arrays(b.columns[:len(names)] + [pa.array(scores, pa.float64())],
                                             names=[*names, "score"])

    return taken.mapInArrow(run, ", ".join(f"{k} {kinds[k]}" for k in names) + ", score double")


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """``doc_id``, ``score`` in 0..1 and ``predicted`` (1 from 0.5 on) per row of ``docs``.

    Null and empty texts are scored on their statistics like any other row.
    Only doc_id, text and n_chars are read.
    """
    out = _scored(docs, machine, ["doc_id"])
    return out.select(F.col("k0").alias("doc_id"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, p: Params = Params()) -> DataFrame:
    """The rows of ``docs`` that the classifier takes for quality 1, all columns unchanged."""
    scored = _scored(docs, train(docs, labels, p), docs.columns).filter(F.col("score") >= 0.5)
    return scored.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(docs.columns)])
