import random
import zlib

import numpy as np
import pytest

from georisk.llm import catalog, quality_fm
from georisk.llm.common import read_table

SF = "/root/testdata/sf0.01"


def test_margin_equals_the_pairwise_sum():
    rng = np.random.default_rng(3)
    p = quality_fm.Params(words=64, rank=3)
    size = p.words + quality_fm.N_STATS * p.bins
    m = quality_fm.Machine(p, 0.3, rng.normal(size=size), rng.normal(size=(size, 3)))
    idx, val = quality_fm.features("One two two THREE\n\n** 12", 20, p)
    want = m.bias + sum(m.w[i] * x for i, x in zip(idx, val))
    for a in range(len(idx)):
        for b in range(a + 1, len(idx)):
            want += float(m.v[idx[a]] @ m.v[idx[b]]) * val[a] * val[b]
    assert m.margin(idx, val) == pytest.approx(want)


def test_gradient_by_finite_differences():
    """One step on one row of each class moves the loss down."""
    p = quality_fm.Params(words=64, rank=2, epochs=1, batch=2, rate=0.01, l2=0.0)
    rows = [quality_fm.features(t, len(t), p) for t in ("good text here", "bad bad bad bad")]
    y = np.array([1, 0])

    def loss(m):
        return sum(np.log1p(np.exp(-(2 * k - 1) * m.margin(*r))) for r, k in zip(rows, y))
    start = quality_fm.fit(rows, y, quality_fm.Params(words=64, rank=2, epochs=0, l2=0.0))
    assert loss(quality_fm.fit(rows, y, p)) < loss(start)


def test_held_out_accuracy(spark):
    got = catalog.QUERIES["op9_quality_classifier"](spark, SF).toPandas()
    docs, labels = read_table(spark, SF, "documents"), read_table(spark, SF, "labels").toPandas()
    assert len(got) == docs.count() and got.score.between(0, 1).all()
    assert (got.predicted == (got.score >= 0.5)).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in got.doc_id]).all()
    test = got[got.held_out].merge(labels, on="doc_id")
    assert (test.predicted == test.quality).mean() > 0.95
    ranks = test.score.rank()
    ones = int(test.quality.sum())
    auc = (ranks[test.quality == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(test) - ones))
    assert auc > 0.98


def test_scores_ignore_held_out_labels_and_other_columns(spark):
    docs, labels = read_table(spark, SF, "documents"), read_table(spark, SF, "labels")
    small = quality_fm.Params(max_rows=60, epochs=2)
    flipped = labels.selectExpr(
        "doc_id", "CASE WHEN crc32(CAST(doc_id AS STRING)) % 3 = 1 THEN 1 - quality ELSE quality END AS quality")
    a, b = quality_fm.train(docs, labels, small), quality_fm.train(docs, flipped, small)
    assert np.array_equal(a.w, b.w) and np.array_equal(a.v, b.v)
    renamed = docs.selectExpr("doc_id", "text", "n_chars", "'x' AS lang", "1 AS source", "2.5 AS score")
    assert (quality_fm.score(docs, a).toPandas().sort_values("doc_id").score.to_numpy()
            == quality_fm.score(renamed, a).toPandas().sort_values("doc_id").score.to_numpy()).all()


def test_edge_rows(spark):
    schema = "doc_id long, text string, n_chars long, score string"
    rows = [(1, None, None, "a"), (2, "", 0, "b"), (None, "x y", 3, "c"), (4, "w " * 200_000, 400_000, None),
            (4, "w " * 200_000, 400_000, None)]
    docs = spark.createDataFrame(rows, schema)
    labels = spark.createDataFrame([(1, 0, 0), (2, None, 0), (None, 1, 1), (4, 1, 0), (3, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    m = quality_fm.train(docs, labels, quality_fm.Params(epochs=1))
    got = quality_fm.score(docs, m).collect()
    assert len(got) == 5 and all(0 <= r["score"] <= 1 for r in got)
    empty = docs.limit(0)
    assert quality_fm.score(empty, quality_fm.train(empty, labels)).count() == 0
    none = quality_fm.train(docs, labels.limit(0))  # nothing learnt: all rows score alike
    assert {r["score"] for r in quality_fm.score(docs, none).collect()} == {0.5}
    assert quality_fm.keep_good(docs, labels.limit(0)).columns == docs.columns


def test_fit_is_deterministic():
    rng = random.Random(2)
    p = quality_fm.Params(epochs=1)
    rows = [quality_fm.features(" ".join(rng.choices("abcdefgh", k=30)), 60, p) for _ in range(40)]
    y = np.array([i % 2 for i in range(40)])
    assert np.array_equal(quality_fm.fit(rows, y, p).w, quality_fm.fit(rows, y, p).w)
