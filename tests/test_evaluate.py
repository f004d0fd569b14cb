"""Metrics: published confusion matrix golden values, AUC against pair counting."""

import random

from georisk.operators import evaluate as ev


def confusion_rows(spark, tn=2282, fp=6, fn=40, tp=272):
    rows = [(0, 0.1)] * tn + [(0, 0.9)] * fp + [(1, 0.1)] * fn + [(1, 0.9)] * tp
    return spark.createDataFrame(rows, "label int, score double")


def test_published_confusion_rates(spark):
    m = ev.binary_metrics(confusion_rows(spark)).first()
    assert (m.tp, m.fp, m.fn, m.tn) == (272, 6, 40, 2282)
    assert round(m.recall, 6) == 0.871795
    assert round(m.precision, 6) == 0.978417
    assert round(m.f1, 6) == 0.922034
    assert round(m.accuracy, 6) == 0.982308
    assert round(m.false_positive_rate, 6) == 0.002622


def test_confusion_matrix_has_four_cells(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.8)], "label int, score double")
    cells = {(r.label, r.predicted): r.n for r in ev.confusion_matrix(df).collect()}
    assert cells == {(0, 0): 0, (0, 1): 0, (1, 0): 0, (1, 1): 2}


def test_auc_equals_pair_counting(spark):
    rnd = random.Random(3)
    rows = [(rnd.randint(0, 1), round(rnd.random(), 2)) for _ in range(300)]
    a = ev.auc(spark.createDataFrame(rows, "label int, score double")).first()[0]
    pos = [s for l, s in rows if l == 1]
    neg = [s for l, s in rows if l == 0]
    u = sum(1.0 if p > q else 0.5 if p == q else 0.0 for p in pos for q in neg)
    assert abs(a - u / (len(pos) * len(neg))) < 1e-12


def test_roc_ends_at_one(spark):
    rows = [(i % 2, i / 100) for i in range(100)]
    roc = ev.roc_curve(spark.createDataFrame(rows, "label int, score double")).orderBy("threshold").collect()
    assert roc[0].fpr == 1.0 and roc[0].tpr == 1.0
    assert all(a.fpr >= b.fpr for a, b in zip(roc, roc[1:]))


def test_report_and_compare(spark):
    rep = {r["class"]: r for r in ev.classification_report(confusion_rows(spark)).collect()}
    assert rep["1"].support == 312 and rep["0"].support == 2288
    assert round(rep["0"].recall, 3) == 0.997
    cmp = ev.compare_runs(ev.metrics_from_counts(ev.confusion_counts(confusion_rows(spark)))).first()
    assert cmp.verdict == "better" and round(cmp.gain_points, 4) == round((272 / 312 - 0.87) * 100, 4)


def test_leaderboard_order(spark):
    res = spark.createDataFrame([("a", 0.8, 0.9, 0.85, 0.9), ("b", 0.87, 0.97, 0.92, 0.97)],
                                "model string, recall double, precision double, f1 double, auc_roc double")
    rows = ev.leaderboard(res).collect()
    assert [r.model for r in rows] == ["b", "a"] and rows[0].Recall == "0.870"


def test_exact_percentiles_match_numpy(spark):
    import numpy as np
    from georisk.operators import profile
    rnd = random.Random(11)
    vals = [round(rnd.gauss(0, 1), 2) for _ in range(777)] + [5.0] * 300      # ties and a heavy value
    df = spark.createDataFrame([(v,) for v in vals], "x double").repartition(5)
    r = profile.exact_percentiles(df, "x", [0.0, 0.1, 0.5, 0.9, 1.0]).first()
    for i, p in enumerate([0.0, 0.1, 0.5, 0.9, 1.0]):
        assert abs(r[f"p{i}"] - float(np.percentile(vals, p * 100))) < 1e-12
