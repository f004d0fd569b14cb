"""The forest fitted by array kernels against brute force and against spark.ml's own forest."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import functions as F

from georisk.operators import evaluate, forest, model
from georisk.session import scratch_path


def rows(spark, n=6000):
    df = spark.range(0, n, 1, 3).selectExpr(
        "cast(pmod(hash(id), 9) AS int) AS atm", "pmod(hash(id, 1), 1000) / 10D AS a", "pmod(hash(id, 2), 3) AS b",
        "pmod(hash(id, 3), 100) / 100D AS r", "id")
    return model.with_raw_label(df.withColumn("target", F.expr("cast((a / 100 + int(atm % 3 = 0) > 0.9) != (r < 0.1) AS int)"))
                                .withColumn("weight", F.expr("if(target = 1, 0.8, 1.3)")))


def auc(df, fitted):
    return evaluate.auc(model.score(df, fitted, out="score").withColumnRenamed("target", "label")).first()[0]


def test_forest_is_as_good_as_that_of_spark(spark):
    df = rows(spark)
    train, test = df.filter("id % 4 > 0"), df.filter("id % 4 = 0")
    ours = model.tree_pipeline("rf", cols=["atm", "a", "b"], encode=True, numTrees=20, maxDepth=5)
    assert isinstance(ours.getStages()[-1], forest.BinnedForest)
    other = Pipeline(stages=[*ours.getStages()[:-1], RandomForestClassifier(
        featuresCol="features", labelCol="target", weightCol="weight", seed=42, numTrees=20, maxDepth=5)])
    fitted, theirs = ours.fit(train), other.fit(train)
    assert auc(test, fitted) > 0.85 and abs(auc(test, fitted) - auc(test, theirs)) < 0.02
    got = fitted.stages[-1]
    assert got.getNumTrees == 20 and max(t.depth for t in got.trees) == 5 and got.getOrDefault("maxDepth") == 5
    assert np.argsort(got.featureImportances.toArray()).tolist() == np.argsort(theirs.stages[-1].featureImportances.toArray()).tolist()
    assert auc(test, ours.fit(train)) == auc(test, fitted)             # the same rows, the same trees
    path = scratch_path(spark, "t_forest")
    fitted.write().overwrite().save(path)
    from pyspark.ml import PipelineModel
    assert auc(test, PipelineModel.load(path)) == auc(test, fitted)


def test_least_rows_of_a_child_and_cases_left_to_spark(spark):
    df = rows(spark, 1500)
    kind = dict(cols=["atm", "a"], encode=True, numTrees=3, maxDepth=6)
    few = model.tree_pipeline("rf", minInstancesPerNode=100, **kind).fit(df).stages[-1]
    assert few.totalNumNodes < model.tree_pipeline("rf", **kind).fit(df).stages[-1].totalNumNodes
    assert all(t.depth <= 6 and t.numNodes <= 2 * 1700 // 100 for t in few.trees)
    three = df.withColumn("target", F.expr("cast(id % 3 AS int)"))
    assert model.tree_pipeline("rf", **kind).fit(three).stages[-1].numClasses == 3
    nan = df.withColumn("a", F.when(F.col("id") == 7, F.lit(float("nan"))).otherwise(F.col("a")))
    with pytest.raises(Exception, match="NaN"):
        model.tree_pipeline("rf", **kind).fit(nan)


def test_best_split_equals_all_splits_tried():
    rng = np.random.default_rng(3)
    arity = np.array([0, 5, 0])
    drawn = np.array([[1, 0], [2, 1]])
    h = rng.integers(0, 30, (1, 2, 2, 6, 2)).astype(float)
    for node in range(2):
        for k in range(2):
            h[0, k, node, arity[drawn[node, k]] or 6:] = 0
        h[0, 1, node] *= h[0, 0, node].sum(0) / h[0, 1, node].sum(0)          # both features see the same rows

    def gini(s):
        return 1 - ((s / s.sum()) ** 2).sum()

    gain, k, s, place, left, right, *_ = forest.best_splits(h, drawn, arity, 1, 0.0)
    for node in range(2):
        most = 0.0
        for j in range(2):
            bins, named = h[0, j, node], arity[drawn[node, j]]
            order = np.argsort(bins[:named, 1], kind="stable") if named else np.arange(6)   # categories by their weight of class 1
            sets = [order[:c].tolist() for c in range(1, len(order))]
            for go in sets:
                a, b = bins[go].sum(0), bins.sum(0) - bins[go].sum(0)
                if a.sum() and b.sum() > 1e-9:
                    n = bins.sum()
                    most = max(most, gini(bins.sum(0)) - a.sum() / n * gini(a) - b.sum() / n * gini(b))
        assert gain[node] == pytest.approx(most) and most > 0
        goes = place[node] <= s[node]
        assert left[node] == pytest.approx(h[0, k[node], node][goes].sum(0)) and right[node] == pytest.approx(h[0, k[node], node][~goes].sum(0))


def test_categories_are_ordered_as_by_spark(spark):
    """Order by weight and by share of class 1 differ here; both fits must send the same categories left."""
    rows = [(c, int(i < ones)) for c, n, ones in ((1, 1000, 400), (2, 30, 30), (3, 1000, 200)) for i in range(n)] * 3
    df = model.with_raw_label(spark.createDataFrame(rows, "atm int, target int").withColumn("weight", F.expr("if(target = 1, 2.5D, 1D)")))
    ours = model.tree_pipeline("rf", cols=["atm"], encode=True, numTrees=1, maxDepth=1)
    other = Pipeline(stages=[*ours.getStages()[:-1], RandomForestClassifier(
        featuresCol="features", labelCol="target", weightCol="weight", seed=42, numTrees=1, maxDepth=1)])
    texts = [p.fit(df).stages[-1].toDebugString.split("\n", 1)[1] for p in (ours, other)]
    assert texts[0] == texts[1] and "in {1.0,2.0}" in texts[0]


def test_bags_and_bins():
    copies = forest._bag(1.0)
    share = np.bincount(copies) / copies.size
    assert share[:4] == pytest.approx([0.36788, 0.36788, 0.18394, 0.06131], abs=2e-5) and copies.mean() == pytest.approx(1, abs=1e-4)
    assert forest._thresholds(np.arange(4.0), np.ones(4), 32).tolist() == [0.5, 1.5, 2.5]
    cut = forest._thresholds(np.arange(1000.0), np.ones(1000), 32)
    assert cut.size == 31 and abs(np.diff(cut) - 1000 / 32).max() <= 1
    assert forest._thresholds(np.zeros(1), np.ones(1), 32).size == 0


def test_weights_of_classes_do_not_deal_rows_by_class(spark):
    plan = model.with_class_weights(rows(spark), "target")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
