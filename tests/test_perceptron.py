"""The perceptron fitted by matrix products: its loss, gradient, optimiser and model against brute force and spark.ml."""

import numpy as np
import pytest
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from georisk.operators import model, perceptron

SIZES = [3, 5, 4, 2]


def prepared(spark, n=900):
    df = spark.range(0, n, 1, 3).selectExpr("pmod(hash(id), 100) / 50D - 1 AS a", "pmod(hash(id, 1), 100) / 50D - 1 AS b",
                                            "pmod(hash(id, 2), 100) / 50D - 1 AS c", "id")
    df = df.withColumn("target", F.expr("cast(a * b + c > 0 AS int)")).withColumn("weight", F.expr("if(target = 1, 2D, 0.5D)"))
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)


def test_gradient_equals_differences():
    rng = np.random.default_rng(1)
    weights = rng.normal(size=sum((a + 1) * b for a, b in zip(SIZES, SIZES[1:])))
    x, y, w = rng.normal(size=(40, 3)), rng.integers(0, 2, 40).astype(np.uint8), rng.random(40)
    _, grad = perceptron.block_loss(weights, SIZES, x, y, w, True)
    for i in range(weights.size):
        d = np.zeros(weights.size)
        d[i] = 1e-6
        up, down = (perceptron.block_loss(weights + s * d, SIZES, x, y, w, False)[0] for s in (1, -1))
        assert (up - down) / 2e-6 == pytest.approx(grad[i], abs=1e-5)


def test_loss_of_the_weights_is_that_of_the_model(spark):
    df = prepared(spark, 768)                              # full blocks of 128 in every part: spark.ml weighs a short one like a full one
    mlp = MultilayerPerceptronClassifier(featuresCol="features", labelCol="target", layers=SIZES, maxIter=30, seed=5)
    theirs = mlp.fit(df)
    blocks = perceptron.stored_blocks(df, 3, "weight")
    assert sum(len(r["y"]) for r in blocks.select("y").collect()) == 768
    loss = perceptron.Loss(blocks, SIZES)
    assert loss(theirs.weights.toArray(), slope=False)[0] == pytest.approx(model.validation_loss(df, theirs), rel=1e-9)
    plain = perceptron.Loss(perceptron.stored_blocks(df, 3), SIZES)
    ours, losses = perceptron.train(mlp, plain.blocks, None, 30, 10, 6, 1e-4)
    assert losses == [] and ours.getMaxIter() == 30
    start = mlp.copy({mlp.maxIter: 0}).fit(df).weights.toArray()
    at = [plain(m, slope=False)[0] for m in (start, theirs.weights.toArray(), ours.weights.toArray())]
    assert at[2] < 0.2 * at[0] and at[2] == pytest.approx(at[1], rel=1e-3)
    few = [m.weights.toArray() for m in (mlp.copy({mlp.maxIter: 8}).fit(df), perceptron.train(mlp, plain.blocks, None, 8, 10, 6, 1e-4)[0])]
    assert few[1] == pytest.approx(few[0], rel=1e-6, abs=1e-8)           # the same steps


def test_sums_do_not_depend_on_the_number_of_tasks(spark, monkeypatch):
    blocks = perceptron.stored_blocks(prepared(spark, 20_000), 3)
    weights = np.linspace(-1, 1, sum((a + 1) * b for a, b in zip(SIZES, SIZES[1:])))
    loss, grad = perceptron.Loss(blocks, SIZES)(weights)
    monkeypatch.setattr(perceptron, "MOST_PARTS", 1)
    again, other = perceptron.Loss(blocks, SIZES)(weights)
    assert again == pytest.approx(loss, rel=1e-12) and np.allclose(other, grad, rtol=1e-9, atol=1e-12)
    assert perceptron.Loss(blocks.filter("false"), SIZES)(weights)[0] == float("inf")


def test_optimiser_finds_the_minimum():
    def rosenbrock(x):
        a, b = x
        return 100 * (b - a * a) ** 2 + (1 - a) ** 2, np.array([-400 * a * (b - a * a) - 2 * (1 - a), 200 * (b - a * a)])

    calls, values = [], []
    x, state = np.array([-1.2, 1.0]), None
    for _ in range(8):                                      # steps, each from the weights of the one before
        x, state = perceptron.minimise(lambda at: calls.append(1) or rosenbrock(at), x, 20, 1e-12, state)
        assert state[0] == rosenbrock(x)[0]
        values.append(state[0])
    assert x == pytest.approx([1, 1], abs=1e-4) and len(calls) < 400
    whole = perceptron.minimise(rosenbrock, np.array([-1.2, 1.0]), 16, 1e-12)[0]
    half, state = perceptron.minimise(rosenbrock, np.array([-1.2, 1.0]), 8, 1e-12)
    assert perceptron.minimise(rosenbrock, half, 8, 1e-12, state)[0].tolist() == whole.tolist()    # steps are no new starts
    assert all(b <= a for a, b in zip(values, values[1:]))
    assert perceptron.minimise(rosenbrock, np.array([1.0, 1.0]), 5)[0].tolist() == [1, 1]


def test_columns_are_packed_without_loss():
    rng = np.random.default_rng(2)
    x = np.column_stack([rng.integers(0, 7, 700), rng.normal(size=700), np.r_[np.zeros(600), np.arange(100)], rng.integers(0, 400, 700) / 7,
                         np.ones(700)]).astype(float)
    data = perceptron.columns_packed(x)
    assert np.array_equal(perceptron.columns_unpacked(data), x) and len(data) < x.nbytes * 0.6
    assert np.array_equal(perceptron.columns_unpacked(perceptron.columns_packed(x[:1])), x[:1])
