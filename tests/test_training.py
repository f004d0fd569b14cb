"""Encoder inside the pipeline, early stopping, successive halving, permutation importance, lookups by zones."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from georisk.operators import evaluate, importance, lookup, model, scoring, tables, tuning
from georisk.operators.tuning import IntRange, LogUniform, Uniform
from georisk.operators.versions import Store
from georisk.session import scratch_path
from georisk.streaming import requests as stream


def points(spark, n=600, noise=0.25, seed=1):
    """Class 1 where a + b is large, a share of the labels turned; c says nothing."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a, b, c = rng.random(), rng.random(), rng.random()
        rows.append((i, a, b, c, int((a + b > 1.2) != (rng.random() < noise))))
    return spark.createDataFrame(rows, "id long, a double, b double, c double, target int").withColumn("weight", F.lit(1.0))


def recall(df, fitted):
    s = model.score(df, fitted, out="score").withColumnRenamed("target", "label")
    return evaluate.metrics_from_counts(evaluate.confusion_counts(s)).first()["recall"]


def test_a_fitted_scorer_needs_its_encoder(spark):
    grid = spark.createDataFrame([(-22.0, 166.0, 3, 50, 1, 10.0)], "latitude double, longitude double, road_type int, "
                                 "speed_limit int, accident_density_5km long, dist_to_noumea_km double")
    day = spark.createDataFrame([(dt.date(2026, 1, 23),)], "date date")
    labels = spark.createDataFrame([(1,), (10,), (2,)], "atm int")
    fitted = model.formula_pipeline(labels)
    from pyspark.ml import PipelineModel
    bare = PipelineModel(stages=fitted.stages[1:])
    for scorer in (bare, lambda rows: rows.withColumn("probability", F.lit(0.5))):
        with pytest.raises(ValueError, match="encoder"):
            scoring.score_day(grid, day, scorer=scorer)
        with pytest.raises(ValueError, match="encoder"):
            stream.scored_stream(spark.createDataFrame([], scoring.REQUEST_SCHEMA), scorer)
    dictionary = model.label_dictionary(labels, "atm")
    by_code = {}
    for code in (1, 10, 2, 7):
        own = scoring.score_day(grid, day, atm_code=code, scorer=fitted).agg(F.max("probability"), F.max("atm_code")).first()
        table = scoring.score_day(grid, day, atm_code=code, scorer=lambda rows: rows.withColumn(
            "probability", scoring.feat.logistic_score()), encoder=dictionary).agg(F.max("probability")).first()
        assert own[0] == pytest.approx(table[0], abs=1e-12) and own[1] == code
        by_code[code] = own[0]
    assert by_code[1] < by_code[10] < by_code[2] < by_code[7]        # text order, the unknown label last


def test_boosting_stops_on_the_validation_part(spark):
    df = tuning.with_validation(points(spark), hash_cols=["id"])
    assert df.filter("is_validation").count() == 120
    shares = {r["target"]: r["s"] for r in df.groupBy("target").agg(F.avg(F.col("is_validation").cast("int")).alias("s")).collect()}
    assert all(abs(s - 0.2) < 0.01 for s in shares.values())
    kind = dict(cols=["a", "b", "c"], maxIter=40, maxDepth=4, stepSize=0.3)
    early = model.tree_pipeline("gbt", validationIndicatorCol="is_validation", validationTol=1e-3, **kind).fit(df)
    assert early.stages[-1].getNumTrees < 40
    test = points(spark, seed=9, noise=0.05)
    assert recall(test, early) > 0.6


def test_perceptron_stops_when_it_overfits(spark):
    df = tuning.with_validation(points(spark, 300, 0.3), hash_cols=["id"])
    fit, held = df.filter("NOT is_validation"), df.filter("is_validation")
    fitted = model.fit_mlp(fit, cols=["a", "b", "c"], categorical=(), hidden=(32,), max_iter=400, validation=held,
                           step=10, patience=3)
    losses = fitted.losses
    assert 4 <= len(losses) < 40 and min(losses) < losses[-1]
    prepared = fitted
    for s in fitted.stages[:-1]:
        prepared = s
        held = s.transform(held)
    assert model.validation_loss(held, fitted.stages[-1]) == pytest.approx(min(losses), abs=2e-4)   # best weights kept
    assert recall(points(spark, seed=9, noise=0.05), fitted) > 0.75


def test_trials_are_drawn_as_asked():
    space = {"depth": IntRange(2, 6), "rate": LogUniform(1e-3, 1.0), "share": Uniform(0.5, 1.0), "kind": ["x", "y"]}
    got = tuning.draw_trials(space, 50, 3)
    assert len({json.dumps(t, sort_keys=True) for t in got}) == 50 and got == tuning.draw_trials(space, 50, 3)
    assert {t["depth"] for t in got} == {2, 3, 4, 5, 6} and {t["kind"] for t in got} == {"x", "y"}
    assert all(1e-3 <= t["rate"] <= 1 and 0.5 <= t["share"] <= 1 for t in got)
    assert sum(t["rate"] < 0.03 for t in got) > 15              # even in the logarithm
    with pytest.raises(ValueError, match="3"):
        tuning.draw_trials({"depth": [1, 2]}, 3)
    with pytest.raises(ValueError, match="points"):
        model.random_param_maps({"depth": [1, 2]}, 3)
    assert tuning.budgets(10, 100, 3) == [10, 11, 33, 100] and tuning.budgets(5, 5, 3) == [5]


def test_halving_is_no_worse_than_random_search(spark):
    df = points(spark, 400)
    space = {"maxDepth": IntRange(1, 5), "minInstancesPerNode": IntRange(1, 60)}
    build = lambda p: model.tree_pipeline("rf", cols=["a", "b", "c"], **p)
    got = tuning.halving(build, space, df, 6, ("numTrees", 3, 9), hash_cols=["id"])
    log = got.trials.collect()
    assert {r["trial"] for r in log} == set(range(6)) and sum(not r["dropped"] for r in log if r["budget"] == 9) == 1
    assert sorted((r["rung"], r["budget"]) for r in log) == [(0, 3)] * 6 + [(1, 9)] * 2
    flagged = tuning.with_validation(df, hash_cols=["id"])
    held = flagged.filter("is_validation")
    every = [recall(held, build(t | {"numTrees": 9}).fit(flagged.filter("NOT is_validation")))
             for t in tuning.draw_trials(space, 2)]
    final = max(r["recall"] for r in log if r["budget"] == 9)
    assert final >= max(every) - 0.05
    assert got.params["numTrees"] == 9 and got.fitted.stages[-1].getNumTrees == 9


def test_permutation_importance_of_any_model(spark):
    df = points(spark, noise=0.1)
    pipe = model.logistic_pipeline(cols=["a", "b", "c"], max_iter=50, sum_weights=600.0).fit(df)
    net = model.fit_mlp(df, cols=["a", "b", "c"], categorical=(), hidden=(8,), max_iter=60)
    for fitted in (pipe, net):
        for loss in (importance.brier, importance.missed):
            got = {r["feature"]: r["importance"] for r in importance.permutation_importance(
                df, lambda d, m=fitted: model.score(d, m, out="score"), ["a", "b", "c"], "id", loss=loss).collect()}
            assert min(got["a"], got["b"]) > 0.03 and abs(got["c"]) < min(got["a"], got["b"]) / 3
    assert importance.permutation_importance(df.limit(0), lambda d: d.withColumn("score", F.lit(0.5)), ["a"], "id").count() == 0
    seen = []

    def keep(d):
        seen.append(d)
        return d.withColumn("score", F.col("a"))
    importance.permutation_importance(df, keep, ["a"], "id").collect()
    old, new = ({r["id"]: r["a"] for r in d.select("id", "a").collect()} for d in seen)
    assert sorted(old.values()) == sorted(new.values()) and sum(old[i] != new[i] for i in old) == 600


def test_lookup_opens_the_files_of_its_zones(spark):
    path = scratch_path(spark, "t_zones")
    rows = [(dt.date(2026, 1, 1 + d), h, ((d * 24 + h) * 37 + i * 11) % 100 / 100, i) for d in range(6) for h in range(24) for i in range(30)]
    df = spark.createDataFrame(rows, "date date, hour int, probability double, place long").repartition(7)
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        lookup.store_for_lookup(df, path, bloom=("place",), rows_per_file=200)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    whole = lookup.files_for(spark, path)
    since = dt.date(2026, 1, 5)
    few = lookup.files_for(spark, path, since=since, hours=[8], least=0.9)
    assert len(whole) > 20 and 1 <= len(few) <= 4
    found = lookup.lookup(spark, path, since=since, hours=[8], least=0.9)
    names = lambda paths: {p.rsplit("/", 1)[1] for p in paths}
    assert names(found.inputFiles()) == names(few) and not names(few) >= names(whole)
    want = sorted((r for r in rows if r[0] >= since and r[1] == 8 and r[2] >= 0.9), key=str)
    assert sorted((tuple(r) for r in found.collect()), key=str) == want and want
    assert lookup.lookup(spark, path, least=2.0).count() == 0 and lookup.lookup(spark, path).count() == len(rows)
    tables.layout_for_lookup(df, path + "-plain")
    lookup.store_for_lookup(df.limit(5), path)
    assert lookup.lookup(spark, path).count() == 5 and lookup.lookup(spark, path, version=1).count() == len(rows)


def test_model_is_read_anew_for_every_micro_batch(spark):
    from test_streaming_model import requests_df
    req, labels = requests_df(spark), spark.createDataFrame([(1,), (2,), (3,)], "atm int")
    src, sink, ckpt, models = (scratch_path(spark, f"t_reload_{n}") for n in ("in", "out", "ckpt", "models"))
    for k, intercept in ((0, -2.5), (1, 0.0)):
        Store(spark, models).replace(models={"model": model.formula_pipeline(labels, intercept=intercept)})
        req.filter(F.col("request_id") % 2 == k).write.mode("append").parquet(src)
        stream.run_with_model_reload(spark, src, sink, ckpt, models)
    once = sorted(tuple(r) for r in Store(spark, sink).read().select("request_id", "risk_score", "model_version").collect())
    assert len(once) == 60 and {r[2] for r in once} == {"v1", "v2"}
    assert Store(spark, f"{sink}-rejected").read().count() == 1
    stream.score_batch(req.filter("request_id % 2 = 1"), 1, sink, models)        # the epoch runs again
    again = sorted(tuple(r) for r in Store(spark, sink).read().select("request_id", "risk_score", "model_version").collect())
    assert again == once


def test_namespaces_and_catalog_tables(spark):
    names = ["t_bronze_ns", "t_silver_ns"]
    tables.ensure_namespaces(spark, names)
    tables.ensure_namespaces(spark, names)
    try:
        tables.replace_table(spark.range(3), name="t_bronze_ns.rows")
        tables.replace_table(spark.range(4), name="t_bronze_ns.rows")
        assert spark.table("t_bronze_ns.rows").count() == 4
    finally:
        for n in names:
            spark.sql(f"DROP DATABASE IF EXISTS {n} CASCADE")
