"""Streaming request scoring equals the batch path; encoders, weights, spark.ml scoring."""

import datetime as dt

from pyspark.sql import functions as F

from georisk.operators import features as feat
from georisk.operators import model, scoring
from georisk.operators.versions import Store
from georisk.session import scratch_path
from georisk.streaming import requests as stream


def requests_df(spark):
    rows = [(i, -22.0 - i * 0.01, 166.0 + i * 0.01, f"2026-01-{10 + i % 10:02d}T{i % 24:02d}:15:00", 1 + i % 9)
            for i in range(60)]
    rows.append((999, -30.0, 166.0, "2026-01-10T10:00:00", 1))       # out of range -> quarantined
    return spark.createDataFrame(rows, scoring.REQUEST_SCHEMA)


def test_stream_equals_batch(spark):
    req = requests_df(spark)
    src = scratch_path(spark, "t_req")
    req.repartition(3).write.parquet(src)
    sink, ckpt = scratch_path(spark, "t_sink"), scratch_path(spark, "t_ckpt")
    stream.run_to_sink(spark, src, sink, ckpt, max_files_per_trigger=1)
    got = sorted(tuple(r) for r in spark.read.parquet(sink).collect())
    want = sorted(tuple(r) for r in stream.scored_stream(req).collect())
    assert got == want and len(got) == 60


def test_request_output_fields(spark):
    r = scoring.score_requests(requests_df(spark).limit(1)).first()
    assert r.risk_level in {"LOW", "MEDIUM", "HIGH", "CRITICAL"}
    assert abs(r.confidence - max(r.risk_score, 1 - r.risk_score)) < 1e-12
    assert r.features_used.hour == 0


def test_score_day_shape(spark):
    grid = spark.createDataFrame([(-22.0 - i * 0.02, 166.0, 3, 50, 1, 10.0) for i in range(5)],
                                 "latitude double, longitude double, road_type int, speed_limit int, "
                                 "accident_density_5km long, dist_to_noumea_km double")
    day = spark.createDataFrame([(dt.date(2026, 1, 23),)], "date date")
    out = scoring.score_day(grid, day, atm_code=2)
    assert out.count() == 5 * 24
    assert out.select("hour").distinct().count() == 24
    assert out.columns == ["date", "hour", "latitude", "longitude", "probability", "atm_code", "dayofweek", "month",
                           "created_at"]
    r = out.agg(F.min("probability"), F.max("probability"), F.max("dayofweek")).first()
    assert 0 <= r[0] <= r[1] <= 1 and r[2] == 4          # Friday, Mon=0 coding


def test_encoders(spark):
    df = spark.createDataFrame([(1,), (10,), (2,), (None,)], "atm int")
    enc = {r.atm: r.atm_code for r in model.encode_label(df, "atm", "atm_code").collect()}
    assert enc == {1: 0, 10: 1, 2: 2, None: 3}                # text order, missing is its own label
    fit = spark.createDataFrame([(1,), (2,), (5,)], "atm int")
    idx = {r.atm: r.atm_idx for r in model.index_with_unknown(df, "atm", fit).collect()}
    assert idx == {1: 0, 2: 1, 10: 3, None: 3}


def test_class_weights(spark):
    df = spark.createDataFrame([(0,)] * 8 + [(1,)] * 2, "target int")
    w = {r.target: r.weight for r in model.class_weight_table(df).collect()}
    assert w == {0: 10 / 16, 1: 10 / 4}
    s = {r.target: r.weight for r in model.class_weight_table(df, mode="scale_pos").collect()}
    assert s == {0: 1.0, 1: 4.0}


def test_logistic_fit_and_folded_coefficients(spark):
    rows = [(float(i % 7), float(i % 5), int((i % 7) > 3)) for i in range(200)]
    df = spark.createDataFrame(rows, "a double, b double, target int").withColumn("weight", F.lit(1.0))
    pipe = model.logistic_pipeline(cols=["a", "b"], max_iter=50, sum_weights=200.0)
    fitted = pipe.fit(df)
    scored = model.score(df, fitted)
    w, b = model.logistic_coefficients(fitted)
    direct = df.withColumn("p2", feat.logistic_score(w, b))
    both = scored.join(direct, ["a", "b", "target", "weight"]).select("probability", "p2").collect()
    assert max(abs(r.probability - r.p2) for r in both) < 1e-9


def test_parse_query_date_and_weather(spark):
    import pytest
    r = scoring.parse_query_date(spark, "2026-01-23", 2).first()
    assert r.date == dt.date(2026, 1, 23) and r.atm_code == 2
    tomorrow = scoring.parse_query_date(spark).first().date
    assert tomorrow == dt.date.today() + dt.timedelta(days=1) or tomorrow > dt.date.today()
    with pytest.raises(ValueError):
        scoring.parse_query_date(spark, "2026-01-23", 4)
    df = spark.createDataFrame([("Normal",), ("Pluie forte",), ("Brouillard",), ("?",)], "w string")
    assert [x[0] for x in df.select(scoring.weather_code("w")).collect()] == [1, 3, 5, 1]


def test_tune_random_search(spark):
    rows = [(float(i % 7), float(i % 5), int((i % 7) > 3)) for i in range(400)]
    df = spark.createDataFrame(rows, "a double, b double, target int").withColumn("weight", F.lit(1.0))
    pipe = model.tree_pipeline("rf", cols=["a", "b"], numTrees=3)
    est = pipe.getStages()[-1]
    tvs = model.tune(pipe, est, {"maxDepth": [2, 3, 4], "numTrees": [3, 5]}, df, n_trials=2, parallelism=2)
    assert len(tvs.validationMetrics) == 2
    assert max(tvs.validationMetrics) > 0.9          # recall of class 1 on the validation split


def test_jobs_train_and_report(spark):
    from georisk.plans import jobs
    from georisk.params import FEATURE_COLUMNS
    rows = []
    for i in range(300):
        vals = [float((i * (j + 3)) % 11) for j in range(len(FEATURE_COLUMNS))]
        rows.append(tuple(vals) + (int(vals[2] > 5), "test" if i % 5 == 0 else "train"))
    schema = ", ".join(f"{c} double" for c in FEATURE_COLUMNS) + ", target int, split string"
    gold = spark.createDataFrame(rows, schema)
    out = scratch_path(spark, "t_train")
    board, fitted = jobs.train(spark, gold, out_dir=out, trees=20, rounds=10, perceptron_iterations=20, tune_trials=2)
    assert board.count() == 4 and set(fitted) == {"LogisticRegression", "RandomForest", "GBT", "MLP"}
    store = Store(spark, out)
    best = store.load_model("best_model")
    assert model.has_encoder(best) and store.meta()["best"] == store.meta()["leaderboard"][0]["model"]
    log = store.read("trials")
    assert log.select("model", "trial").distinct().count() == 6
    assert log.filter("dropped").count() == 3      # of two trials of each model one is dropped
    assert all(1 <= r["rounds"] <= 20 for r in board.collect() if r["model"] in ("RandomForest", "GBT"))
    day = spark.createDataFrame([(dt.date(2026, 1, 23), h, -22.0 - i * 0.01, 166.0, (h * 7 + i) % 10 / 10)
                                 for h in range(24) for i in range(8)],
                                "date date, hour int, latitude double, longitude double, probability double")
    rep = jobs.risk_report(day, "top_n", n=3)
    assert rep["selection"].count() == 72 and rep["top10"].count() == 10
    assert rep["summary"].first().total_points == 72
    assert jobs.risk_report(day, "threshold", threshold=0.8)["selection"].count() == \
        day.filter("probability >= 0.8").count()


def test_mlp_with_oversampling(spark):
    rows = [(float(i % 7), float(i % 3 + 1), int(i % 7 > 4)) for i in range(280)]
    df = spark.createDataFrame(rows, "a double, atm double, target int")
    over = model.oversample(df, "target")
    c = {r.target: r["count"] for r in over.groupBy("target").count().collect()}
    assert c[1] == 80 * 2 and c[0] == 200                 # 200 // 80 = 2 copies of each positive
    fitted = model.fit_mlp(over, cols=["a", "atm"], categorical=("atm",), hidden=(8,), max_iter=50)
    scored = model.score(df, fitted)
    assert scored.filter("probability < 0 OR probability > 1").count() == 0
