"""Lenient CSV scan, raw datetime parse, table replace, pandas scoring, sampling fallbacks, ranking."""

import datetime as dt
import os

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from georisk.functions import parse
from georisk.operators import model, sampling, tables
from georisk.session import scratch_path
from georisk.sources import files


def test_csv_union_by_name_and_lenient(spark):
    base = scratch_path(spark, "t_csv")
    local = base[len("file:"):] if base.startswith("file:") else base
    os.makedirs(local, exist_ok=True)
    with open(os.path.join(local, "a-2020.csv"), "w") as f:
        f.write("Num_Acc,jour,mois,an,hrmn,atm\n1,5,1,2020,14:30:00,2\n2,6,1,2020,bad,\n")
    with open(os.path.join(local, "a-2021.csv"), "w") as f:
        f.write("Num_Acc,jour,mois,an,hrmn,extra\n3,7,2,2021,09:15:00,x\n4,oops,2,2021,09:15:00,y\n")
    paths = files.discover_sources(spark, os.path.join(base, "a-*.csv"))
    assert len(paths) == 2
    u = files.scan_csv_union(spark, paths)
    assert set(u.columns) >= {"Num_Acc", "atm", "extra"} and u.count() == 4
    schema = T.StructType([T.StructField(n, t) for n, t in [
        ("Num_Acc", T.LongType()), ("jour", T.IntegerType()), ("mois", T.IntegerType()), ("an", T.IntegerType()),
        ("hrmn", T.StringType()), ("atm", T.IntegerType())]])
    lenient = files.scan_csv_lenient(spark, paths, schema)
    rows = lenient.select("Num_Acc", "filename").collect()
    assert 4 not in {r.Num_Acc for r in rows}                 # malformed 'oops' day dropped
    assert all(r.filename.endswith(".csv") for r in rows)
    ts = lenient.select("Num_Acc", parse.try_assemble_datetime("jour", "mois", "an", "hrmn").alias("t"),
                        F.coalesce("atm", F.lit(1)).alias("atm")).collect()
    got = {r.Num_Acc: (r.t, r.atm) for r in ts}
    assert got[1] == (dt.datetime(2020, 1, 5, 14, 30), 2)
    assert got[2] == (None, 1)                                 # 'bad' time -> NULL, missing atm -> 1


def test_replace_table_overwrites(spark):
    path = scratch_path(spark, "t_tbl")
    tables.replace_table(spark.range(3), path=path)
    tables.replace_table(spark.range(5), path=path)
    assert tables.read_table(spark, path).count() == 5


def test_score_pandas_matches_formula(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 4.0)], "a double, b double")

    def proba(pdf):
        p = 1 / (1 + np.exp(-(pdf["a"] - pdf["b"]).to_numpy()))
        return np.column_stack([1 - p, p])
    out = model.score_pandas(df, proba, feature_cols=["a", "b"]).collect()
    for r in out:
        assert abs(r.probability - 1 / (1 + np.exp(-(r.a - r.b)))) < 1e-12


def test_negatives_fallbacks(spark):
    ev = spark.createDataFrame(
        [(i, dt.datetime(2024, 1, 1 + i % 20, i % 24), -22.0 - i * 0.001, 166.0, 1 + i % 3) for i in range(30)],
        "num_acc long, datetime timestamp_ntz, latitude double, longitude double, atm int")
    empty = spark.createDataFrame([], "latitude double, longitude double")
    road = spark.createDataFrame([(-22.5, 166.5), (-22.6, 166.6)], "latitude double, longitude double")
    a = sampling.generate_negatives(spark, ev, empty, road, seed=1, ratio=2)
    assert a.count() == 20                                     # no safe point -> all road points, cap 10 each
    assert {(r.latitude, r.longitude) for r in a.collect()} <= {(-22.5, 166.5), (-22.6, 166.6)}
    b = sampling.generate_negatives(spark, ev, empty, None, seed=1, ratio=2)
    assert b.count() == 60 and b.filter("target = 0").count() == 60   # marginal sampling from events
    n_obs = a.join(ev.select("datetime"), "datetime", "left_semi").count()
    assert n_obs >= int(20 * 0.85)                             # observed-time share


def test_standardize_population(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,)], "x double")
    z = [r.x_z for r in model.standardize(df, ["x"]).orderBy("x").collect()]
    s = np.std([1.0, 2.0, 3.0])
    assert all(abs(a - b) < 1e-12 for a, b in zip(z, [(-1) / s, 0.0, 1 / s]))


def test_rank_features(spark):
    rows = [(float(i % 7), float(i % 3), int(i % 7 > 3)) for i in range(300)]
    df = spark.createDataFrame(rows, "a double, b double, target int").withColumn("weight", F.lit(1.0))
    fitted = model.tree_pipeline("rf", cols=["a", "b"], numTrees=5, maxDepth=3).fit(df)
    top = model.rank_features(spark, fitted, ["a", "b"], k=2).collect()
    assert top[0].feature == "a" and abs(sum(r.share_pct for r in top) - 100) < 0.2


def test_geojson_collection_with_list_attributes(spark):
    base = scratch_path(spark, "t_geo")
    local = base[len("file:"):] if base.startswith("file:") else base
    os.makedirs(local, exist_ok=True)
    with open(os.path.join(local, "roads.geojson"), "w") as f:
        f.write('{"type": "FeatureCollection", "features": ['
                '{"type": "Feature", "geometry": {"type": "LineString", "coordinates": [[166.0, -22.0], [166.1, -22.0], [166.1, -22.1]]},'
                ' "properties": {"edge_id": 1, "highway": ["primary", "x"], "maxspeed": "80 km/h"}},'
                '{"type": "Feature", "geometry": {"type": "LineString", "coordinates": [[166.2, -22.0], [166.3, -22.0]]},'
                ' "properties": {"edge_id": 2, "highway": "motorway", "maxspeed": null}}]}')
    seg = files.read_road_edges(spark, os.path.join(base, "roads.geojson"), multiline=True)
    assert seg.count() == 3                                     # 2 segments + 1 segment
    from georisk.operators import spatial
    attrs = {r.edge_id: (r.road_type, r.speed_limit) for r in spatial.road_attributes(seg).collect()}
    assert attrs == {1: (3, 80), 2: (5, 50)}


def test_lenient_event_loader(spark):
    from georisk.plans import jobs
    base = scratch_path(spark, "t_len")
    local = base[len("file:"):] if base.startswith("file:") else base
    os.makedirs(local, exist_ok=True)
    with open(os.path.join(local, "c-2021.csv"), "w") as f:
        f.write("Num_Acc,jour,mois,an,hrmn,lat,long,atm,dep\n"
                "1,5,1,2021,14:30:00,\"-22,1\",\"166,4\",,988\n"      # kept, atm -> 1
                "2,5,1,2021,14:30,\"-22,1\",\"166,4\",2,988\n"        # HH:MM without seconds -> dropped
                "3,6,1,2021,08:00:00,\"-22,1\",\"166,4\",2,75\n"      # other department
                "4,7,1,2021,09:00:00,\"-30,0\",\"166,4\",2,988\n"     # outside the box
                "5,oops,1,2021,09:00:00,\"-22,2\",\"166,5\",3,988\n"  # malformed -> dropped
                "6,4,1,2021,07:15:00,\"-22,2\",\"166,5\",3,988\n")    # kept, earlier
    schema = T.StructType([T.StructField(n, t) for n, t in [
        ("Num_Acc", T.LongType()), ("jour", T.IntegerType()), ("mois", T.IntegerType()), ("an", T.IntegerType()),
        ("hrmn", T.StringType()), ("lat", T.StringType()), ("long", T.StringType()), ("atm", T.IntegerType()),
        ("dep", T.StringType())]])
    rows = jobs.load_events_lenient(spark, [os.path.join(base, "c-2021.csv")], schema).collect()
    assert [(r.hour, r.atm, r.dayofweek, r.year) for r in rows] == [(7, 3, 1, 2021), (14, 1, 2, 2021)]


def test_apply_encoder_unknown_label(spark):
    fit = spark.createDataFrame([(1,), (2,), (3,)], "atm int")
    dic = model.label_dictionary(fit, "atm")
    df = spark.createDataFrame([(1,), (3,), (7,)], "atm int")
    got = {r.atm: r.atm_code for r in model.apply_encoder(df, "atm", dic, "atm_code").collect()}
    assert got == {1: 0, 3: 2, 7: 3}
    text = spark.createDataFrame([("b",), ("z",), (None,), ("a",)], "atm string")
    dic = model.label_dictionary(text.filter("atm <> 'z'"), "atm")
    got = {r.atm: r.atm_code for r in model.apply_encoder(text, "atm", dic, "atm_code").collect()}
    assert got == {"a": 0, "b": 1, "z": 2, None: 2}
