"""Registered queries of stored objects: versioned tables, saved models, pre-compute store, layouts, road documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import bands
from ..functions.hashing import sql_hash_draw as H
from ..operators import features as feat
from ..operators import importance, lookup, model, spatial
from ..operators.versions import Store
from ..session import scratch_path
from ..sources import bindings as B
from ..sources import files
from ..sources.grid import load_patterns
from ..streaming import requests as stream
from . import jobs
from .catalog import ACC_PARTS_SQL, FEATURE_SQL, acc_features
from .q_ingest import BRONZE_OUT, BRONZE_SQL
from .q_ml import (DAY_CTES, PROB_SQL, REQ_ENCODED_SQL, _flat, _next_day, _pre_grid, _pre_store, _requests,
                   _stored, pre_ctes)
from .q_spatial import CENTROIDS
from .registry import r6, register

SEED = 42
# labels that the fit has not seen: code 4
DIC = {"dic": """SELECT atm, row_number() OVER (ORDER BY CAST(atm AS VARCHAR)) - 1 AS code
                 FROM (SELECT DISTINCT atm FROM acc WHERE atm <> 4)"""}


# ------------------------------------------------------------------ saved models
def _saved_formula(spark, sf_dir):
    """The formula with an encoder that does not know code 4, saved as a pipeline and loaded again."""
    store = Store(spark, scratch_path(spark, "saved_model"))
    store.replace(models={"model": model.formula_pipeline(B.acc(spark, sf_dir).select("atm").filter("atm <> 4"))})
    return store.load_model()


@register("score_saved_model", B.with_views(f"SELECT * FROM ({REQ_ENCODED_SQL})", "acc", extra=DIC))
def q_saved_model(spark, sf_dir):
    """Requests scored by a saved and reloaded pipeline that encodes the raw label itself, one label unknown to it."""
    return _flat(stream.scored_stream(_requests(spark, sf_dir), _saved_formula(spark, sf_dir)))


@register("score_daily_saved_model", B.with_views(
    """SELECT row_number() OVER (ORDER BY hour, latitude, longitude) AS id, date, hour, latitude, longitude,
              round(probability, 6) AS probability, 4 AS atm_code, dayofweek, month FROM dfeat""", "grid", "roads", "acc",
    extra={**pre_ctes(), **DIC, **DAY_CTES, "drows": DAY_CTES["drows"].replace("1 AS atm", "(SELECT count(*) FROM dic) AS atm")}))
def q_daily_saved(spark, sf_dir):
    """The daily job with a saved and reloaded pipeline and a weather code that it doesn't know."""
    stored, _ = jobs.score_daily(_pre_grid(spark, sf_dir), _next_day(spark, sf_dir), scratch_path(spark, "daily_saved"),
                                 atm_code=4, scorer=_saved_formula(spark, sf_dir))
    return stored.select("id", "date", "hour", "latitude", "longitude", r6(F.col("probability")).alias("probability"),
                         "atm_code", "dayofweek", "month")


SECOND_INTERCEPT = -1.5
_RELOAD = REQ_ENCODED_SQL.replace("SELECT d.code FROM dic d", "SELECT d.code FROM all_codes d").replace(
    "SELECT count(*) FROM dic", "SELECT count(*) FROM all_codes")


@register("score_stream_model_reload", B.with_views(
    "SELECT * FROM (" + _RELOAD.replace("FROM acc)", "FROM acc WHERE num_acc % 2 = 0)").replace("'formula-1'", "'v1'")
    + ") UNION ALL SELECT * FROM ("
    + _RELOAD.replace(PROB_SQL, feat.logistic_score_sql(intercept=SECOND_INTERCEPT))
    .replace("FROM acc)", "FROM acc WHERE num_acc % 2 = 1)").replace("'formula-1'", "'v2'") + ")", "acc",
    extra={"all_codes": "SELECT atm, row_number() OVER (ORDER BY CAST(atm AS VARCHAR)) - 1 AS code FROM (SELECT DISTINCT atm FROM acc)"}))
def q_model_reload(spark, sf_dir):
    """A stream over two request files, the model replaced between their micro-batches; the second batch runs twice."""
    requests, acc = _requests(spark, sf_dir), B.acc(spark, sf_dir).select("atm")
    src, sink, ckpt, models = (scratch_path(spark, n) for n in ("reload_in", "reload_out", "reload_ckpt", "reload_models"))
    for k, intercept in ((0, None), (1, SECOND_INTERCEPT)):
        Store(spark, models).replace(models={"model": model.formula_pipeline(acc, intercept=intercept)})
        requests.filter(F.col("request_id") % 2 == k).write.mode("append").parquet(src)
        stream.run_with_model_reload(spark, src, sink, ckpt, models)
    stream.score_batch(requests.filter(F.col("request_id") % 2 == 1), 1, sink, models)   # a replay of the last epoch
    return _flat(Store(spark, sink).read())


# ------------------------------------------------------------------ importance
FEATURES = ("atm", "is_night", "is_weekend", "hour_sin", "month")


def _importance_sql() -> str:
    ranked = f"""SELECT *, CAST(num_acc * 31 % 7 < 3 AS INT) AS y,
        row_number() OVER (ORDER BY {H(SEED, 'permutation', 'num_acc')}, num_acc) - 1 AS i FROM feats"""
    shift = "(1 + CAST(('0x' || substr(md5('{s}|shift|{f}'), 1, 15)) AS BIGINT) % ((SELECT count(*) FROM ranked) - 1))"
    loss = "avg((y - ({p})) * (y - ({p})))".format(p=PROB_SQL)
    parts = [f"""SELECT '{f}' AS feature, {loss} AS permuted FROM (
        SELECT a.* REPLACE (b.{f} AS {f}) FROM ranked a
        JOIN ranked b ON b.i = (a.i + {shift.format(s=SEED, f=f)}) % (SELECT count(*) FROM ranked))""" for f in FEATURES]
    return f"""WITH ranked AS ({ranked}), base AS (SELECT {loss} AS base FROM ranked), p AS ({' UNION ALL '.join(parts)})
        SELECT feature, round(base, 6) AS base_loss, round(permuted, 6) AS permuted_loss,
               round(permuted - base, 6) AS importance FROM p, base"""


@register("permutation_importance", B.with_views(f"SELECT * FROM ({_importance_sql()})", "acc",
                                                 extra={"acc_parts": ACC_PARTS_SQL, "feats": FEATURE_SQL}))
def q_importance(spark, sf_dir):
    """How much the formula's squared error grows when one feature's values are dealt to other rows."""
    rows = acc_features(spark, sf_dir).withColumn("y", (F.col("num_acc") * 31 % 7 < 3).cast("int"))
    found = importance.permutation_importance(rows, lambda d: d.withColumn("score", feat.logistic_score()), FEATURES,
                                              "num_acc", label="y", seed=SEED)
    return found.select("feature", *[r6(F.col(c)).alias(c) for c in ("base_loss", "permuted_loss", "importance")])


# ------------------------------------------------------------------ pre-compute store
@register("precompute_store", B.with_views(
    """SELECT kind, key, round(value, 6) AS value, (SELECT count(*) FROM road_grid) AS n_points,
              (SELECT max(accident_density_5km) FROM density) AS max_density FROM (
         SELECT 'hourly_risk' AS kind, hour AS key, count(*) / max(ny) AS value FROM a, ny GROUP BY hour
         UNION ALL SELECT 'dayofweek_risk', dow, count(*) / max(ny) FROM a, ny GROUP BY dow
         UNION ALL SELECT 'monthly_risk', month, count(*) / max(ny) FROM a, ny GROUP BY month)""", "grid", "roads", "acc",
    extra={**pre_ctes(), "a": """SELECT CAST(hour(datetime) AS INT) AS hour, CAST(isodow(datetime) - 1 AS INT) AS dow,
                                        CAST(month(datetime) AS INT) AS month, year(datetime) AS year FROM acc""",
           "ny": "SELECT count(DISTINCT year) AS ny FROM a"}))
def q_precompute_store(spark, sf_dir):
    """Patterns (a map per kind) and metadata that the pre-compute job has published beside its grid, read back."""
    path = _pre_store(spark, sf_dir)
    meta = Store(spark, path).meta()
    return load_patterns(spark, path).select("kind", F.explode("pattern").alias("key", "value")).select(
        "kind", "key", r6(F.col("value")).alias("value"), F.lit(meta["n_points"]).cast("long").alias("n_points"),
        F.lit(meta["max_density"]).cast("long").alias("max_density"))


@register("hourly_counts_json", B.with_views(
    """SELECT date, '{' || string_agg('"' || CAST(hour AS VARCHAR) || '":' || CAST(n AS VARCHAR), ',' ORDER BY hour) || '}' AS counts
       FROM (SELECT date, hour, count(*) AS n FROM preds GROUP BY date, hour) GROUP BY date""", "preds"))
def q_counts_json(spark, sf_dir):
    """Each date's predictions per hour as a JSON object."""
    n = B.preds(spark, sf_dir).groupBy("date", "hour").agg(F.count(F.lit(1)).alias("n"))
    entries = F.sort_array(F.collect_list(F.struct("hour", "n")))     # at most 24 entries
    return n.groupBy("date").agg(F.to_json(F.map_from_entries(entries)).alias("counts"))


@register("date_names", B.with_views(
    """SELECT num_acc, strftime(datetime, '%Y-%m-%d (%A)') AS label, strftime(datetime, '%A') AS day_name,
              strftime(datetime, '%B') AS month_name FROM acc""", "acc"))
def q_date_names(spark, sf_dir):
    """Date with the name of its day, names of day and month."""
    return B.acc(spark, sf_dir).select("num_acc", bands.date_label("datetime").alias("label"),
                                       bands.day_name("datetime").alias("day_name"), bands.month_name("datetime").alias("month_name"))


# ------------------------------------------------------------------ bronze job
def _bronze_store(spark, sf_dir) -> str:
    """The bronze job over CSV files of two separators; its store, made once per application and input."""
    path = _stored(spark, sf_dir, "bronze_job")
    if not Store(spark, path).versions():
        raw, csvs = B.carac_raw(spark, sf_dir), scratch_path(spark, "bronze_csv")
        for k, (sep, columns) in enumerate(((",", raw.columns), (";", raw.columns[::-1]))):
            raw.filter(F.col("an") % 2 == k).select(*columns).write.option("header", True).option("sep", sep).csv(f"{csvs}/carac/{k}")
        B.usagers_raw(spark, sf_dir).write.option("header", True).csv(f"{csvs}/usagers")
        jobs.bronze(spark, f"{csvs}/carac/*/*.csv", f"{csvs}/usagers/*.csv", out_dir=path)
    return path


@register("bronze_job", B.with_views(BRONZE_OUT, "carac_raw", "usagers_raw", extra={"b0": BRONZE_SQL}))
def q_bronze_job(spark, sf_dir):
    """The table accidents_nc that the bronze job has replaced, read back."""
    return Store(spark, _bronze_store(spark, sf_dir)).read("accidents_nc")


@register("bronze_stage_counts", B.with_views(
    f"""SELECT 'caracteristiques' AS stage, count(*) AS n FROM carac_raw UNION ALL SELECT 'usagers', count(*) FROM usagers_raw
        UNION ALL SELECT 'accidents_nc', count(*) FROM ({BRONZE_OUT})""", "carac_raw", "usagers_raw", extra={"b0": BRONZE_SQL}))
def q_bronze_counts(spark, sf_dir):
    """Rows per stage, as the bronze job has published them with its tables."""
    counts = Store(spark, _bronze_store(spark, sf_dir)).meta()["counts"]
    return spark.createDataFrame(list(counts.items()), "stage string, n long")


# ------------------------------------------------------------------ lookups
@register("prediction_lookup_zones", B.with_views(
    """SELECT event_id, date, hour, probability FROM preds
       WHERE date >= (SELECT max(date) - 100 FROM preds) AND hour IN (8, 17) AND probability >= 0.9e0""", "preds"))
def q_lookup_zones(spark, sf_dir):
    """The lookup of recent high probabilities at two hours, over the files that the zone table names."""
    path, p = scratch_path(spark, "pred_zones"), B.preds(spark, sf_dir)
    lookup.store_for_lookup(p, path, bloom=("event_id",))
    since = p.agg(F.date_sub(F.max("date"), 100)).first()[0]
    return lookup.lookup(spark, path, since=since, hours=(8, 17), least=0.9).select("event_id", "date", "hour", "probability")


# ------------------------------------------------------------------ road documents
_SPEED = "CASE edge_id % 4 WHEN 0 THEN 80 WHEN 1 THEN 60 WHEN 2 THEN 50 ELSE 90 END"


@register("road_edges_collection", B.with_views(
    f"""SELECT edge_id, lon1, lat1, lon2, lat2, road_type, CAST({_SPEED} AS INT) AS speed_limit
        FROM roads JOIN (SELECT edge_id, road_type FROM ({CENTROIDS})) USING (edge_id)""", "roads"))
def q_collection(spark, sf_dir):
    """FeatureCollection documents, each parsed by many tasks; speeds as number, list, text with a fraction and text."""
    r, k = B.roads(spark, sf_dir), F.col("edge_id") % 4
    speed = F.when(k == 0, F.lit("80.0")).when(k == 1, '["60","x"]').when(k == 2, '"70.5"').otherwise('"90 km/h"')
    line = F.to_json(F.array(F.array("lon1", "lat1"), F.array("lon2", "lat2")))
    feature = F.concat(F.lit('{"type": "Feature", "properties": {"edge_id": '), "edge_id", F.lit(', "maxspeed": '), speed,
                       F.lit(', "highway": '), F.coalesce(F.concat(F.lit('"'), "highway", F.lit('"')), F.lit("null")),
                       F.lit('}, "geometry": {"type": "LineString", "coordinates": '), line, F.lit("}},"))
    doc = F.col("edge_id") % 3
    # a document per folder: its head, its features, and a last one without geometry
    ends = r.select(doc.alias("doc")).distinct()
    text = (r.select(doc.alias("doc"), F.lit(1).alias("at"), feature.alias("value"))
            .unionByName(ends.select("doc", F.lit(0).alias("at"), F.lit('{"type": "FeatureCollection", "features": [').alias("value")))
            .unionByName(ends.select("doc", F.lit(2).alias("at"), F.lit('{"type": "Feature", "properties": {}, "geometry": null}]}').alias("value"))))
    out = scratch_path(spark, "road_documents")
    text.repartition("doc").sortWithinPartitions("doc", "at", "value").drop("at").write.partitionBy("doc").text(out)
    parts = [files.read_road_edges(spark, p, multiline=True) for p in
             sorted({f.rsplit("/", 1)[0] for f in files.discover_sources(spark, f"{out}/doc=*/part-*")})]
    seg = parts[0]
    for p in parts[1:]:
        seg = seg.unionByName(p)
    return seg.select("edge_id", "lon1", "lat1", "lon2", "lat2").join(spatial.road_attributes(seg), "edge_id")


@register("road_edges_polylines", B.with_views(
    """SELECT edge_id, 0 AS seg, lon1, lat1, lon2, lat2 FROM e UNION ALL
       SELECT edge_id, 1, lon2, lat2, lon1 + 1e0, lat1 FROM e""", "roads",
    extra={"e": "SELECT min(edge_id) AS edge_id, lon1, lat1, lon2, lat2 FROM roads GROUP BY lon1, lat1, lon2, lat2"}))
def q_polylines(spark, sf_dir):
    """Three-point edges written as one feature each (equal geometries once) and read back with both segments."""
    r = B.roads(spark, sf_dir)
    segs = r.select("*", F.lit(0).alias("seg")).unionByName(r.select(
        "edge_id", "highway", "maxspeed", F.lit(1).alias("seg"), F.col("lon2").alias("lon1"), F.col("lat2").alias("lat1"),
        (F.col("lon1") + 1.0).alias("lon2"), F.col("lat1").alias("lat2")))
    out = scratch_path(spark, "polylines")
    files.write_road_edges(segs, out)
    return files.read_road_edges(spark, out).select("edge_id", F.col("seg").cast("int").alias("seg"), "lon1", "lat1", "lon2", "lat2")
