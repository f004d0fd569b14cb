"""Registered feature-store, scoring, streaming and training queries."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from ..operators import features as feat
from ..operators import model, profile, scoring
from ..session import scratch_path
from ..operators.versions import Store
from ..sources import bindings as B
from ..streaming import requests as stream
from . import jobs
from .catalog import FEATURE_CORE_SQL
from .q_sampling import NEG_SQL
from .q_spatial import CENTROIDS, DENSITY_SQL, ROAD_ATTR_SQL, ROAD_GRID_CTES, _vincenty_sql
from ..params import true_radius_rad
from .registry import r6, register

PROB_SQL = feat.logistic_score_sql()


def _on(sql: str, src: str) -> str:
    """Point a SQL fragment written against ``acc`` at another event table."""
    return re.sub(r"\bacc\b", src, sql)


def pre_ctes(events: str = "acc") -> dict:
    return {**ROAD_GRID_CTES, "cent": CENTROIDS, "road_attr": ROAD_ATTR_SQL,
            "density": _on(DENSITY_SQL.format(r=repr(true_radius_rad(5.0)) + "e0"), events),
            "vin": _vincenty_sql("road_grid"),
            "pre": """SELECT r.latitude, r.longitude, r.road_type, r.speed_limit, d.accident_density_5km,
                             v.d AS dist_to_noumea_km
                      FROM road_attr r JOIN density d USING (latitude, longitude) JOIN vin v USING (latitude, longitude)"""}


_stores: dict[tuple, str] = {}


def _stored(spark, sf_dir, name: str) -> str:
    """One store per application, input and name: the queries that score share what the first one computed."""
    return _stores.setdefault((spark.sparkContext.applicationId, sf_dir, name), scratch_path(spark, name))


def _pre_store(spark, sf_dir) -> str:
    """The store that the pre-compute job has filled."""
    path = _stored(spark, sf_dir, "enriched_grid")
    if not Store(spark, path).versions():
        jobs.precompute(spark, B.roads(spark, sf_dir), B.acc(spark, sf_dir), out_dir=path)
    return path


def _pre_grid(spark, sf_dir):
    return Store(spark, _pre_store(spark, sf_dir)).read("grid")


def _next_day(spark, sf_dir):
    return B.acc(spark, sf_dir).agg(F.date_add(F.max(F.to_date("datetime")), 1).alias("date"))


DAY_CTES = {
    "day": "SELECT CAST(max(datetime) AS DATE) + 1 AS date FROM acc",
    "drows": """SELECT p.*, h.hour, d.date, CAST(isodow(d.date) - 1 AS INT) AS dayofweek,
                       CAST(month(d.date) AS INT) AS month, CAST(day(d.date) AS INT) AS day, 1 AS atm
                FROM pre p, (SELECT CAST(range AS INT) AS hour FROM range(24)) h, day d""",
    "dfeat": f"SELECT *, {FEATURE_CORE_SQL}, {PROB_SQL} AS probability FROM drows",
}


@register("score_day", B.with_views(
    """SELECT date, hour, latitude, longitude, round(probability, 6) AS probability, atm AS atm_code,
              dayofweek, month FROM dfeat""", "grid", "roads", "acc", extra={**pre_ctes(), **DAY_CTES}))
def q_score_day(spark, sf_dir):
    """Road grid x 24 hours of the day after the last event -> features -> probability (9 columns)."""
    s = scoring.score_day(_pre_grid(spark, sf_dir), _next_day(spark, sf_dir), atm_code=1)
    return s.select("date", "hour", "latitude", "longitude", r6(F.col("probability")).alias("probability"),
                    "atm_code", "dayofweek", "month")


@register("score_day_stats", B.with_views(
    """SELECT date, count(*) AS total_points, round(avg(probability), 6) AS avg_probability,
              round(max(probability), 6) AS max_probability,
              count(*) FILTER (WHERE probability >= 0.5e0) AS high_risk_points FROM dfeat GROUP BY date""",
    "grid", "roads", "acc", extra={**pre_ctes(), **DAY_CTES}))
def q_score_day_stats(spark, sf_dir):
    """Day statistics of the scored grid (count, mean, max, points >= 0.5)."""
    s = scoring.score_day(_pre_grid(spark, sf_dir), _next_day(spark, sf_dir), atm_code=1)
    st = profile.prediction_day_stats(s)
    return st.select("date", "total_points", r6(F.col("avg_probability")).alias("avg_probability"),
                     r6(F.col("max_probability")).alias("max_probability"), "high_risk_points")


BANDS_SQL = """CASE WHEN probability >= 0.8e0 THEN 'red' WHEN probability >= 0.6e0 THEN 'orange' ELSE 'yellow' END AS colour,
  CASE WHEN probability >= 0.8e0 THEN 'ÉLEVÉ' WHEN probability >= 0.6e0 THEN 'MOYEN' ELSE 'FAIBLE' END AS level,
  printf('%02dh00', hour) AS hour_label, printf('%.1f%%', round_even(probability * 100, 1)) AS probability_label,
  printf('%s - %s', printf('%02dh', hour), printf('%.1f%%', round_even(probability * 100, 1))) AS tooltip"""


@register("daily_risk_top5", B.with_views(
    f"""SELECT hour, latitude, longitude, round(probability, 6) AS probability, rank, {BANDS_SQL} FROM (
          SELECT *, row_number() OVER (PARTITION BY hour ORDER BY probability DESC, latitude, longitude) AS rank
          FROM dfeat) WHERE rank <= 5""", "grid", "roads", "acc", extra={**pre_ctes(), **DAY_CTES}))
def q_daily_top5(spark, sf_dir):
    """Top-5 risk points per hour of the scored day with marker bands and labels."""
    s = scoring.score_day(_pre_grid(spark, sf_dir), _next_day(spark, sf_dir), atm_code=1)
    top = profile.top_n_per_group(s, "hour", "probability", 5, ties=["latitude", "longitude"])
    top = scoring.with_marker_bands(top)
    return top.select("hour", "latitude", "longitude", r6(F.col("probability")).alias("probability"),
                      F.col("rank").cast("long").alias("rank"), "colour", "level", "hour_label",
                      "probability_label", "tooltip")


# ---------------------------------------------------------------- requests
def _requests(spark, sf_dir):
    a = B.acc(spark, sf_dir)
    return a.select(F.col("num_acc").alias("request_id"), "latitude", "longitude",
                    F.date_format("datetime", "yyyy-MM-dd'T'HH:mm:ss").alias("datetime"), "atm")


REQ_SQL = f"""WITH r AS (SELECT num_acc AS request_id, latitude, longitude,
                   strftime(datetime, '%Y-%m-%dT%H:%M:%S') AS datetime, atm FROM acc),
t AS (SELECT *, CAST(datetime AS TIMESTAMP) AS ts FROM r),
p AS (SELECT request_id, latitude, longitude, datetime, atm, CAST(hour(ts) AS INT) AS hour,
             CAST(isodow(ts) - 1 AS INT) AS dayofweek, CAST(month(ts) AS INT) AS month, CAST(day(ts) AS INT) AS day
      FROM t WHERE latitude BETWEEN -23e0 AND -19.5e0 AND longitude BETWEEN 163.5e0 AND 168e0 AND atm BETWEEN 1 AND 9),
f AS (SELECT * REPLACE (0 AS is_holiday) FROM (SELECT *, {FEATURE_CORE_SQL}, 2 AS road_type, 50 AS speed_limit,
             0 AS accident_density_5km, 100 AS dist_to_noumea_km FROM p)),
s AS (SELECT *, {PROB_SQL} AS risk_score FROM f)
SELECT request_id, round(risk_score, 6) AS risk_score,
       CASE WHEN risk_score < 0.2e0 THEN 'LOW' WHEN risk_score < 0.5e0 THEN 'MEDIUM' WHEN risk_score < 0.8e0 THEN 'HIGH'
            ELSE 'CRITICAL' END AS risk_level,
       round(greatest(risk_score, 1e0 - risk_score), 6) AS confidence, 'formula-1' AS model_version,
       hour, is_weekend = 1 AS is_weekend FROM s"""


def _flat(s):
    return s.select("request_id", r6(F.col("risk_score")).alias("risk_score"), "risk_level",
                    r6(F.col("confidence")).alias("confidence"), "model_version", "hour", "is_weekend")


@register("score_requests", B.with_views("SELECT * FROM (" + REQ_SQL + ")", "acc"))
def q_score_requests(spark, sf_dir):
    """Request rows -> range validation -> features -> score, level, confidence, features used."""
    return _flat(stream.scored_stream(_requests(spark, sf_dir)))


@register("score_requests_stream", B.with_views("SELECT * FROM (" + REQ_SQL + ")", "acc"))
def q_score_requests_stream(spark, sf_dir):
    """Same scoring as a Structured Streaming job: request files -> availableNow micro-batches -> Parquet sink."""
    src = scratch_path(spark, "requests_in")
    _requests(spark, sf_dir).repartition(4).write.parquet(src)
    sink, ckpt = scratch_path(spark, "requests_out"), scratch_path(spark, "requests_ckpt")
    stream.run_to_sink(spark, src, sink, ckpt)
    return _flat(spark.read.parquet(sink).select(
        "request_id", "risk_score", "risk_level", "confidence", "model_version", "hour", "is_weekend"))


# ------------------------------------------------------------------ silver / gold
SILVER_ROUND = ["lat_hour", "lon_hour", "lat_dayofweek", "lon_dayofweek", "hour_sin", "hour_cos",
                "dayofweek_sin", "dayofweek_cos", "dist_to_noumea_km"]
SILVER_EXACT = ["src_id", "target", "datetime", "latitude", "longitude", "hour", "dayofweek", "month", "atm",
                "road_type", "speed_limit", "accident_density_5km", "is_weekend", "is_rush_morning",
                "is_rush_evening", "is_night", "is_holiday", "school_holidays"]
SILVER_CTES = {
    "pos": """SELECT num_acc AS src_id, datetime, latitude, longitude, atm, CAST(hour(datetime) AS INT) AS hour,
                     CAST(isodow(datetime) - 1 AS INT) AS dayofweek, CAST(month(datetime) AS INT) AS month,
                     CAST(day(datetime) AS INT) AS day, 1 AS target FROM acc
              WHERE latitude BETWEEN -23e0 AND -19.5e0 AND longitude BETWEEN 163.5e0 AND 168e0""",
    "ev": "SELECT src_id AS num_acc, datetime, latitude, longitude, atm FROM pos",
    **pre_ctes("ev"),
    "neg_out": "SELECT * FROM (" + _on(NEG_SQL, "ev") + ")",
    "neg2": """SELECT sample_id AS src_id, datetime, latitude, longitude, atm, hour, dayofweek, month,
                      CAST(day(datetime) AS INT) AS day, target FROM neg_out""",
    "both_rows": "SELECT * FROM pos UNION ALL SELECT * FROM neg2",
    "nearest": """SELECT latitude, longitude, road_type, speed_limit, accident_density_5km, dist_to_noumea_km FROM (
        SELECT b.latitude, b.longitude, p.road_type, p.speed_limit, p.accident_density_5km, p.dist_to_noumea_km,
               row_number() OVER (PARTITION BY b.latitude, b.longitude ORDER BY
                   sqrt(power(b.latitude - p.latitude, 2) + power(b.longitude - p.longitude, 2)),
                   p.latitude, p.longitude) AS rn
        FROM (SELECT DISTINCT latitude, longitude FROM both_rows) b, pre p) WHERE rn = 1""",
    "silver": f"""SELECT *, {FEATURE_CORE_SQL} FROM (SELECT b.*, n.road_type, n.speed_limit, n.accident_density_5km,
                         n.dist_to_noumea_km FROM both_rows b JOIN nearest n USING (latitude, longitude))""",
}


def _silver(spark, sf_dir):
    path = _stored(spark, sf_dir, "silver")
    if not Store(spark, path).versions():
        jobs.silver(spark, B.acc(spark, sf_dir), B.roads(spark, sf_dir), out_dir=path)
    return Store(spark, path).read("full_dataset")


@register("silver_dataset", B.with_views(
    "SELECT " + ", ".join(SILVER_EXACT) + ", " + ", ".join(f"round({c}, 6) AS {c}" for c in SILVER_ROUND) +
    " FROM silver", "grid", "roads", "acc", extra=SILVER_CTES))
def q_silver(spark, sf_dir):
    """Feature store: positives + negatives, 24 features with nearest road-grid enrichment."""
    s = _silver(spark, sf_dir)
    return s.select(*SILVER_EXACT, *[r6(F.col(c)).alias(c) for c in SILVER_ROUND])


@register("gold_split_sizes", B.with_views(
    """SELECT _cls AS target, 'test' AS split, CAST(k AS BIGINT) AS n FROM quota
       UNION ALL SELECT _cls, 'train', CAST(n - k AS BIGINT) FROM quota JOIN cls USING (_cls)""",
    "grid", "roads", "acc", extra={**SILVER_CTES,
                                    "cls": "SELECT target AS _cls, count(*) AS n FROM silver GROUP BY 1",
                                    "q": """SELECT _cls, n, floor(0.2e0 * n) AS base,
                                                   0.2e0 * n - floor(0.2e0 * n) AS frac FROM cls""",
                                    "ex": "SELECT ceil(0.2e0 * sum(n)) - sum(base) AS extra FROM q",
                                    "quota": """SELECT _cls, base + CASE WHEN row_number() OVER (ORDER BY frac DESC, _cls)
                                                <= (SELECT extra FROM ex) THEN 1 ELSE 0 END AS k FROM q"""}))
def q_gold_sizes(spark, sf_dir):
    """Gold: encoded, complete rows split 80/20 stratified by target -> sizes per class and split."""
    g = jobs.gold(_silver(spark, sf_dir))
    return g.groupBy("target", "split").agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------ training
@register("train_leaderboard")
def q_train(spark, sf_dir):
    """Train the four spark.ml classifiers on gold train, evaluate on test, rank by recall (rows-only check)."""
    board, _ = jobs.train(spark, jobs.gold(_silver(spark, sf_dir)))
    return board


# ------------------------------------------------------------------ risk report
TOP5_CTE = {"top5": """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY hour ORDER BY probability DESC,
                         latitude, longitude) AS rank FROM dfeat) WHERE rank <= 5"""}


def _top5(spark, sf_dir):
    s = scoring.score_day(_pre_grid(spark, sf_dir), _next_day(spark, sf_dir), atm_code=1)
    return profile.top_n_per_group(s, "hour", "probability", 5, ties=["latitude", "longitude"])


@register("risk_report_summary", B.with_views(
    """SELECT t.total_points, round(t.mean_p, 6) AS mean_p, round(t.max_p, 6) AS max_p, h.peak_hour FROM
       (SELECT count(*) AS total_points, avg(probability) AS mean_p, max(probability) AS max_p FROM top5) t,
       (SELECT hour AS peak_hour FROM (SELECT hour, count(*) AS n FROM top5 GROUP BY hour)
        ORDER BY n DESC, hour LIMIT 1) h""", "grid", "roads", "acc",
    extra={**pre_ctes(), **DAY_CTES, **TOP5_CTE}))
def q_risk_summary(spark, sf_dir):
    """Risk report (top-N mode): top 5 points per hour of the scored day -> total, mean, max, peak hour."""
    g = profile.global_summary(_top5(spark, sf_dir))
    return g.select("total_points", r6(F.col("mean_p")).alias("mean_p"), r6(F.col("max_p")).alias("max_p"),
                    "peak_hour")


@register("risk_report_hourly", B.with_views(
    """SELECT hour, count(*) AS n_points, round(avg(probability), 6) AS mean_p, round(max(probability), 6) AS max_p,
              round(min(probability), 6) AS min_p FROM top5 GROUP BY hour""", "grid", "roads", "acc",
    extra={**pre_ctes(), **DAY_CTES, **TOP5_CTE}))
def q_risk_hourly(spark, sf_dir):
    """Risk report: per-hour statistics of the selected top-5 points."""
    return profile.hourly_stats(_top5(spark, sf_dir), decimals=6, half_even=False)


def _hist_sql(src: str) -> str:
    return f"""WITH m AS (SELECT min(probability) AS lo, max(probability) AS hi,
                              (max(probability) - min(probability)) / 10 AS w FROM {src}),
c AS (SELECT CAST(CASE WHEN hi = lo THEN 1 ELSE greatest(1, least(10, ceil((probability - lo) / w))) END AS INT) AS bin
      FROM {src}, m)
SELECT CAST(b.bin AS INT) AS bin, (SELECT count(*) FROM c WHERE c.bin = b.bin) AS n
FROM range(1, 11) b(bin) WHERE EXISTS (SELECT 1 FROM {src})"""


HIGH_CTE = {"high": "SELECT * FROM dfeat WHERE probability > 0.1e0 AND probability >= 0.12e0"}


def _report(spark, sf_dir, **how):
    return jobs.risk_report(scoring.score_day(_pre_grid(spark, sf_dir), _next_day(spark, sf_dir), atm_code=1), **how)


@register("risk_report_histogram", B.with_views(
    f"SELECT * FROM ({_hist_sql('top5')})", "grid", "roads", "acc", extra={**pre_ctes(), **DAY_CTES, **TOP5_CTE}))
def q_risk_histogram(spark, sf_dir):
    """Risk report (top-N mode): ten bins of the selected points' probabilities, empty ones included."""
    return _report(spark, sf_dir, mode="top_n", n=5)["histogram"].select("bin", "n")


@register("risk_report_threshold", B.with_views(
    f"""SELECT hour, latitude, longitude, round(probability, 6) AS probability, {BANDS_SQL} FROM high""",
    "grid", "roads", "acc", extra={**pre_ctes(), **DAY_CTES, **HIGH_CTE}))
def q_risk_threshold(spark, sf_dir):
    """Risk report (threshold mode with a minimum display filter): the selected points with bands and labels."""
    sel = _report(spark, sf_dir, mode="threshold", threshold=0.1, min_display=0.12)["selection"]
    return sel.select("hour", "latitude", "longitude", r6(F.col("probability")).alias("probability"), "colour", "level",
                      "hour_label", "probability_label", "tooltip")


@register("risk_report_top10", B.with_views(
    """SELECT hour, latitude, longitude, round(probability, 6) AS probability FROM top5
       ORDER BY top5.probability DESC, hour, latitude, longitude LIMIT 10""",
    "grid", "roads", "acc", extra={**pre_ctes(), **DAY_CTES, **TOP5_CTE}))
def q_risk_top10(spark, sf_dir):
    """Risk report: the ten riskiest of the selected points."""
    top = _report(spark, sf_dir, mode="top_n", n=5)["top10"]
    return top.select("hour", "latitude", "longitude", r6(F.col("probability")).alias("probability"))


@register("score_daily_job", B.with_views(
    """SELECT row_number() OVER (ORDER BY hour, latitude, longitude) AS id, date, hour, latitude, longitude,
              round(probability, 6) AS probability, atm AS atm_code, dayofweek, month FROM dfeat""",
    "grid", "roads", "acc", extra={**pre_ctes(), **DAY_CTES}))
def q_score_daily(spark, sf_dir):
    """The daily job: a first run with another weather code, then the run whose rows replace that date; read back."""
    out = scratch_path(spark, "daily_predictions")
    grid, day = _pre_grid(spark, sf_dir), _next_day(spark, sf_dir)
    jobs.score_daily(grid, day, out, atm_code=3)
    stored, _ = jobs.score_daily(grid, day, out, atm_code=1)
    return stored.select("id", "date", "hour", "latitude", "longitude", r6(F.col("probability")).alias("probability"),
                         "atm_code", "dayofweek", "month")


# ------------------------------------------------------------------ encoder and rejects
@register("apply_encoder", B.with_views(
    """SELECT a.num_acc, a.atm, CAST(coalesce(d.code, (SELECT count(*) FROM dic)) AS INT) AS atm_code
       FROM acc a LEFT JOIN dic d ON d.atm = a.atm""", "acc",
    extra={"dic": """SELECT atm, row_number() OVER (ORDER BY CAST(atm AS VARCHAR)) - 1 AS code
                     FROM (SELECT DISTINCT atm FROM acc WHERE atm <> 4)"""}))
def q_apply_encoder(spark, sf_dir):
    """A dictionary fitted without one of the labels, applied to all rows: the unknown label has its own code."""
    a = B.acc(spark, sf_dir).select("num_acc", "atm")
    dic = model.label_dictionary(a.filter("atm <> 4"), "atm")
    return model.apply_encoder(a, "atm", dic, "atm_code")


REQ_ENCODED_SQL = REQ_SQL.replace("AS is_holiday) FROM", "AS is_holiday, CAST(coalesce((SELECT d.code FROM dic d WHERE d.atm = "
                                  "q.atm), (SELECT count(*) FROM dic)) AS INT) AS atm) FROM").replace("FROM p)),", "FROM p) q),")


@register("score_requests_encoded", B.with_views(
    f"SELECT * FROM ({REQ_ENCODED_SQL})", "acc",
    extra={"dic": """SELECT atm, row_number() OVER (ORDER BY CAST(atm AS VARCHAR)) - 1 AS code
                     FROM (SELECT DISTINCT atm FROM acc WHERE atm <> 4)"""}))
def q_score_encoded(spark, sf_dir):
    """Requests scored by logistic coefficients on the encoded weather code, one label unknown to the encoder."""
    dic = model.label_dictionary(B.acc(spark, sf_dir).select("atm").filter("atm <> 4"), "atm")
    return _flat(stream.scored_stream(_requests(spark, sf_dir), encoder=dic))


def _dirty_requests(spark, sf_dir):
    """Every 7th request has an unreadable time, every 5th a latitude outside the box, every 3rd weather code 0."""
    r, k = _requests(spark, sf_dir), F.col("request_id")
    return r.withColumns({"datetime": F.when(k % 7 == 0, "junk").otherwise(F.col("datetime")),
                          "latitude": F.when(k % 5 == 0, F.lit(10.0)).otherwise(F.col("latitude")),
                          "atm": F.when(k % 3 == 0, F.lit(0)).otherwise(F.col("atm"))})


REJECT_SQL = """SELECT num_acc AS request_id, concat_ws(',',
    CASE WHEN num_acc % 5 = 0 OR NOT latitude BETWEEN -23e0 AND -19.5e0 THEN 'latitude' END,
    CASE WHEN NOT longitude BETWEEN 163.5e0 AND 168e0 THEN 'longitude' END,
    CASE WHEN num_acc % 7 = 0 THEN 'datetime' END,
    CASE WHEN num_acc % 3 = 0 OR NOT atm BETWEEN 1 AND 9 THEN 'atm' END) AS reasons FROM acc"""


@register("score_requests_rejects", B.with_views(f"SELECT * FROM ({REJECT_SQL}) WHERE reasons <> ''", "acc"))
def q_rejects(spark, sf_dir):
    """Requests with unreadable times, places outside the box and bad codes through the stream: the rejects table."""
    src, sink = scratch_path(spark, "dirty_in"), scratch_path(spark, "dirty_out")
    _dirty_requests(spark, sf_dir).repartition(4).write.parquet(src)
    stream.run_to_sink(spark, src, sink, scratch_path(spark, "dirty_ckpt"))
    return spark.read.parquet(f"{sink}-rejected").select("request_id", "reasons")
