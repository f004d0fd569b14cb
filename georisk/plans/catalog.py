"""Registered queries: each is (spark, sf_dir) -> DataFrame, with an optional
SQL oracle that computes the same result from the raw tables.

Queries read whole tables; every output column is aliased identically in the
Spark plan and the SQL text.  Doubles produced by long arithmetic chains
(averages, trigonometry) are rounded to 6 decimals on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import features as feat
from ..operators import ingest, profile
from ..params import HOLIDAYS
from ..sources import bindings as B
from .registry import ORACLES, QUERIES, r6, register



def all_queries():
    """Import every query module (they register on import) and return the registry."""
    from . import q_eval, q_ingest, q_ml, q_more, q_sampling, q_spatial, q_stores  # noqa: F401
    return QUERIES


def all_oracles():
    all_queries()
    return ORACLES


# ============================================================ features / flagship
HOLIDAY_NUMBERS = ", ".join(str(100 * m + d) for m, d in HOLIDAYS)
FEATURE_CORE_SQL = f"""latitude * hour / 24 AS lat_hour, longitude * hour / 24 AS lon_hour,
  latitude * dayofweek / 7 AS lat_dayofweek, longitude * dayofweek / 7 AS lon_dayofweek,
  CAST(dayofweek >= 5 AS INT) AS is_weekend,
  CAST(hour BETWEEN 6 AND 8 AS INT) AS is_rush_morning,
  CAST(hour BETWEEN 16 AND 18 AS INT) AS is_rush_evening,
  CAST(hour >= 19 OR hour <= 5 AS INT) AS is_night,
  sin(2*pi()*hour/24) AS hour_sin, cos(2*pi()*hour/24) AS hour_cos,
  sin(2*pi()*dayofweek/7) AS dayofweek_sin, cos(2*pi()*dayofweek/7) AS dayofweek_cos,
  CAST(month*100 + day IN ({HOLIDAY_NUMBERS}) AS INT) AS is_holiday,
  CAST(month IN (1, 7, 8, 12) AS INT) AS school_holidays"""
DEFAULTS_SQL = "2 AS road_type, 50 AS speed_limit, 0 AS accident_density_5km, 100 AS dist_to_noumea_km"
FEATURE_SQL = f"SELECT *, {FEATURE_CORE_SQL},\n  {DEFAULTS_SQL}\nFROM acc_parts"

ACC_PARTS_SQL = """SELECT num_acc, datetime, latitude, longitude, atm,
  CAST(hour(datetime) AS INT) AS hour, CAST(isodow(datetime) - 1 AS INT) AS dayofweek,
  CAST(month(datetime) AS INT) AS month, CAST(day(datetime) AS INT) AS day
FROM acc WHERE latitude BETWEEN -23e0 AND -19.5e0 AND longitude BETWEEN 163.5e0 AND 168e0"""


def acc_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = ingest.filter_bbox(B.acc(spark, sf_dir))
    a = feat.add_time_parts(a, "datetime", "mon0")
    return feat.build_features(a, "pipeline")


FEATURE_OUT = ["num_acc", "hour", "dayofweek", "month", "atm", "is_weekend", "is_rush_morning",
               "is_rush_evening", "is_night", "is_holiday", "school_holidays"]
FEATURE_ROUNDED = ["lat_hour", "lon_hour", "lat_dayofweek", "lon_dayofweek",
                   "hour_sin", "hour_cos", "dayofweek_sin", "dayofweek_cos"]


@register("features_acc", B.with_views(
    "SELECT " + ", ".join(FEATURE_OUT) + ", " + ", ".join(f"round({c}, 6) AS {c}" for c in FEATURE_ROUNDED)
    + " FROM feats", "acc", extra={"acc_parts": ACC_PARTS_SQL, "feats": FEATURE_SQL}))
def q_features_acc(spark, sf_dir):
    f = acc_features(spark, sf_dir)
    return f.select(*FEATURE_OUT, *[r6(F.col(c)).alias(c) for c in FEATURE_ROUNDED])


@register("flagship_top_risk_per_hour", B.with_views(
    f"""SELECT hour, num_acc, latitude, longitude, round(p, 6) AS probability, rank FROM (
      SELECT hour, num_acc, latitude, longitude, p,
             row_number() OVER (PARTITION BY hour ORDER BY p DESC, num_acc) AS rank
      FROM (SELECT *, {feat.logistic_score_sql()} AS p FROM feats)) WHERE rank <= 5""",
    "acc", extra={"acc_parts": ACC_PARTS_SQL, "feats": FEATURE_SQL}))
def q_flagship(spark, sf_dir):
    """acc -> bbox -> 24 features -> logistic score -> 5 riskiest events per hour."""
    f = acc_features(spark, sf_dir).withColumn("p", feat.logistic_score())
    top = profile.top_n_per_group(f, "hour", "p", 5, ties=["num_acc"])
    return top.select("hour", "num_acc", "latitude", "longitude", r6(F.col("p")).alias("probability"),
                      F.col("rank").cast("long").alias("rank"))


# ============================================================== prediction reports
@register("hourly_stats", B.with_views(
    """SELECT hour, count(*) AS n_points, round(avg(probability), 6) AS mean_p,
              round(max(probability), 6) AS max_p, round(min(probability), 6) AS min_p
       FROM preds GROUP BY hour""", "preds"))
def q_hourly_stats(spark, sf_dir):
    return profile.hourly_stats(B.preds(spark, sf_dir), decimals=6, half_even=False)


@register("prediction_day_stats", B.with_views(
    """SELECT date, count(*) AS total_points, round(avg(probability), 6) AS avg_probability,
              max(probability) AS max_probability,
              count(CASE WHEN probability >= 0.5e0 THEN 1 END) AS high_risk_points
       FROM preds GROUP BY date""", "preds"))
def q_day_stats(spark, sf_dir):
    s = profile.prediction_day_stats(B.preds(spark, sf_dir))
    return s.withColumn("avg_probability", r6(F.col("avg_probability")))


@register("global_summary", B.with_views(
    """SELECT t.total_points, round(t.mean_p, 6) AS mean_p, t.max_p, h.peak_hour FROM
       (SELECT count(*) AS total_points, avg(probability) AS mean_p, max(probability) AS max_p FROM preds) t,
       (SELECT hour AS peak_hour FROM (SELECT hour, count(*) AS n FROM preds GROUP BY hour)
        ORDER BY n DESC, hour LIMIT 1) h""", "preds"))
def q_global_summary(spark, sf_dir):
    return profile.global_summary(B.preds(spark, sf_dir)).withColumn("mean_p", r6(F.col("mean_p")))


HIST_SQL = """WITH m AS (SELECT min(probability) AS lo, max(probability) AS hi,
                              (max(probability) - min(probability)) / 10 AS w FROM preds),
c AS (SELECT CAST(CASE WHEN hi = lo THEN 1 ELSE greatest(1, least(10, ceil((probability - lo) / w))) END AS INT) AS bin
      FROM preds, m)
SELECT CAST(b.bin AS INT) AS bin, round(lo + (b.bin - 1) * w, 6) AS bin_lo, round(lo + b.bin * w, 6) AS bin_hi,
       (SELECT count(*) FROM c WHERE c.bin = b.bin) AS n FROM range(1, 11) b(bin), m"""


@register("histogram", B.with_views(f"SELECT * FROM ({HIST_SQL})", "preds"))
def q_histogram(spark, sf_dir):
    h = profile.histogram(B.preds(spark, sf_dir), "probability", 10)
    return h.select("bin", r6(F.col("bin_lo")).alias("bin_lo"), r6(F.col("bin_hi")).alias("bin_hi"), "n")


@register("top_n_per_hour", B.with_views(
    """SELECT hour, event_id, latitude, longitude, probability, rank FROM (
       SELECT *, row_number() OVER (PARTITION BY hour ORDER BY probability DESC, event_id) AS rank FROM preds)
       WHERE rank <= 5""", "preds"))
def q_top_n_per_hour(spark, sf_dir):
    t = profile.top_n_per_group(B.preds(spark, sf_dir), "hour", "probability", 5, ties=["event_id"])
    return t.select("hour", "event_id", "latitude", "longitude", "probability", F.col("rank").cast("long"))


@register("top_k", B.with_views(
    """SELECT hour, latitude, longitude, probability, event_id FROM preds
       ORDER BY probability DESC, event_id LIMIT 10""", "preds"))
def q_top_k(spark, sf_dir):
    return profile.top_k(B.preds(spark, sf_dir), "probability", 10, ties=["event_id"],
                         cols=["hour", "latitude", "longitude", "probability", "event_id"])


@register("top_groups", B.with_views(
    """SELECT hour, count(*) AS n FROM preds GROUP BY hour ORDER BY n DESC, hour LIMIT 5""", "preds"))
def q_top_groups(spark, sf_dir):
    return profile.top_groups(B.preds(spark, sf_dir), "hour", 5)


@register("threshold_filter", B.with_views(
    """SELECT event_id, hour, probability FROM preds WHERE probability >= 0.7e0 AND probability >= 0.8e0""",
    "preds"))
def q_threshold(spark, sf_dir):
    return profile.filter_threshold(B.preds(spark, sf_dir), 0.7, 0.8).select("event_id", "hour", "probability")


@register("mean_centre", B.with_views(
    "SELECT round(avg(latitude), 6) AS centre_lat, round(avg(longitude), 6) AS centre_lon FROM preds", "preds"))
def q_mean_centre(spark, sf_dir):
    m = profile.mean_centre(B.preds(spark, sf_dir))
    return m.select(r6(F.col("centre_lat")).alias("centre_lat"), r6(F.col("centre_lon")).alias("centre_lon"))


@register("distribution_stats", B.with_views(
    """SELECT s.min_v, s.max_v, round(s.mean_v, 6) AS mean_v, round(s.median_v, 6) AS median_v,
              round(s.p90_v, 6) AS p90_v, (SELECT count(*) FROM preds WHERE probability >= s.p90_v) AS n_ge_p90
       FROM (SELECT min(probability) AS min_v, max(probability) AS max_v, avg(probability) AS mean_v,
                    quantile_cont(probability, 0.5) AS median_v, quantile_cont(probability, 0.9) AS p90_v
             FROM preds) s""", "preds"))
def q_distribution(spark, sf_dir):
    d = profile.distribution_stats(B.preds(spark, sf_dir), "probability")
    return d.select("min_v", "max_v", *[r6(F.col(c)).alias(c) for c in ("mean_v", "median_v", "p90_v")], "n_ge_p90")


# ============================================================ temporal patterns
PATTERN_SQL = """WITH a AS (SELECT CAST(hour(datetime) AS INT) AS hour, CAST(dayofweek(datetime) AS INT) AS dayofweek,
                      CAST(month(datetime) AS INT) AS month, CAST(year(datetime) AS INT) AS year FROM acc),
  ny AS (SELECT count(DISTINCT year) AS ny FROM a)
SELECT 'hourly_risk' AS kind, hour AS key, round(count(*) / max(ny), 6) AS value FROM a, ny GROUP BY hour
UNION ALL SELECT 'dayofweek_risk', dayofweek, round(count(*) / max(ny), 6) FROM a, ny GROUP BY dayofweek
UNION ALL SELECT 'monthly_risk', month, round(count(*) / max(ny), 6) FROM a, ny GROUP BY month"""


def acc_time_parts(spark, sf_dir):
    a = B.acc(spark, sf_dir)
    return a.select(F.hour("datetime").alias("hour"), (F.dayofweek("datetime") - 1).alias("dayofweek"),
                    F.month("datetime").alias("month"), F.year("datetime").alias("year"))


@register("temporal_patterns", B.with_views("SELECT * FROM (" + PATTERN_SQL + ")", "acc"))
def q_patterns(spark, sf_dir):
    p = profile.temporal_patterns(acc_time_parts(spark, sf_dir))
    return p.withColumn("value", r6(F.col("value")))


@register("temporal_pattern_peaks", B.with_views(
    """SELECT kind, key AS peak_key, round(value, 6) AS peak_value FROM (
         SELECT *, row_number() OVER (PARTITION BY kind ORDER BY value DESC, key) AS rn FROM (""" +
    PATTERN_SQL.replace("round(count(*) / max(ny), 6)", "count(*) / max(ny)") + """)) WHERE rn = 1""", "acc"))
def q_pattern_peaks(spark, sf_dir):
    p = profile.pattern_peaks(profile.temporal_patterns(acc_time_parts(spark, sf_dir)))
    return p.withColumn("peak_value", r6(F.col("peak_value")))


@register("count_by_year", B.with_views(
    "SELECT CAST(year(datetime) AS INT) AS year, count(*) AS n FROM acc GROUP BY 1", "acc"))
def q_count_by_year(spark, sf_dir):
    return profile.count_by_year(B.acc(spark, sf_dir))


@register("distinct_values", B.with_views(
    """SELECT count(DISTINCT hour(datetime)) AS n_hour, count(DISTINCT year(datetime)) AS n_year,
              count(DISTINCT atm) AS n_atm FROM acc""", "acc"))
def q_distinct(spark, sf_dir):
    a = B.acc(spark, sf_dir).select(F.hour("datetime").alias("hour"), F.year("datetime").alias("year"), "atm")
    return profile.distinct_counts(a, ["hour", "year", "atm"])


# ============================================================== class balance
@register("class_balance", """SELECT l_returnflag, count(*) AS n,
       round(count(*) / sum(count(*)) OVER (), 6) AS share,
       round(count(*) / min(count(*)) OVER (), 6) AS ratio_to_min
FROM lineitem GROUP BY l_returnflag""")
def q_class_balance(spark, sf_dir):
    c = profile.class_balance(B.strata(spark, sf_dir), "l_returnflag")
    return c.select("l_returnflag", "n", r6(F.col("share")).alias("share"), r6(F.col("ratio_to_min")).alias("ratio_to_min"))
