"""Views that bind the operators to the driver's parquet tables.

Each function reads one or two parquet tables and derives the shape the
operators expect (accident points, raw CSV-like records, road edges,
predictions, scored labels).  Only projections: Catalyst prunes the scan to
the referenced columns and pushes filters placed above into the reader.

``VIEW_SQL`` holds the same views as SQL text; oracle queries prepend the
ones they use as CTEs.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F



# every known road class, one unknown and one missing, by p_size % 10
ROAD_CLASSES = ("motorway", "trunk", "primary", "secondary", "tertiary", "residential", "unclassified", "service", "track", None)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _lat(key):
    return F.lit(-23.0) + ((key * 7919) % 3500) / F.lit(1000.0)


def _lon(key):
    return F.lit(163.5) + ((key * 104729) % 4500) / F.lit(1000.0)


def acc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Point events (positives): num_acc, datetime, latitude, longitude, atm, target."""
    e = table(spark, sf_dir, "events")
    k = F.col("event_id")
    return e.select(
        k.alias("num_acc"),
        F.col("ts").cast("timestamp_ntz").alias("datetime"),
        _lat(k).alias("latitude"),
        _lon(k).alias("longitude"),
        (F.lit(1) + k % 9).cast("int").alias("atm"),
        F.lit(1).alias("target"),
    )


def carac_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty accident records: text dates parts, decimal commas, department code."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    d = F.col("o_orderdate")
    return o.select(
        k.alias("Num_Acc"),
        F.dayofmonth(d).alias("jour"),
        F.month(d).alias("mois"),
        F.year(d).alias("an"),
        F.when(k % 3 == 0, "14:30").when(k % 3 == 1, "930").otherwise("1745").alias("hrmn"),
        F.concat(F.lit(" "), F.replace(_lat(k).cast("string"), F.lit("."), F.lit(","))).alias("lat"),
        F.replace(_lon(k).cast("string"), F.lit("."), F.lit(",")).alias("long"),
        (F.lit(1) + k % 9).cast("int").alias("atm"),
        F.when(k % 4 == 0, "988").otherwise("75").alias("dep"),
    )


def usagers_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Child records: one row per person involved."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_orderkey").alias("Num_Acc"), F.col("l_linenumber").alias("num_user"))


def roads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-point road edges with class and speed text."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    size = F.col("p_size")
    return p.select(
        k.alias("edge_id"),
        _lon(k).alias("lon1"),
        _lat(k).alias("lat1"),
        (_lon(k) + ((k % 7) - 3) / F.lit(100.0)).alias("lon2"),
        (_lat(k) + ((k % 5) - 2) / F.lit(100.0)).alias("lat2"),
        F.element_at(F.array(*[F.lit(c) for c in ROAD_CLASSES]), (size % 10 + 1).cast("int")).alias("highway"),
        F.when(size % 4 == 0, "50").when(size % 4 == 1, "80 km/h").when(size % 4 == 2, "walk").alias("maxspeed"),
    )


def preds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction rows: event_id (tie key), date, hour, latitude, longitude, probability."""
    e = table(spark, sf_dir, "events")
    k = F.col("event_id")
    return e.select(
        k.alias("event_id"),
        F.to_date("ts").alias("date"),
        F.hour("ts").alias("hour"),
        _lat(k).alias("latitude"),
        _lon(k).alias("longitude"),
        (((k * 31) % 1000) / F.lit(1000.0)).alias("probability"),
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Truth and score per labelled document."""
    lab = table(spark, sf_dir, "labels")
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return lab.join(docs, "doc_id").select(
        "doc_id", F.col("quality").alias("label"), ((F.col("n_chars") % 1000) / F.lit(1000.0)).alias("score"))


def strata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows to split, stratified by l_returnflag."""
    return table(spark, sf_dir, "lineitem")


# ------------------------------------------------------------------ SQL text
VIEW_SQL = {
    "acc": """SELECT event_id AS num_acc, ts AS datetime,
       -23e0   + ((event_id*7919)   % 3500)/1000e0 AS latitude,
       1635e-1 + ((event_id*104729) % 4500)/1000e0 AS longitude,
       CAST(1 + event_id % 9 AS INT) AS atm, 1 AS target FROM events""",
    "carac_raw": """SELECT o_orderkey AS Num_Acc, day(o_orderdate) AS jour, month(o_orderdate) AS mois, year(o_orderdate) AS an,
       CASE WHEN o_orderkey % 3 = 0 THEN '14:30' WHEN o_orderkey % 3 = 1 THEN '930' ELSE '1745' END AS hrmn,
       concat(' ', replace(CAST(-23e0 + ((o_orderkey*7919) % 3500)/1000e0 AS VARCHAR), '.', ',')) AS lat,
       replace(CAST(1635e-1 + ((o_orderkey*104729) % 4500)/1000e0 AS VARCHAR), '.', ',') AS long,
       CAST(1 + o_orderkey % 9 AS INT) AS atm,
       CASE WHEN o_orderkey % 4 = 0 THEN '988' ELSE '75' END AS dep FROM orders""",
    "usagers_raw": "SELECT l_orderkey AS Num_Acc, l_linenumber AS num_user FROM lineitem",
    "roads": """SELECT p_partkey AS edge_id,
       1635e-1 + ((p_partkey*104729) % 4500)/1000e0 AS lon1, -23e0 + ((p_partkey*7919) % 3500)/1000e0 AS lat1,
       1635e-1 + ((p_partkey*104729) % 4500)/1000e0 + ((p_partkey % 7) - 3)/100e0 AS lon2,
       -23e0 + ((p_partkey*7919) % 3500)/1000e0 + ((p_partkey % 5) - 2)/100e0 AS lat2,
       CASE p_size % 10 WHEN 0 THEN 'motorway' WHEN 1 THEN 'trunk' WHEN 2 THEN 'primary' WHEN 3 THEN 'secondary'
         WHEN 4 THEN 'tertiary' WHEN 5 THEN 'residential' WHEN 6 THEN 'unclassified' WHEN 7 THEN 'service' WHEN 8 THEN 'track'
         ELSE NULL END AS highway,
       CASE p_size % 4 WHEN 0 THEN '50' WHEN 1 THEN '80 km/h' WHEN 2 THEN 'walk' ELSE NULL END AS maxspeed FROM part""",
    "preds": """SELECT event_id, CAST(ts AS DATE) AS date, CAST(hour(ts) AS INT) AS hour,
       -23e0 + ((event_id*7919) % 3500)/1000e0 AS latitude, 1635e-1 + ((event_id*104729) % 4500)/1000e0 AS longitude,
       ((event_id*31) % 1000)/1000e0 AS probability FROM events""",
    "scored": """SELECT l.doc_id, l.quality AS label, (d.n_chars % 1000)/1000e0 AS score
FROM labels l JOIN documents d ON l.doc_id = d.doc_id""",
    "grid": """SELECT CAST(a.i AS BIGINT) AS i, CAST(b.j AS BIGINT) AS j,
       -23e0 + a.i*2e-2 AS latitude, 1635e-1 + b.j*2e-2 AS longitude
FROM range(175) a(i), range(225) b(j)""",
}


def with_views(sql: str, *names: str, extra: dict | None = None) -> str:
    """Prefix ``sql`` with the named views (and extra CTEs, in order)."""
    ctes = [f"{n} AS ({VIEW_SQL[n]})" for n in names]
    ctes += [f"{k} AS ({v})" for k, v in (extra or {}).items()]
    return ("WITH " + ",\n".join(ctes) + "\n" + sql) if ctes else sql
