"""Registered ingest / cleaning / table-maintenance queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import parse
from ..operators import ingest, profile, spatial, tables
from ..session import scratch_path
from ..sources import bindings as B
from ..sources import files
from . import jobs
from .q_spatial import CENTROIDS
from .registry import r6, register


def _dt_sql(mode: str) -> str:
    if mode == "correct":
        hh = "lpad(replace(trim(CAST(hrmn AS VARCHAR)), ':', ''), 4, '0')"
        text = (f"concat(lpad(CAST(jour AS VARCHAR), 2, '0'), '/', lpad(CAST(mois AS VARCHAR), 2, '0'), '/', "
                f"CAST(an AS VARCHAR), ' ', substr({hh}, 1, 2), ':', substr({hh}, 3, 2), ':00')")
    else:
        hh = "lpad(CAST(hrmn AS VARCHAR), 4, '0')"
        text = (f"regexp_replace(concat(lpad(CAST(jour AS VARCHAR), 2, '0'), '/', lpad(CAST(mois AS VARCHAR), 2, '0'), "
                f"'/', CAST(an AS VARCHAR), ' ', substr({hh}, 1, 2), ':', substr({hh}, 3, 2), ':00'), '::', ':')")
    return f"try_strptime({text}, '%d/%m/%Y %H:%M:%S')"


BRONZE_SQL = f"""SELECT c.Num_Acc AS num_acc, {_dt_sql('correct').replace('jour', 'c.jour').replace('mois', 'c.mois')
                                             .replace('CAST(an ', 'CAST(c.an ').replace('hrmn', 'c.hrmn')} AS datetime,
       CAST(replace(trim(c.lat), ',', '.') AS DOUBLE) AS latitude,
       CAST(replace(trim(c.long), ',', '.') AS DOUBLE) AS longitude, CAST(c.atm AS INT) AS atm
FROM carac_raw c LEFT JOIN usagers_raw u ON c.Num_Acc = u.Num_Acc WHERE c.dep = '988'"""

BRONZE_OUT = """SELECT num_acc, datetime, latitude, longitude, atm, CAST(hour(datetime) AS INT) AS hour,
       CAST(dayofweek(datetime) AS INT) AS dayofweek, CAST(month(datetime) AS INT) AS month, 1 AS target
FROM b0 WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND datetime IS NOT NULL"""


def bronze(spark, sf_dir):
    return ingest.parse_accidents(B.carac_raw(spark, sf_dir), B.usagers_raw(spark, sf_dir), mode="correct")


@register("bronze_accidents", B.with_views(BRONZE_OUT, "carac_raw", "usagers_raw", extra={"b0": BRONZE_SQL}))
def q_bronze(spark, sf_dir):
    """dep filter -> fan-out by persons (left join) -> datetime / decimal-comma parsing -> not-null filter."""
    return bronze(spark, sf_dir)


@register("datetime_parsing", B.with_views(
    f"""SELECT Num_Acc, hrmn, {_dt_sql('correct')} AS dt_correct, {_dt_sql('compat')} AS dt_compat,
               CAST(dayofweek({_dt_sql('correct')}) AS INT) AS dow_sun0,
               CAST(isodow({_dt_sql('correct')}) AS INT) AS dow_iso,
               CAST(isodow({_dt_sql('correct')}) - 1 AS INT) AS dow_mon0,
               CAST(replace(trim(lat), ',', '.') AS DOUBLE) AS latitude
        FROM carac_raw""", "carac_raw"))
def q_datetime_parsing(spark, sf_dir):
    """Both hrmn modes (correct / compat) and the three day-of-week codings on every raw record."""
    c = B.carac_raw(spark, sf_dir)
    correct = parse.assemble_datetime("jour", "mois", "an", "hrmn", "correct")
    return c.select(
        "Num_Acc", "hrmn", correct.alias("dt_correct"),
        parse.assemble_datetime("jour", "mois", "an", "hrmn", "compat").alias("dt_compat"),
        parse.day_of_week(correct, "sun0").alias("dow_sun0"), parse.day_of_week(correct, "iso").alias("dow_iso"),
        parse.day_of_week(correct, "mon0").alias("dow_mon0"),
        parse.parse_decimal_comma("lat").alias("latitude"))


@register("stage_stats", B.with_views(
    """SELECT (SELECT count(*) FROM carac_raw) AS caracteristiques, (SELECT count(*) FROM usagers_raw) AS usagers,
              (SELECT count(*) FROM (""" + BRONZE_OUT + """)) AS accidents_nc""", "carac_raw", "usagers_raw",
    extra={"b0": BRONZE_SQL}))
def q_stage_stats(spark, sf_dir):
    """Row counts of the ingest stage (sources and cleaned table)."""
    return profile.stage_stats(caracteristiques=B.carac_raw(spark, sf_dir), usagers=B.usagers_raw(spark, sf_dir),
                               accidents_nc=bronze(spark, sf_dir))


@register("null_profile", B.with_views(
    """SELECT count(*) AS n_rows, count(*) FILTER (WHERE num_acc IS NULL) AS null_num_acc,
              count(*) FILTER (WHERE latitude IS NULL) AS null_latitude,
              count(*) FILTER (WHERE longitude IS NULL) AS null_longitude,
              count(*) FILTER (WHERE atm IS NULL) AS null_atm,
              min(datetime) AS min_time, max(datetime) AS max_time FROM (""" + BRONZE_OUT + ")",
    "carac_raw", "usagers_raw", extra={"b0": BRONZE_SQL}))
def q_null_profile(spark, sf_dir):
    return profile.null_profile(bronze(spark, sf_dir), ["num_acc", "latitude", "longitude", "atm"], ts="datetime")


@register("table_constraints", B.with_views(
    """SELECT 'unique' AS rule, CAST(num_acc AS VARCHAR) AS key, count(*) AS n FROM (""" + BRONZE_OUT +
    """) GROUP BY num_acc HAVING count(*) > 1""", "carac_raw", "usagers_raw", extra={"b0": BRONZE_SQL}))
def q_constraints(spark, sf_dir):
    """NOT NULL on coordinates/time and UNIQUE(num_acc) on the cleaned table -> violations."""
    v = ingest.check_table_constraints(bronze(spark, sf_dir), not_null=["latitude", "longitude", "datetime"],
                                       unique=["num_acc"])
    return v.withColumnRenamed("constraint", "rule")


@register("validate_quarantine", B.with_views(
    """SELECT Num_Acc, concat_ws(',',
         CASE WHEN NOT coalesce(lat_d BETWEEN -23e0 AND -19.5e0, false) THEN 'latitude' END,
         CASE WHEN NOT coalesce(lon_d BETWEEN 163.5e0 AND 168e0, false) THEN 'longitude' END,
         CASE WHEN NOT coalesce(atm BETWEEN 1 AND 9, false) THEN 'atm' END,
         CASE WHEN NOT coalesce(atm IN (1, 2, 3, 5), false) THEN 'atm_code' END) AS reasons,
       concat_ws(',',
         CASE WHEN NOT coalesce(lat_d BETWEEN -23e0 AND -19.5e0, false) THEN 'latitude' END,
         CASE WHEN NOT coalesce(lon_d BETWEEN 163.5e0 AND 168e0, false) THEN 'longitude' END,
         CASE WHEN NOT coalesce(atm BETWEEN 1 AND 9, false) THEN 'atm' END,
         CASE WHEN NOT coalesce(atm IN (1, 2, 3, 5), false) THEN 'atm_code' END) = '' AS valid
FROM (SELECT Num_Acc, atm, CAST(replace(trim(lat), ',', '.') AS DOUBLE) AS lat_d,
             CAST(replace(trim(long), ',', '.') AS DOUBLE) AS lon_d FROM carac_raw)""", "carac_raw"))
def q_validate(spark, sf_dir):
    """Range rules (request bounds + allowed weather codes) -> valid flag and failed-rule list."""
    c = B.carac_raw(spark, sf_dir).select(
        "Num_Acc", "atm", parse.parse_decimal_comma("lat").alias("latitude"),
        parse.parse_decimal_comma("long").alias("longitude"))
    rules = {**ingest.request_rules(time=None), "atm_code": F.col("atm").isin(1, 2, 3, 5)}
    return ingest.validate_ranges(c, rules).select("Num_Acc", "reasons", "valid")


@register("dedupe_points", B.with_views(
    """SELECT num_acc, latitude, longitude, atm FROM (
         SELECT *, row_number() OVER (PARTITION BY latitude, longitude ORDER BY num_acc) AS rn FROM acc) WHERE rn = 1""",
    "acc"))
def q_dedupe(spark, sf_dir):
    """Keep the first event (smallest id) per coordinate."""
    a = B.acc(spark, sf_dir).select("num_acc", "latitude", "longitude", "atm")
    return ingest.dedupe_first(a, ["latitude", "longitude"], "num_acc")


@register("union_distinct", B.with_views(
    """SELECT latitude, longitude, atm FROM acc UNION SELECT latitude, longitude, atm FROM (""" + BRONZE_OUT + ")",
    "acc", "carac_raw", "usagers_raw", extra={"b0": BRONZE_SQL}))
def q_union_distinct(spark, sf_dir):
    """Legacy UNION (duplicates collapse) of two point sources."""
    a = B.acc(spark, sf_dir)
    b = bronze(spark, sf_dir)
    return ingest.union_distinct(a, b, cols=["latitude", "longitude", "atm"])


@register("bronze_from_csv", B.with_views(BRONZE_OUT.replace("FROM b0", "FROM b1"), "carac_raw",
                                          extra={"b1": BRONZE_SQL.replace(
                                              " LEFT JOIN usagers_raw u ON c.Num_Acc = u.Num_Acc", "")}))
def q_bronze_csv(spark, sf_dir):
    """Raw records written as CSV files per year and form of ``hrmn``, half of the years with ``;`` and another
    column order, discovered by glob, read as text and unioned by name, then cleaned (no fan-out)."""
    out = scratch_path(spark, "carac_csv")
    raw = B.carac_raw(spark, sf_dir).withColumns({"year_part": F.col("an"), "form": F.col("Num_Acc") % 3})
    for k, (sep, columns) in enumerate(((",", raw.columns), (";", raw.columns[::-1]))):
        raw.filter(F.col("an") % 2 == k).select(*columns).repartition("year_part", "form") \
            .write.partitionBy("year_part", "form").option("header", True).option("sep", sep).csv(f"{out}/{k}")
    paths = files.discover_sources(spark, f"{out}/*/year_part=*/form=*/*.csv")
    return ingest.parse_accidents(files.scan_csv_union(spark, paths, schema=jobs.ACCIDENT_SCHEMA), None, mode="correct")


@register("road_edges_geojson", B.with_views(
    """SELECT edge_id, lon1, lat1, lon2, lat2, road_type, speed_limit FROM roads JOIN (""" +
    CENTROIDS +
    """) USING (edge_id)""", "roads"))
def q_road_edges(spark, sf_dir):
    """Road edges written as GeoJSON features (one per line), read back to segments + attributes."""
    out = scratch_path(spark, "roads_geojson")
    files.write_road_edges(B.roads(spark, sf_dir), out)
    seg = files.read_road_edges(spark, out)
    attrs = spatial.road_attributes(seg)
    return seg.select("edge_id", "lon1", "lat1", "lon2", "lat2").join(attrs, "edge_id")


@register("replace_partition", B.with_views(
    """SELECT event_id, date, hour, CASE WHEN date = (SELECT min(date) FROM preds)
                                       THEN round(1e0 - probability, 6) ELSE round(probability, 6) END AS probability
       FROM preds""", "preds"))
def q_replace_partition(spark, sf_dir):
    """Write predictions partitioned by date, then replace the first date only, in one published step."""
    out = scratch_path(spark, "predictions")
    p = B.preds(spark, sf_dir).select("event_id", "hour", "probability", "date")
    tables.replace_partition(p, out)
    first = p.agg(F.min("date").alias("date"))
    redo = p.join(first, "date").withColumn("probability", F.lit(1.0) - F.col("probability"))
    tables.replace_partition(redo.select("event_id", "hour", "probability", "date"), out)
    back = tables.read_table(spark, out)
    return back.select("event_id", "date", "hour", r6(F.col("probability")).alias("probability"))


@register("assign_row_ids", B.with_views(
    """SELECT event_id, date, hour, row_number() OVER (PARTITION BY date ORDER BY hour, latitude, longitude, event_id)
       AS id FROM preds""", "preds"))
def q_row_ids(spark, sf_dir):
    """Stable per-date ids ordered by (hour, latitude, longitude, event_id)."""
    p = B.preds(spark, sf_dir)
    out = tables.assign_row_ids(p, "date", ["hour", "latitude", "longitude", "event_id"])
    return out.select("event_id", "date", "hour", "id")


@register("prediction_constraints", B.with_views(
    """SELECT 'unique' AS rule, concat_ws('|', CAST(date AS VARCHAR), CAST(hour AS VARCHAR)) AS key, count(*) AS n
       FROM preds GROUP BY date, hour HAVING count(*) > 1""", "preds"))
def q_pred_constraints(spark, sf_dir):
    """UNIQUE(date, hour), which events break, and NOT NULL checks on the prediction table."""
    v = ingest.check_table_constraints(B.preds(spark, sf_dir), not_null=["probability", "date"],
                                       unique=["date", "hour"])
    return v.withColumnRenamed("constraint", "rule")


@register("prediction_lookup", B.with_views(
    """SELECT event_id, date, hour, probability FROM preds
       WHERE date >= (SELECT max(date) - 100 FROM preds) AND hour = 8 AND probability >= 0.9e0""", "preds"))
def q_lookup(spark, sf_dir):
    """Predictions laid out for lookups (date partitions, hour ranges, probability-sorted files), then a
    (hour, probability) lookup that prunes by partition and Parquet min/max statistics."""
    out = scratch_path(spark, "pred_layout")
    tables.layout_for_lookup(B.preds(spark, sf_dir), out)
    back = spark.read.parquet(out)
    since = back.agg(F.date_sub(F.max("date"), 100)).first()[0]      # a literal date prunes folders
    return back.filter((F.col("date") >= F.lit(since)) & (F.col("hour") == 8) & (F.col("probability") >= 0.9)) \
        .select("event_id", "date", "hour", "probability")
