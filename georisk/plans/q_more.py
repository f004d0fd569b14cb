"""Registered queries of operators that no job query shows on its own."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import bands, parse
from ..functions.hashing import sql_hash_draw as H
from ..operators import evaluate, features as feat, ingest, model, profile, sampling, tables
from ..operators.versions import Store
from ..session import scratch_path
from ..sources import bindings as B
from ..sources import files
from . import jobs
from .catalog import ACC_PARTS_SQL, FEATURE_SQL, acc_features
from .q_spatial import ROAD_GRID_CTES
from .registry import r6, register

SEED = 42

# ------------------------------------------------------------------ sources
LENIENT_SCHEMA = T.StructType([
    T.StructField("Num_Acc", T.LongType()), T.StructField("jour", T.IntegerType()), T.StructField("mois", T.IntegerType()),
    T.StructField("an", T.IntegerType()), T.StructField("hrmn", T.StringType()), T.StructField("lat", T.StringType()),
    T.StructField("long", T.StringType()), T.StructField("atm", T.IntegerType()), T.StructField("dep", T.StringType())])
# every 7th day is no number, every 11th code is missing, every 3rd time has no seconds; files of every 3rd year lack the codes
DIRTY_SQL = """SELECT Num_Acc, CASE WHEN Num_Acc % 7 = 0 THEN 'oops' ELSE CAST(jour AS VARCHAR) END AS jour, mois, an,
  CASE WHEN Num_Acc % 3 = 0 THEN '14:30' ELSE '09:15:00' END AS hrmn, lat, long,
  CASE WHEN Num_Acc % 11 = 0 OR an % 3 = 2 THEN NULL ELSE atm END AS atm, dep FROM carac_raw"""


def _dirty_csv(spark, sf_dir) -> list[str]:
    k = F.col("Num_Acc")
    raw = B.carac_raw(spark, sf_dir).withColumns({
        "jour": F.when(k % 7 == 0, "oops").otherwise(F.col("jour").cast("string")),
        "hrmn": F.when(k % 3 == 0, "14:30").otherwise("09:15:00"),
        "atm": F.when(k % 11 != 0, F.col("atm"))})
    out, names = scratch_path(spark, "dirty_csv"), LENIENT_SCHEMA.fieldNames()
    forms = ((",", names), (";", names[::-1]), (",", [n for n in names[::-1] if n != "atm"]))
    for form, (sep, columns) in enumerate(forms):
        raw.filter(F.col("an") % 3 == form).select(*columns).write.option("header", True).option("sep", sep).csv(f"{out}/{form}")
    return [f"{out}/{form}" for form in range(len(forms))]


@register("scan_csv_lenient", B.with_views(
    """SELECT Num_Acc, CAST(jour AS INT) AS jour, atm, dep FROM dirty WHERE jour <> 'oops'""", "carac_raw",
    extra={"dirty": DIRTY_SQL}))
def q_lenient(spark, sf_dir):
    """Files of three forms (order, separator, a column missing): rows that don't fit are dropped, missing fields stay NULL."""
    out = files.scan_csv_lenient(spark, _dirty_csv(spark, sf_dir), LENIENT_SCHEMA)
    return out.select("Num_Acc", "jour", "atm", "dep")


@register("load_events_lenient", B.with_views(
    """SELECT CAST(replace(trim(lat), ',', '.') AS DOUBLE) AS latitude, CAST(replace(trim(long), ',', '.') AS DOUBLE) AS longitude,
              9 AS hour, CAST(isodow(make_date(an, mois, CAST(jour AS INT))) % 7 AS INT) AS dayofweek, CAST(mois AS INT) AS month,
              CAST(an AS INT) AS year, coalesce(atm, 1) AS atm
       FROM dirty WHERE jour <> 'oops' AND Num_Acc % 3 <> 0 AND dep = '988'
         AND CAST(replace(trim(lat), ',', '.') AS DOUBLE) BETWEEN -23e0 AND -19e0
         AND CAST(replace(trim(long), ',', '.') AS DOUBLE) BETWEEN 163e0 AND 169e0""", "carac_raw", extra={"dirty": DIRTY_SQL}))
def q_load_events(spark, sf_dir):
    """The pre-compute stage's loader: department and wide box, times without seconds dropped, missing code 1."""
    out = jobs.load_events_lenient(spark, _dirty_csv(spark, sf_dir), LENIENT_SCHEMA)
    return out.select("latitude", "longitude", "hour", "dayofweek", "month", "year", "atm")


@register("try_assemble_datetime", B.with_views(
    """SELECT Num_Acc, CASE WHEN Num_Acc % 3 <> 0 AND jour <> 'oops'
              THEN make_timestamp(an, mois, CAST(jour AS INT), 9, 15, 0) END AS datetime FROM dirty""", "carac_raw",
    extra={"dirty": DIRTY_SQL}).replace("CAST(jour AS INT), 9", "CAST(CASE WHEN jour <> 'oops' THEN jour END AS INT), 9"))
def q_try_datetime(spark, sf_dir):
    """Raw time appended to the date; NULL where it doesn't parse as HH:MM:SS or the day is no number."""
    k = F.col("Num_Acc")
    raw = B.carac_raw(spark, sf_dir).withColumns({
        "jour": F.when(k % 7 == 0, "oops").otherwise(F.col("jour").cast("string")),
        "hrmn": F.when(k % 3 == 0, "14:30").otherwise("09:15:00")})
    return raw.select("Num_Acc", parse.try_assemble_datetime("jour", "mois", "an", "hrmn").alias("datetime"))


@register("first_of_list", """SELECT p_partkey, CAST(CASE p_size % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 1 END AS INT) AS road_type
FROM part""")
def q_first_of_list(spark, sf_dir):
    """List-valued road class: first element decides, an empty list is class 1."""
    p = B.table(spark, sf_dir, "part")
    k = F.col("p_size") % 3
    lists = p.select("p_partkey", F.when(k == 0, F.array(F.lit("primary"), F.lit("motorway")))
                     .when(k == 1, F.array().cast("array<string>")).otherwise(F.array(F.lit("track"))).alias("highway"))
    return lists.select("p_partkey", parse.road_type_code(parse.first_of_list("highway")).alias("road_type"))


@register("road_edges_plain_geojson", B.with_views(
    """SELECT count(*) AS n_edges, sum(t) AS sum_type, sum(s) AS sum_speed FROM (
         SELECT DISTINCT lon1, lat1, lon2, lat2, 2 AS t, 50 AS s FROM roads)""", "roads"))
def q_plain_geojson(spark, sf_dir):
    """Road file without edge_id, class and speed, half of it MultiLineString: keys from the geometry, class 2, 50 km/h."""
    r = B.roads(spark, sf_dir)
    line = F.array(F.array("lon1", "lat1"), F.array("lon2", "lat2"))
    out = scratch_path(spark, "plain_geojson")
    text = F.when(F.col("edge_id") % 2 == 0, F.concat(
        F.lit('{"type":"Feature","properties":{},"geometry":{"type":"MultiLineString","coordinates":['), F.to_json(line), F.lit("]}}"))
    ).otherwise(F.concat(F.lit('{"type":"Feature","properties":{},"geometry":{"type":"LineString","coordinates":'),
                         F.to_json(line), F.lit("}}")))
    distinct = r.groupBy("lon1", "lat1", "lon2", "lat2").agg(F.min("edge_id").alias("edge_id"))
    distinct.select(text.alias("value")).write.text(out)
    from ..operators import spatial
    attrs = spatial.road_attributes(files.read_road_edges(spark, out))
    return attrs.agg(F.count(F.lit(1)).alias("n_edges"), F.sum("road_type").alias("sum_type"), F.sum("speed_limit").alias("sum_speed"))


# ------------------------------------------------------------------ tables
@register("replace_table", """SELECT 'orders' AS source, o_orderpriority AS kind, count(*) AS n FROM orders GROUP BY 2
    UNION ALL SELECT 'lineitem', l_returnflag, count(*) FROM lineitem GROUP BY 2""")
def q_replace_table(spark, sf_dir):
    """A stored table replaced by another one while a reader still holds the first; both looked at through views."""
    out = scratch_path(spark, "replaced")
    tables.replace_table(B.table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderpriority").alias("kind")), path=out)
    before = tables.read_table(spark, out)
    tables.replace_table(B.table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_returnflag").alias("kind")), path=out)
    count = "SELECT '{0}' AS source, kind, count(*) AS n FROM {0}_kinds GROUP BY kind"
    with tables.with_view(before, "orders_kinds") as s, tables.with_view(tables.read_table(spark, out), "lineitem_kinds"):
        return s.sql(count.format("orders")).unionByName(s.sql(count.format("lineitem")))


@register("preview", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 20")
def q_preview(spark, sf_dir):
    """The first 20 rows by key."""
    return tables.preview(B.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), 20, "o_orderkey")


@register("gold_tables", B.with_views("""SELECT count(*) AS n, sum(CASE WHEN atm BETWEEN 1 AND 9 THEN 1 ELSE 0 END) AS n_coded,
    24 AS n_features, CAST((SELECT count(DISTINCT atm) FROM acc) AS BIGINT) AS n_labels FROM acc
    WHERE latitude BETWEEN -23e0 AND -19.5e0 AND longitude BETWEEN 163.5e0 AND 168e0""", "acc"))
def q_gold_tables(spark, sf_dir):
    """Gold over the events alone: train, test, feature_metadata and encoder written, then read back."""
    out = scratch_path(spark, "gold_tables")
    a = ingest.filter_bbox(B.acc(spark, sf_dir))
    rows = feat.build_features(feat.add_time_parts(a, "datetime", "mon0"), "pipeline").withColumn("src_id", F.col("num_acc"))
    jobs.gold(rows, out_dir=out)
    store = Store(spark, out)
    both = store.read("train").unionByName(store.read("test"))
    known = jobs.load_encoder(spark, out).count()
    meta = store.read("feature_metadata").count()
    return both.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("atm").between(0, 8)).alias("n_coded")) \
        .select("n", "n_coded", F.lit(meta).cast("int").alias("n_features"), F.lit(known).cast("long").alias("n_labels"))


@register("feature_metadata", B.with_views(" UNION ALL ".join(
    f"SELECT '{c}' AS feature_name, {i} AS order_index, count(*) - count({c}) AS n_null, "
    f"round(CAST(min({c}) AS DOUBLE), 6) AS least, round(CAST(max({c}) AS DOUBLE), 6) AS most FROM feats"
    for i, c in enumerate(feat.FEATURE_COLUMNS)), "acc", extra={"acc_parts": ACC_PARTS_SQL, "feats": FEATURE_SQL}))
def q_feature_metadata(spark, sf_dir):
    """Name and order of the 24 features, with null count, minimum and maximum of each over all events."""
    rows = acc_features(spark, sf_dir)
    feat.require_columns(rows)
    return feat.feature_profile(rows).select("feature_name", "order_index", "n_null", *[r6(F.col(c)).alias(c) for c in ("least", "most")])


# ------------------------------------------------------------------ features
@register("features_daily_profile", B.with_views(
    "SELECT num_acc, is_rush_morning, is_rush_evening, is_night, is_weekend FROM feats", "acc",
    extra={"acc_parts": ACC_PARTS_SQL, "feats": "SELECT num_acc, CAST(hour BETWEEN 7 AND 9 AS INT) AS is_rush_morning, "
           "CAST(hour BETWEEN 17 AND 19 AS INT) AS is_rush_evening, CAST(hour >= 22 OR hour <= 6 AS INT) AS is_night, "
           "CAST(dayofweek >= 5 AS INT) AS is_weekend FROM acc_parts"}))
def q_daily_profile(spark, sf_dir):
    """Calendar flags with the hours of the daily job."""
    a = feat.add_time_parts(ingest.filter_bbox(B.acc(spark, sf_dir)), "datetime", "mon0")
    return feat.build_features(a, "daily").select("num_acc", "is_rush_morning", "is_rush_evening", "is_night", "is_weekend")


@register("default_value", "SELECT event_id, coalesce(CASE WHEN event_id % 4 > 0 THEN CAST(event_id % 9 AS INT) END, 1) AS atm FROM events")
def q_default_value(spark, sf_dir):
    """Missing weather code -> 1."""
    k = F.col("event_id")
    e = B.table(spark, sf_dir, "events").select("event_id", F.when(k % 4 > 0, (k % 9).cast("int")).alias("atm"))
    return e.select("event_id", ingest.default_value("atm", 1).alias("atm"))


@register("filter_not_null", "SELECT event_id FROM events WHERE event_id % 4 > 0 AND event_id % 5 > 0")
def q_not_null(spark, sf_dir):
    """Rows with both values present."""
    k = F.col("event_id")
    e = B.table(spark, sf_dir, "events").select("event_id", F.when(k % 4 > 0, k).alias("a"), F.when(k % 5 > 0, k).alias("b"))
    return ingest.filter_not_null(e, ["a", "b"]).select("event_id")


@register("position_label", B.with_views(
    """SELECT num_acc, printf('%.4f, %.4f', round_even(latitude, 4), round_even(longitude, 4)) AS place FROM acc""", "acc"))
def q_position(spark, sf_dir):
    """'latitude, longitude' with four decimals."""
    return B.acc(spark, sf_dir).select("num_acc", bands.position_label("latitude", "longitude").alias("place"))


# ------------------------------------------------------------------ model preparation
@register("index_with_unknown", B.with_views(
    """SELECT a.num_acc, CAST(coalesce(d.code, (SELECT count(*) FROM dic)) AS INT) AS atm_idx FROM acc a
       LEFT JOIN dic d ON d.atm = a.atm""", "acc",
    extra={"dic": "SELECT atm, row_number() OVER (ORDER BY atm) - 1 AS code FROM (SELECT DISTINCT atm FROM acc WHERE atm <> 4)"}))
def q_index_unknown(spark, sf_dir):
    """Sorted values -> 0..k-1, a value that the fit has not seen -> k."""
    a = B.acc(spark, sf_dir).select("num_acc", "atm")
    return model.index_with_unknown(a, "atm", a.filter("atm <> 4")).select("num_acc", "atm_idx")


@register("standardize", """SELECT l_orderkey, l_linenumber, l_partkey,
    round((l_quantity - avg(l_quantity) OVER ()) / stddev_pop(l_quantity) OVER (), 6) AS l_quantity_z FROM lineitem""")
def q_standardize(spark, sf_dir):
    """z-score of a column over the whole table."""
    li = B.strata(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").cast("double").alias("l_quantity"))
    return model.standardize(li, ["l_quantity"]).select("l_orderkey", "l_linenumber", "l_partkey", r6(F.col("l_quantity_z")).alias("l_quantity_z"))


@register("class_weights_scale_pos", B.with_views(
    """SELECT s.doc_id, s.label, round(CASE WHEN label = 1 THEN (SELECT count(*) FROM scored WHERE label = 0)
              / CAST((SELECT count(*) FROM scored WHERE label = 1) AS DOUBLE) ELSE 1e0 END, 6) AS weight FROM scored s""", "scored"))
def q_scale_pos(spark, sf_dir):
    """Weight of positives n_neg / n_pos, of negatives 1."""
    w = model.with_class_weights(B.scored(spark, sf_dir), "label", "scale_pos")
    return w.select("doc_id", "label", r6(F.col("weight")).alias("weight"))


METRIC_SQL = """SELECT label AS g, m.name AS model, count(*) FILTER (WHERE label = 1 AND score >= m.cut) AS tp,
  count(*) FILTER (WHERE label = 0 AND score >= m.cut) AS fp, count(*) FILTER (WHERE label = 1 AND score < m.cut) AS fn
  FROM scored, (VALUES ('low', 0.3e0), ('mid', 0.5e0), ('high', 0.8e0)) m(name, cut) GROUP BY 1, 2"""


@register("leaderboard", B.with_views(
    """SELECT model, printf('%.3f', round_even(recall, 3)) AS "Recall", printf('%.3f', round_even(prec, 3)) AS "Precision",
              printf('%.3f', round_even(2 * prec * recall / (prec + recall), 3)) AS "F1-Score",
              row_number() OVER (ORDER BY recall DESC, model) AS rank FROM (
         SELECT model, sum(tp) / CAST(sum(tp) + sum(fn) AS DOUBLE) AS recall, sum(tp) / CAST(sum(tp) + sum(fp) AS DOUBLE) AS prec
         FROM m GROUP BY model)""", "scored", extra={"m": METRIC_SQL}))
def q_leaderboard(spark, sf_dir):
    """Three thresholds of one score as three models: metrics, half-even formatting, rank by recall."""
    from functools import reduce

    from pyspark.sql import DataFrame, Window
    s = B.scored(spark, sf_dir)
    parts = [evaluate.binary_metrics(s, "label", "score", cut).withColumn("model", F.lit(name))
             for name, cut in (("low", 0.3), ("mid", 0.5), ("high", 0.8))]
    board = evaluate.leaderboard(reduce(DataFrame.unionByName, parts))
    w = Window.orderBy(F.desc("recall_raw"), F.asc("model"))     # one row per model
    return board.select("model", "Recall", "Precision", "F1-Score", F.row_number().over(w).cast("long").alias("rank"))


# ------------------------------------------------------------------ sampling
@register("marginal_sampling", B.with_views(
    f"""SELECT d.sample_id, t.datetime, la.latitude, lo.longitude, a.atm FROM (SELECT unnest(range((SELECT count(*) FROM acc) * 2)) AS sample_id) d
        JOIN eidx t ON t.idx = {H(SEED, 'marginal_datetime', 'd.sample_id')} % (SELECT count(*) FROM acc)
        JOIN eidx la ON la.idx = {H(SEED, 'marginal_latitude', 'd.sample_id')} % (SELECT count(*) FROM acc)
        JOIN eidx lo ON lo.idx = {H(SEED, 'marginal_longitude', 'd.sample_id')} % (SELECT count(*) FROM acc)
        JOIN eidx a ON a.idx = {H(SEED, 'atm', 'd.sample_id')} % (SELECT count(*) FROM acc)""", "acc",
    extra={"eidx": "SELECT *, row_number() OVER (ORDER BY datetime, num_acc) - 1 AS idx FROM acc"}))
def q_marginal(spark, sf_dir):
    """No road point at all: time, latitude, longitude and code are each drawn from the events on their own."""
    a = B.acc(spark, sf_dir)
    none = a.select("latitude", "longitude").filter(F.lit(False))
    return sampling.generate_negatives(spark, a, none, None, seed=SEED, ratio=2).select(
        "sample_id", "datetime", "latitude", "longitude", "atm")


@register("fallback_full_grid", B.with_views(
    f"""SELECT d.sample_id, p.latitude, p.longitude FROM
          (SELECT unnest(range((SELECT least((SELECT count(*) FROM acc) * 22000, count(*) * 10) FROM road_grid))) AS sample_id) d
        JOIN pidx p ON p.idx = {H(SEED, 'point', 'd.sample_id')} % (SELECT count(*) FROM road_grid)""", "grid", "roads", "acc",
    extra={**ROAD_GRID_CTES, "pidx": "SELECT latitude, longitude, row_number() OVER (ORDER BY latitude, longitude) - 1 AS idx FROM road_grid"}))
def q_fallback(spark, sf_dir):
    """No safe point: locations are drawn from the whole road grid."""
    road = jobs.road_grid(spark, B.roads(spark, sf_dir), meters=200.0, dedupe=True).select("latitude", "longitude")
    return sampling.generate_negatives(spark, B.acc(spark, sf_dir), road.filter(F.lit(False)), road, seed=SEED).select(
        "sample_id", "latitude", "longitude")


@register("wide_index_draw", f"""SELECT event_id, {H(SEED, 'wide', 'event_id')} % 17592186044416 AS idx FROM events""")
def q_wide_draw(spark, sf_dir):
    """Draws over a nominal source of 2^44 rows: beyond any 32-bit index."""
    from ..functions.hashing import index_draw
    return B.table(spark, sf_dir, "events").select("event_id", index_draw(SEED, "wide", F.lit(1 << 44), "event_id").alias("idx"))


@register("hourly_stats_rounded", B.with_views(
    """SELECT hour, count(*) AS n_points, round_even(avg(probability), 3) AS mean_p, round_even(max(probability), 3) AS max_p,
              round_even(min(probability), 3) AS min_p FROM preds GROUP BY hour""", "preds"))
def q_hourly_rounded(spark, sf_dir):
    """Per-hour statistics in the report's default form: three decimals, half to even."""
    return profile.hourly_stats(B.preds(spark, sf_dir))
