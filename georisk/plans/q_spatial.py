"""Registered spatial queries; oracles are brute-force SQL over all pairs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.geo import vincenty_stages
from ..operators import spatial
from ..params import CITY_CENTRE, true_radius_rad
from ..sources import bindings as B
from . import jobs
from .registry import r6, register

# ----------------------------------------------------------------- SQL pieces
MERC_POINTS = """SELECT latitude, longitude, 6378137e0 * radians(longitude) AS x,
       6378137e0 * ln(tan(pi()/4 + radians(latitude)/2)) AS y FROM grid"""
MERC_ROADS = """SELECT edge_id, 6378137e0 * radians(lon1) AS sx1, 6378137e0 * ln(tan(pi()/4 + radians(lat1)/2)) AS sy1,
       6378137e0 * radians(lon2) AS sx2, 6378137e0 * ln(tan(pi()/4 + radians(lat2)/2)) AS sy2 FROM roads"""
SEG_T = """CASE WHEN (sx2-sx1)*(sx2-sx1) + (sy2-sy1)*(sy2-sy1) > 0 THEN
   greatest(0e0, least(1e0, ((x-sx1)*(sx2-sx1) + (y-sy1)*(sy2-sy1)) / ((sx2-sx1)*(sx2-sx1) + (sy2-sy1)*(sy2-sy1)))) ELSE 0e0 END"""
SEG_DIST = f"""sqrt(power(x - (sx1 + ({SEG_T})*(sx2-sx1)), 2) + power(y - (sy1 + ({SEG_T})*(sy2-sy1)), 2))"""
NEAR_PAIRS = f"""SELECT p.latitude, p.longitude, r.edge_id FROM gp p, gr r
  WHERE p.x BETWEEN least(sx1, sx2) - 200e0 AND greatest(sx1, sx2) + 200e0
    AND p.y BETWEEN least(sy1, sy2) - 200e0 AND greatest(sy1, sy2) + 200e0 AND {SEG_DIST} <= 200e0"""
ROAD_GRID_CTES = {"gp": MERC_POINTS, "gr": MERC_ROADS,
                  "road_grid": f"SELECT latitude, longitude, count(DISTINCT edge_id) AS n_edges FROM ({NEAR_PAIRS}) "
                               "GROUP BY latitude, longitude"}

CENTROIDS = """SELECT edge_id,
  CASE WHEN sqrt(power(lon1-lon2,2) + power(lat1-lat2,2)) > 0
       THEN (sqrt(power(lon1-lon2,2) + power(lat1-lat2,2)) * ((lat1+lat2)/2)) / sqrt(power(lon1-lon2,2) + power(lat1-lat2,2))
       ELSE (lat1+lat2)/2 END AS clat,
  CASE WHEN sqrt(power(lon1-lon2,2) + power(lat1-lat2,2)) > 0
       THEN (sqrt(power(lon1-lon2,2) + power(lat1-lat2,2)) * ((lon1+lon2)/2)) / sqrt(power(lon1-lon2,2) + power(lat1-lat2,2))
       ELSE (lon1+lon2)/2 END AS clon,
  CAST(CASE coalesce(highway, 'unclassified') WHEN 'motorway' THEN 5 WHEN 'trunk' THEN 4 WHEN 'primary' THEN 3
       WHEN 'secondary' THEN 2 WHEN 'tertiary' THEN 2 ELSE 1 END AS INT) AS road_type,
  CAST(CASE WHEN regexp_matches(coalesce(regexp_extract(coalesce(maxspeed, ''), '^\\s*(\\S+)', 1), ''), '^[0-9]+$')
       THEN CAST(regexp_extract(coalesce(maxspeed, ''), '^\\s*(\\S+)', 1) AS INT) ELSE 50 END AS INT) AS speed_limit
FROM roads"""

ROAD_ATTR_SQL = """SELECT latitude, longitude, edge_id AS nearest_edge_id, road_type, speed_limit FROM (
  SELECT g.latitude, g.longitude, c.edge_id, c.road_type, c.speed_limit,
         row_number() OVER (PARTITION BY g.latitude, g.longitude
                            ORDER BY sqrt(power(g.latitude - c.clat, 2) + power(g.longitude - c.clon, 2)), c.edge_id) AS rn
  FROM road_grid g, cent c) WHERE rn = 1"""


def _roads(spark, sf_dir):
    return B.roads(spark, sf_dir)


def _road_grid(spark, sf_dir):
    return jobs.road_grid(spark, _roads(spark, sf_dir), meters=200.0, dedupe=True)


# ---------------------------------------------------------------- queries
@register("road_grid_points", B.with_views(
    "SELECT latitude, longitude, n_edges FROM road_grid", "grid", "roads", extra=ROAD_GRID_CTES))
def q_road_grid(spark, sf_dir):
    """Grid points within 200 m (EPSG:3857) of a road edge, with the number of edges."""
    return _road_grid(spark, sf_dir)


@register("road_grid_pairs", B.with_views(
    f"SELECT DISTINCT latitude, longitude, edge_id FROM ({NEAR_PAIRS})", "grid", "roads",
    extra={"gp": MERC_POINTS, "gr": MERC_ROADS}))
def q_road_grid_pairs(spark, sf_dir):
    """Inner spatial join without dedupe: one row per (grid point, matching edge)."""
    return jobs.road_grid(spark, _roads(spark, sf_dir), meters=200.0, dedupe=False)


@register("line_centroids", B.with_views(
    "SELECT edge_id, round(clat, 6) AS centroid_lat, round(clon, 6) AS centroid_lon FROM cent", "roads",
    extra={"cent": CENTROIDS}))
def q_centroids(spark, sf_dir):
    c = spatial.line_centroids(_roads(spark, sf_dir))
    return c.select("edge_id", r6(F.col("centroid_lat")).alias("centroid_lat"),
                    r6(F.col("centroid_lon")).alias("centroid_lon"))


@register("road_attributes", B.with_views(
    "SELECT edge_id, road_type, speed_limit FROM cent", "roads", extra={"cent": CENTROIDS}))
def q_road_attributes(spark, sf_dir):
    return spatial.road_attributes(_roads(spark, sf_dir))


@register("road_grid_attributes", B.with_views(
    ROAD_ATTR_SQL, "grid", "roads", extra={**ROAD_GRID_CTES, "cent": CENTROIDS}))
def q_road_grid_attributes(spark, sf_dir):
    """Nearest edge centroid (planar degrees, tie: smallest edge_id) for every road-grid point."""
    g = _road_grid(spark, sf_dir).select("latitude", "longitude")
    out = jobs.attach_road_attributes(g, _roads(spark, sf_dir))
    return out.select("latitude", "longitude", "nearest_edge_id", "road_type", "speed_limit")


DENSITY_SQL = """SELECT g.latitude, g.longitude, CAST(count(a.latitude) AS BIGINT) AS accident_density_5km
FROM road_grid g LEFT JOIN acc a ON
  2e0 * asin(sqrt(least(1e0, power(sin((radians(a.latitude) - radians(g.latitude)) / 2), 2) +
     cos(radians(g.latitude)) * cos(radians(a.latitude)) *
     power(sin((radians(a.longitude) - radians(g.longitude)) / 2), 2)))) <= {r}
GROUP BY g.latitude, g.longitude"""


@register("accident_density", B.with_views(
    DENSITY_SQL.format(r=repr(true_radius_rad(5.0)) + "e0"), "grid", "roads", "acc", extra=ROAD_GRID_CTES))
def q_density(spark, sf_dir):
    """Events within 5 km (great circle) of every road-grid point; 0 when none."""
    g = _road_grid(spark, sf_dir).select("latitude", "longitude")
    a = B.acc(spark, sf_dir).select("latitude", "longitude")
    return spatial.radius_count(g, a, true_radius_rad(5.0))


SAFE_SQL = """SELECT g.latitude, g.longitude FROM road_grid g WHERE NOT EXISTS (
  SELECT 1 FROM acc a WHERE sqrt(power(6378137e0 * radians(g.longitude) - 6378137e0 * radians(a.longitude), 2) +
     power(6378137e0 * ln(tan(pi()/4 + radians(g.latitude)/2)) - 6378137e0 * ln(tan(pi()/4 + radians(a.latitude)/2)), 2))
     <= 300e0)"""


@register("safe_points", B.with_views(SAFE_SQL, "grid", "roads", "acc", extra=ROAD_GRID_CTES))
def q_safe_points(spark, sf_dir):
    """Road-grid points with no event within 300 m (spatial left-anti join)."""
    g = _road_grid(spark, sf_dir).select("latitude", "longitude")
    return spatial.exclude_near_points(g, B.acc(spark, sf_dir), 300.0)


def _vincenty_sql(src: str) -> str:
    stages = vincenty_stages("latitude", "longitude", f"{CITY_CENTRE[0]!r}e0", f"{CITY_CENTRE[1]!r}e0", "d")
    sql = f"SELECT latitude, longitude FROM {src}"
    for name, expr in stages:
        sql = f"SELECT *, {expr} AS {name} FROM ({sql})"
    return sql


@register("dist_to_centre", B.with_views(
    "SELECT latitude, longitude, round(d, 6) AS dist_to_noumea_km FROM (" + _vincenty_sql("road_grid") + ")",
    "grid", "roads", extra=ROAD_GRID_CTES))
def q_dist_centre(spark, sf_dir):
    """Ellipsoidal (WGS-84) distance in km from every road-grid point to the city centre."""
    g = _road_grid(spark, sf_dir).select("latitude", "longitude")
    d = jobs.attach_distance_to_centre(g)
    return d.select("latitude", "longitude", r6(F.col("dist_to_noumea_km")).alias("dist_to_noumea_km"))


NEAREST_SQL = """SELECT num_acc, nlat AS nearest_lat, nlon AS nearest_lon, round(dist, 9) AS nearest_dist FROM (
  SELECT a.num_acc, g.latitude AS nlat, g.longitude AS nlon,
         sqrt(power(a.latitude - g.latitude, 2) + power(a.longitude - g.longitude, 2)) AS dist,
         row_number() OVER (PARTITION BY a.num_acc ORDER BY
             sqrt(power(a.latitude - g.latitude, 2) + power(a.longitude - g.longitude, 2)), g.latitude, g.longitude) AS rn
  FROM acc a, road_grid g) WHERE rn = 1"""


@register("nearest_road_point", B.with_views(NEAREST_SQL, "grid", "roads", "acc", extra=ROAD_GRID_CTES))
def q_nearest(spark, sf_dir):
    """For every event, the nearest road-grid point (planar degrees; tie: smallest lat, lon)."""
    g = _road_grid(spark, sf_dir).select(
        "latitude", "longitude", F.col("latitude").alias("nearest_lat"), F.col("longitude").alias("nearest_lon"),
        F.struct("latitude", "longitude").alias("_key"))
    a = B.acc(spark, sf_dir).select("num_acc", "latitude", "longitude")
    out = spatial.nearest_join(a, g, ["nearest_lat", "nearest_lon"], tie="_key")
    return out.select("num_acc", "nearest_lat", "nearest_lon", F.round("nearest_dist", 9).alias("nearest_dist"))


@register("precompute_grid", B.with_views(
    """SELECT r.latitude, r.longitude, r.road_type, r.speed_limit, d.accident_density_5km,
              round(v.d, 6) AS dist_to_noumea_km
       FROM road_attr r JOIN density d USING (latitude, longitude) JOIN (""" + _vincenty_sql("road_grid") +
    """) v USING (latitude, longitude)""", "grid", "roads", "acc",
    extra={**ROAD_GRID_CTES, "cent": CENTROIDS, "road_attr": ROAD_ATTR_SQL,
           "density": DENSITY_SQL.format(r=repr(true_radius_rad(5.0)) + "e0")}))
def q_precompute(spark, sf_dir):
    """Pre-compute job: road grid + road attributes + 5 km density + distance to centre."""
    p = jobs.precompute(spark, _roads(spark, sf_dir), B.acc(spark, sf_dir))
    return p.withColumn("dist_to_noumea_km", r6(F.col("dist_to_noumea_km")))


HAV_ATTR_SQL = """SELECT latitude, longitude, edge_id AS nearest_edge_id, road_type, speed_limit,
       round(d, 6) AS nearest_km FROM (
  SELECT *, row_number() OVER (PARTITION BY latitude, longitude ORDER BY d, edge_id) AS rn FROM (
    SELECT g.latitude, g.longitude, c.edge_id, c.road_type, c.speed_limit,
           2e0 * asin(sqrt(least(1e0, power(sin((radians(c.clat) - radians(g.latitude)) / 2), 2) +
               cos(radians(g.latitude)) * cos(radians(c.clat)) *
               power(sin((radians(c.clon) - radians(g.longitude)) / 2), 2)))) * 6371.0088e0 AS d
    FROM road_grid g, cent c)) WHERE rn = 1"""


@register("road_grid_attributes_haversine", B.with_views(
    HAV_ATTR_SQL, "grid", "roads", extra={**ROAD_GRID_CTES, "cent": CENTROIDS}))
def q_road_grid_attributes_hav(spark, sf_dir):
    """Nearest edge centroid on the sphere (haversine km, tie: smallest edge_id) for every road-grid point."""
    g = _road_grid(spark, sf_dir).select("latitude", "longitude")
    out = jobs.attach_road_attributes(g, _roads(spark, sf_dir), metric="haversine")
    return out.select("latitude", "longitude", "nearest_edge_id", "road_type", "speed_limit",
                      F.round("nearest_dist", 6).alias("nearest_km"))
