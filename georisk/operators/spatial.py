"""Spatial joins without a geometry type: cell bucketing + exact refinement.

Every join here is an *equi-join on a cell key* followed by an exact distance
predicate, so Spark plans it as a normal hash/sort-merge join (or broadcast
when one side is provably small) instead of a nested loop over all pairs:

* both sides are bucketed into square cells of side >= the search radius;
* one side is replicated into the cells its search disc can touch
  (3x3 neighbourhood for points, the expanded bounding box for segments);
* candidate pairs are refined with the exact distance.

Repeated coordinates are collapsed before joining (distinct coordinates, or
coordinates with a multiplicity), so a location that holds a third of all
rows is one row in the join.  Adaptive execution splits what skew remains
(dense cells) via ``spark.sql.adaptive.skewJoin``.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import geo
from ..functions.parse import first_of_list, parse_speed, road_type_code
from ..params import EARTH_RADIUS_KM, ENRICHMENT_DEFAULTS, ROAD_TYPE_WITHOUT_COLUMN
from ..session import cut_lineage

KM_PER_DEG = EARTH_RADIUS_KM * math.pi / 180.0
INITIAL_DENSITY = 4.0    # nearest_join: right coordinates per occupied starting cell


def _with_mercator(df: DataFrame, lat: str = "latitude", lon: str = "longitude", x: str = "_x", y: str = "_y"):
    return df.withColumns({x: geo.mercator_x(lon), y: geo.mercator_y(lat)})


# ---------------------------------------------------------------- hot cells
HOT_PAIRS = 50_000_000   # candidate pairs that one task compares in a cell; a cell with more is split
TASK_PAIRS = 2_000_000   # candidate pairs for which a join gets one more task


def cell_join(probe: DataFrame, build: DataFrame, keys=("_cx", "_cy"), hot_pairs: int | None = None) -> DataFrame:
    """Inner equi-join on cell keys that splits hot cells on both sides.

    What a cell costs is its probe rows times its build rows; one aggregation
    finds the sum and the greatest of that over all cells.  Without a cell of
    more than ``hot_pairs`` it is a plain join, left to the planner if it is
    small, else dealt over as many tasks as its pairs ask for (few bytes make
    many pairs here, which sizes in bytes don't show).  A hot cell is cut into
    shares of about sqrt(hot_pairs) rows on either side, dealt by a hash of the
    row; every pair of shares is a group of its own, so each pair of rows still
    meets exactly once.
    """
    keys = list(keys)
    hot_pairs = hot_pairs or HOT_PAIRS
    sizes = (probe.groupBy(*keys).agg(F.count(F.lit(1)).alias("_np"))
             .join(build.groupBy(*keys).agg(F.count(F.lit(1)).alias("_nb")), keys))
    pairs = F.col("_np").cast("double") * F.col("_nb")
    total, most = sizes.agg(F.sum(pairs), F.max(pairs)).first()
    most_tasks = int(probe.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = min(most_tasks, math.ceil((total or 0.0) / TASK_PAIRS))
    if (most or 0.0) <= hot_pairs:
        return (probe.repartition(tasks, *keys) if tasks > 1 else probe).join(build, keys)

    share = math.isqrt(hot_pairs)
    hot = (sizes.filter(pairs > hot_pairs)
           .select(*keys, F.ceil(F.col("_np") / share).cast("int").alias("_sp"),
                   F.ceil(F.col("_nb") / share).cast("int").alias("_sb")))

    def dealt(df, own, other, salt):
        mine = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.col(own)).cast("int")
        salts = F.when(F.col(own).isNull(), F.array(F.lit(0))) \
            .otherwise(F.transform(F.sequence(F.lit(0), F.col(other) - 1), lambda t: salt(mine, t)))
        return df.join(hot, keys, "left").withColumn("_salt", F.explode(salts)).drop("_sp", "_sb")

    p = dealt(probe, "_sp", "_sb", lambda m, t: m * F.col("_sb") + t)
    b = dealt(build, "_sb", "_sp", lambda m, t: t * F.col("_sb") + m)
    return p.repartition(tasks, *keys, "_salt").join(b, keys + ["_salt"]).drop("_salt")


# ------------------------------------------------------------- cells on the sphere
def _row_width(row, dlat: float, theta: float):
    """Width in degrees of the longitude cells of latitude row ``row``.

    Two points at most ``theta`` apart, one in the row and one in it or a
    neighbouring row, differ by less than this in longitude.  Where a cell
    would span a third of the circle or more the row has one cell (360).
    """
    top = F.least(F.greatest(F.abs(row - 1), F.abs(row + 2)) * F.lit(dlat), F.lit(90.0))
    s = F.lit(math.sin(min(theta, math.pi) / 2)) / F.greatest(F.cos(F.radians(top)), F.lit(1e-12))
    w = F.degrees(2 * F.asin(F.least(s, F.lit(1.0))))
    return F.when((s >= 1) | (w >= 120), F.lit(360.0)).otherwise(F.greatest(w, F.lit(1e-9)))


def _sphere_cells(df: DataFrame, lat: str, lon: str, dlat: float, theta: float) -> DataFrame:
    """One row per cell ``(_cy, _cx)`` of a point; near the antimeridian also the cell seen from the other side."""
    w = _row_width(F.col("_cy"), dlat, theta)
    x = F.col(lon)
    seen = F.filter(F.array(x, x - 360, x + 360), lambda v: (v == x) | ((F.col("_w") < 360) & (F.abs(v) <= 180 + 2 * F.col("_w"))))
    return (df.withColumn("_cy", geo.cell_index(lat, dlat)).withColumn("_w", w)
            .withColumn("_x", F.explode(seen)).withColumn("_cx", F.floor(F.col("_x") / F.col("_w"))).drop("_w", "_x"))


def _sphere_neighbours(df: DataFrame, lat: str, lon: str, dlat: float, theta: float) -> DataFrame:
    """One row per cell that a disc of angle ``theta`` around the point can reach."""
    row = geo.cell_index(lat, dlat) + F.col("_o.dy")
    return (df.withColumn("_o", F.explode(geo.neighbour_offsets())).withColumn("_cy", row)
            .withColumn("_cx", F.floor(F.col(lon) / _row_width(F.col("_cy"), dlat, theta)) + F.col("_o.dx")).drop("_o"))


# ------------------------------------------------------------ point near line
def segments_mercator(segments: DataFrame) -> DataFrame:
    return segments.withColumns({
        "_ax": geo.mercator_x("lon1"), "_ay": geo.mercator_y("lat1"),
        "_bx": geo.mercator_x("lon2"), "_by": geo.mercator_y("lat2"),
    })


def _cells_along(seg: DataFrame, r: float, c: float) -> DataFrame:
    """A segment's row for every cell within ``r`` of it: per column of cells only the rows that the line crosses
    there, so a diagonal takes cells in proportion to its length and not to its bounding box."""
    turn = F.col("_ax") <= F.col("_bx")
    x0, x1 = F.least("_ax", "_bx"), F.greatest("_ax", "_bx")
    y0, y1 = F.when(turn, F.col("_ay")).otherwise(F.col("_by")), F.when(turn, F.col("_by")).otherwise(F.col("_ay"))
    pad = F.lit(r + 1e-6)
    seg = seg.withColumns({"_x0": x0, "_x1": x1, "_y0": y0, "_y1": y1}).withColumn(
        "_cx", F.explode(F.sequence(F.floor((F.col("_x0") - pad) / c), F.floor((F.col("_x1") + pad) / c))))

    def y_at(x):
        inside = F.least(F.greatest(x, F.col("_x0")), F.col("_x1"))
        return F.col("_y0") + (inside - F.col("_x0")) / (F.col("_x1") - F.col("_x0")) * (F.col("_y1") - F.col("_y0"))

    flat = F.col("_x1") == F.col("_x0")
    ya = F.when(flat, F.col("_y0")).otherwise(y_at(F.col("_cx") * c - pad))
    yb = F.when(flat, F.col("_y1")).otherwise(y_at((F.col("_cx") + 1) * c + pad))
    seg = seg.withColumns({"_ya": ya, "_yb": yb}).withColumn("_cy", F.explode(F.sequence(
        F.floor((F.least("_ya", "_yb") - pad) / c), F.floor((F.greatest("_ya", "_yb") + pad) / c))))
    return seg.drop("_x0", "_x1", "_y0", "_y1", "_ya", "_yb", "lon1", "lat1", "lon2", "lat2")


def points_near_lines(points: DataFrame, segments: DataFrame, meters: float, point_keys=("latitude", "longitude"),
                      edge_key: str = "edge_id", cell_m: float | None = None, dedupe: bool = True) -> DataFrame:
    """Points within ``meters`` (EPSG:3857) of any segment.

    dedupe=True : one row per point with ``n_edges`` (number of matching edges).
    dedupe=False: one row per (point, matching edge), like an inner spatial join.
    """
    r = float(meters)
    c = float(cell_m or max(r, 1000.0))
    keys = list(point_keys)
    pts = _with_mercator(points.select(*dict.fromkeys(keys + ["latitude", "longitude"])))
    pts = pts.withColumns({"_cx": geo.cell_index("_x", c), "_cy": geo.cell_index("_y", c)})
    seg = _cells_along(segments_mercator(segments.select(edge_key, "lon1", "lat1", "lon2", "lat2")), r, c)
    pairs = cell_join(pts, seg).filter(
        geo.point_segment_distance("_x", "_y", "_ax", "_ay", "_bx", "_by") <= F.lit(r))
    pairs = pairs.select(*keys, edge_key).distinct()
    if not dedupe:
        return pairs
    return pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_edges"))


# ------------------------------------------------------- exclusion (left anti)
def near_point_keys(points: DataFrame, events: DataFrame, meters: float, keys=("latitude", "longitude"),
                    cell_m: float | None = None) -> DataFrame:
    """Keys of points with at least one event within ``meters`` (EPSG:3857)."""
    r = float(meters)
    c = float(cell_m or r)
    keys = list(keys)
    ev = _with_mercator(events.select("latitude", "longitude").distinct(), x="_ex", y="_ey")
    ev = ev.select("_ex", "_ey", geo.cell_index("_ex", c).alias("_cx"), geo.cell_index("_ey", c).alias("_cy"))
    pts = _with_mercator(points.select(*dict.fromkeys(keys + ["latitude", "longitude"])))
    pts9 = pts.select(*keys, "_x", "_y", F.explode(geo.neighbour_offsets()).alias("_o")).select(
        *keys, "_x", "_y",
        (geo.cell_index("_x", c) + F.col("_o.dx")).alias("_cx"),
        (geo.cell_index("_y", c) + F.col("_o.dy")).alias("_cy"))
    cond = ["_cx", "_cy"]
    near = cell_join(ev, pts9, cond).filter(geo.euclid("_x", "_y", "_ex", "_ey") <= F.lit(r))
    return near.select(*keys).distinct()


def exclude_near_points(points: DataFrame, events: DataFrame, meters: float, keys=("latitude", "longitude"),
                        cell_m: float | None = None) -> DataFrame:
    """Points with no event within ``meters`` -- a spatial left-anti join."""
    near = near_point_keys(points, events, meters, keys, cell_m)
    return points.join(near, list(keys), "left_anti")


# ------------------------------------------------------------- radius count
def radius_count(points: DataFrame, events: DataFrame, radius_rad: float, keys=("latitude", "longitude"),
                 out: str = "accident_density_5km") -> DataFrame:
    """Number of events within a great-circle angle ``radius_rad`` of each point (0 if none).

    Events are first reduced to (coordinate, multiplicity).  Cells are as high
    as the radius and, row by row, as wide as it is at the row's latitude, so
    one event near a pole widens the cells there and nowhere else; cells at the
    antimeridian see across it.  ``radius_rad`` is an angle: 5 km is 5/6371.0088.
    """
    keys = list(keys)
    ev = cut_lineage(events.groupBy("latitude", "longitude").agg(F.count(F.lit(1)).alias("_w0"))
                     .withColumnsRenamed({"latitude": "_elat", "longitude": "_elon"}), "radius_events")
    pts = cut_lineage(points.select(*dict.fromkeys(keys + ["latitude", "longitude"])), "radius_points")
    dlat = max(math.degrees(radius_rad), 1e-9)
    ev = _sphere_cells(ev, "_elat", "_elon", dlat, radius_rad)
    pts9 = _sphere_neighbours(pts.withColumns({"_plat": F.col("latitude"), "_plon": F.col("longitude")}), "_plat", "_plon",
                              dlat, radius_rad).select(*keys, "_plat", "_plon", "_cx", "_cy")
    hits = cell_join(ev, pts9).filter(
        geo.haversine_rad("_plat", "_plon", "_elat", "_elon") <= F.lit(float(radius_rad)))
    counts = hits.groupBy(*keys).agg(F.sum("_w0").alias(out))
    return points.join(counts, keys, "left").withColumn(out, F.coalesce(F.col(out), F.lit(0)).cast("long"))


# ------------------------------------------------------------------ nearest
ROUNDS = 3              # rounds of growing cells before what is left goes down the levels
LADDER = tuple(360.0 / 2 ** k for k in range(26))
TOP_CELLS = 64          # occupied cells of the coarsest level, each compared with every coordinate left


def nearest_join(left: DataFrame, right: DataFrame, right_cols, tie: str, metric: str = "euclid_deg",
                 lat: str = "latitude", lon: str = "longitude", initial_cell: float | None = None,
                 dist_col: str = "nearest_dist") -> DataFrame:
    """For every left row, the right row at minimum distance (smallest ``tie`` on equal distance).

    metric 'euclid_deg': planar distance in degrees; 'haversine': km on the sphere.

    Exact, with no cap on the search distance.  Distinct left coordinates look
    into the 3x3 cells of size c around them; a best candidate at distance <= c
    is the nearest, since all else is farther.  c is the size at which occupied
    cells hold about ``INITIAL_DENSITY`` right coordinates, so stray rows on
    either side don't change it, and it doubles for the few coordinates left.
    Coordinates far from all right rows then go down a hierarchy of cells: a
    cell can be left out if its lower bound, the distance to its
    representative less its radius, is above the least distance to any
    representative.  Every step is an equi-join on a cell key.  An empty right
    side gives the documented enrichment defaults.
    """
    want_tie = tie in right_cols
    right_cols = [c for c in right_cols if c not in (lat, lon, tie)]
    if metric not in ("euclid_deg", "haversine"):
        raise ValueError(f"unknown metric {metric!r}")
    sphere = metric == "haversine"
    dist = geo.haversine_km if sphere else geo.euclid
    # of equal right coordinates only the smallest tie can win; both inputs are read by several jobs
    R = cut_lineage(right.select(F.col(lat).alias("_rlat"), F.col(lon).alias("_rlon"),
                                 F.struct(F.col(tie).alias("_tie"), *right_cols).alias("_row"))
                    .filter("_rlat IS NOT NULL AND _rlon IS NOT NULL").groupBy("_rlat", "_rlon")
                    .agg(F.min("_row").alias("_row")), "nearest_right")
    L = cut_lineage(left.select(F.col(lat).alias("_llat"), F.col(lon).alias("_llon"))
                    .filter("_llat IS NOT NULL AND _llon IS NOT NULL").distinct(), "nearest_left")
    occupied = R.agg(F.count(F.lit(1)), *[F.approx_count_distinct(F.struct(
        geo.cell_index("_rlat", c), geo.cell_index("_rlon", c))) for c in LADDER]).first()
    n_right = occupied[0]
    if not n_right:
        return left.withColumns({c: F.lit(ENRICHMENT_DEFAULTS.get(c)).cast(right.schema[c].dataType) for c in right_cols}
                                | {dist_col: F.lit(None).cast("double")})
    level = next((k for k, n in enumerate(occupied[1:]) if n_right <= INITIAL_DENSITY * n), len(LADDER) - 1)
    c = initial_cell or LADDER[level]

    def least(cand):
        return cand.groupBy("_llat", "_llon").agg(F.min(F.struct("_d", "_row")).alias("_b"))

    done, pending = [], L
    for _ in range(ROUNDS):
        if sphere:
            theta, accept = math.radians(c), c * KM_PER_DEG
            near = _sphere_cells(R, "_rlat", "_rlon", c, theta)
            look = _sphere_neighbours(pending, "_llat", "_llon", c, theta)
        else:
            accept = c
            near = R.withColumns({"_cy": geo.cell_index("_rlat", c), "_cx": geo.cell_index("_rlon", c)})
            look = pending.withColumn("_o", F.explode(geo.neighbour_offsets())).select(
                "_llat", "_llon", (geo.cell_index("_llat", c) + F.col("_o.dy")).alias("_cy"),
                (geo.cell_index("_llon", c) + F.col("_o.dx")).alias("_cx"))
        cand = cell_join(look, near, ("_cy", "_cx")).withColumn("_d", dist("_llat", "_llon", "_rlat", "_rlon"))
        ok = cut_lineage(least(cand).filter(F.col("_b._d") <= F.lit(float(accept))), "nearest_round")
        done.append(ok)
        pending = cut_lineage(pending.join(ok.select("_llat", "_llon"), ["_llat", "_llon"], "left_anti"),
                              "nearest_pending")
        if pending.isEmpty():
            break
        c *= 2.0
    else:
        done.append(least(_down_the_levels(pending, R, occupied[1:], level, dist)))

    resolved = done[0]
    for d in done[1:]:
        resolved = resolved.unionByName(d)
    resolved = resolved.select(F.col("_llat").alias(lat), F.col("_llon").alias(lon),
                               *[F.col(f"_b._row.{x}").alias(x) for x in right_cols],
                               F.col("_b._d").alias(dist_col), F.col("_b._row._tie").alias(f"nearest_{tie}"),
                               *([F.col("_b._row._tie").alias(tie)] if want_tie else []))
    return left.join(resolved, [lat, lon], "left")


def _down_the_levels(pending: DataFrame, R: DataFrame, occupied, leaf: int, dist) -> DataFrame:
    """``_llat, _llon, _row, _d`` of all right coordinates that may be nearest to a pending one.

    A level's cells are four times as wide as those of the next one.  Each
    cell has one of its own coordinates as representative and a radius around
    it that holds the cell; both follow from the cells of the level below.
    """
    top = max((k for k, n in enumerate(occupied) if n <= TOP_CELLS // 2), default=0)   # the count is approximate
    depth = max(0, -(-(leaf - top) // 2))
    size = LADDER[leaf]

    def key(c):
        return [F.floor(F.col(c[0]) / 4).alias("_py"), F.floor(F.col(c[1]) / 4).alias("_px")]

    points = R.withColumns({"_ky": geo.cell_index("_rlat", size), "_kx": geo.cell_index("_rlon", size)})
    rep = points.groupBy("_ky", "_kx").agg(F.min(F.struct("_rlat", "_rlon")).alias("_m"))
    cells = cut_lineage(
        points.join(rep, ["_ky", "_kx"]).withColumn("_d", dist("_rlat", "_rlon", F.col("_m._rlat"), F.col("_m._rlon")))
        .groupBy("_ky", "_kx").agg(F.first("_m").alias("_m"), F.max("_d").alias("_rad"))
        .select("_ky", "_kx", F.col("_m._rlat").alias("_clat"), F.col("_m._rlon").alias("_clon"), "_rad"), "nearest_cells")
    levels = [cells]
    for _ in range(depth):
        below = levels[-1].select("*", *key(("_ky", "_kx")))
        rep = below.groupBy("_py", "_px").agg(F.min(F.struct("_clat", "_clon")).alias("_m"))
        levels.append(cut_lineage(
            below.join(rep, ["_py", "_px"])
            .withColumn("_d", dist("_clat", "_clon", F.col("_m._clat"), F.col("_m._clon")) + F.col("_rad"))
            .groupBy("_py", "_px").agg(F.first("_m").alias("_m"), F.max("_d").alias("_rad"))
            .select(F.col("_py").alias("_ky"), F.col("_px").alias("_kx"), F.col("_m._clat").alias("_clat"),
                    F.col("_m._clon").alias("_clon"), "_rad"), "nearest_cells"))

    own = Window.partitionBy("_llat", "_llon")

    def possible(cand):
        up = dist("_llat", "_llon", "_clat", "_clon")
        return (cand.withColumn("_up", up).withColumn("_least", F.min("_up").over(own))
                .filter(F.col("_up") - F.col("_rad") <= F.col("_least") * (1 + 1e-9) + 1e-9)
                .select("_llat", "_llon", F.col("_ky").alias("_py"), F.col("_kx").alias("_px")))

    cand = possible(pending.crossJoin(F.broadcast(levels[-1])))        # about TOP_CELLS rows
    for cells in levels[-2::-1]:
        children = cells.select("*", *key(("_ky", "_kx")))
        cand = possible(cell_join(cut_lineage(cand, "nearest_level"), children, ("_py", "_px")))
    at = points.withColumnsRenamed({"_ky": "_py", "_kx": "_px"})
    return cell_join(cut_lineage(cand, "nearest_level"), at, ("_py", "_px")).select(
        "_llat", "_llon", "_row", dist("_llat", "_llon", "_rlat", "_rlon").alias("_d"))


# ------------------------------------------------------------ road attributes
def line_centroids(segments: DataFrame, edge_key: str = "edge_id") -> DataFrame:
    """Length-weighted mean of segment midpoints per edge (planar lon/lat).

    Zero-length edges fall back to the mean of their vertices.
    """
    seg = segments.withColumns({
        "_len": geo.euclid("lon1", "lat1", "lon2", "lat2"),
        "_mx": (F.col("lon1") + F.col("lon2")) / 2, "_my": (F.col("lat1") + F.col("lat2")) / 2,
    })
    g = seg.groupBy(edge_key).agg(
        F.sum("_len").alias("_L"),
        F.sum(F.col("_len") * F.col("_mx")).alias("_sx"), F.sum(F.col("_len") * F.col("_my")).alias("_sy"),
        F.avg("_mx").alias("_ax"), F.avg("_my").alias("_ay"))
    return g.select(
        edge_key,
        F.when(F.col("_L") > 0, F.col("_sy") / F.col("_L")).otherwise(F.col("_ay")).alias("centroid_lat"),
        F.when(F.col("_L") > 0, F.col("_sx") / F.col("_L")).otherwise(F.col("_ax")).alias("centroid_lon"))


def road_attributes(edges: DataFrame, edge_key: str = "edge_id") -> DataFrame:
    """edge -> road_type (class code) and speed_limit (parsed), one row per edge.

    Without a ``highway`` column at all every edge has class 2, without ``maxspeed`` the default speed.
    """
    if "highway" in edges.columns:
        hw = F.col("highway")
        kind = road_type_code(first_of_list(hw) if isinstance(edges.schema["highway"].dataType, T.ArrayType) else hw)
    else:
        kind = F.lit(ROAD_TYPE_WITHOUT_COLUMN)
    speed = parse_speed("maxspeed" if "maxspeed" in edges.columns else F.lit(None))
    # an edge's segments carry the same attributes; min makes the choice independent of their order
    return edges.groupBy(edge_key).agg(F.min(F.struct(kind.alias("road_type"), speed.alias("speed_limit"))).alias("a")) \
        .select(edge_key, "a.road_type", "a.speed_limit")
