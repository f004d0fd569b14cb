"""Regular lat/lon grid, generated in parallel from one range (no join)."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.profile import pattern_maps
from ..operators.versions import Store
from ..params import GRID_BOUNDS, GRID_STEP


def grid_shape(bounds=GRID_BOUNDS, step: float = GRID_STEP) -> tuple[int, int]:
    """Half-open arange lengths (lat, lon), as numpy computes them."""
    lat_min, lat_max, lon_min, lon_max = bounds
    return math.ceil((lat_max - lat_min) / step), math.ceil((lon_max - lon_min) / step)


def make_grid(spark: SparkSession, bounds=GRID_BOUNDS, step: float = GRID_STEP,
              num_partitions: int | None = None) -> DataFrame:
    """Grid points (i, j, latitude, longitude), lat outer / lon inner order.

    Coordinates are computed as ``min + index * step`` (never by cumulative
    addition).  One ``range`` of n_lat * n_lon ids is split into i, j, so the
    grid is produced by every partition independently, whatever its size.
    """
    lat_min, _, lon_min, _ = bounds
    n_lat, n_lon = grid_shape(bounds, step)
    ids = spark.range(0, n_lat * n_lon, 1, num_partitions) if num_partitions else spark.range(n_lat * n_lon)
    i = (F.col("id") / n_lon).cast("long")
    j = F.col("id") % n_lon
    return ids.select(
        i.alias("i"), j.alias("j"),
        (F.lit(float(lat_min)) + i * F.lit(float(step))).alias("latitude"),
        (F.lit(float(lon_min)) + j * F.lit(float(step))).alias("longitude"),
    )


def grid_metadata(grid: DataFrame) -> dict:
    """Number of points, columns and summary figures of an enriched grid (one aggregation)."""
    want = {"accident_density_5km": {"mean_density": F.avg, "max_density": F.max}, "dist_to_noumea_km": {"mean_distance_km": F.avg}}
    aggs = [f(c).alias(k) for c, fs in want.items() if c in grid.columns for k, f in fs.items()]
    return {"columns": grid.columns} | grid.agg(F.count(F.lit(1)).alias("n_points"), *aggs).first().asDict()


def save_enriched_grid(grid: DataFrame, path: str, patterns: DataFrame | None = None) -> int:
    """Grid, temporal patterns (a map per kind) and metadata as one version of a store; readers see all of it or none."""
    store = Store(grid.sparkSession, path)
    base = (store.versions() or [0])[-1]
    entries = {"grid": store.stage("grid", grid)}
    if patterns is not None:
        entries["patterns"] = store.stage("patterns", pattern_maps(patterns))
    return store.publish(entries, grid_metadata(store.staged("grid", entries["grid"])), base)


def load_enriched_grid(spark: SparkSession, path: str, build) -> DataFrame:
    """The grid stored by ``save_enriched_grid``; if there is none, ``build()`` it and store it.

    Only a missing store is built: an unreadable one raises.
    """
    store = Store(spark, path)
    if not store.versions():
        built = build()
        grid, patterns = built if isinstance(built, tuple) else (built, None)
        save_enriched_grid(grid, path, patterns)
    return store.read("grid")


def load_patterns(spark: SparkSession, path: str) -> DataFrame:
    """``(kind, pattern)`` as stored beside the grid; ``pattern`` maps hour, day of week or month to its value."""
    return Store(spark, path).read("patterns")
