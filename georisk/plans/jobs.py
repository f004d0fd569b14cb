"""Composed jobs: table(s) in -> table(s) out, built from the operators."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import geo
from ..operators import spatial
from ..operators.tuning import IntRange, LogUniform, Uniform
from ..operators.versions import Store
from ..params import CITY_CENTRE, DEFAULT_PARAMS, GRID_BOUNDS, GRID_STEP, JobParams, true_radius_rad
from ..session import cut_lineage, scratch_path
from ..sources.grid import make_grid


# ------------------------------------------------------------- road grid
def road_grid(spark: SparkSession, segments: DataFrame, bounds=GRID_BOUNDS, step: float = GRID_STEP,
              meters: float = 200.0, dedupe: bool = True) -> DataFrame:
    """Grid points within ``meters`` of a road (EPSG:3857).

    dedupe=True gives one row per point (scoring); dedupe=False repeats a point
    once per matching edge (as the training grid does).
    """
    grid = make_grid(spark, bounds, step)
    near = spatial.points_near_lines(grid, segments, meters, ("latitude", "longitude"), dedupe=dedupe)
    return near


def road_centroids(segments: DataFrame) -> DataFrame:
    """Edge centroid with its road_type and speed_limit."""
    cent = spatial.line_centroids(segments)
    attrs = spatial.road_attributes(segments)
    return cent.join(attrs, "edge_id").select(
        "edge_id", F.col("centroid_lat").alias("latitude"), F.col("centroid_lon").alias("longitude"),
        "road_type", "speed_limit")


def attach_road_attributes(points: DataFrame, segments: DataFrame, metric: str = "euclid_deg") -> DataFrame:
    """road_type / speed_limit of the edge whose centroid is nearest (tie: smallest edge_id)."""
    return spatial.nearest_join(points, road_centroids(segments), ["road_type", "speed_limit"], tie="edge_id",
                                metric=metric)


def attach_distance_to_centre(points: DataFrame, centre=CITY_CENTRE, out: str = "dist_to_noumea_km") -> DataFrame:
    return geo.with_geodesic_km(points, "latitude", "longitude", centre[0], centre[1], out)


def precompute(spark: SparkSession, segments: DataFrame, events: DataFrame,
               params: JobParams = DEFAULT_PARAMS, compat_radius: bool = False, out_dir: str | None = None) -> DataFrame:
    """Road grid with road attributes, accident density and distance to the centre.

    With ``out_dir`` grid, temporal patterns of the events and metadata are
    published there as one version, and the grid is read from it.
    """
    grid = cut_lineage(road_grid(spark, segments, params.bounds, params.step, params.road_buffer_m,
                                 dedupe=True))
    grid = attach_road_attributes(grid.select("latitude", "longitude"), segments)
    radius = params.density_radius_km / 111.0 if compat_radius else true_radius_rad(params.density_radius_km)
    grid = spatial.radius_count(grid, events.select("latitude", "longitude"), radius)
    grid = attach_distance_to_centre(grid).select("latitude", "longitude", "road_type", "speed_limit",
                                                  "accident_density_5km", "dist_to_noumea_km")
    if not out_dir:
        return cut_lineage(grid)
    from ..operators import features, profile
    from ..sources.grid import save_enriched_grid
    parts = features.add_time_parts(events, "datetime", params.dow_base).withColumn("year", F.year("datetime"))
    save_enriched_grid(grid, out_dir, profile.temporal_patterns(parts))
    return Store(spark, out_dir).read("grid")


# ------------------------------------------------------------------ silver
def positives(events: DataFrame, bounds=GRID_BOUNDS, dow_base: str = "mon0") -> DataFrame:
    """Events inside the box with time parts and target 1 (src_id = event id)."""
    from ..operators import features as feat
    from ..operators import ingest
    e = ingest.filter_bbox(events.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()), bounds)
    e = feat.add_time_parts(e, "datetime", dow_base)
    return e.select(F.col("num_acc").alias("src_id"), "datetime", "latitude", "longitude", "atm",
                    "hour", "dayofweek", "month", "day", F.lit(1).alias("target"))


def silver(spark: SparkSession, events: DataFrame, segments: DataFrame, params: JobParams = DEFAULT_PARAMS,
           grid: DataFrame | None = None, out_dir: str | None = None) -> DataFrame:
    """Positives + synthetic negatives, 24 features, enrichment from the nearest road-grid point.

    With ``out_dir`` the table full_dataset is replaced there and read back.
    """
    from ..operators import features as feat
    from ..operators import ingest, sampling
    pos = positives(events, params.bounds, params.dow_base)
    ev = pos.select(F.col("src_id").alias("num_acc"), "datetime", "latitude", "longitude", "atm")
    g = grid if grid is not None else precompute(spark, segments, ev, params)
    road = g.select("latitude", "longitude")        # the stored grid is the (deduplicated) road grid
    safe = cut_lineage(spatial.exclude_near_points(road, ev, params.sampling.exclusion_m))
    neg = sampling.generate_negatives(spark, ev, safe, road, seed=params.sampling.seed,
                                      ratio=params.sampling.ratio, cap_per_point=params.sampling.cap_per_point,
                                      risk_ratio=params.sampling.observed_times, dow_base=params.dow_base)
    neg = neg.select(F.col("sample_id").alias("src_id"), "datetime", "latitude", "longitude", "atm", "hour",
                     "dayofweek", "month", F.dayofmonth("datetime").cast("int").alias("day"), "target")
    both = ingest.union_all(pos, cut_lineage(neg))
    g = g.select("latitude", "longitude", F.struct("latitude", "longitude").alias("_gkey"),
                 "road_type", "speed_limit", "accident_density_5km", "dist_to_noumea_km")
    enriched = spatial.nearest_join(both, g, ["road_type", "speed_limit", "accident_density_5km",
                                              "dist_to_noumea_km"], tie="_gkey")
    out = feat.build_features(enriched, params.calendar).drop("nearest_dist", "nearest__gkey")
    if not out_dir:
        return cut_lineage(out)
    Store(spark, out_dir).replace({"full_dataset": out})
    return Store(spark, out_dir).read("full_dataset")


def gold(silver_df: DataFrame, params: JobParams = DEFAULT_PARAMS, out_dir: str | None = None) -> DataFrame:
    """Encode atm (text order), drop incomplete rows, exact stratified split -> column ``split``.

    ``atm_raw`` keeps the label as it came, for pipelines that hold their encoder.  With ``out_dir`` the tables train,
    test, feature_metadata and encoder are replaced there in one step; ``load_encoder`` reads the last one for scoring.
    """
    from ..operators import features, ingest, model, sampling
    from ..params import FEATURE_COLUMNS
    encoder = cut_lineage(model.label_dictionary(silver_df, "atm"), "encoder")
    features.require_columns(silver_df)
    clean = ingest.drop_incomplete(model.apply_encoder(model.with_raw_label(silver_df), "atm", encoder), FEATURE_COLUMNS)
    out = cut_lineage(sampling.stratified_split(clean, "target", params.test_share, params.sampling.seed,
                                                hash_cols=["target", "src_id"]), "gold")
    if out_dir:
        parts = {p: out.filter(F.col("split") == p).select(*FEATURE_COLUMNS, "target") for p in ("train", "test")}
        Store(silver_df.sparkSession, out_dir).replace(
            parts | {"feature_metadata": features.feature_metadata(silver_df.sparkSession), "encoder": encoder})
    return out


def load_encoder(spark: SparkSession, gold_dir: str) -> DataFrame:
    return Store(spark, gold_dir).read("encoder")


# ------------------------------------------------------------------ scoring
def score_daily(grid: DataFrame, day: DataFrame, path: str, atm_code: int = 1, profile: str = "pipeline", scorer=None,
                encoder: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Score every grid point for every hour of ``day`` and replace that date's rows under ``path``.

    Rows get ids from 1 per date.  A broken constraint (null date or
    probability, a repeated date, hour and place) raises before anything is
    published, and the day's old rows stay.  A grid without points leaves the
    date empty.  Returns the stored table and the day's statistics.
    """
    from ..operators import ingest, profile as prof, scoring, tables
    scored = scoring.score_day(grid, day, atm_code, profile, scorer, encoder=encoder)
    rows = tables.assign_row_ids(scored, "date", ["hour", "latitude", "longitude"])

    def check(_, stored):
        broken = ingest.check_table_constraints(stored, ["date", "probability"], ["date", "hour", "latitude", "longitude"])
        if first := broken.first():
            raise ValueError(f"predictions break {first['constraint']} at {first['key']} ({first['n']} rows)")

    when = day.select("date").limit(1).first()[0]
    tables.replace_partition(rows, path, "date", [when], check=check)
    stored = tables.read_table(grid.sparkSession, path)
    return stored, prof.prediction_day_stats(stored.filter(F.col("date") == F.lit(when)))


# ------------------------------------------------------------------ bronze
ACCIDENT_SCHEMA = T.StructType([T.StructField("Num_Acc", T.LongType())] + [
    T.StructField(c, T.StringType()) for c in ("jour", "mois", "an", "hrmn", "lat", "long", "atm", "dep")])
USER_SCHEMA = T.StructType([T.StructField("Num_Acc", T.LongType())])


def bronze(spark: SparkSession, carac_pattern: str, usagers_pattern: str | None = None, mode: str = "correct",
           carac_fallback=(), usagers_fallback=(), sep: str | None = None, out_dir: str | None = None):
    """Yearly CSV files -> cleaned events; returns (frame, stage counts).

    ``sep=None`` finds each file's separator.  Each CSV file is read once: its
    table is stored, the count comes from the row counts in the footers of what
    was stored (an ``Observation`` of the write would do, but one makes the
    session's later spark.ml fits fail in Spark 4.1), and the cleaning reads the
    stored table.  With ``out_dir`` the tables
    caracteristiques, usagers and accidents_nc are replaced there in one step,
    the counts with them.
    """
    from ..operators import ingest
    from ..sources import files
    store, entries, found = Store(spark, out_dir or scratch_path(spark, "bronze")), {}, {}

    def keep(name, df):
        entries[name] = store.stage(name, df)
        found[name] = store.staged(name, entries[name])
        return found[name]

    base = (store.versions() or [0])[-1]
    carac = keep("caracteristiques", files.scan_csv_union(spark, files.discover_sources(spark, carac_pattern, carac_fallback), sep))
    keys = None
    if usagers_pattern:
        users = keep("usagers", files.scan_csv_union(spark, files.discover_sources(spark, usagers_pattern, usagers_fallback), sep))
        keys = users.select(F.col("Num_Acc").try_cast("long").alias("Num_Acc"))
    typed = carac.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in ACCIDENT_SCHEMA.fields])
    out = keep("accidents_nc", ingest.parse_accidents(typed, keys, mode=mode))
    counts = {name: rows.count() for name, rows in found.items()}
    store.publish(entries, {"counts": counts}, base)
    return out, counts


# ------------------------------------------------------------------ training
GBT_SPACE = {"maxDepth": IntRange(3, 8), "stepSize": LogUniform(0.01, 0.3), "subsamplingRate": Uniform(0.6, 1.0),
             "minInstancesPerNode": IntRange(1, 100)}
FOREST_SPACE = {"maxDepth": IntRange(4, 10), "minInstancesPerNode": IntRange(1, 100), "subsamplingRate": Uniform(0.6, 1.0)}
LOGISTIC_SPACE = {"regParam": LogUniform(1e-8, 1e-1), "elasticNetParam": Uniform(0.0, 1.0)}


def train(spark: SparkSession, gold_df: DataFrame, out_dir: str | None = None, logistic_iterations: int = 2000,
          trees: int = 200, rounds: int = 200, perceptron_iterations: int = 100, tune_trials: int = 0,
          validation_share: float = 0.2):
    """Fit the candidate models on the train split, evaluate on the test split, rank by recall.

    ``logistic_iterations`` is a bound (the optimiser stops when it has
    converged); ``trees`` of the forest are the work asked for.  ``rounds`` of
    boosting and ``perceptron_iterations`` are bounds too: both stop early on a
    stratified validation part carved out of the training rows, and the
    leaderboard says how many ``rounds`` the kept model has.  ``tune_trials`` > 0
    picks parameters of the first three by successive halving over that many
    draws (``operators.tuning``).  The test split stays unseen throughout.

    Every model begins with the label encoder, fitted on ``atm_raw``.  Returns
    (leaderboard, fitted models by name).  With ``out_dir`` leaderboard, trials
    and best_model are published there as one version, the leaderboard also as
    JSON in its metadata.
    """
    from ..operators import evaluate as ev
    from ..operators import model, tables, tuning
    rows = model.with_class_weights(model.with_raw_label(gold_df.filter(F.col("split") == "train")).drop("split"), "target")
    keys = ["target", "src_id"] if "src_id" in rows.columns else None
    # each fit goes over the rows hundreds of times: files of like size, else its tasks wait for the largest
    train_df = tables.evenly_stored(tuning.with_validation(rows, validation_share, hash_cols=keys), "train_rows")
    test_df = tables.evenly_stored(model.with_raw_label(gold_df.filter(F.col("split") == "test")), "test_rows")
    sw = train_df.agg(F.sum("weight")).first()[0]
    build = {
        "LogisticRegression": lambda p: model.logistic_pipeline(C=0.5, sum_weights=sw, encode=True,
                                                                **{"maxIter": logistic_iterations} | p),
        "RandomForest": lambda p: model.tree_pipeline("rf", encode=True, **{"numTrees": trees, "maxDepth": 8} | p),
        "GBT": lambda p: model.tree_pipeline("gbt", encode=True, validationIndicatorCol="is_validation", validationTol=1e-3,
                                             **{"maxIter": rounds, "maxDepth": 5} | p),
    }
    search = {"LogisticRegression": (LOGISTIC_SPACE, ("maxIter", min(20, logistic_iterations), logistic_iterations)),
              "RandomForest": (FOREST_SPACE, ("numTrees", min(10, trees), trees)),
              "GBT": (GBT_SPACE, ("maxIter", min(10, rounds), rounds))}
    trials = []

    def fit(name):
        if name == "MLP":
            held = train_df.filter("is_validation")
            over = tables.evenly_stored(model.oversample(train_df.filter("NOT is_validation")), "oversampled")
            return model.fit_mlp(over, max_iter=perceptron_iterations, encode=True, validation=held)
        params = {}
        if tune_trials:
            space, budget = search[name]
            # trials are scored on a part of the rows that models learn from; boosting keeps its own part for stopping
            pool_rows = train_df.drop("is_validation")
            if name == "GBT":
                pool_rows = cut_lineage(tuning.with_validation(pool_rows, validation_share, 7, hash_cols=keys, out="_part"), "gbt_rows")
                plain = lambda p: model.tree_pipeline("gbt", encode=True, **{"maxDepth": 5} | p)
                tuned = tuning.halving(plain, space, pool_rows.filter("NOT _part"), tune_trials, budget, hash_cols=keys)
            else:
                tuned = tuning.halving(build[name], space, pool_rows, tune_trials, budget, hash_cols=keys)
            trials.append(tuned.trials.withColumn("model", F.lit(name)))
            params = tuned.params
        return build[name](params).fit(train_df)

    # the candidates are fitted side by side: each is a long row of small jobs that leaves most cores idle
    names = [*build, "MLP"]

    def fit_and_score(name):
        m = fit(name)
        # stored once: each metric reads the scored rows, not the model
        return m, cut_lineage(model.score(test_df, m, out="score").select(F.col("target").alias("label"), "score"), "scored")

    with ThreadPoolExecutor(len(names)) as pool:
        done = dict(zip(names, pool.map(inheritable_thread_target(spark)(fit_and_score), names)))
    fitted = {name: m for name, (m, _) in done.items()}
    used = {"GBT": lambda m: m.stages[-1].getNumTrees, "RandomForest": lambda m: m.stages[-1].getNumTrees,
            "LogisticRegression": lambda m: m.stages[-1].summary.totalIterations, "MLP": lambda m: len(m.losses)}
    parts = []
    for name, (m, scored) in done.items():
        parts.append(ev.binary_metrics(scored, "label", "score").withColumn("model", F.lit(name))
                     .withColumn("rounds", F.lit(int(used[name](m)))))
    board = cut_lineage(ev.leaderboard(reduce(DataFrame.unionByName, parts)), "leaderboard")
    if out_dir:
        lines = [r.asDict() for r in board.orderBy(F.desc("recall_raw"), F.asc("model")).collect()]   # a line per model
        best = lines[0]["model"]
        tables = {"leaderboard": board}
        if trials:
            tables["trials"] = reduce(DataFrame.unionByName, trials)
        Store(spark, out_dir).replace(tables, {"best_model": fitted[best]}, {"best": best, "leaderboard": lines})
    return board, fitted


# ------------------------------------------------------------------ reports
def risk_report(scored_day: DataFrame, mode: str = "top_n", n: int = 5, threshold: float = 0.7,
                min_display: float = 0.0) -> dict:
    """Selection (top-N per hour or threshold) -> minimum display filter -> report frames."""
    from ..operators import profile, scoring
    if mode == "top_n":
        sel = profile.top_n_per_group(scored_day, "hour", "probability", n, ties=["latitude", "longitude"])
    elif mode == "threshold":
        sel = profile.filter_threshold(scored_day, threshold)
    else:
        raise ValueError(mode)
    sel = sel.filter(F.col("probability") >= min_display)
    return {
        "selection": scoring.with_marker_bands(sel),
        "summary": profile.global_summary(sel),
        "hourly": profile.hourly_stats(sel),
        "histogram": profile.histogram(sel, "probability", 10),
        "top10": profile.top_k(sel, "probability", 10, ties=["hour", "latitude", "longitude"],
                               cols=["hour", "latitude", "longitude", "probability"]),
    }


# ------------------------------------------------------------------ lenient load
def load_events_lenient(spark: SparkSession, paths, schema, dep: str = "988", bounds=None) -> DataFrame:
    """Events for the pre-compute stage: malformed rows dropped, department and wide-box filters,
    raw 'HH:MM:SS' time (unparseable -> dropped), missing weather code -> 1, ordered by time."""
    from ..functions.parse import parse_decimal_comma, try_assemble_datetime
    from ..params import WIDE_BOUNDS
    from ..sources import files
    lat_min, lat_max, lon_min, lon_max = bounds or WIDE_BOUNDS
    raw = files.scan_csv_lenient(spark, paths, schema)
    lat, lon = parse_decimal_comma("lat"), parse_decimal_comma("long")
    df = raw.filter((F.col("dep").cast("string") == dep) & F.col("lat").isNotNull() & F.col("long").isNotNull()
                    & F.col("hrmn").isNotNull() & lat.between(lat_min, lat_max) & lon.between(lon_min, lon_max))
    ts = try_assemble_datetime("jour", "mois", "an", "hrmn")
    df = df.select(lat.alias("latitude"), lon.alias("longitude"), ts.alias("datetime"),
                   F.coalesce(F.col("atm").cast("int"), F.lit(1)).alias("atm"), "filename") \
        .filter(F.col("datetime").isNotNull())
    return df.select("latitude", "longitude", F.hour("datetime").alias("hour"),
                     (F.dayofweek("datetime") - 1).alias("dayofweek"), F.month("datetime").alias("month"),
                     F.year("datetime").alias("year"), "atm", "datetime").orderBy("datetime")
