"""The 24-column feature vector as one projection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions.parse import day_of_week
from ..functions.sqltext import dbl
from ..params import ENRICHMENT_DEFAULTS, FEATURE_COLUMNS, PROFILES


def add_time_parts(df: DataFrame, ts: str = "datetime", dow_base: str = "mon0") -> DataFrame:
    """hour, dayofweek (chosen coding), month, day from a timestamp column."""
    t = F.col(ts)
    return df.withColumns({
        "hour": F.hour(t).cast("int"),
        "dayofweek": day_of_week(t, dow_base),
        "month": F.month(t).cast("int"),
        "day": F.dayofmonth(t).cast("int"),
    })


def attach_defaults(df: DataFrame, defaults: dict | None = None) -> DataFrame:
    """Constant enrichment columns for those absent from the frame."""
    defaults = defaults if defaults is not None else ENRICHMENT_DEFAULTS
    missing = {k: F.lit(v) for k, v in defaults.items() if k not in df.columns}
    return df.withColumns(missing) if missing else df


def build_features(df: DataFrame, profile: str = "pipeline", defaults: dict | None = None) -> DataFrame:
    """Interactions, calendar flags, cyclic encodings and calendar features.

    Expects latitude, longitude, hour, dayofweek, month, atm and either
    ``day`` or ``datetime``; enrichment columns missing from the input get
    their defaults.  Everything is one ``withColumns`` projection, so the
    whole vector is computed inside one codegen stage.
    """
    prof = PROFILES[profile]
    df = attach_defaults(df, defaults)
    lat, lon, hour, dow, month = (F.col(c) for c in ("latitude", "longitude", "hour", "dayofweek", "month"))
    day = F.col("day") if "day" in df.columns else F.dayofmonth("datetime")
    hs, hc = cal.cyclic(hour, 24)
    ds, dc = cal.cyclic(dow, 7)
    return df.withColumns({
        "lat_hour": lat * hour / 24,
        "lon_hour": lon * hour / 24,
        "lat_dayofweek": lat * dow / 7,
        "lon_dayofweek": lon * dow / 7,
        "is_weekend": cal.is_weekend(dow, prof),
        "is_rush_morning": cal.is_rush_morning(hour, prof),
        "is_rush_evening": cal.is_rush_evening(hour, prof),
        "is_night": cal.is_night(hour, prof),
        "hour_sin": hs,
        "hour_cos": hc,
        "dayofweek_sin": ds,
        "dayofweek_cos": dc,
        "is_holiday": cal.is_holiday(month, day),
        "school_holidays": cal.school_holidays(month),
    })


def feature_vector(df: DataFrame, keep=()) -> DataFrame:
    """Select the canonical 24 columns (plus ``keep``) in order."""
    return df.select(*keep, *FEATURE_COLUMNS)


def require_columns(df: DataFrame, cols=FEATURE_COLUMNS) -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing feature columns: {missing}")


def feature_metadata(spark, cols=FEATURE_COLUMNS) -> DataFrame:
    """(feature_name, order_index) from 0."""
    return spark.range(1).select(F.posexplode(F.array(*[F.lit(c) for c in cols])).alias("order_index", "feature_name")) \
        .select("feature_name", F.col("order_index").cast("int").alias("order_index"))


def feature_profile(df: DataFrame, cols=FEATURE_COLUMNS) -> DataFrame:
    """Name, order, null count, minimum and maximum of each feature over all rows: one aggregation, then a row each."""
    aggs = [a for i, c in enumerate(cols) for a in (
        F.count_if(F.col(c).isNull()).alias(f"n{i}"), F.min(F.col(c).cast("double")).alias(f"a{i}"),
        F.max(F.col(c).cast("double")).alias(f"b{i}"))]
    rows = F.array(*[F.struct(F.lit(c).alias("feature_name"), F.lit(i).alias("order_index"), F.col(f"n{i}").alias("n_null"),
                              F.col(f"a{i}").alias("least"), F.col(f"b{i}").alias("most")) for i, c in enumerate(cols)])
    return df.agg(*aggs).select(F.explode(rows).alias("r")).select("r.*")


# -------------------------------------------------------------- scoring
# A logistic scorer as a column expression: probability = sigmoid(b + w.x).
# Coefficients can come from a fitted spark.ml LogisticRegressionModel
# (see model.logistic_coefficients) so scoring stays JVM-side.

# Fixed demonstration coefficients of the formula scorer used by the
# registered queries (a stand-in for a fitted model; any fitted coefficient
# set can be passed instead).  The weights are dyadic fractions: with integer
# features every partial sum is exact, so equal scores stay exactly equal
# whatever order an engine adds the terms in, and ties resolve by the key.
FORMULA_INTERCEPT = -2.5
FORMULA_WEIGHTS = {
    "is_night": 0.75, "is_rush_morning": 0.375, "is_rush_evening": 0.625, "is_weekend": 0.25,
    "speed_limit": 0.015625, "road_type": 0.125, "accident_density_5km": 0.046875,
    "dist_to_noumea_km": -0.0078125, "atm": 0.09375, "hour_sin": -0.25, "is_holiday": 0.25,
}


def logistic_score(weights: dict | None = None, intercept: float | None = None):
    weights = FORMULA_WEIGHTS if weights is None else weights
    intercept = FORMULA_INTERCEPT if intercept is None else intercept
    z = F.lit(float(intercept))
    for name, w in weights.items():
        z = z + F.lit(float(w)) * F.col(name)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def logistic_score_sql(weights: dict | None = None, intercept: float | None = None) -> str:
    weights = FORMULA_WEIGHTS if weights is None else weights
    intercept = FORMULA_INTERCEPT if intercept is None else intercept
    z = f"({dbl(intercept)}"
    for name, w in weights.items():
        z += f" + {dbl(w)} * {name}"
    return f"1e0 / (1e0 + exp(-{z})))"
