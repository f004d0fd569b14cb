"""Scoring: a day of the grid, request batches, risk bands."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import bands
from ..functions.parse import day_of_week
from ..params import ENRICHMENT_DEFAULTS
from . import features as feat
from . import ingest
from . import model
from .model import apply_encoder


def expand_day(grid: DataFrame, day: DataFrame, atm_code: int | Column = 1, dow_base: str = "mon0") -> DataFrame:
    """grid x 24 hours for one date.

    ``day`` is a one-row frame with a ``date`` column.  The 24 hours and the
    date are broadcast (fixed size: 24 rows, 1 row); the grid keeps its own
    partitioning, so every grid partition emits its 24 hourly rows locally.
    """
    hours = grid.sparkSession.range(24).select(F.col("id").cast("int").alias("hour"))
    d = F.col("date")
    cal = day.select(d, day_of_week(d, dow_base).alias("dayofweek"), F.month(d).cast("int").alias("month"),
                     F.dayofmonth(d).cast("int").alias("day"))
    atm = atm_code if isinstance(atm_code, Column) else F.lit(int(atm_code))
    return grid.crossJoin(F.broadcast(hours)).crossJoin(F.broadcast(cal)).withColumn("atm", atm)


def encoded(rows: DataFrame, encoder: DataFrame | None) -> DataFrame:
    """``atm`` as the model was fitted on it; the raw code stays in ``atm_raw``."""
    rows = rows.withColumn("atm_raw", F.col("atm"))
    return apply_encoder(rows, "atm", encoder) if encoder is not None else rows


def scored(rows: DataFrame, scorer=None, encoder: DataFrame | None = None, out: str = "probability") -> DataFrame:
    """``rows`` with the probability of the formula, of a fitted pipeline or of a function of the rows.

    What has been fitted needs the label codes of its training rows: a pipeline
    that holds the encoder, or the ``encoder`` table.  Without either this raises.
    """
    if scorer is None:
        return rows.withColumn(out, feat.logistic_score())
    if encoder is None and not model.has_encoder(scorer):
        raise ValueError("a fitted scorer needs its label encoder: as a stage of the pipeline, or as encoder=")
    if hasattr(scorer, "stages"):
        return model.score(rows, scorer, out)
    p = scorer(rows)
    return p if out in p.columns else p.withColumnRenamed("probability", out)


def score_day(grid: DataFrame, day: DataFrame, atm_code: int = 1, profile: str = "pipeline", scorer=None,
              created_at: Column | None = None, encoder: DataFrame | None = None) -> DataFrame:
    """Every road-grid point for every hour of ``day``: features, probability, 9 output columns.

    A fitted model brings its label encoder, or needs the ``encoder`` that gold stored with its training rows.
    """
    rows = encoded(feat.build_features(expand_day(grid, day.limit(1), atm_code), profile), encoder)
    p = scored(rows, scorer, encoder)
    return p.select("date", "hour", "latitude", "longitude", "probability", F.col("atm_raw").alias("atm_code"),
                    "dayofweek", "month", (created_at if created_at is not None else F.current_timestamp())
                    .alias("created_at"))


def with_marker_bands(df: DataFrame, p: str = "probability") -> DataFrame:
    """Colour / level band and display labels of each prediction."""
    return df.withColumns({
        "colour": bands.marker_colour(p), "level": bands.marker_level(p),
        "hour_label": bands.hour_label("hour"), "probability_label": bands.percent_label(F.col(p), 1),
        "tooltip": F.format_string("%s - %s", bands.hour_short_label("hour"), bands.percent_label(F.col(p), 1)),
    })


# ---------------------------------------------------------------- requests
REQUEST_SCHEMA = "request_id long, latitude double, longitude double, datetime string, atm int"


def request_features(requests: DataFrame, profile: str = "pipeline") -> DataFrame:
    """Request rows (ISO datetime text) -> the 24 features; enrichment absent -> defaults,
    holiday fixed to 0 as the request path does."""
    ts = F.try_to_timestamp("datetime").cast("timestamp_ntz")
    r = requests.withColumns({
        "_ts": ts, "hour": F.hour(ts).cast("int"), "dayofweek": day_of_week(ts, "mon0"),
        "month": F.month(ts).cast("int"), "day": F.dayofmonth(ts).cast("int")})
    r = feat.build_features(r, profile, defaults=ENRICHMENT_DEFAULTS)
    return r.withColumn("is_holiday", F.lit(0)).drop("_ts")


def score_requests(requests: DataFrame, scorer=None, model_version: str = "formula-1",
                   encoder: DataFrame | None = None) -> DataFrame:
    """Per request: risk score, level, confidence, model version and the features used.

    A request whose datetime can't be read has a null score; ``split_requests`` takes such rows out first.
    """
    f = encoded(request_features(requests), encoder)
    p = scored(f, scorer, encoder, out="risk_score")
    return p.select(
        "request_id", "risk_score", bands.risk_level("risk_score").alias("risk_level"),
        bands.confidence("risk_score").alias("confidence"), F.lit(model_version).alias("model_version"),
        F.struct("latitude", "longitude", "datetime", "hour", (F.col("is_weekend") == 1).alias("is_weekend"))
        .alias("features_used"))


def split_requests(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid requests, and the rejected ones with ``reasons`` (names of the rules that failed)."""
    valid, rejected = ingest.split_valid(requests, ingest.request_rules())
    return valid, rejected.drop("valid")


ALLOWED_ATM_CODES = (1, 2, 3, 5)


def parse_query_date(spark, text: str | None = None, atm_code: int = 1, max_days: int | None = None) -> DataFrame:
    """One-row frame (date, atm_code) for a scoring run: ``text`` as YYYY-MM-DD, default tomorrow.

    Weather codes outside the allowed set, and dates more than ``max_days`` after today, are rejected before any
    work starts."""
    if text and max_days is not None and date.fromisoformat(text) > date.today() + timedelta(days=max_days):
        raise ValueError(f"{text} is more than {max_days} days ahead")
    if atm_code not in ALLOWED_ATM_CODES:
        raise ValueError(f"atm code {atm_code} not in {ALLOWED_ATM_CODES}")
    d = F.to_date(F.lit(text), "yyyy-MM-dd") if text else F.date_add(F.current_date(), 1)
    out = spark.range(1).select(d.alias("date"), F.lit(atm_code).alias("atm_code"))
    return out


def weather_code(label) -> Column:
    """Weather label -> atm code (unknown -> 1)."""
    from ..functions.parse import map_lookup
    from ..params import WEATHER_CODES
    return map_lookup(label, WEATHER_CODES, 1).cast("int")
