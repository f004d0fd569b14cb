"""Feature vector: columns, cyclic values, calendar flags (both hour profiles)."""

import datetime as dt
import math

from georisk.operators import features as feat
from georisk.params import FEATURE_COLUMNS

BASE = [(-22.0, 166.0, 14, 2, 7, 1, 14), (-22.5, 166.5, 8, 5, 1, 2, 1), (-21.0, 167.0, 18, 6, 12, 1, 25)]
SCHEMA = "latitude double, longitude double, hour int, dayofweek int, month int, atm int, day int"


def build(spark, rows=BASE, profile="pipeline"):
    return feat.build_features(spark.createDataFrame(rows, SCHEMA), profile)


def test_24_columns_in_order(spark):
    out = feat.feature_vector(build(spark))
    assert out.columns == list(FEATURE_COLUMNS)
    assert len(out.columns) == 24
    assert out.count() == 3


def test_defaults_attached(spark):
    r = build(spark).first()
    assert (r.road_type, r.speed_limit, r.accident_density_5km, r.dist_to_noumea_km) == (2, 50, 0, 100)


def test_cyclic_values(spark):
    rows = [(-22.0, 166.0, h, 0, 1, 1, 2) for h in (0, 6, 12, 18, 23)]
    out = build(spark, rows).orderBy("hour").collect()
    for r in out:
        assert abs(r.hour_sin - math.sin(2 * math.pi * r.hour / 24)) < 1e-12
        assert abs(r.hour_cos - math.cos(2 * math.pi * r.hour / 24)) < 1e-12
        assert abs(r.hour_sin ** 2 + r.hour_cos ** 2 - 1) < 1e-12


def test_flags_pipeline_profile(spark):
    rows = [(-22.0, 166.0, h, d, 3, 1, 2) for h, d in [(7, 5), (17, 6), (20, 2), (12, 1), (5, 4)]]
    got = {(r.hour, r.dayofweek): (r.is_weekend, r.is_rush_morning, r.is_rush_evening, r.is_night)
           for r in build(spark, rows).collect()}
    assert got[(7, 5)] == (1, 1, 0, 0)
    assert got[(17, 6)] == (1, 0, 1, 0)
    assert got[(20, 2)] == (0, 0, 0, 1)
    assert got[(12, 1)] == (0, 0, 0, 0)
    assert got[(5, 4)] == (0, 0, 0, 1)


def test_flags_daily_profile(spark):
    rows = [(-22.0, 166.0, h, 1, 3, 1, 2) for h in (6, 7, 9, 19, 21, 22)]
    got = {r.hour: (r.is_rush_morning, r.is_rush_evening, r.is_night) for r in build(spark, rows, "daily").collect()}
    assert got == {6: (0, 0, 1), 7: (1, 0, 0), 9: (1, 0, 0), 19: (0, 1, 0), 21: (0, 0, 0), 22: (0, 0, 1)}


def test_holidays(spark):
    yes = [(1, 1), (5, 1), (5, 8), (7, 14), (9, 24), (11, 1), (11, 11), (12, 25)]
    no = [(6, 15), (3, 20)]
    rows = [(-22.0, 166.0, 10, 1, m, 1, d) for m, d in yes + no]
    got = {(r.month, r.day): r.is_holiday for r in build(spark, rows).collect()}
    assert all(got[k] == 1 for k in yes) and all(got[k] == 0 for k in no)


def test_school_months(spark):
    rows = [(-22.0, 166.0, 10, 1, m, 1, 2) for m in (1, 7, 8, 12, 5, 10)]
    got = {r.month: r.school_holidays for r in build(spark, rows).collect()}
    assert got == {1: 1, 7: 1, 8: 1, 12: 1, 5: 0, 10: 0}


def test_interaction_ranges(spark):
    r = build(spark, [(-22.0, 166.0, 14, 3, 1, 1, 2)]).first()
    assert abs(r.lat_hour - (-22.0 * 14 / 24)) < 1e-12
    assert abs(r.lon_dayofweek - 166.0 * 3 / 7) < 1e-12


def test_time_parts_from_timestamp(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 1, 25, 14, 30),)], "datetime timestamp_ntz")
    r = feat.add_time_parts(df).first()
    assert (r.hour, r.dayofweek, r.month, r.day) == (14, 6, 1, 25)


def test_feature_metadata(spark):
    rows = feat.feature_metadata(spark).orderBy("order_index").collect()
    assert [r.feature_name for r in rows] == list(FEATURE_COLUMNS)
    assert [r.order_index for r in rows] == list(range(24))
