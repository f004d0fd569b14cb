"""Hand-computed scalar cases (FIXTURES §4) and fixed constants."""

import datetime as dt
import hashlib
import math

from pyspark.sql import functions as F

from georisk.functions import bands, geo, hashing, parse
from georisk.params import EARTH_RADIUS_KM, compat_radius_rad
from georisk.sources.grid import grid_shape


def one(spark, col, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(col).collect()]


def test_hrmn_correct(spark):
    data = [(25, 1, 2026, h) for h in ["14:30", "14:05", "930", "1430", "5"]]
    out = one(spark, parse.assemble_datetime("jour", "mois", "an", "hrmn", "correct"), data,
              "jour int, mois int, an int, hrmn string")
    assert [(t.hour, t.minute) for t in out] == [(14, 30), (14, 5), (9, 30), (14, 30), (0, 5)]


def test_hrmn_compat_reproduces_defect(spark):
    data = [(25, 1, 2026, h) for h in ["14:30", "14:05", "14:30:00"]]
    out = one(spark, parse.assemble_datetime("jour", "mois", "an", "hrmn", "compat"), data,
              "jour int, mois int, an int, hrmn string")
    assert [(t.hour, t.minute) for t in out] == [(14, 3), (14, 0), (14, 3)]


def test_day_of_week_codings(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 1, 25, 10), dt.datetime(2026, 1, 23, 10))], "sun timestamp_ntz, fri timestamp_ntz")
    r = df.select(parse.day_of_week("sun", "sun0"), parse.day_of_week("sun", "iso"), parse.day_of_week("sun", "mon0"),
                  parse.day_of_week("fri", "iso"), parse.day_of_week("fri", "mon0")).first()
    assert tuple(r) == (0, 7, 6, 5, 4)
    # Friday counts as weekend with ISO coding (dow >= 5) but not with Mon=0
    assert (r[3] >= 5, r[4] >= 5) == (True, False)


def test_speed_parse(spark):
    out = one(spark, parse.parse_speed("s"), [("50",), ("80 km/h",), ("walk",), (None,)], "s string")
    assert out == [50, 80, 50, 50]


def test_road_class(spark):
    df = spark.createDataFrame([(["motorway"],), (["primary", "x"],), ([],), (["track"],), (None,)], "h array<string>")
    out = [r[0] for r in df.select(parse.road_type_code(parse.first_of_list("h"))).collect()]
    assert out == [5, 3, 1, 1, 1]


def test_decimal_comma(spark):
    out = one(spark, parse.parse_decimal_comma("s"), [(" -22,5",), ("166,25 ",), ("junk",)], "s string")
    assert out == [-22.5, 166.25, None]


def test_risk_level_and_confidence(spark):
    df = spark.createDataFrame([(0.19,), (0.2,), (0.5,), (0.8,)], "p double")
    assert [r[0] for r in df.select(bands.risk_level("p")).collect()] == ["LOW", "MEDIUM", "HIGH", "CRITICAL"]
    assert abs(spark.range(1).select(bands.confidence(F.lit(0.2))).first()[0] - 0.8) < 1e-12


def test_marker_bands(spark):
    df = spark.createDataFrame([(0.85,), (0.7,), (0.3,)], "p double")
    assert [r[0] for r in df.select(bands.marker_colour("p")).collect()] == ["red", "orange", "yellow"]


def test_interaction_value(spark):
    v = spark.range(1).select(F.lit(-22.0) * F.lit(14) / 24).first()[0]
    assert round(v, 6) == -12.833333


def test_p90_linear(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "x double")
    assert abs(df.select(F.percentile("x", 0.9)).first()[0] - 3.7) < 1e-12


def test_grid_size():
    assert grid_shape() == (175, 225)


def test_compat_radius_km():
    assert round(compat_radius_rad(5.0) * EARTH_RADIUS_KM, 3) == 286.982


def test_hash_draw_constant(spark):
    assert spark.range(1).select(hashing.hash_draw(42, "choice", F.lit(7))).first()[0] == int(hashlib.md5(b"42|choice|7").hexdigest()[:15], 16)


def test_rounding_modes(spark):
    r = spark.range(1).select(F.bround(F.lit(0.0625), 3), F.round(F.lit(0.0625), 3)).first()
    assert (float(r[0]), float(r[1])) == (0.062, 0.063)


def test_vincenty_against_known_distance(spark):
    # ellipsoidal distance of 1 degree of latitude at the equator: 110.574 km
    df = spark.createDataFrame([(0.0, 0.0)], "latitude double, longitude double")
    d = geo.with_geodesic_km(df, "latitude", "longitude", 1.0, 0.0).first()["geodesic_km"]
    assert abs(d - 110.574389) < 1e-3
    zero = geo.with_geodesic_km(df, "latitude", "longitude", 0.0, 0.0).first()["geodesic_km"]
    assert zero == 0.0


def test_haversine(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 1.0)], "a double, b double, c double, d double")
    km = df.select(geo.haversine_km("a", "b", "c", "d")).first()[0]
    assert abs(km - EARTH_RADIUS_KM * math.radians(1.0)) < 1e-9


def _geodesic_km(spark, rows):
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    for name, expr in geo.vincenty_stages("a", "b", "c", "d"):
        df = df.withColumn(name, F.expr(expr))
    return [r.geodesic_km for r in df.collect()]


def test_geodesic_of_a_published_line(spark):
    """Flinders Peak - Buninyong, 54 972.271 m in the survey manuals (GRS80, here to the millimetre as WGS84)."""
    deg = lambda d, m, s: math.copysign(abs(d) + m / 60 + s / 3600, d)
    line = (deg(-37, 57, 3.72030), deg(144, 25, 29.52440), deg(-37, 39, 10.15610), deg(143, 55, 35.38390))
    assert abs(_geodesic_km(spark, [line])[0] - 54.972271) < 2e-6


def test_geodesic_against_integrated_lines_in_the_study_box(spark):
    """Follow a geodesic by its differential equation for a known length; the inverse must return that length."""
    a, f = 6378137.0, 1 / 298.257223563
    e2 = f * (2 - f)

    def slope(lat, lon, az):
        w = math.sqrt(1 - e2 * math.sin(lat) ** 2)
        m, n = a * (1 - e2) / w ** 3, a / w
        return math.cos(az) / m, math.sin(az) / (n * math.cos(lat)), math.tan(lat) * math.sin(az) / n
    rows, lengths = [], []
    for lat, lon, az, length in ((-22.2758, 166.458, 0.3, 40_000), (-22.2758, 166.458, 2.5, 150_000),
                                 (-20.5, 164.2, 1.6, 260_000), (-21.0, 165.5, 4.0, 90_000)):
        state, steps = [math.radians(lat), math.radians(lon), az], 2000
        h = length / steps
        for _ in range(steps):
            k1 = slope(*state)
            k2 = slope(*[x + h / 2 * k for x, k in zip(state, k1)])
            k3 = slope(*[x + h / 2 * k for x, k in zip(state, k2)])
            k4 = slope(*[x + h * k for x, k in zip(state, k3)])
            state = [x + h / 6 * (p + 2 * q + 2 * r + s) for x, p, q, r, s in zip(state, k1, k2, k3, k4)]
        rows.append((lat, lon, math.degrees(state[0]), math.degrees(state[1])))
        lengths.append(length / 1000)
    for got, want in zip(_geodesic_km(spark, rows), lengths):
        assert abs(got - want) < 1e-6
