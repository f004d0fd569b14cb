"""Table maintenance, validation, fan-out, dedupe, constraints."""

import datetime as dt

from pyspark.sql import functions as F

from georisk.operators import ingest, tables
from georisk.session import scratch_path


def test_replace_partition_touches_one_date(spark):
    path = scratch_path(spark, "t_part")
    d1, d2 = dt.date(2026, 1, 1), dt.date(2026, 1, 2)
    df = spark.createDataFrame([(d1, 1, 0.1), (d2, 1, 0.2)], "date date, hour int, probability double")
    tables.replace_partition(df, path)
    tables.replace_partition(spark.createDataFrame([(d2, 5, 0.9)], "date date, hour int, probability double"), path)
    got = sorted((r.date, r.hour) for r in tables.read_table(spark, path).collect())
    assert got == [(d1, 1), (d2, 5)]


def test_row_ids_per_date(spark):
    d1, d2 = dt.date(2026, 1, 1), dt.date(2026, 1, 2)
    rows = [(d1, h, 0.0, 0.0) for h in (3, 1, 2)] + [(d2, h, 0.0, 0.0) for h in (5, 4)]
    df = spark.createDataFrame(rows, "date date, hour int, latitude double, longitude double")
    got = {(r.date, r.hour): r.id for r in tables.assign_row_ids(df).collect()}
    assert got == {(d1, 1): 1, (d1, 2): 2, (d1, 3): 3, (d2, 4): 1, (d2, 5): 2}


def test_left_join_fanout_equals_left_join(spark):
    parent = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k long, v string")
    child = spark.createDataFrame([(1,)] * 7 + [(2,)], "k long")
    got = sorted(tuple(r) for r in ingest.left_join_fanout(parent, child, "k", chunk=3).collect())
    want = sorted(tuple(r) for r in parent.join(child, "k", "left").collect())
    assert got == want and len(got) == 9


def test_validate_ranges(spark):
    df = spark.createDataFrame([(-22.0, 166.0, 1), (-25.0, 170.0, 4), (None, 166.0, 0)],
                               "latitude double, longitude double, atm int")
    rules = {**ingest.request_rules(time=None), "atm_code": F.col("atm").isin(1, 2, 3, 5)}
    out = [(r.valid, r.reasons) for r in ingest.validate_ranges(df, rules).collect()]
    assert out == [(True, ""), (False, "latitude,longitude,atm_code"), (False, "latitude,atm,atm_code")]


def test_constraints(spark):
    df = spark.createDataFrame([(1, None), (1, 2.0), (2, 3.0)], "k long, x double")
    v = {(r.constraint, r.key): r.n for r in ingest.check_table_constraints(df, ["x"], ["k"]).collect()}
    assert v == {("not_null", "x"): 1, ("unique", "1"): 2}


def test_dedupe_first(spark):
    df = spark.createDataFrame([(3, 1.0, 2.0, "c"), (1, 1.0, 2.0, "a"), (2, 5.0, 5.0, "b")],
                               "id long, latitude double, longitude double, tag string")
    got = sorted(tuple(r) for r in ingest.dedupe_first(df, ["latitude", "longitude"], "id").collect())
    assert got == [(1, 1.0, 2.0, "a"), (2, 5.0, 5.0, "b")]


def test_filter_bbox_closed(spark):
    df = spark.createDataFrame([(-23.0, 163.5), (-19.5, 168.0), (-25.0, 166.0), (None, 166.0)],
                               "latitude double, longitude double")
    assert ingest.filter_bbox(df).count() == 2


def test_bronze_job_from_csv_equals_direct(spark):
    from conftest import SF_SMALL
    from georisk.plans import jobs
    from georisk.sources import bindings as B
    base = scratch_path(spark, "t_bronze")
    carac = B.carac_raw(spark, SF_SMALL)
    carac.withColumn("y", F.col("an")).write.partitionBy("y").option("header", True).csv(base + "/carac")
    B.usagers_raw(spark, SF_SMALL).write.option("header", True).csv(base + "/usagers")
    out, counts = jobs.bronze(spark, base + "/carac/y=*/*.csv", base + "/usagers/*.csv")
    direct = ingest.parse_accidents(carac, B.usagers_raw(spark, SF_SMALL))
    assert sorted(tuple(r) for r in out.collect()) == sorted(tuple(r) for r in direct.collect())
    assert counts["caracteristiques"] == carac.count() and counts["accidents_nc"] == direct.count()


def test_rows_read_many_times_are_stored_in_even_files(spark):
    """Nine tenths of the rows in one part: the files are even, every row is there with its copies."""
    rows = spark.range(0, 9000, 1, 1).unionByName(spark.range(9000, 10000, 1, 4)).selectExpr("id % 4999 AS k", "'x' AS v")
    got = tables.evenly_stored(rows, "even", rows_per_file=1000)
    sizes = [r["count"] for r in got.groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) == 10 and max(sizes) <= 1100
    assert got.exceptAll(rows).count() == 0 and rows.exceptAll(got).count() == 0
    assert tables.evenly_stored(rows.filter("false"), "even").count() == 0
