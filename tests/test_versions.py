"""Versioned tables: readers see the whole of a publication or nothing of it."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from georisk.operators import tables
from georisk.operators.versions import Conflict, Store
from georisk.session import scratch_path

D1, D2, D3 = (dt.date(2026, 1, d) for d in (1, 2, 3))
SCHEMA = "date date, hour int, v string"


def days(spark, *rows):
    return spark.createDataFrame([(d, h, f"r{h}") for d, h in rows], SCHEMA)


def test_a_failure_between_the_steps_leaves_the_old_rows(spark, monkeypatch):
    path = scratch_path(spark, "t_fail")
    tables.replace_table(spark.range(3), path=path)
    before = tables.read_table(spark, path)

    def fail(*_, **__):
        raise OSError("lost")
    monkeypatch.setattr(Store, "publish", fail)
    with pytest.raises(OSError):
        tables.replace_table(spark.range(9), path=path)
    with pytest.raises(OSError):
        tables.replace_partition(days(spark, (D1, 1)), path + "-days")
    monkeypatch.undo()
    assert before.count() == tables.read_table(spark, path).count() == 3
    tables.replace_table(spark.range(9), path=path)
    assert before.count() == 3 and tables.read_table(spark, path).count() == 9
    with pytest.raises(FileNotFoundError):
        tables.read_table(spark, path + "-days")


def test_two_dates_and_an_empty_run_are_one_step(spark):
    path = scratch_path(spark, "t_days")
    store = Store(spark, path)
    tables.replace_partition(days(spark, (D1, 1), (D2, 2), (D3, 3)), path)
    tables.replace_partition(days(spark, (D1, 10), (D2, 20)), path)
    assert len(store.versions()) == 2
    rows = lambda version=None: sorted((r.date, r.hour, r.v) for r in store.read(version=version).collect())
    assert rows() == [(D1, 10, "r10"), (D2, 20, "r20"), (D3, 3, "r3")]
    tables.replace_partition(days(spark), path, values=[D2, D3])
    assert rows() == [(D1, 10, "r10")] and len(store.versions()) == 3
    tables.replace_partition(days(spark), path, values=[D1])
    assert rows() == [] and store.read().columns == ["date", "hour", "v"]
    assert rows(1) == [(D1, 1, "r1"), (D2, 2, "r2"), (D3, 3, "r3")]


def test_a_failed_check_publishes_nothing(spark):
    path = scratch_path(spark, "t_check")
    tables.replace_partition(days(spark, (D1, 1)), path)

    def check(name, rows):
        if rows.filter("hour > 23").count():
            raise ValueError("hour")
    with pytest.raises(ValueError):
        tables.replace_partition(days(spark, (D1, 99)), path, check=check)
    assert [r.hour for r in tables.read_table(spark, path).collect()] == [1]


def test_a_second_writer(spark, monkeypatch):
    path = scratch_path(spark, "t_two")
    store = Store(spark, path)
    store.replace_partitions(days(spark, (D1, 1)), "date")
    with pytest.raises(Conflict):
        store.publish({}, base=0)
    inner, met = Store.publish, []

    def late(self, entries, meta=None, base=None):   # another writer publishes first, once
        if not met:
            met.append(1)
            Store(spark, path).replace_partitions(days(spark, (D3, 3)), "date")
        return inner(self, entries, meta, base)
    monkeypatch.setattr(Store, "publish", late)
    store.replace_partitions(days(spark, (D2, 2)), "date")
    assert sorted(r.hour for r in store.read().collect()) == [1, 2, 3] and len(store.versions()) == 3
    with pytest.raises(ValueError):
        store.replace_partitions(days(spark, (D2, 2)), "hour")


def test_dates_are_pruned_and_null_is_a_partition(spark):
    path = scratch_path(spark, "t_prune")
    tables.replace_partition(days(spark, (D1, 1), (D2, 2), (None, 3)), path)
    found = tables.read_table(spark, path)
    assert sorted((r.date is None, r.hour) for r in found.collect()) == [(False, 1), (False, 2), (True, 3)]
    one = found.filter(F.col("date") == F.lit(D2))
    assert "PartitionFilters: [isnotnull(date" in one._jdf.queryExecution().toString()
    assert [r.hour for r in one.collect()] == [2]
    tables.replace_partition(days(spark), path, values=[None])
    assert tables.read_table(spark, path).filter("date IS NULL").count() == 0


def test_tables_models_and_meta_under_one_version(spark):
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import SQLTransformer
    store = Store(spark, scratch_path(spark, "t_bundle"))
    assert store.manifest() is None and store.meta() == {}
    model = lambda k: PipelineModel([SQLTransformer(statement=f"SELECT *, id * {k} AS y FROM __THIS__")])
    store.replace({"a": spark.range(2), "b": spark.range(3)}, {"model": model(2)}, {"note": "one"})
    store.replace({"a": spark.range(4)}, {"model": model(3)}, {"note": "two"})
    assert store.read("a").count() == 4 and store.read("b", version=1).count() == 3
    assert store.meta() == {"note": "two"} and store.meta(1) == {"note": "one"}
    assert store.load_model().transform(spark.range(2)).agg(F.sum("y")).first()[0] == 3
    assert store.load_model(version=1).transform(spark.range(2)).agg(F.sum("y")).first()[0] == 2
    with pytest.raises(FileNotFoundError):
        store.read("b")
    assert store.vacuum(keep=1) == 4     # a manifest, two tables, a model
    assert store.versions() == [2] and store.read("a").count() == 4
