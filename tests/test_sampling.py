"""Exact sizes, determinism under repartitioning, exact stratified quotas."""

from pyspark.sql import functions as F

from georisk.operators import ordering, sampling


def test_dense_index_is_dense_and_ordered(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k")).repartition(7)
    out = ordering.dense_index(df, ["k"]).collect()
    assert sorted(r._idx for r in out) == list(range(1000))
    assert all(r._idx == r.k for r in out)          # k is a permutation of 0..999


def test_prefix_sums(spark):
    df = spark.range(1, 501).select(F.col("id").alias("k"), F.lit(2).alias("v")).repartition(5)
    out = {r.k: r.v_cum for r in ordering.prefix_sums(df, ["k"], ["v"]).collect()}
    assert all(out[k] == 2 * k for k in range(1, 501))


def test_expand_copies_chunks(spark):
    df = spark.createDataFrame([("a", 5), ("b", 0), ("c", 23)], "k string, n long")
    out = ordering.expand_copies(df, "n", chunk=4).groupBy("k").count().collect()
    assert {r.k: r["count"] for r in out} == {"a": 5, "c": 23}


def test_sample_with_replacement_exact_and_repeatable(spark):
    src = spark.range(50).select(F.col("id").alias("k"))
    a = sampling.sample_with_replacement(spark, src, 1234, 42, "s", ["k"])
    b = sampling.sample_with_replacement(spark, src.repartition(3), 1234, 42, "s", ["k"])
    ra = sorted((r.sample_id, r.k) for r in a.collect())
    rb = sorted((r.sample_id, r.k) for r in b.collect())
    assert len(ra) == 1234 and ra == rb
    assert len({k for _, k in ra}) > 40


def test_stratified_split_exact_quotas(spark):
    rows = [(i, "A" if i % 10 < 7 else ("B" if i % 10 < 9 else "C")) for i in range(1003)]
    df = spark.createDataFrame(rows, "id long, cls string")
    out = sampling.stratified_split(df, "cls", 0.2, 42, hash_cols=["id"])
    counts = {(r.cls, r.split): r["count"] for r in out.groupBy("cls", "split").count().collect()}
    n = {c: sum(1 for _, k in rows if k == c) for c in "ABC"}
    test_total = sum(v for (c, s), v in counts.items() if s == "test")
    assert test_total == -(-1003 * 2 // 10)           # ceil(0.2 * 1003) = 201
    for c in "ABC":
        assert counts[(c, "test")] + counts[(c, "train")] == n[c]
        assert abs(counts[(c, "test")] - 0.2 * n[c]) < 1
    assert out.count() == 1003


def test_stratified_split_leaves_the_table_where_it_is(spark):
    """A few classes must not be the keys that the whole table is shuffled and sorted by."""
    df = spark.range(30000).selectExpr("id", "CAST(id % 3 AS INT) AS cls", "repeat('x', 40) AS filler")
    key, was = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set(key, "20000")   # less than the histogram, more than the classes
    try:
        out = sampling.stratified_split(df, "cls", 0.2, 42, hash_cols=["id"])
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
        assert {(r["cls"], r["split"]): r["count"] for r in out.groupBy("cls", "split").count().collect()} == {
            (c, s): n for c in range(3) for s, n in (("test", 2000), ("train", 8000))}
    finally:
        spark.conf.set(key, was)


def test_stratified_split_with_copies(spark):
    # one repeated row holds a third of the data: it is split by multiplicity, not dropped
    rows = [(0, "A")] * 400 + [(i, "A") for i in range(1, 801)]
    df = spark.createDataFrame(rows, "id long, cls string")
    out = sampling.stratified_split(df, "cls", 0.25, 7, hash_cols=["id"])
    assert out.count() == 1200
    assert out.filter("split = 'test'").count() == 300
    assert out.filter("id = 0").count() == 400


def test_split_repeatable(spark):
    df = spark.range(500).select("id", (F.col("id") % 2).alias("t"))
    a = {r.id for r in sampling.stratified_split(df, "t", 0.2, 1, ["id"]).filter("split='test'").collect()}
    b = {r.id for r in sampling.stratified_split(df.repartition(9), "t", 0.2, 1, ["id"]).filter("split='test'").collect()}
    assert a == b and len(a) == 100


def test_negative_size():
    assert sampling.negative_size(100, 50) == 500
    assert sampling.negative_size(1, 10**9) == 22000
