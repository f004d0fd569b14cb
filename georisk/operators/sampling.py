"""Deterministic sampling and exact splits.

Randomness is a hash of (seed, stream, draw id), so every result is a pure
function of the input: retries, executor loss and repartitioning cannot
change it, and the SQL oracles reproduce it.  Exact sizes are guaranteed --
no ``sample``/``randomSplit``, whose sizes are only expected values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import DRAW_BITS, hash_draw, index_draw, uniform_draw
from ..functions.parse import day_of_week
from ..session import cut_lineage
from .ordering import dense_index, expand_copies


def negative_size(n_events: int, n_safe: int, ratio: int = 22000, cap_per_point: int = 10) -> int:
    """min(n_events * ratio, n_safe * cap) -- the cap is what applies in practice."""
    return int(min(n_events * ratio, n_safe * cap_per_point))


def indexed(df: DataFrame, order) -> tuple[DataFrame, int]:
    """(df with dense ``_idx`` in ``order``, row count)."""
    out = dense_index(df, order)
    return out, out.count()


def draw_ids(spark, n: int, num_partitions: int | None = None) -> DataFrame:
    return spark.range(0, n, 1, num_partitions).withColumnRenamed("id", "sample_id") if num_partitions \
        else spark.range(n).withColumnRenamed("id", "sample_id")


def gather(draws: DataFrame, src_indexed: DataFrame, n_src: int, idx_col: str, cols, prefix: str = "") -> DataFrame:
    """Positional gather: join draws on the dense index of the source."""
    src = src_indexed.select(F.col("_idx").alias(idx_col), *[F.col(c).alias(prefix + c) for c in cols])
    return draws.join(src, idx_col).drop(idx_col)


def sample_with_replacement(spark, df: DataFrame, n: int, seed: int, stream: str, order, cols=None) -> DataFrame:
    """Exactly n uniform draws (with replacement) from ``df``; rows ordered by ``order`` for indexing."""
    src, n_src = indexed(df, order)
    if n_src == 0:
        raise ValueError("cannot sample from an empty frame")
    cols = cols or [c for c in df.columns]
    draws = draw_ids(spark, n).withColumn("_i", index_draw(seed, stream, n_src, "sample_id"))
    return gather(draws, src, n_src, "_i", cols)


def smallest_by_hash(spark, n: int, k: int, seed: int, stream: str, buckets_log2: int = 20) -> DataFrame:
    """One row ``(_h, _id)``: the k-th smallest (hash, id) of the ids 0..n-1; exactly k ids are not above it.

    Only counts per hash bucket and the ids of one bucket (about n / 2^20) are
    ordered; the ids themselves are never sorted or shuffled.
    """
    if not 0 < k <= n:
        raise ValueError(f"k = {k} is not between 1 and n = {n}")
    h = hash_draw(seed, stream, "sample_id")
    ids = draw_ids(spark, n).select("sample_id", h.alias("_h"), F.shiftright(h, DRAW_BITS - buckets_log2).alias("_b"))
    hist = ids.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))          # at most 2^buckets_log2 rows, whatever n is
    run = hist.withColumn("_cum", F.sum("_n").over(Window.orderBy("_b")))
    edge = run.filter((F.col("_cum") >= k) & (F.col("_cum") - F.col("_n") < k)) \
        .select("_b", (F.lit(k) - F.col("_cum") + F.col("_n")).alias("_k"))   # one row
    w = Window.partitionBy("_b").orderBy("_h", "sample_id")
    return (ids.join(F.broadcast(edge), "_b").withColumn("_r", F.row_number().over(w))
            .filter(F.col("_r") == F.col("_k")).select("_h", F.col("sample_id").alias("_id")))


def sample_times(spark, draws: DataFrame, events_idx: DataFrame, n_events: int, n: int, seed: int,
                 t_bounds: DataFrame, risk_ratio: float = 0.85, ts: str = "datetime") -> DataFrame:
    """Draw a time per sample: int(n * ratio) of them copied from observed
    times, the rest uniform (whole seconds) between the first and last
    observed time; which samples get which kind is a random permutation,
    decided by comparing a sample's hash with one threshold row.
    ``t_bounds`` is a one-row frame (_tmin, _tmax).
    """
    n_obs = int(n * risk_ratio)
    d = draws.withColumn("_ti", index_draw(seed, "time", n_events, "sample_id"))
    if n_obs > 0:
        last = smallest_by_hash(spark, n, n_obs, seed, "shuffle").select(F.struct("_h", "_id").alias("_last"))
        key = F.struct(hash_draw(seed, "shuffle", "sample_id").alias("_h"), F.col("sample_id").alias("_id"))
        d = d.crossJoin(F.broadcast(last)).withColumn("_copied", key <= F.col("_last")).drop("_last")   # one row
    else:
        d = d.withColumn("_copied", F.lit(False))
    obs = events_idx.select(F.col("_idx").alias("_ti"), F.col(ts).alias("_obs_ts"))
    d = d.join(obs, "_ti", "left").crossJoin(F.broadcast(t_bounds))
    total_s = F.timestamp_diff("MICROSECOND", F.col("_tmin"), F.col("_tmax")) / F.lit(1e6)
    offset = F.floor(uniform_draw(seed, "uniform", "sample_id") * total_s).cast("long")
    uni = F.timestamp_add("SECOND", offset, F.col("_tmin"))
    return d.withColumn(ts, F.when(F.col("_copied"), F.col("_obs_ts")).otherwise(uni)) \
        .drop("_copied", "_ti", "_obs_ts", "_tmin", "_tmax")


def generate_negatives(spark, events: DataFrame, safe_points: DataFrame, road_points: DataFrame | None = None,
                       seed: int = 42, ratio: int = 22000, cap_per_point: int = 10, risk_ratio: float = 0.85,
                       dow_base: str = "mon0") -> DataFrame:
    """Synthetic 'no event' rows (target = 0).

    Locations: uniform draws with replacement from the safe points (falling
    back to all road points when none is safe); times: observed/uniform
    mixture; weather code: drawn from the events.  With no road point at all,
    time, latitude, longitude and atm are each drawn independently from the
    events (marginal sampling).
    """
    ev = events.select("num_acc", "datetime", "latitude", "longitude", "atm")
    ev_idx, n_ev = indexed(ev, ["datetime", "num_acc"])
    if n_ev == 0:
        raise ValueError("no events to sample from")
    t_bounds = ev.agg(F.min("datetime").alias("_tmin"), F.max("datetime").alias("_tmax"))
    pts = safe_points.select("latitude", "longitude")
    pts_idx, n_pts = indexed(pts, ["latitude", "longitude"])
    if n_pts == 0 and road_points is not None:
        pts_idx, n_pts = indexed(road_points.select("latitude", "longitude"), ["latitude", "longitude"])
    if n_pts > 0:
        n = negative_size(n_ev, n_pts, ratio, cap_per_point)
        draws = draw_ids(spark, n).withColumn("_pi", index_draw(seed, "point", n_pts, "sample_id"))
        draws = gather(draws, pts_idx, n_pts, "_pi", ["latitude", "longitude"])
        draws = sample_times(spark, draws, ev_idx, n_ev, n, seed, t_bounds, risk_ratio)
    else:
        n = n_ev * ratio
        draws = draw_ids(spark, n)
        for c in ("datetime", "latitude", "longitude"):
            draws = draws.withColumn(f"_{c}", index_draw(seed, f"marginal_{c}", n_ev, "sample_id"))
            draws = gather(draws, ev_idx, n_ev, f"_{c}", [c])
    draws = draws.withColumn("_ai", index_draw(seed, "atm", n_ev, "sample_id"))
    draws = gather(draws, ev_idx, n_ev, "_ai", ["atm"])
    return draws.select(
        "sample_id", "datetime", "latitude", "longitude", "atm",
        F.hour("datetime").cast("int").alias("hour"), day_of_week("datetime", dow_base).alias("dayofweek"),
        F.month("datetime").cast("int").alias("month"), F.lit(0).alias("target"))


# ------------------------------------------------------------------ splits
def class_quotas(df: DataFrame, target: str, test_size: float, weight: str | None = None) -> DataFrame:
    """Per class: n, k_test.  Total test rows = ceil(test_size * N); classes get
    floor(test_size * n_c) plus one for the largest fractional remainders
    (ties: smaller class label).  One row per class.  ``weight`` counts a row
    that many times (collapsed copies).
    """
    cnt = F.sum(weight) if weight else F.count(F.lit(1))
    cls = df.groupBy(target).agg(cnt.cast("long").alias("n"))
    w_all = Window.partitionBy()           # over the class table (one row per class)
    q = F.lit(float(test_size)) * F.col("n")
    cls = cls.withColumns({"_base": F.floor(q), "_frac": q - F.floor(q)})
    cls = cls.withColumn("_extra", F.ceil(F.lit(float(test_size)) * F.sum("n").over(w_all)) - F.sum("_base").over(w_all))
    cls = cls.withColumn("_rr", F.row_number().over(Window.orderBy(F.desc("_frac"), F.asc(target))))
    return cls.select(target, "n", (F.col("_base") + F.when(F.col("_rr") <= F.col("_extra"), 1).otherwise(0))
                      .cast("long").alias("k_test"))


def stratified_split(df: DataFrame, target: str, test_size: float = 0.2, seed: int = 42, hash_cols=None,
                     buckets_log2: int = 20) -> DataFrame:
    """Exact stratified split: adds ``split`` ('test' / 'train').

    Within each class rows are ordered by a hash of ``hash_cols`` (then by
    every column); the first k_test are test.  Scale path, without shuffling
    the table itself:
      * the 60-bit hash is bucketed (2^20 buckets); one aggregation gives the
        per-class histogram (bounded by the bucket count) and, from it, the
        class quotas and the single boundary bucket of every class;
      * every row outside its class's boundary bucket is assigned by comparing
        bucket numbers -- a projection over the scan;
      * only boundary-bucket rows are ranked: identical rows are collapsed
        to (row, copies) first (so a row repeated for a third of the table is
        one row), ranked by a window over one bucket per class, and their
        test / train copies expanded again in chunks.
    """
    cols = df.columns
    hash_cols = list(hash_cols or cols)
    shift = DRAW_BITS - buckets_log2
    h = hash_draw(seed, "split", *hash_cols)
    hashed = df.withColumn("_h", h).withColumn("_b", F.shiftright("_h", shift))
    hist = hashed.groupBy(target, "_b").agg(F.count(F.lit(1)).alias("_cnt"))
    hist = cut_lineage(hist, "split_hist")            # small: classes x buckets
    quotas = class_quotas(hist, target, test_size, weight="_cnt")
    wc = Window.partitionBy(target).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    hist = hist.withColumn("_start", F.coalesce(F.sum("_cnt").over(wc), F.lit(0)))
    bnd = hist.join(quotas, target) \
        .filter((F.col("_start") < F.col("k_test")) & (F.col("_start") + F.col("_cnt") >= F.col("k_test"))) \
        .select(target, F.col("_b").alias("_bb"), F.col("_start").alias("_bstart"))
    # one row per class, stored: its size is known when the join is planned, so the table itself is not shuffled by class
    cls = cut_lineage(quotas.join(bnd, target, "left").select(target, "k_test", "_bb", "_bstart"), "split_classes")
    rows = hashed.join(cls, target)
    outer = rows.filter(F.col("_bb").isNull() | (F.col("_b") != F.col("_bb"))).select(
        *cols, F.when(F.col("_bb").isNotNull() & (F.col("_b") < F.col("_bb")), "test").otherwise("train")
        .alias("split"))
    inner = rows.filter(F.col("_b") == F.col("_bb")) \
        .groupBy(*cols, "_h", "k_test", "_bstart").agg(F.count(F.lit(1)).alias("_m"))
    order = [F.col("_h")] + [F.col(c).asc_nulls_first() for c in cols]
    wr = Window.partitionBy(target).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    inner = inner.withColumn("_t", F.least(F.col("_m"), F.greatest(
        F.lit(0), F.col("k_test") - F.col("_bstart") - (F.sum("_m").over(wr) - F.col("_m")))))
    parts = inner.select(*cols, F.explode(F.array(
        F.struct(F.lit("test").alias("split"), F.col("_t").alias("_k")),
        F.struct(F.lit("train").alias("split"), (F.col("_m") - F.col("_t")).alias("_k")))).alias("_p"))
    parts = parts.select(*cols, F.col("_p.split").alias("split"), F.col("_p._k").alias("_k"))
    return outer.unionByName(expand_copies(parts, "_k"))


def random_split(df: DataFrame, test_size: float = 0.2, seed: int = 42, hash_cols=None) -> DataFrame:
    """Exact, not stratified: one pseudo-class."""
    out = stratified_split(df.withColumn("_all", F.lit(0)), "_all", test_size, seed, hash_cols)
    return out.drop("_all")
