"""Statistics, distributions and top-k reports.

All aggregations are plain ``groupBy().agg()`` (partial aggregation before the
shuffle, so a hot group collapses map-side).  Top-k per group uses
``row_number() <= k``, which Catalyst turns into a ``WindowGroupLimit`` that
keeps only k rows per group in every task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _round(c, decimals: int | None, half_even: bool):
    if decimals is None:
        return c
    return F.bround(c, decimals) if half_even else F.round(c, decimals)


# ---------------------------------------------------------------- counts
def row_count(df: DataFrame, name: str = "n") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def stage_stats(**frames: DataFrame) -> DataFrame:
    """One row, one count column per named frame (each counted once)."""
    it = iter(frames.items())
    name, df = next(it)
    out = row_count(df, name)
    for name, df in it:
        out = out.crossJoin(row_count(df, name))   # 1 x 1 rows: scalar combination
    return out


def class_balance(df: DataFrame, target: str = "target") -> DataFrame:
    """Count and share per class, and the ratio to the smallest class."""
    w = Window.partitionBy()   # over the per-class aggregate only (one row per class)
    g = df.groupBy(target).agg(F.count(F.lit(1)).alias("n"))
    return g.select(
        target, "n",
        (F.col("n") / F.sum("n").over(w)).alias("share"),
        (F.col("n") / F.min("n").over(w)).alias("ratio_to_min"),
    )


def distinct_counts(df: DataFrame, cols) -> DataFrame:
    """Number of distinct values per column (one row)."""
    return df.agg(*[F.countDistinct(c).alias(f"n_{c}") for c in cols])


def count_by_year(df: DataFrame, ts: str = "datetime") -> DataFrame:
    return df.groupBy(F.year(ts).cast("int").alias("year")).agg(F.count(F.lit(1)).alias("n")).orderBy("year")


def null_profile(df: DataFrame, cols, ts: str | None = None) -> DataFrame:
    """Null count per column and, if given, min/max of a time column (one row)."""
    aggs = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in cols]
    if ts:
        aggs += [F.min(ts).alias("min_time"), F.max(ts).alias("max_time")]
    return df.agg(F.count(F.lit(1)).alias("n_rows"), *aggs)


def mean_centre(df: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    return df.agg(F.avg(lat).alias("centre_lat"), F.avg(lon).alias("centre_lon"))


# ------------------------------------------------------------ prediction stats
def hourly_stats(df: DataFrame, p: str = "probability", decimals: int | None = 3,
                 half_even: bool = True) -> DataFrame:
    """Per hour: count, mean, max, min (rounded like pandas: half-even)."""
    return df.groupBy("hour").agg(
        F.count(F.lit(1)).alias("n_points"),
        _round(F.avg(p), decimals, half_even).alias("mean_p"),
        _round(F.max(p), decimals, half_even).alias("max_p"),
        _round(F.min(p), decimals, half_even).alias("min_p"),
    )


def prediction_day_stats(df: DataFrame, p: str = "probability", high: float = 0.5) -> DataFrame:
    """Per date: total points, average, maximum, points with p >= high."""
    return df.groupBy("date").agg(
        F.count(F.lit(1)).alias("total_points"),
        F.avg(p).alias("avg_probability"),
        F.max(p).alias("max_probability"),
        F.count_if(F.col(p) >= high).alias("high_risk_points"),
    )


def global_summary(df: DataFrame, p: str = "probability") -> DataFrame:
    """Total, mean, max and the hour with most rows (smallest hour on a tie)."""
    per_hour = df.groupBy("hour").agg(F.count(F.lit(1)).alias("n"))
    peak = per_hour.agg(F.max_by("hour", F.struct(F.col("n"), -F.col("hour"))).alias("peak_hour"))
    tot = df.agg(F.count(F.lit(1)).alias("total_points"), F.avg(p).alias("mean_p"), F.max(p).alias("max_p"))
    return tot.crossJoin(peak)   # 1 x 1


def histogram(df: DataFrame, col: str = "probability", bins: int = 10) -> DataFrame:
    """Equal-width bins over [min, max], right-closed; the minimum falls in bin 1.

    All ``bins`` rows are returned, empty ones with n = 0 (none for an empty input).

    Only min/max travel to every row (a one-row cross join); the counts are a
    normal partial aggregation, so the histogram scales with the data.
    """
    mm = df.agg(F.min(col).alias("_lo"), F.max(col).alias("_hi"))
    x = F.col(col)
    width = (F.col("_hi") - F.col("_lo")) / bins
    raw = F.ceil((x - F.col("_lo")) / width)
    b = F.when(F.col("_hi") == F.col("_lo"), F.lit(1)).otherwise(F.greatest(F.lit(1), F.least(F.lit(bins), raw)))
    counts = (df.select(col).filter(x.isNotNull()).crossJoin(F.broadcast(mm)).select(b.cast("int").alias("bin"))
              .groupBy("bin").agg(F.count(F.lit(1)).alias("_n")))
    edges = mm.filter(F.col("_lo").isNotNull()).select(   # one row per bin
        F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"), "_lo", width.alias("_w"))
    return edges.join(counts, "bin", "left").select(
        "bin", (F.col("_lo") + (F.col("bin") - 1) * F.col("_w")).alias("bin_lo"),
        (F.col("_lo") + F.col("bin") * F.col("_w")).alias("bin_hi"), F.coalesce("_n", F.lit(0).cast("long")).alias("n"))


def _order_statistics(df: DataFrame, col: str, probs) -> DataFrame:
    """One row: n, min, max, mean of the values, and per prob ``p<i>`` with ``ge<i>``, the rows not below it.

    Instead of buffering every value in one task, values are reduced to
    (distinct value, count), the only read of the input; running counts come
    from range-partitioned prefix sums, and everything is one aggregation over
    those.
    """
    from .ordering import prefix_sums
    counts = df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    cum = prefix_sums(counts, ["_v"], ["_c"])                   # _c_cum: rows with value <= _v
    n = cum.agg(F.max("_c_cum").alias("_n"))
    cum = cum.crossJoin(F.broadcast(n)).withColumn("_first", F.col("_c_cum") - F.col("_c"))  # rank of first copy
    aggs = [F.max("_n").alias("n"), F.min("_v").alias("min_v"), F.max("_v").alias("max_v"),
            (F.sum(F.col("_v") * F.col("_c")) / F.max("_n")).alias("mean_v")]
    finals = ["n", "min_v", "max_v", "mean_v"]
    for i, p in enumerate(probs):
        pos = F.lit(float(p)) * (F.col("_n") - 1)
        for name, rank in (("lo", F.floor(pos)), ("hi", F.ceil(pos))):
            # value at a rank: the distinct value whose copies cover it  (_first <= rank < _c_cum)
            here = (F.col("_first") <= rank) & (rank < F.col("_c_cum"))
            aggs += [F.max(F.when(here, F.col("_v"))).alias(f"_{name}{i}"),
                     F.max(F.when(here, F.col("_first"))).alias(f"_{name}_first{i}")]
        aggs.append(F.max(pos - F.floor(pos)).alias(f"_f{i}"))
        value = F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_f{i}")
        below = F.when(value > F.col(f"_lo{i}"), F.col(f"_hi_first{i}")).otherwise(F.col(f"_lo_first{i}"))
        finals += [value.alias(f"p{i}"), (F.col("n") - below).alias(f"ge{i}")]
    return cum.agg(*aggs).select(*finals)


def exact_percentiles(df: DataFrame, col: str, probs) -> DataFrame:
    """Exact percentiles with linear interpolation (NumPy's default), one row ``p<k>`` per prob."""
    return _order_statistics(df, col, probs).select(*[f"p{i}" for i in range(len(probs))])


def distribution_stats(df: DataFrame, col: str) -> DataFrame:
    """min, max, mean, exact median and p90 (linear interpolation), count >= p90; the input is read once."""
    s = _order_statistics(df, col, [0.5, 0.9])
    return s.select("min_v", "max_v", "mean_v", F.col("p0").alias("median_v"), F.col("p1").alias("p90_v"),
                    F.coalesce("ge1", F.lit(0)).cast("long").alias("n_ge_p90"))


# ------------------------------------------------------------- top-k family
def top_n_per_group(df: DataFrame, group: str, order_col: str, n: int, ties=()) -> DataFrame:
    """n largest ``order_col`` per group; explicit tie columns make it repeatable."""
    w = Window.partitionBy(group).orderBy(F.desc(order_col), *[F.asc(t) for t in ties])
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def top_k(df: DataFrame, order_col: str, k: int, ties=(), cols=None) -> DataFrame:
    """Global top-k (TakeOrderedAndProject: k rows per task, then k overall)."""
    out = df.orderBy(F.desc(order_col), *[F.asc(t) for t in ties]).limit(k)
    return out.select(*cols) if cols else out


def top_groups(df: DataFrame, group: str, k: int) -> DataFrame:
    """Groups with most rows, ties by group key."""
    return df.groupBy(group).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc(group)).limit(k)


def filter_threshold(df: DataFrame, threshold: float, min_display: float | None = None,
                     p: str = "probability") -> DataFrame:
    out = df.filter(F.col(p) >= threshold)
    if min_display is not None:
        out = out.filter(F.col(p) >= min_display)
    return out


# --------------------------------------------------------- temporal patterns
def temporal_patterns(df: DataFrame, year: str = "year") -> DataFrame:
    """Average events per year for each hour, day of week and month, long form.

    One aggregation with GROUPING SETS ((hour), (dayofweek), (month)) instead of
    three scans; the distinct-year count is a one-row scalar.
    """
    n_years = df.agg(F.countDistinct(year).alias("_ny"))
    g = (df.groupingSets([["hour"], ["dayofweek"], ["month"]], "hour", "dayofweek", "month")
           .agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("_gid")))
    # grouping_id bits (hour, dayofweek, month): 3 = by hour, 5 = by day, 6 = by month
    kind = F.when(F.col("_gid") == 3, "hourly_risk").when(F.col("_gid") == 5, "dayofweek_risk") \
        .otherwise("monthly_risk")
    key = F.coalesce(F.when(F.col("_gid") == 3, F.col("hour")),
                     F.when(F.col("_gid") == 5, F.col("dayofweek")),
                     F.when(F.col("_gid") == 6, F.col("month")))
    return g.crossJoin(F.broadcast(n_years)).select(
        kind.alias("kind"), key.cast("int").alias("key"), (F.col("n") / F.col("_ny")).alias("value"))


def pattern_maps(patterns: DataFrame) -> DataFrame:
    """``(kind, pattern)``: the long form as one map of key to value per kind (at most 24 entries), keys in order."""
    entries = F.transform(F.sort_array(F.collect_list(F.struct("key", "value"))), lambda e: F.struct(e["key"], e["value"]))
    return patterns.groupBy("kind").agg(F.map_from_entries(entries).alias("pattern"))


def pattern_peaks(patterns: DataFrame) -> DataFrame:
    """Arg-max per kind (smallest key on a tie)."""
    return patterns.groupBy("kind").agg(
        F.max_by("key", F.struct(F.col("value"), -F.col("key"))).alias("peak_key"),
        F.max("value").alias("peak_value"))
