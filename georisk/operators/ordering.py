"""Distributed positional helpers: dense index, prefix sums, copy expansion.

None of these uses an unpartitioned window: rows are range-partitioned by the
order key, each partition is numbered / summed locally, and only one number
per partition (a table bounded by the partition count) is combined into
offsets and broadcast back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

_LOCAL_BITS = 33   # monotonically_increasing_id = partition_id << 33 | row_in_partition


def _sorted_with_pid(df: DataFrame, order) -> DataFrame:
    # rows with equal keys are spread by a last key of their own: a key that a third of the rows share is
    # cut over many ranges (which of them comes first is open, so order keys should be unique or the rows alike)
    s = df.withColumn("_spread", F.monotonically_increasing_id()).orderBy(*order, "_spread").drop("_spread")
    s = s.withColumns({"_mid": F.monotonically_increasing_id(), "_pid": F.spark_partition_id()})
    return cut_lineage(s)   # materialised once: offsets and rows agree under retries


def _partition_offsets(s: DataFrame, sums: dict) -> DataFrame:
    """Exclusive running totals per partition id (one row per partition)."""
    per = s.groupBy("_pid").agg(*[e.alias(k) for k, e in sums.items()])
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    return per.select("_pid", *[F.coalesce(F.sum(k).over(w), F.lit(0)).alias(f"_off_{k}") for k in sums])


def dense_index(df: DataFrame, order, out: str = "_idx") -> DataFrame:
    """0-based position of every row in ``order`` (order keys should be unique).

    Range-partitioned sort, a per-partition row count, offsets over the
    partition counts, then ``offset + position inside the partition``.
    """
    order = [order] if isinstance(order, str) else list(order)
    s = _sorted_with_pid(df, order)
    offs = _partition_offsets(s, {"n": F.count(F.lit(1))})
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), _LOCAL_BITS)
    return s.join(F.broadcast(offs), "_pid").withColumn(out, F.col("_off_n") + local) \
        .drop("_mid", "_pid", "_off_n")


def prefix_sums(df: DataFrame, order, cols, suffix: str = "_cum") -> DataFrame:
    """Inclusive running sums of ``cols`` in ``order`` (order keys unique).

    Each range partition is summed locally (a window partitioned by the
    partition id -- bounded by the partition size), then shifted by the sum
    of all earlier partitions.
    """
    order = [order] if not isinstance(order, (list, tuple)) else list(order)
    s = _sorted_with_pid(df, order)
    offs = _partition_offsets(s, {c: F.sum(c) for c in cols})
    w = Window.partitionBy("_pid").orderBy("_mid").rowsBetween(Window.unboundedPreceding, 0)
    out = s.join(F.broadcast(offs), "_pid")
    out = out.withColumns({f"{c}{suffix}": F.sum(c).over(w) + F.col(f"_off_{c}") for c in cols})
    return out.drop("_mid", "_pid", *[f"_off_{c}" for c in cols])


def expand_copies(df: DataFrame, count_col: str, chunk: int = 100_000, salt_cols=()) -> DataFrame:
    """Repeat every row ``count_col`` times (0 drops it).

    Rows needing more than one chunk are first split into chunk rows and
    spread over tasks, so one row with a billion copies is produced by many
    tasks, not one.
    """
    n = F.col(count_col)
    staged = df.filter(n > 0).withColumn("_c", F.explode(F.sequence(F.lit(0), F.floor((n - 1) / chunk))))
    big = staged.filter(n > chunk).repartition(*salt_cols, "_c") if salt_cols else \
        staged.filter(n > chunk).repartition("_c")
    small = staged.filter(n <= chunk)
    lo = F.col("_c") * chunk + 1
    hi = F.least(n, (F.col("_c") + 1) * chunk)

    def expand(d):
        return d.withColumn("_r", F.explode(F.sequence(lo, hi))).drop("_c", "_r")

    return expand(small).unionByName(expand(big)).drop(count_col)
