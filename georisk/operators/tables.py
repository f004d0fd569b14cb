"""Sinks and table maintenance: replace, partition replace, row ids, layout."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage, scratch_path
from .ordering import dense_index
from .versions import Store

NAMESPACES = ("bronze", "silver", "gold")


def ensure_namespaces(spark: SparkSession, names=NAMESPACES) -> None:
    for n in names:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {n}")


def replace_table(df: DataFrame, name: str | None = None, path: str | None = None) -> None:
    """CREATE OR REPLACE: a catalog table (name) or a stored table (path), whose readers see the old or the new rows."""
    if name:
        df.write.mode("overwrite").saveAsTable(name)
    else:
        Store(df.sparkSession, path).replace({"data": df})


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The newest version of what ``replace_table`` or ``replace_partition`` has stored."""
    return Store(spark, path).read()


def evenly_stored(df: DataFrame, name: str, rows_per_file: int = 25_000) -> DataFrame:
    """The rows in files of about equal size, however they were dealt before; their number follows that of the rows.

    For rows that are gone over many times: a reader's tasks then have like parts.
    """
    stored = cut_lineage(df, name)
    return cut_lineage(stored.repartition(max(1, -(-stored.count() // rows_per_file))), f"{name}_even")


def stored_blocks(blocks: DataFrame, name: str, tasks: int | None = None) -> DataFrame:
    """Rows that hold up to a megabyte or so of packed bytes each, for kernels that go over them many times.

    They are dealt evenly over files of small row groups, and read by a task per file, a few rows at a time, so that no
    task holds more than that however large its file is.  The reading settings are those of a session of its own.
    """
    spark = blocks.sparkSession
    path = scratch_path(spark, name)
    blocks.repartition(tasks or 2 * spark.sparkContext.defaultParallelism).write \
        .option("parquet.block.size", 8 << 20).option("parquet.page.size.row.check.min", 4).parquet(path)
    own = spark.newSession()
    for k, v in {"spark.sql.files.openCostInBytes": 1 << 40, "spark.sql.parquet.columnarReaderBatchSize": 8,
                 "spark.sql.execution.arrow.maxRecordsPerBatch": 8,
                 "spark.sql.session.timeZone": spark.conf.get("spark.sql.session.timeZone")}.items():
        own.conf.set(k, str(v))
    return own.read.parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def replace_partition(df: DataFrame, path: str, partition_col: str = "date", values=(), check=None) -> None:
    """Replace the partitions present in ``df`` and those named in ``values``, in one step; others stay untouched.

    A date named in ``values`` for which ``df`` has no row ends up empty: a run
    that finds nothing must not leave the rows of the run before.  ``check(name, rows)``
    sees the stored rows before they are published.
    """
    Store(df.sparkSession, path).replace_partitions(df, partition_col, values, check=check)


def layout_for_lookup(df: DataFrame, path: str, partition_col: str = "date", range_col: str = "hour",
                      sort_desc: str = "probability") -> None:
    """Partition by date, cluster by hour and descending probability, so lookups by (date, hour) and by probability
    skip row groups via min/max statistics.  The probability is part of the range key: a full hour is several files.
    Replaces all that is stored under ``path``."""
    (df.repartitionByRange(partition_col, range_col, F.desc(sort_desc))
       .sortWithinPartitions(partition_col, range_col, F.desc(sort_desc))
       .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(partition_col).parquet(path))


@contextmanager
def with_view(df: DataFrame, name: str):
    """``df`` as a temporary view inside the block."""
    df.createOrReplaceTempView(name)
    try:
        yield df.sparkSession
    finally:
        df.sparkSession.catalog.dropTempView(name)


def preview(df: DataFrame, n: int, order) -> DataFrame:
    """The first ``n`` rows in ``order`` (a top-k, not a sort of the table)."""
    return df.orderBy(*([order] if isinstance(order, str) else order)).limit(n)


def assign_row_ids(df: DataFrame, partition_col: str = "date", order=("hour", "latitude", "longitude"),
                   out: str = "id") -> DataFrame:
    """Stable id from 1 inside each partition value, in ``order``.

    A window partitioned by date would put a whole day in one task; instead
    a global dense index over (date, order...) is shifted by the first index
    of each date (a partial aggregation).
    """
    order = list(order)
    idx = dense_index(df, [partition_col, *order], out="_gidx")
    first = idx.groupBy(partition_col).agg(F.min("_gidx").alias("_first"))
    # one row per date: the planner broadcasts it when its measured size allows
    return idx.join(first, partition_col) \
        .withColumn(out, F.col("_gidx") - F.col("_first") + 1).drop("_gidx", "_first")
