"""Predictions laid out for lookups, with a zone table that says which files to read.

Rows are clustered by date, hour and falling probability, so that a file holds
few (date, hour) pairs and a narrow range of probabilities.  The zone table has
a row per file, date and hour with the least and greatest probability in it; a
lookup picks the files from it and opens no other.  Parquet Bloom filters of
further columns let a reader skip row groups on equality.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .versions import Store


def store_for_lookup(df: DataFrame, path: str, date: str = "date", hour: str = "hour", value: str = "probability",
                     bloom=(), rows_per_file: int | None = None) -> int:
    """Publish ``rows`` (laid out) and ``zones`` as one version of the store; returns its number.

    ``bloom`` names columns with a Bloom filter in each row group.
    """
    store = Store(df.sparkSession, path)
    base = (store.versions() or [0])[-1]
    laid = df.repartitionByRange(date, hour, F.desc(value)).sortWithinPartitions(date, hour, F.desc(value))
    options = {f"parquet.bloom.filter.enabled#{c}": "true" for c in bloom}
    if rows_per_file:
        options["maxRecordsPerFile"] = str(rows_per_file)
    rows = store.stage("rows", laid, options=options)
    zones = (store.staged("rows", rows).groupBy(F.col("_metadata.file_path").alias("file"), date, hour)
             .agg(F.min(value).alias("least"), F.max(value).alias("most"), F.count(F.lit(1)).alias("n")))
    return store.publish({"rows": rows, "zones": store.stage("zones", zones.repartitionByRange(date, hour))},
                         {"date": date, "hour": hour, "value": value}, base)


def files_for(spark: SparkSession, path: str, since=None, until=None, hours=None, least: float | None = None,
              version: int | None = None) -> list[str]:
    """Files that can hold rows with a date in [since, until], one of ``hours`` and a value of at least ``least``."""
    store = Store(spark, path)
    meta, zones = store.meta(version), store.read("zones", version)
    if since is not None:
        zones = zones.filter(F.col(meta["date"]) >= F.lit(since))
    if until is not None:
        zones = zones.filter(F.col(meta["date"]) <= F.lit(until))
    if hours is not None:
        zones = zones.filter(F.col(meta["hour"]).isin(list(hours)))
    if least is not None:
        zones = zones.filter(F.col("most") >= least)
    return sorted(r["file"] for r in zones.select("file").distinct().collect())   # names of the files to be read


def lookup(spark: SparkSession, path: str, since=None, until=None, hours=None, least: float | None = None,
           version: int | None = None) -> DataFrame:
    """The rows that meet all conditions, from the files that the zones name."""
    store = Store(spark, path)
    meta, whole = store.meta(version), store.read("rows", version)
    files = files_for(spark, path, since, until, hours, least, version)
    found = spark.read.schema(whole.schema).parquet(*files) if files else spark.createDataFrame([], whole.schema)
    if since is not None:
        found = found.filter(F.col(meta["date"]) >= F.lit(since))
    if until is not None:
        found = found.filter(F.col(meta["date"]) <= F.lit(until))
    if hours is not None:
        found = found.filter(F.col(meta["hour"]).isin(list(hours)))
    return found if least is None else found.filter(F.col(meta["value"]) >= least)
