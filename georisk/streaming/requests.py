"""Request scoring as a Structured Streaming job.

Requests arrive as files (JSON or Parquet) in a folder; each micro-batch is
validated, featurised and scored with the same stateless functions as the
batch path, and appended to a Parquet sink.  The checkpoint folder makes the
job restartable and exactly-once for the file sink.  ``availableNow`` drains
what is there and stops (scheduled / backfill runs); a processing-time
trigger keeps it running.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.scoring import REQUEST_SCHEMA, score_requests, split_requests
from ..operators.versions import Store


def request_stream(spark: SparkSession, source_dir: str, fmt: str = "parquet",
                   max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(REQUEST_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.format(fmt).load(source_dir)


def scored_stream(requests: DataFrame, scorer=None, model_version: str = "formula-1",
                  encoder: DataFrame | None = None) -> DataFrame:
    """Valid requests scored, with the features used; those of the sink's filters flattened beside them."""
    valid, _ = split_requests(requests)
    s = score_requests(valid, scorer, model_version, encoder)
    return s.select("request_id", "risk_score", "risk_level", "confidence", "model_version", "features_used",
                    F.col("features_used.hour").alias("hour"), F.col("features_used.is_weekend").alias("is_weekend"))


def run_to_sink(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint_dir: str, fmt: str = "parquet",
                available_now: bool = True, scorer=None, model_version: str = "formula-1",
                max_files_per_trigger: int | None = None, encoder: DataFrame | None = None,
                rejects_dir: str | None = None):
    """Start the stream into a Parquet sink; with availableNow it returns when drained.

    A request that fails a rule goes to ``rejects_dir`` (default: ``rejected`` beside the sink) with its reasons,
    by a second query over the same files with a checkpoint of its own.
    """
    source = request_stream(spark, source_dir, fmt, max_files_per_trigger)
    rejects_dir = rejects_dir or f"{sink_dir.rstrip('/')}-rejected"
    handles = []
    for rows, sink, name in ((scored_stream(source, scorer, model_version, encoder), sink_dir, "scored"),
                             (split_requests(source)[1], rejects_dir, "rejected")):
        q = rows.writeStream.format("parquet").option("path", sink).outputMode("append") \
            .option("checkpointLocation", f"{checkpoint_dir.rstrip('/')}/{name}")
        handles.append((q.trigger(availableNow=True) if available_now else q.trigger(processingTime="10 seconds")).start())
    if available_now:
        for h in handles:
            h.awaitTermination()
    return handles[0]


def score_batch(df: DataFrame, epoch_id: int, sink_dir: str, model_store: str,
                encoder: DataFrame | None = None) -> None:
    """One micro-batch, scored by the newest published model and stored under its epoch.

    The epoch is a partition that is replaced as a whole: a batch that runs
    again puts its rows in place of those of its first run.
    """
    store = Store(df.sparkSession, model_store)
    version = store.versions()[-1]
    out = scored_stream(df, store.load_model("model", version), f"v{version}", encoder)
    for rows, path in ((out, sink_dir), (split_requests(df)[1], f"{sink_dir.rstrip('/')}-rejected")):
        Store(df.sparkSession, path).replace_partitions(rows.withColumn("epoch_id", F.lit(epoch_id)), "epoch_id", [epoch_id])


def run_with_model_reload(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint_dir: str,
                          model_store: str, fmt: str = "parquet", available_now: bool = True,
                          encoder: DataFrame | None = None, max_files_per_trigger: int | None = None):
    """foreachBatch variant: the newest version of ``model`` in the store is read at the start of every
    micro-batch, so a newly published model is picked up without a restart."""
    q = request_stream(spark, source_dir, fmt, max_files_per_trigger).writeStream \
        .foreachBatch(lambda df, epoch_id: score_batch(df, epoch_id, sink_dir, model_store, encoder)) \
        .option("checkpointLocation", checkpoint_dir)
    q = q.trigger(availableNow=True) if available_now else q.trigger(processingTime="10 seconds")
    handle = q.start()
    if available_now:
        handle.awaitTermination()
    return handle
