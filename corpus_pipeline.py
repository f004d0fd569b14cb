"""From raw documents to a mixed training stream, five stages over the operators of ``georisk.llm``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet in the shared folder and read again as the next stage's ``docs``.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from georisk.llm import decontaminate, mixing, quality_fm, simhash, suffix_dedup
from georisk.llm.common import cut_lineage, read_table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine takes for label 1; it learns on this stage's own rows."""
    return quality_fm.keep_good(docs, read_table(spark, sf_dir, "labels"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints, that with the smallest doc_id."""
    return simhash.keep_representatives(docs, shingle=3, radius=3)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of passages of 50 words and more are cut out; documents left empty go."""
    return suffix_dedup.remove_repeats(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontaminate.keep_clean(docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their place in the mixed stream, whole shards in stream order."""
    return mixing.in_stream_order(mixing.mix(docs))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("mix_sources", mix_sources),
]

# A fitted classifier, fingerprints and an earliest-deadline-first schedule have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    name, last = STAGES[-1]
    return last(spark, docs, sf_dir)
