"""Shared helpers of the operators: reading, empty batches, word splitting."""

from __future__ import annotations

import pickle

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

from ..session import cut_lineage, scratch_path  # noqa: F401  (re-exported for the operators)

# One space for each byte that is no word byte in `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`; A-Z become a-z.
ALNUM_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
                    for b in range(256))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def alnum_words(text: str | None) -> list[bytes]:
    """Words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of the text, A-Z lower-cased, as UTF-8."""
    return text.encode().translate(ALNUM_TABLE).split() if text else []


def space_words(text: str | None, lower: bool = False) -> list[bytes]:
    """Words `[^\\x20\\x09-\\x0D]+` of the text as UTF-8; ``lower`` lower-cases A-Z only.

    bytes.split() and bytes.lower() know ASCII alone, which is the contract.
    """
    if not text:
        return []
    data = text.encode()
    return (data.lower() if lower else data).split()


class Shared:
    """An object sent to every executor once, with its class: tasks need no import of this package."""

    def __init__(self, spark: SparkSession, obj):
        self._sent = spark.sparkContext.broadcast(cloudpickle.dumps(obj))

    @property
    def value(self):
        return pickle.loads(self._sent.value)

    def release(self) -> None:
        """Drop the executors' copies; a task that still asks fetches it again."""
        self._sent.unpersist()
