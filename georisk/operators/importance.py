"""Permutation importance of any scorer: how much worse it gets when a column's values are dealt to other rows.

Rows are put in the order of a hash of their key once (a range-partitioned
dense index).  A feature's permutation is a rotation of that order: row i takes
the value of row (i + shift) mod n, with a shift drawn per feature, so a feature
costs one equi-join on unique row numbers and no sort of its own.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import hash_draw
from ..session import cut_lineage
from .ordering import dense_index


def brier(label: str, score: str) -> Column:
    """Mean squared error of a probability (lower is better)."""
    return F.avg((F.col(label) - F.col(score)) * (F.col(label) - F.col(score)))


def missed(label: str, score: str) -> Column:
    """Share of class 1 below 0.5, that is 1 - recall (lower is better)."""
    return F.count_if((F.col(label) == 1) & (F.col(score) < 0.5)) / F.count_if(F.col(label) == 1)


def shift_of(seed: int, feature: str, n: int) -> int:
    """Rotation of a feature, 1 to n - 1 (0 for a single row)."""
    import hashlib
    return 1 + int(hashlib.md5(f"{seed}|shift|{feature}".encode()).hexdigest()[:15], 16) % (n - 1) if n > 1 else 0


def permutation_importance(df: DataFrame, scorer, features, key, label: str = "target", loss=brier,
                           seed: int = 42) -> DataFrame:
    """``(feature, base_loss, permuted_loss, importance)``, a row per feature; importance is the loss's increase.

    ``scorer(rows)`` adds a column ``score``: any fitted pipeline, a formula, a
    Python model in Arrow batches.  ``key`` names columns that identify a row.
    """
    key = [key] if isinstance(key, str) else list(key)
    hashed = df.withColumn("_order", hash_draw(seed, "permutation", *key))
    rows = cut_lineage(dense_index(hashed, ["_order", *key], out="_row").drop("_order"), "permutation_rows")
    n = rows.count()
    if not n:
        return df.sparkSession.createDataFrame([], "feature string, base_loss double, permuted_loss double, importance double")
    base = scorer(rows).agg(loss(label, "score").alias("base_loss"))
    parts = []
    for f in features:
        values = rows.select(F.col("_row").alias("_from"), F.col(f).alias("_value"))
        dealt = (rows.withColumn("_from", (F.col("_row") + shift_of(seed, f, n)) % n).join(values, "_from")
                 .withColumn(f, F.col("_value")).drop("_from", "_value"))
        parts.append(scorer(dealt).agg(loss(label, "score").alias("permuted_loss")).select(F.lit(f).alias("feature"), "permuted_loss"))
    found = reduce(DataFrame.unionByName, parts).crossJoin(F.broadcast(base))   # one row a feature, one row
    return found.select("feature", "base_loss", "permuted_loss", (F.col("permuted_loss") - F.col("base_loss")).alias("importance"))
