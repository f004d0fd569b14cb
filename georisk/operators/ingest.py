"""Cleaning, validation, fan-out join and de-duplication."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.parse import assemble_datetime, day_of_week, parse_decimal_comma
from ..params import DEPARTMENT, GRID_BOUNDS


# ------------------------------------------------------------------ filters
def filter_equals(df: DataFrame, col: str, value: str) -> DataFrame:
    """Text comparison, whatever the column's inferred type."""
    return df.filter(F.col(col).cast("string") == F.lit(value))


def filter_not_null(df: DataFrame, cols) -> DataFrame:
    return df.na.drop(how="any", subset=list(cols))


def filter_bbox(df: DataFrame, bounds=GRID_BOUNDS, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Closed BETWEEN on both axes; NULL coordinates are dropped."""
    lat_min, lat_max, lon_min, lon_max = bounds
    return df.filter(F.col(lat).between(lat_min, lat_max) & F.col(lon).between(lon_min, lon_max))


def default_value(c: str, value) -> Column:
    col = F.col(c)
    return F.coalesce(F.nanvl(col, F.lit(value)) if isinstance(value, float) else col, F.lit(value))


def drop_incomplete(df: DataFrame, cols) -> DataFrame:
    """Drop rows with NULL (or NaN) in any of ``cols``."""
    return df.na.drop(how="any", subset=list(cols))


# --------------------------------------------------------------- validation
def validate_ranges(df: DataFrame, rules: dict) -> DataFrame:
    """Attach ``valid`` and ``reasons`` (comma-separated failed rule names).

    rules: name -> boolean Column that is TRUE for a valid row.  A NULL rule
    result counts as a failure.
    """
    fails = [F.when(~F.coalesce(cond, F.lit(False)), F.lit(name)) for name, cond in rules.items()]
    reasons = F.concat_ws(",", *fails)
    return df.withColumn("reasons", reasons).withColumn("valid", F.col("reasons") == "")


def split_valid(df: DataFrame, rules: dict) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows with reasons) from one tagged frame."""
    tagged = validate_ranges(df, rules)
    return tagged.filter("valid").drop("valid", "reasons"), tagged.filter(~F.col("valid"))


def request_rules(bounds=GRID_BOUNDS, time: str | None = "datetime") -> dict:
    """Rules of a scoring request; ``time=None`` for rows whose time has been checked before."""
    lat_min, lat_max, lon_min, lon_max = bounds
    rules = {
        "latitude": F.col("latitude").between(lat_min, lat_max),
        "longitude": F.col("longitude").between(lon_min, lon_max),
    }
    if time:
        rules["datetime"] = F.try_to_timestamp(F.col(time).cast("string")).isNotNull()
    return rules | {"atm": F.col("atm").between(1, 9)}


def test_rules() -> dict:
    return {
        "hour": F.col("hour").between(0, 23),
        "dayofweek": F.col("dayofweek").between(0, 6),
        "atm": F.col("atm").isin(1, 2, 3, 5),
        "probability": F.col("probability").between(0.0, 1.0),
    }


def check_table_constraints(df: DataFrame, not_null=(), unique=()) -> DataFrame:
    """Violations as rows (constraint, key, n).

    NOT NULL: one row per column with its null count (if > 0).
    UNIQUE: one row per duplicated key with its multiplicity.  Both are
    aggregations with map-side combine, so a key repeated a billion times
    costs one partial row per task.
    """
    spark = df.sparkSession
    parts = []
    if not_null:
        nn = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in not_null])
        stack = "stack({}, {}) as (key, n)".format(
            len(not_null), ", ".join(f"'{c}', `{c}`" for c in not_null))
        parts.append(nn.selectExpr(stack).filter("n > 0").select(F.lit("not_null").alias("constraint"), "key", "n"))
    if unique:
        key = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in unique])
        dup = df.groupBy(*unique).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        parts.append(dup.select(F.lit("unique").alias("constraint"), key.alias("key"), "n"))
    if not parts:
        return spark.createDataFrame([], "constraint string, key string, n long")
    return reduce(DataFrame.unionByName, parts)


# ---------------------------------------------------------------- fan-out
def left_join_fanout(parent: DataFrame, child: DataFrame, key: str, chunk: int = 100_000) -> DataFrame:
    """``parent LEFT JOIN child ON key`` when no child column is kept.

    The result is every parent row repeated once per matching child row (at
    least once).  Instead of shuffling the child rows, the child side is
    reduced to one count per key (map-side partial aggregation, so a key with
    a third of all rows costs one row per task), joined 1:1, then expanded.
    Expansion goes in two steps -- chunk starts, a repartition of the chunk
    rows by (key, chunk), then rows inside the chunk -- so a key with millions
    of children is generated by many tasks instead of one.
    """
    counts = child.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    joined = parent.join(counts, key, "left").withColumn("_n", F.greatest(F.coalesce("_n", F.lit(0)), F.lit(1)))
    chunks = joined.withColumn("_c", F.explode(F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / chunk))))
    # only keys above one chunk move: their chunks spread over tasks by (key, chunk)
    big = chunks.filter(F.col("_n") > chunk).repartition(key, "_c")
    small = chunks.filter(F.col("_n") <= chunk)
    lo = F.col("_c") * chunk + 1
    hi = F.least(F.col("_n"), (F.col("_c") + 1) * chunk)

    def expand(d):
        return d.withColumn("_r", F.explode(F.sequence(lo, hi))).drop("_n", "_c", "_r")

    return expand(small).unionByName(expand(big))


# ---------------------------------------------------------------- dedupe
def dedupe_first(df: DataFrame, keys, order) -> DataFrame:
    """Keep, per key, the row that comes first by ``order``.

    Written as ``min(struct(order..., row))`` per key -- an aggregation with
    partial combine -- instead of a window: a key holding a third of all rows
    is reduced inside every task before anything is shuffled.
    """
    keys = list(keys)
    order = [order] if isinstance(order, str) else list(order)
    rest = [c for c in df.columns if c not in keys]
    packed = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], *[F.col(c) for c in rest])
    g = df.groupBy(*keys).agg(F.min(packed).alias("_m"))
    return g.select(*keys, *[F.col(f"_m.{c}").alias(c) for c in rest]).select(*df.columns)


def union_all(*frames: DataFrame, cols=None) -> DataFrame:
    """Positional UNION ALL after a fixed projection."""
    cols = cols or frames[0].columns
    return reduce(DataFrame.union, [f.select(*cols) for f in frames])


def union_distinct(*frames: DataFrame, cols=None) -> DataFrame:
    return union_all(*frames, cols=cols).distinct()


# ------------------------------------------------------------------ bronze
def parse_accidents(carac: DataFrame, users: DataFrame | None = None, mode: str = "correct",
                    dep: str = DEPARTMENT, dow_base: str = "sun0", key: str = "Num_Acc") -> DataFrame:
    """Raw records -> clean accident events (bronze).

    dep filter -> optional fan-out by child rows -> datetime assembly ->
    decimal-comma coordinates -> drop rows without coordinates or time.
    """
    df = filter_equals(carac, "dep", dep)
    if users is not None:
        df = left_join_fanout(df, users.select(key), key)
    ts = assemble_datetime("jour", "mois", "an", "hrmn", mode)
    out = df.select(
        F.col(key).alias("num_acc"),
        ts.alias("datetime"),
        parse_decimal_comma("lat").alias("latitude"),
        parse_decimal_comma("long").alias("longitude"),
        F.col("atm").try_cast("int").alias("atm"),
    )
    out = out.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull() & F.col("datetime").isNotNull())
    return out.withColumns({
        "hour": F.hour("datetime").cast("int"),
        "dayofweek": day_of_week("datetime", dow_base),
        "month": F.month("datetime").cast("int"),
        "target": F.lit(1),
    })
