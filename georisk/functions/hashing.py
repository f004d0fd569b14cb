"""Portable deterministic draws.

A draw is the first 60 bits of md5('seed|stream|key') read as an integer, wide
enough to reach every row of a source of 2^40 rows with a bias below 2^-20.  It is a pure function of its inputs, so results do not depend on
partitioning, retries or executor loss, and any SQL engine with md5 can
reproduce it (used by the oracle queries).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DRAW_BITS = 60
DRAW_RANGE = 1152921504606846976.0   # 2^60


def _c(c) -> Column:
    if isinstance(c, Column):
        return c
    if isinstance(c, str):
        return F.col(c)
    return F.lit(c)


def hash_draw(seed: int, stream: str, *keys) -> Column:
    """60-bit integer (BIGINT, not negative) from md5 of 'seed|stream|k1|k2...'."""
    parts = [F.lit(f"{seed}|{stream}")] + [_c(k).cast("string") for k in keys]
    text = F.concat_ws("|", *parts)
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def uniform_draw(seed: int, stream: str, *keys) -> Column:
    """Uniform double in [0, 1)."""
    return hash_draw(seed, stream, *keys) / F.lit(DRAW_RANGE)


def index_draw(seed: int, stream: str, n, *keys) -> Column:
    """Uniform integer in [0, n)."""
    return F.pmod(hash_draw(seed, stream, *keys), _c(n).cast("long"))


def sql_hash_draw(seed: int, stream: str, *key_sql: str) -> str:
    """The same draw in DuckDB SQL (for oracles)."""
    inner = ", ".join([f"'{seed}|{stream}'"] + [f"CAST({k} AS VARCHAR)" for k in key_sql])
    return f"CAST(('0x' || substr(md5(concat_ws('|', {inner})), 1, 15)) AS BIGINT)"
