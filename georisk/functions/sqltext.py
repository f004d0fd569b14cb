"""Helpers for SQL text shared by Spark expressions and oracle queries."""

from __future__ import annotations


def dbl(x: float) -> str:
    """A DOUBLE literal in both Spark SQL and ANSI engines (plain '1.5' would be DECIMAL)."""
    r = repr(float(x))
    return r if ("e" in r or "inf" in r or "nan" in r) else r + "e0"
