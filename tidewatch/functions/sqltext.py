"""Helpers for building Spark SQL expression text."""

from __future__ import annotations


def sql_str(v: str | None) -> str:
    """A Spark SQL string literal for ``v`` (backslash and quote escaped); NULL for None."""
    if v is None:
        return "CAST(NULL AS STRING)"
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
