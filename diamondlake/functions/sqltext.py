"""Tiny helpers that render literal lists for the SQL oracle strings."""

from __future__ import annotations


def lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return repr(v)


def sql_in(col: str, values) -> str:
    """``col IN (...)``; an empty list is FALSE (SQL has no empty IN list)."""
    values = list(values)
    if not values:
        return "FALSE"
    return f"{col} IN ({', '.join(lit(v) for v in values)})"
