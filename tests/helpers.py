"""Helpers of the tests."""

from __future__ import annotations


def rows(df, *columns):
    """Sorted plain tuples of a result."""
    out = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in out.collect()), key=repr)
