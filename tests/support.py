"""Helpers of the tests."""

from __future__ import annotations


def values(df, *columns):
    """Rows as sorted tuples of the given (or all) columns."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
