"""Folders of the generated tables and row comparison, shared by the tests."""

from __future__ import annotations

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


def rows(df, *cols):
    """Rows as sorted tuples (order-insensitive comparisons)."""
    cols = cols or tuple(df.columns)
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
