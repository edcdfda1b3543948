"""Predicate expressions (F1-F5). Plain ``Column`` booleans, so Catalyst can
push the simple ones (equality, ``IN``, ``startswith``) into the Parquet
scan and keep the rest in codegen."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import ColumnOrName, _c, base_name


def contains_not(col: ColumnOrName, has: str, has_not: str | None = None) -> Column:
    """literal substring test; ``has_not`` must be absent."""
    c = _c(col)
    cond = c.contains(has)
    if has_not is not None:
        cond = cond & ~c.contains(has_not)
    return cond


def is_exact(col: ColumnOrName, value: str) -> Column:
    """whole-value equality (no regex: dots are dots)."""
    return _c(col) == F.lit(value)


def is_allowed(col: ColumnOrName, allowed: Iterable[str]) -> Column:
    """case-sensitive membership in a literal list."""
    return _c(col).isin(list(allowed))


def is_set(col: ColumnOrName) -> Column:
    """Null and the empty string both count as unset."""
    return F.coalesce(_c(col).cast("string"), F.lit("")) != F.lit("")


def all_set(cols: Sequence[ColumnOrName]) -> Column:
    """every field present and non-empty."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & is_set(c)
    return cond


def starts_with_any(col: ColumnOrName, prefixes: Sequence[str], on_base_name: bool = True) -> Column:
    """True where the (base name of the) value starts with any prefix."""
    c = base_name(col) if on_base_name else _c(col)
    cond = F.lit(False)
    for p in prefixes:
        cond = cond | c.startswith(p)
    return cond
