"""Filters F1-F6 as DataFrame operators."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import predicates as P
from .joins import semi_join


def filter_contains(df: DataFrame, col: str, has: str, has_not: str | None = None) -> DataFrame:
    """rows whose ``col`` contains ``has`` and not ``has_not`` (literal)."""
    return df.filter(P.contains_not(col, has, has_not))


def filter_exact(df: DataFrame, col: str, value: str) -> DataFrame:
    """rows whose ``col`` equals ``value`` exactly (pushed to the scan)."""
    return df.filter(P.is_exact(col, value))


def allow_list(df: DataFrame, col: str, allowed: Iterable[str] | DataFrame,
               allowed_col: str | None = None) -> DataFrame:
    """keep known names only.

    A literal list becomes ``IN`` (pushed into the Parquet scan). A table of
    allowed names becomes a left-semi join; AQE broadcasts it when its
    measured size is small and otherwise shuffles both sides.
    """
    if isinstance(allowed, DataFrame):
        key = allowed_col or allowed.columns[0]
        return semi_join(df, allowed.select(F.col(key).alias(col)), [col])
    return df.filter(P.is_allowed(col, allowed))


def all_present(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """rows where every column is non-null and non-empty."""
    return df.filter(P.all_set(cols))


def exclude_prefixes(df: DataFrame, col: str, prefixes: Sequence[str],
                     on_base_name: bool = True) -> DataFrame:
    """drop rows whose base name starts with any prefix."""
    return df.filter(~P.starts_with_any(col, prefixes, on_base_name))


def split_valid(df: DataFrame, rule: Column, mode: str = "permissive",
                message: str = "invalid value") -> DataFrame | tuple[DataFrame, DataFrame]:
    """validate rows against ``rule``.

    ``strict``: one DataFrame; the first bad row fails the job inside the
    plan (``raise_error``), like a script that stops on a bad argument.
    ``permissive``: ``(good, rejects)``; together they are exactly the input.
    A null rule result counts as a reject.
    """
    ok = F.coalesce(rule, F.lit(False))
    if mode == "strict":
        return df.filter(F.when(ok, F.lit(True)).otherwise(F.raise_error(F.lit(message))))
    if mode != "permissive":
        raise ValueError(f"unknown mode {mode!r}")
    return df.filter(ok), df.filter(~ok)


def validity_counts(df: DataFrame, rule: Column) -> DataFrame:
    """Good / reject counts in one pass (one partial aggregate per task)."""
    ok = F.coalesce(rule, F.lit(False))
    return (df.groupBy(F.when(ok, F.lit("good")).otherwise(F.lit("reject")).alias("verdict"))
              .agg(F.count(F.lit(1)).alias("n")))
