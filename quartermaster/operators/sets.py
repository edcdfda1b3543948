"""Set operations (U1, U2), matrix expansion (J3) and ordered manifests (O1)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .aggregates import ordinal
from .joins import missing_work

# A domain used to expand ``all`` (or a matrix dimension given as a table)
# is attached to every row as one array, so its size must stay bounded.
MAX_DOMAIN = 10_000


def _bounded_array(domain: DataFrame, col: str, max_size: int) -> Column:
    """The distinct values of ``domain.col`` as one array column, computed
    once as a scalar subquery. The job fails if the domain is too big to be
    attached to every row; at most one value more than the bound is ever
    collected."""
    arr = F.array_sort(F.collect_set(F.col(col)))
    guarded = F.when(F.size(arr) <= max_size, arr).otherwise(
        F.raise_error(F.lit(f"domain {col} has more than {max_size} values")))
    few = domain.select(col).distinct().limit(max_size + 2)  # a null is not collected
    return few.select(guarded).scalar()


# ---------------------------------------------------------------- U1

def union_sets(a: DataFrame, b: DataFrame, key: str | Sequence[str],
               source_col: str = "source", names: tuple[str, str] = ("a", "b")) -> DataFrame:
    """Both inputs in one set; on a key clash the second input wins.

    All of ``b``, plus the rows of ``a`` whose key ``b`` does not have: a
    left anti join against ``b``'s distinct keys (hash join, partial
    de-duplication before the shuffle), then ``unionByName``. Rows are never
    merged or dropped within one input."""
    ks = [key] if isinstance(key, str) else list(key)
    kept_a = missing_work(a, b, ks)
    return (kept_a.withColumn(source_col, F.lit(names[0]))
            .unionByName(b.withColumn(source_col, F.lit(names[1]))))


# ---------------------------------------------------------------- U2

def expand_all(selection: DataFrame, col: str, domain: DataFrame | Sequence[str],
               domain_col: str | None = None, all_value: str = "all",
               keys: Sequence[str] = (), max_domain: int = MAX_DOMAIN) -> DataFrame:
    """``all`` stands for every domain value except ``all`` itself; the
    result is de-duplicated, so ``all`` plus a name is the full set once.

    The domain becomes one bounded array (literal, or a scalar subquery over
    a table) and ``explode`` expands the ``all`` rows in place: no join.
    """
    c = F.col(col)
    if isinstance(domain, DataFrame):
        arr = _bounded_array(domain, domain_col or domain.columns[0], max_domain)
    else:
        if len(domain) > max_domain:
            raise ValueError("domain too large to attach to every row")
        arr = F.array(*[F.lit(v) for v in domain])
    arr = F.array_remove(arr, F.lit(all_value))
    expanded = F.explode(F.when(c == all_value, arr).otherwise(F.array(c)))
    return selection.select(*keys, expanded.alias(col)).dropDuplicates()


# ---------------------------------------------------------------- J3

def expand_matrix(base: DataFrame, dims: Mapping[str, Sequence | DataFrame],
                  exclusions: Sequence[Mapping[str, object]] = (),
                  max_domain: int = MAX_DOMAIN) -> DataFrame:
    """Every row of ``base`` times every combination of the option
    dimensions, minus excluded cells.

    Each dimension is a bounded literal list (or a small table turned into a
    bounded array by a scalar subquery) and is expanded with ``explode`` in
    the same stage: no cross join, no shuffle. An exclusion is a partial
    cell, e.g. ``{"platform": "web", "flavour": "mono"}``; rows matching any
    exclusion are filtered out.
    """
    out = base
    for name, values in dims.items():
        if isinstance(values, DataFrame):
            arr = _bounded_array(values, values.columns[0], max_domain)
        else:
            if len(values) > max_domain:
                raise ValueError(f"dimension {name} too large")
            arr = F.array(*[F.lit(v) for v in values])
        out = out.withColumn(name, F.explode(arr))
    if exclusions:
        drop = F.lit(False)
        for cell in exclusions:
            cond = F.lit(True)
            for k, v in cell.items():
                cond = cond & (F.col(k) == F.lit(v))
            drop = drop | cond
        out = out.filter(~F.coalesce(drop, F.lit(False)))
    return out


# ---------------------------------------------------------------- O1

def ordered_manifest(df: DataFrame, order_by: str | Sequence[str],
                     with_position: bool = False) -> DataFrame:
    """O1: rows in byte order of ``order_by`` (a range-partitioned global
    sort; written out, the part files are in order). ``with_position`` adds
    the exact 1-based line number without a single-task window."""
    cols = [order_by] if isinstance(order_by, str) else list(order_by)
    if with_position:
        return ordinal(df, cols, (), name="position")
    return df.orderBy(*cols)
