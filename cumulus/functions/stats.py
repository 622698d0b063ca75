"""Aggregate column builders that are safe under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_corr(a: Column | str, b: Column | str, nulls: str = "skip") -> Column:
    """Pearson correlation as an aggregate.

    ``nulls="skip"`` drops pairs where either side is NULL (SQL ``corr`` semantics);
    ``nulls="zero"`` treats NULL as 0.0 first. A constant column gives NULL instead of a
    division-by-zero error.
    """
    a, b = _c(a), _c(b)
    if nulls == "zero":
        a2, b2 = F.coalesce(a, F.lit(0.0)), F.coalesce(b, F.lit(0.0))
    elif nulls == "skip":
        both = a.isNotNull() & b.isNotNull()
        a2, b2 = F.when(both, a), F.when(both, b)
    else:
        raise ValueError(f"unknown nulls mode {nulls!r}")
    a2, b2 = a2.cast("double"), b2.cast("double")
    return F.try_divide(F.covar_pop(a2, b2), F.stddev_pop(a2) * F.stddev_pop(b2))


def share_pct(part: Column | str, total: Column | str, digits: int = 2) -> Column:
    """``part / total * 100`` rounded; total 0 or NULL gives NULL."""
    return F.round(F.try_divide(_c(part).cast("double"), _c(total)) * 100, digits)
