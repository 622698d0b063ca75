"""Text-field column builders: validity tests, safe numeric parse, labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_valid_text(c: Column | str) -> Column:
    """Not NULL, not blank after trimming, and not the literal ``null`` (case-sensitive).

    Always TRUE/FALSE, never NULL, so it can be counted and negated safely.
    """
    t = F.trim(_c(c))
    return F.coalesce((t != F.lit("")) & (t != F.lit("null")), F.lit(False))


def safe_double(c: Column | str) -> Column:
    """Trimmed text -> DOUBLE; anything unparseable gives NULL instead of failing the job."""
    return F.trim(_c(c)).try_cast("double")


def prefixed(prefix: str, c: Column | str) -> Column:
    """``prefix + value`` (NULL value stays NULL)."""
    return F.concat(F.lit(prefix), _c(c))


def clean_city_name(c: Column | str) -> Column:
    """Drop footnote marks such as ``[1]`` from a name."""
    return F.trim(F.regexp_replace(_c(c), r"\[\d+\]", ""))
