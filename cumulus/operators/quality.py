"""Data-quality counters for the delimited-text path, as one aggregate (plus an
``Observation`` variant that collects the same counters as a side effect of any action)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.dates import parse_date
from ..functions.text import is_valid_text
from ..plans.compute_once import compute_once
from ..sources.lines import field_count, has_fields
from ..schema import HEADER_TOKEN, MIN_FIELDS


def line_flags(lines: DataFrame, min_year: int = 2014, date_mode: str = "lenient") -> DataFrame:
    """Per line: header / short / invalid-date / missing-ET0 / period flags and the
    year-month key. The split and the date parse run once per line."""
    v = F.col("value")
    once = compute_once(lines, {
        "_is_header": F.coalesce(v.startswith(HEADER_TOKEN), F.lit(False)),
        "_f": F.split(v, ",", -1),
    }, keep=[])
    full = has_fields(F.col("_f"), MIN_FIELDS)
    raw_date = F.get(F.col("_f"), 1)
    raw_et0 = F.get(F.col("_f"), 18)
    dated = compute_once(once, {"_date": parse_date(raw_date, date_mode)})
    body = ~F.col("_is_header") & full
    start = F.make_date(F.lit(min_year), F.lit(1), F.lit(1))
    d = F.col("_date")
    return dated.select(
        F.col("_is_header").alias("is_header"),
        (~F.col("_is_header") & ~full).alias("is_short"),
        (body & (~is_valid_text(raw_date) | d.isNull())).alias("bad_date"),
        (body & F.trim(raw_et0).try_cast("double").isNull()).alias("missing_et0"),
        (body & (d < start)).alias("before_min_year"),
        (body & (d >= start)).alias("kept"),
        F.when(body, F.year(d) * 100 + F.month(d)).alias("year_month"),  # int key: no string per row
    )


def quality_counters(lines: DataFrame, min_year: int = 2014, date_mode: str = "lenient") -> DataFrame:
    """One-row counters over raw lines: total, header, short (malformed), invalid date,
    missing ET0, rows before / since ``min_year``, distinct months seen."""
    f = line_flags(lines, min_year, date_mode)
    return f.agg(
        F.count(F.lit(1)).alias("lines_total"),
        F.count_if("is_header").alias("header_lines"),
        F.count_if("is_short").alias("short_lines"),
        F.count_if("bad_date").alias("invalid_date"),
        F.count_if("missing_et0").alias("missing_et0"),
        F.count_if("before_min_year").alias("before_min_year"),
        F.count_if("kept").alias("rows_kept"),
        F.count_distinct("year_month").alias("months_processed"),
    )


def valid_text_counts(lines: DataFrame, fields: dict[str, int]) -> DataFrame:
    """Count of valid text values per named field position (one row, one column per
    field); the split runs once per line."""
    once = compute_once(lines, {"_f": F.split(F.col("value"), ",", -1)}, keep=[])
    return once.agg(*[F.count_if(is_valid_text(F.get(F.col("_f"), i))).alias(f"valid_{n}")
                      for n, i in fields.items()])


def observe_lines(lines: DataFrame, name: str = "line_quality") -> tuple[DataFrame, Observation]:
    """Attach cheap counters (no distinct) to a line frame; they fill in when an action runs
    over the returned frame, without a second pass."""
    v = F.col("value")
    is_header = F.coalesce(v.startswith(HEADER_TOKEN), F.lit(False))
    n_fields = field_count(v)
    obs = Observation(name)
    observed = lines.observe(obs, F.count(F.lit(1)).alias("lines_total"),
                             F.count_if(is_header).alias("header_lines"),
                             F.count_if(~is_header & (n_fields < MIN_FIELDS)).alias("short_lines"))
    return observed, obs
