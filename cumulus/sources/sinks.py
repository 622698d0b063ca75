"""Sinks: typed Parquet/CSV output, overwrite, manual partition folders, and the legacy
``key<TAB>value`` text line."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def legacy_text_lines(monthly: DataFrame) -> DataFrame:
    """``district|yyyy-MM<TAB>total,mean`` with both numbers as ``%.2f``, one line per
    group (the typed columns remain the primary output)."""
    return monthly.select(F.concat(
        F.col("label"), F.lit("\t"),
        F.format_string("%.2f,%.2f", F.col("total_precipitation_hours"), F.col("mean_temperature")),
    ).alias("value"))


def write_text(lines: DataFrame, path: str) -> None:
    """One text file per task under ``path`` (replaced if present)."""
    lines.select("value").write.mode("overwrite").text(path)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None,
                  mode: str = "overwrite") -> None:
    """Parquet write; ``overwrite`` replaces the target instead of deleting it by hand.
    With ``partition_by`` each value lands in a ``col=value`` folder."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_format(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", **options) -> None:
    """Format-named save (``df.write.save(path, format=...)``)."""
    df.write.save(path, format=fmt, mode=mode, **options)


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", header).csv(path)
