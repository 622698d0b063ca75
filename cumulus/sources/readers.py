"""Readers: headered CSV (inferred or fixed schema), JSON, text-to-rows, Parquet,
format-named load, location dimension, and the ingest job that writes the typed fact
table once so every analysis reads Parquet with pushdown."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import parse_date
from ..functions.text import clean_city_name
from ..plans.compute_once import compute_once
from ..plans.joins import dedup_locations
from ..schema import FACT_COLUMNS, FACT_SCHEMA, LOCATION_SCHEMA, RAW_HEADER_NAMES
from .lines import BAD_DATE, BLANK, HEADER, REJECTED, SHORT, VALID, classified

# Reader options: blank and the literal "null" mean missing, surrounding blanks are ignored,
# a bad value nulls only its own field (PERMISSIVE keeps the rest of the row).
CSV_OPTIONS = {
    "nullValue": "null",
    "ignoreLeadingWhiteSpace": "true",
    "ignoreTrailingWhiteSpace": "true",
    "mode": "PERMISSIVE",
}


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """Headered CSV with inferred types (a separate inference pass; prefer a fixed schema)."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def normalise_headers(df: DataFrame) -> DataFrame:
    """Rename unit-suffixed raw headers (``temperature_2m_max (°C)``) to plain names."""
    return df.withColumnsRenamed({k: v for k, v in RAW_HEADER_NAMES.items() if k in df.columns and k != v})


def read_fact_csv(spark: SparkSession, path: str, schema: T.StructType = FACT_SCHEMA) -> DataFrame:
    """Fixed-schema delimited fact file: header skipped, columns by position, blank or
    ``null`` text -> NULL, a malformed value nulls only its own field."""
    return (spark.read.schema(schema).option("header", True).option("enforceSchema", True)
            .options(**CSV_OPTIONS).csv(path))


def read_location_csv(spark: SparkSession, path: str | list[str], clean_names: bool = False) -> DataFrame:
    """Location dimension: ids unique (a later duplicate line wins: by file path, then place in
    the file), optional removal of footnote marks in names."""
    df = (spark.read.schema(LOCATION_SCHEMA).option("header", True)
          .options(**CSV_OPTIONS).csv(path)
          .withColumn("_order", F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"),
                                         F.monotonically_increasing_id())))
    if clean_names:
        df = df.withColumn("city_name", clean_city_name("city_name"))
    return dedup_locations(df, order_col="_order")


def read_json(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def read_format(spark: SparkSession, path: str, fmt: str | None = None, **options) -> DataFrame:
    """``spark.read.load`` - Parquet unless a format is named."""
    return spark.read.load(path, format=fmt, **options) if fmt else spark.read.load(path, **options)


def text_to_rows(spark: SparkSession, path: str, schema_text: str | None = None,
                 types: dict[str, str] | None = None, sep: str = ",") -> DataFrame:
    """``name, age``-style text lines -> rows. Column names come from ``schema_text``
    (space separated, built at run time) and default to string; ``types`` casts some of them
    (``try_cast``, so bad text gives NULL). Fields are trimmed."""
    names = (schema_text or "").split()
    parts = F.split(F.col("value"), sep, -1)
    cols = []
    for i, n in enumerate(names):
        c = F.trim(F.get(parts, i))
        if types and n in types:
            c = c.try_cast(types[n])
        cols.append(c.alias(n))
    return spark.read.text(path).where(F.length(F.trim("value")) > 0).select(*cols)


@dataclass
class Ingested:
    """``valid``: typed rows with year and month; ``rejected``: what was not taken, with its status;
    ``counts``: lines or rows by status, as they lie in the table, and ``total``."""

    valid: DataFrame
    rejected: DataFrame
    counts: dict[str, int]


def _write_by_status(rows: DataFrame, path: str, by_year: bool) -> tuple[dict[str, int], T.StructType]:
    """Write ``rows`` (status, obs_date, ...) once, in folders by status and year, and count them there.

    Rows are first brought together by status and year: the planner merges small partitions and
    splits large ones by their real size, so the number of files follows from the data and not from
    the tasks that read it, and a year with a third of all rows is several files. Within a file
    rows are sorted by month and location, so a filter on either skips row groups. Every row is
    written, whatever its status; the counts come from the files' footers, so a task that ran twice
    counts once."""
    rows = rows.withColumns({"year": F.year("obs_date"), "month": F.month("obs_date")})
    keys = ["status", "year"] if by_year else ["status"]
    order = [c for c in (*keys, "month", "location_id") if c in rows.columns]
    laid = rows.hint("rebalance", *[F.col(c) for c in keys]).sortWithinPartitions(*order)
    laid.write.mode("overwrite").partitionBy(*keys).parquet(path)
    stored = rows.sparkSession.read.schema(rows.schema).parquet(path).groupBy("status").count()
    counts = dict.fromkeys((HEADER, BLANK, SHORT, BAD_DATE, VALID), 0) | {r.status: r["count"] for r in stored.collect()}
    return counts | {"total": sum(counts.values())}, rows.schema


def _read_by_status(spark: SparkSession, path: str, schema: T.StructType, status: str) -> DataFrame:
    """The rows of one status; none if nothing had it."""
    own = T.StructType([f for f in schema.fields if f.name != "status"])
    try:
        return spark.read.schema(own).parquet(f"{path}/status={status}")
    except AnalysisException:  # no such folder
        return spark.createDataFrame([], own)


def ingest_lines(lines: DataFrame, path: str, date_mode: str = "lenient", by_year: bool = True) -> Ingested:
    """Raw lines (``value``) -> typed Parquet under ``path``, with the rejected lines beside it, in one
    pass over the lines."""
    spark = lines.sparkSession
    rows = classified(lines, date_mode=date_mode)
    # the line itself is kept of what is rejected only
    rows = rows.withColumn("line", F.when(F.col("status") != VALID, F.col("line")))
    counts, schema = _write_by_status(rows, path, by_year)
    valid = _read_by_status(spark, path, schema, VALID).drop("line")
    rejected = [_read_by_status(spark, path, schema, s).select(F.lit(s).alias("status"), "line", *[n for n, _ in FACT_COLUMNS]) for s in REJECTED]
    return Ingested(valid, rejected[0].union(rejected[1]), counts)


def ingest_observations(spark: SparkSession, facts: DataFrame, path: str,
                        date_mode: str = "lenient", partition_by_year: bool = True,
                        bad_dates: str | None = None) -> DataFrame:
    """Write the typed fact table once: dates parsed, year and month added. Rows without a valid date
    go to ``path/status=bad_date``, and to ``bad_dates`` too when given; the others are returned.
    Partitioned by year, so a year or date-range filter prunes whole folders and the rest is
    skipped by Parquet row-group statistics."""
    dated = compute_once(facts, {"obs_date": parse_date("weather_date", date_mode)})
    rows = dated.withColumn("status", F.when(F.col("obs_date").isNull(), BAD_DATE).otherwise(VALID))
    _, schema = _write_by_status(rows, path, partition_by_year)
    if bad_dates:
        _read_by_status(spark, path, schema, BAD_DATE).select(*facts.columns).write.mode("overwrite").parquet(bad_dates)
    return _read_by_status(spark, path, schema, VALID)


def ingest_files(spark: SparkSession, source: str, target: str, rejects: str | None = None,
                 date_mode: str = "lenient") -> DataFrame:
    """Raw observation files -> typed Parquet partitioned by year, read once.

    Lines follow the text-path rules (header lines dropped, short lines and bad dates rejected, bad
    values NULL). What is rejected always stays, under ``target/status=...``; with ``rejects`` the
    short lines are also written to ``rejects/short_lines`` as they were, and the rows whose date
    does not parse to ``rejects/bad_dates``, from there."""
    done = ingest_lines(spark.read.text(source), target, date_mode)
    if rejects:
        done.rejected.where(F.col("status") == SHORT).select("line").write.mode("overwrite").text(f"{rejects}/short_lines")
        done.rejected.where(F.col("status") == BAD_DATE).drop("status", "line").write.mode("overwrite").parquet(f"{rejects}/bad_dates")
    return done.valid
