"""Delimited-text path for the observation file over ``spark.read.text`` output (a
``value`` column): header drop, field-count check, positional field pick, text validity
and safe numeric parse. The split runs once per line (see ``plans/compute_once``); every
typed field is a cheap pick from it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import parse_date
from ..functions.text import is_valid_text
from ..plans.compute_once import compute_once
from ..schema import FACT_COLUMNS, HEADER_TOKEN, MIN_FIELDS


@dataclass
class ParsedLines:
    """``valid``: typed rows; ``rejected``: header-free lines with too few fields."""

    valid: DataFrame
    rejected: DataFrame
    all_rows: DataFrame


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Line-text scan of one file or a folder of files."""
    return spark.read.text(path)


def field_count(value: Column) -> Column:
    # Trailing empty fields do not count (a line ending in ",,," has fewer fields).
    # fields = commas + 1, counted without a second split
    body = F.rtrim(value, F.lit(","))
    return F.length(body) - F.length(F.replace(body, F.lit(","), F.lit(""))) + 1


def has_fields(fields: Column, n: int) -> Column:
    """Whether a split line has ``n`` fields by :func:`field_count`: some field from the n-th on is not
    empty. A look at the rest of the split is all it takes; counting would read the line again."""
    if n <= 1:
        return F.lit(True)
    return F.length(F.array_join(F.slice(fields, n, F.size(fields)), "")) > 0


#: How every text begins that casts to a floating number: control characters and blanks, a sign, then a
#: digit, a point and a digit, ``NaN`` or ``Infinity``.
NUMBER_START = r"^[\x00-\x20]*[+-]?(?:\.?[0-9]|[nN][aA][nN]|[iI][nN][fF])"


def typed_field(raw: Column, dtype) -> Column:
    """Text field -> typed value. Blank, the literal ``null`` and unparseable numbers give
    NULL (a numeric cast rejects both), so one bad value never fails the job."""
    t = F.trim(raw)
    if dtype.typeName() == "string":
        return F.when(is_valid_text(t), t)
    return t.try_cast(dtype)


def _castable(raw: Column, dtype) -> Column:
    """The field, NULL where it begins like no number at all (blank, a header's name, ``null``): a failed
    cast to a floating number is an exception thrown and caught, far dearer than a look."""
    return F.when(raw.rlike(NUMBER_START), raw) if dtype.typeName() == "double" else raw


# --- fixed values: what a line can be ------------------------------------------------------
HEADER, BLANK, SHORT, BAD_DATE, VALID = "header", "blank", "short_line", "bad_date", "valid"
REJECTED = (SHORT, BAD_DATE)


def classified(lines: DataFrame, min_fields: int = MIN_FIELDS, columns=FACT_COLUMNS,
               date_mode: str = "lenient") -> DataFrame:
    """Every line with its ``status``, its typed fields, ``obs_date``, and the ``line`` itself.

    The line is split once and its date parsed once. A header line, wherever it stands, and a line
    without any character hold no record; a short line and one without a valid date are rejected;
    the rest is valid. Typed fields of anything but valid lines are what the text gives."""
    v = F.col("line")
    once = compute_once(lines.select(F.col("value").alias("line")), {
        "_header": F.coalesce(v.startswith(HEADER_TOKEN), F.lit(False)),
        "_f": F.split(v, ",", -1),
    })
    names = {n: i for i, (n, _) in enumerate(columns)}
    dated = compute_once(once, {"obs_date": parse_date(F.get(F.col("_f"), names["weather_date"]), date_mode)})
    status = (F.when(F.col("_header"), HEADER).when(F.coalesce(F.length(v), F.lit(0)) == 0, BLANK)
              .when(~F.coalesce(has_fields(F.col("_f"), min_fields), F.lit(False)), SHORT).when(F.col("obs_date").isNull(), BAD_DATE).otherwise(VALID))
    return dated.select(status.alias("status"), "line", "obs_date",
                        *[typed_field(_castable(F.get(F.col("_f"), i), t), t).alias(n) for i, (n, t) in enumerate(columns)])


def parse_lines(lines: DataFrame, min_fields: int = MIN_FIELDS,
                columns=FACT_COLUMNS) -> ParsedLines:
    """Split comma-separated lines into typed columns by position.

    Every line starting with the header token is dropped (so concatenated files with
    repeated headers work). Lines with fewer than ``min_fields`` fields go to ``rejected``.
    The split runs once per line; each typed field is a cheap pick from it, so fields a
    query does not use are pruned away.
    """
    v, f = F.col("_line"), F.col("_f")
    unpacked = compute_once(lines.select(F.col("value").alias("_line")), {
        "_is_header": F.coalesce(v.startswith(HEADER_TOKEN), F.lit(False)),
        "_f": F.split(v, ",", -1),
    }, keep=["_line"])
    parsed = unpacked.where(~F.col("_is_header")).select(
        "_line", has_fields(f, min_fields).alias("_full"),
        *[typed_field(F.get(f, i), t).alias(n) for i, (n, t) in enumerate(columns)])
    ok = F.coalesce(F.col("_full"), F.lit(False))
    return ParsedLines(
        valid=parsed.where(ok).drop("_line", "_full"),
        rejected=parsed.where(~ok).select("_line", field_count(v).alias("_n_fields")),
        all_rows=parsed.withColumn("_n_fields", field_count(v)).drop("_full"),
    )


def read_observation_files(spark: SparkSession, path: str, min_fields: int = MIN_FIELDS,
                           columns=FACT_COLUMNS, stream: bool = False) -> ParsedLines:
    """The text path over files: the lines go through :func:`parse_lines`, so files and line
    frames follow the same rules and a rejected line is kept byte for byte. An empty line in
    a file holds no record and is passed over."""
    lines = (spark.readStream if stream else spark.read).text(path).where(F.length("value") > 0)
    parsed = parse_lines(lines, min_fields, columns)
    return ParsedLines(valid=parsed.valid, rejected=parsed.rejected.select("_line"), all_rows=parsed.all_rows)
