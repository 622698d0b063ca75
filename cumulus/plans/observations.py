"""Binding of the driver's TPC-H-style tables to the observation data model.

There is no weather file among the given tables, so one observation view is derived from
``lineitem`` (facts) and ``supplier`` (locations). Every measure is an integer or a dyadic
fraction, so sums are exact and independent of row order. The same view is written in SQL
in :mod:`cumulus.plans.oracle`; the two must stay in step.

Three shapes of the same facts are offered:

* :func:`observations` - typed 21-column fact frame, dates as ``M/d/yyyy`` text (like the
  raw file), parsed by the operators.
* :func:`observation_lines` - the same rows as comma-separated text lines (what
  ``spark.read.text`` returns for the raw file), for the delimited-text path.
* :func:`locations` - the location dimension.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import let
from ..schema import FACT_COLUMNS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fact_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact scan for per-row heavy work (text building and parsing)."""
    return table(spark, sf_dir, "lineitem")


def _fact_exprs() -> dict[str, Column]:
    q = F.col("l_quantity") / 2
    okey, pkey = F.col("l_orderkey"), F.col("l_partkey")
    pct = lambda c: F.round(F.col(c) * 100)  # noqa: E731  0.07 -> 7.0
    return {
        "location_id": F.col("l_suppkey").cast("bigint"),
        "weather_date": F.date_format("l_shipdate", "M/d/yyyy"),
        "weather_code": (okey % 4).cast("int"),
        "temperature_2m_max": 10 + q,
        "temperature_2m_min": q,
        "temperature_2m_mean": 5 + q,
        "apparent_temperature_max": 12 + q,
        "apparent_temperature_min": 2 + q,
        "apparent_temperature_mean": 7 + q,
        "daylight_duration": (43200 + (pkey % 7) * 600).cast("double"),
        "sunshine_duration": ((pkey % 43) * 1000).cast("double"),
        "precipitation_sum": pct("l_discount") * 8,
        "rain_sum": pct("l_discount") * 6,
        "precipitation_hours": (okey % 25).cast("double"),
        "wind_speed_10m_max": F.col("l_linenumber").cast("double"),
        "wind_gusts_10m_max": pct("l_tax") * 10,
        "wind_direction_10m_dominant": ((okey % 36) * 10).cast("double"),
        "shortwave_radiation_sum": q,
        "et0_fao_evapotranspiration": F.when(okey % 97 != 0, (pkey % 160) / 8),
        "sunrise": F.lit(None).cast("string"),
        "sunset": F.lit(None).cast("string"),
    }


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed fact frame in file column order plus the parsed ``obs_date``. Unused columns
    are pruned by Catalyst."""
    exprs = _fact_exprs()
    li = table(spark, sf_dir, "lineitem")
    # ``obs_date`` is the typed date an ingest job writes next to the raw text (the text
    # itself stays for the analyses defined on it); analyses then skip re-parsing
    return li.select(*[exprs[n].cast(t).alias(n) for n, t in FACT_COLUMNS],
                     F.to_date("l_shipdate").alias("obs_date"))


# Columns of the binding that only ever hold whole numbers; they are written without a
# fraction (``7``, not ``7.0``) as an integer-reading job expects.
_WHOLE = {"location_id", "weather_code", "daylight_duration", "sunshine_duration",
          "precipitation_sum", "rain_sum", "precipitation_hours", "wind_speed_10m_max",
          "wind_gusts_10m_max", "wind_direction_10m_dominant"}


def observation_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The facts as raw comma-separated lines in a single ``value`` column (NULL -> '')."""
    fields = _line_fields()
    return fact_table(spark, sf_dir).select(F.concat_ws(",", *[fields[n] for n, _ in FACT_COLUMNS]).alias("value"))


def _line_fields() -> dict[str, Column]:
    exprs, out = _fact_exprs(), {}
    for name, _ in FACT_COLUMNS:
        c = exprs[name]
        out[name] = F.coalesce(c.cast("bigint").cast("string") if name in _WHOLE else c.cast("string"), F.lit(""))
    return out


def dirty_lines(spark: SparkSession, sf_dir: str, rows: Column | None = None) -> DataFrame:
    """The facts as raw lines with every fault the text path knows, placed by the row's key:
    repeated headers, short and blank lines, dates that are missing, odd or roll over, blank,
    ``null``, padded and non-numeric numbers, and readings beyond the plausible ranges. ``rows``, a
    condition on the facts, picks those whose lines are wanted before any is put together."""
    # with a higher-order function in it Spark splits the projection into small methods; as whole-stage
    # code it is a single one, longer than the JVM compiles
    k = let(F.col("l_orderkey") * 7 + F.col("l_linenumber"), lambda key: key)
    fields, day = _line_fields(), F.col("l_shipdate")

    def by(modulus: int, *texts) -> Column:
        out = F.when(k % modulus == 0, texts[0])
        for i, t in enumerate(texts[1:], 1):
            out = out.when(k % modulus == i, t)
        return out

    def lit(*texts: str) -> list[Column]:
        return [F.lit(t) for t in texts]

    padded = {c: F.concat(F.lit("  "), fields[c], F.lit(" ")) for c in ("location_id", "precipitation_hours")}
    fields |= {
        "weather_date": by(17, *lit("null", "", "not a date"), F.date_format(day, "yyyy-MM-dd"), F.date_format(day, "d/M/yyyy"),
                           F.date_format(day, "M/d/yyyy'x'")).otherwise(fields["weather_date"]),
        "precipitation_hours": by(19, *lit("null", "", "x7"), padded["precipitation_hours"]).otherwise(fields["precipitation_hours"]),
        "location_id": by(23, *lit("", "null", "abc"), padded["location_id"]).otherwise(fields["location_id"]),
        "temperature_2m_max": by(29, *lit("99", "-50", "n/a", "60")).otherwise(fields["temperature_2m_max"]),
        "et0_fao_evapotranspiration": by(31, *lit("25", "-1", "20", "null")).otherwise(fields["et0_fao_evapotranspiration"]),
        "temperature_2m_mean": by(37, *lit("null", " ")).otherwise(fields["temperature_2m_mean"]),
        "shortwave_radiation_sum": by(41, *lit("null", "")).otherwise(fields["shortwave_radiation_sum"]),
    }
    whole = F.concat_ws(",", *[fields[n] for n, _ in FACT_COLUMNS])
    header = F.lit(",".join(["location_id", "date", *[n for n, _ in FACT_COLUMNS[2:]]]))
    # a short line whose missing fields are still counted by their commas, and one without these
    short = F.concat_ws(",", *[fields[n] for n, _ in FACT_COLUMNS[:5]])
    line = (F.when(k % 11 == 0, header).when(k % 13 == 0, F.concat(short, F.lit("," * 16))).when(k % 13 == 1, short)
            .when(k % 43 == 0, F.lit("")).otherwise(whole))
    facts = fact_table(spark, sf_dir)
    return (facts if rows is None else facts.where(rows)).select(line.alias("value"))


def locations(spark: SparkSession, sf_dir: str, registered_only: bool = False) -> DataFrame:
    """Location dimension (location_id, city_name) from ``supplier``.

    ``registered_only`` keeps suppliers whose account balance is not negative; the others
    then fall back to the lookup default.
    """
    s = table(spark, sf_dir, "supplier")
    if registered_only:
        s = s.where(F.col("s_acctbal") >= 0)
    return s.select(F.col("s_suppkey").cast("bigint").alias("location_id"),
                    F.col("s_name").alias("city_name"))
