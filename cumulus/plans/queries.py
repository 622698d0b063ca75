"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame over the whole
given tables. Column names match :func:`cumulus.plans.oracle.oracle_sql`."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import calendar_parts, parse_date, split_date_parts, us_week_of_year, year_month_key
from ..operators import climate, generic, kpi, ml, quality, stats
from ..schema import FACT_COLUMNS, LOCATION_SCHEMA, RAW_HEADER_NAMES
from ..session import scratch_path
from ..sources import readers
from ..sources.lines import parse_lines, read_observation_files
from ..streaming import incremental
from ..sources.sinks import legacy_text_lines, write_csv, write_parquet
from . import catalog
from .joins import known_locations
from .observations import dirty_lines, fact_table, locations, observation_lines, observations, table
from .oracle import MIN_YEAR
from .views import session_views

Query = Callable[[SparkSession, str], DataFrame]


def _obs(spark, d):
    return observations(spark, d)


def _text_facts(spark, d):
    """Facts through the delimited-text path (header drop, field check, lenient typing)."""
    return parse_lines(observation_lines(spark, d)).valid


def _side_by_side(*rows: DataFrame) -> DataFrame:
    """Frames of one row each, with different columns, as one row."""
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


# ---- core analyses ---------------------------------------------------------------------
def q_monthly_district_weather(spark, d):
    return climate.monthly_district_weather(_obs(spark, d), locations(spark, d), min_year=MIN_YEAR)


def q_monthly_district_weather_text(spark, d):
    return climate.monthly_district_weather(_text_facts(spark, d), locations(spark, d), min_year=MIN_YEAR)


def q_monthly_district_weather_strict(spark, d):
    """The text path with strict dates (month/day/year, then day/month/year, no roll-over);
    on valid dates it must agree with the lenient default."""
    return climate.monthly_district_weather(_text_facts(spark, d), locations(spark, d),
                                            min_year=MIN_YEAR, date_mode="strict")


def q_monthly_district_weather_files(spark, d):
    """The raw lines as text files, read through the text path for files, then the monthly district
    analysis."""
    path = scratch_path(spark, "lines")
    observation_lines(spark, d).write.mode("overwrite").text(path)
    facts = read_observation_files(spark, path).valid
    return climate.monthly_district_weather(facts, locations(spark, d), min_year=MIN_YEAR)


def q_monthly_district_weather_ingested(spark, d):
    """Production path: the raw facts are ingested once into typed Parquet partitioned by
    year (in the shared folder), then analysed; the year bound prunes whole folders."""
    raw = _obs(spark, d).drop("obs_date")
    typed = readers.ingest_observations(spark, raw, scratch_path(spark, "facts"))
    return climate.monthly_district_weather(typed, locations(spark, d), min_year=MIN_YEAR)


def q_streaming_ingest(spark, d):
    """The raw lines land as text files; an availableNow stream parses and appends them to
    a typed table (exactly-once through its checkpoint), which is then read back."""
    root = scratch_path(spark, "stream")
    observation_lines(spark, d).write.mode("overwrite").text(f"{root}/landing")
    q = incremental.start_ingest(spark, f"{root}/landing", f"{root}/typed", f"{root}/checkpoint")
    q.awaitTermination()
    return spark.read.parquet(f"{root}/typed").select(
        "location_id", "obs_date", "precipitation_hours", "et0_fao_evapotranspiration")


def q_fact_csv_scan(spark, d):
    """The facts written as headered CSV (NULL as the literal ``null``), read back through
    the fixed-schema reader: header skipped, columns by position, ``null`` -> NULL."""
    path = scratch_path(spark, "facts-csv")
    (_obs(spark, d).drop("obs_date").write.mode("overwrite")
     .option("header", True).option("nullValue", "null").csv(path))
    facts = readers.read_fact_csv(spark, path)
    return facts.select("location_id", parse_date("weather_date").alias("obs_date"),
                        "temperature_2m_max", "precipitation_hours", "et0_fao_evapotranspiration")


def q_json_scan(spark, d):
    """Facts written as JSON lines and read back with an inferred schema (format-named load)."""
    path = scratch_path(spark, "facts-json")
    (_obs(spark, d).select("location_id", "weather_date", "precipitation_hours",
                           "et0_fao_evapotranspiration").write.mode("overwrite").json(path))
    facts = readers.read_format(spark, path, "json")
    return facts.select("location_id", parse_date("weather_date").alias("obs_date"),
                        "precipitation_hours", "et0_fao_evapotranspiration")


def q_text_rows_scan(spark, d):
    """``name, value`` text lines turned into rows under a schema given as a string."""
    path = scratch_path(spark, "names-txt")
    sup = table(spark, d, "supplier")
    (sup.select(F.concat_ws(", ", "s_name", F.col("s_nationkey").cast("string")).alias("value"))
     .write.mode("overwrite").text(path))
    return readers.text_to_rows(spark, path, "name nation", {"nation": "int"})


def q_district_lookup_default(spark, d):
    return climate.monthly_district_weather(_text_facts(spark, d),
                                            locations(spark, d, registered_only=True),
                                            min_year=MIN_YEAR)


def q_legacy_text_output(spark, d):
    return legacy_text_lines(climate.monthly_district_weather(_text_facts(spark, d), locations(spark, d),
                                                              min_year=MIN_YEAR))


def _int_hours_facts(spark, d):
    # the peak-month job reads hours as whole numbers; other text gives NULL (counted)
    cols = [(n, T.IntegerType() if n == "precipitation_hours" else t) for n, t in FACT_COLUMNS]
    return parse_lines(observation_lines(spark, d), columns=cols).valid


def q_peak_precipitation_month(spark, d):
    return climate.peak_precipitation_month(_int_hours_facts(spark, d))


def q_monthly_precipitation_totals(spark, d):
    return climate.precipitation_by_month(_int_hours_facts(spark, d))


def q_combined_observations(spark, d):
    return climate.combined_observations(_obs(spark, d), locations(spark, d))


def q_coolest_cities(spark, d):
    return climate.city_temperature_ranking(_obs(spark, d), locations(spark, d), direction="asc")


def q_warmest_cities(spark, d):
    return climate.city_temperature_ranking(_obs(spark, d), locations(spark, d), direction="desc",
                                            display="desc")


def q_coolest_cities_600(spark, d):
    return climate.city_temperature_ranking(_obs(spark, d), locations(spark, d), min_records=600)


def q_seasonal_et0(spark, d):
    return climate.seasonal_et0(_obs(spark, d), locations(spark, d))


def q_monthly_radiation(spark, d):
    return climate.monthly_radiation(_obs(spark, d), locations(spark, d))


def q_top_radiation_months(spark, d):
    return climate.top_radiation_months(_obs(spark, d), locations(spark, d))


def q_high_radiation_flag(spark, d):
    o = climate.with_obs_date(_obs(spark, d))
    return o.select("location_id", "obs_date", "shortwave_radiation_sum",
                    climate.high_radiation_flag("shortwave_radiation_sum").alias("is_high_radiation"))


def q_clean_observations(spark, d):
    return climate.clean_observations(_obs(spark, d)).select(
        "location_id", "obs_date", "year_val", "month_val", "week_val", "is_high_radiation", "temp_max")


def q_calendar_parts(spark, d):
    """Date parsed from the text once, then year / month / US week in one projection."""
    o = _obs(spark, d).select("location_id", "weather_date")
    parsed = climate.with_obs_date(o)
    parts = calendar_parts("obs_date")
    return parsed.withColumns({"year_val": parts["year"], "month_val": parts["month"],
                               "week_val": parts["week"]}).drop("weather_date")


def q_valid_text(spark, d):
    """Valid (not blank, not 'null') text values per field of the raw lines."""
    return quality.valid_text_counts(observation_lines(spark, d), {
        "location_id": 0, "weather_date": 1, "temperature_2m_mean": 5,
        "precipitation_hours": 13, "et0_fao_evapotranspiration": 18})


def q_hottest_month_per_year(spark, d):
    return climate.hottest_month_per_year(_obs(spark, d))


def q_hottest_month_weekly_max(spark, d):
    return climate.hottest_month_weekly_max(_obs(spark, d))


def _distinct_dates(spark, d):
    o = _obs(spark, d).select("weather_date").distinct()
    return o.withColumn("obs_date", parse_date("weather_date"))


def q_us_week_of_year(spark, d):
    return _distinct_dates(spark, d).select("obs_date", us_week_of_year("obs_date").alias("week_val"))


def q_year_month_key(spark, d):
    return _distinct_dates(spark, d).select("obs_date", year_month_key("obs_date").alias("year_month"))


def q_parse_dates(spark, d):
    o = _obs(spark, d).select("weather_date").distinct()
    return o.select("weather_date", parse_date("weather_date", "lenient").alias("lenient_date"),
                    parse_date("weather_date", "strict").alias("strict_date"))


def q_split_date_parts(spark, d):
    o = _obs(spark, d).select("weather_date").distinct()
    y, m, dd = split_date_parts("weather_date")
    return o.select("weather_date", y.alias("year_val"), m.alias("month_val"), dd.alias("day_val"))


def q_known_location_filter(spark, d):
    o = climate.with_obs_date(_obs(spark, d))
    return known_locations(o, locations(spark, d, registered_only=True)).select(
        "location_id", "obs_date", "shortwave_radiation_sum")


def q_safe_numeric_parse(spark, d):
    f = _text_facts(spark, d)
    return f.select("location_id", parse_date("weather_date").alias("obs_date"), "et0_fao_evapotranspiration")


def q_quality_counters(spark, d):
    return quality.quality_counters(observation_lines(spark, d), min_year=MIN_YEAR)


# ---- statistics ------------------------------------------------------------------------
def _model_rows(spark, d, keep_split_key=False):
    return stats.modelling_set(_obs(spark, d), keep_split_key=keep_split_key)


def q_et0_correlations(spark, d):
    return stats.et0_correlations(_obs(spark, d))


def q_et0_correlations_exact_types(spark, d):
    return stats.et0_correlations(_obs(spark, d), exact_types=True)


def q_et0_correlations_nulls_as_zero(spark, d):
    return stats.et0_correlations(_obs(spark, d), nulls="zero")


def q_feature_projection(spark, d):
    return _model_rows(spark, d)


def q_feature_summary(spark, d):
    return stats.feature_summary(_model_rows(spark, d))


def q_simple_regression(spark, d):
    return stats.simple_regression(_obs(spark, d))


def q_regression_metrics(spark, d):
    return stats.fitted_line_metrics(_model_rows(spark, d))


def q_deterministic_split(spark, d):
    return stats.split_summary(_model_rows(spark, d, keep_split_key=True))


def q_global_means(spark, d):
    return _model_rows(spark, d).agg(
        F.round(F.avg("precipitation_hours"), 2).alias("avg_precip"),
        F.round(F.avg("sunshine_duration"), 2).alias("avg_sunshine"),
        F.round(F.avg("wind_speed"), 2).alias("avg_wind"),
        F.round(F.avg("et0"), 2).alias("avg_et0"))


def q_low_et0_conditions_actual(spark, d):
    rows = _model_rows(spark, d).where(F.col("et0") < 1.5)
    return stats.mean_conditions(rows, "et0", "avg_et0")


# ---- Spark ML ------------------------------------------------------------------------
def _fitted(spark, d, *which):
    return ml.fit_models(_model_rows(spark, d, keep_split_key=True), which)


def q_linear_regression_eval(spark, d):
    rmse, r2 = _fitted(spark, d, "lr").metrics["lr"]
    # 6 dp: the least-squares solution is unique, so any exact solver agrees to this precision
    row = spark.createDataFrame([(ml.MODEL_TITLES["lr"], float(rmse), float(r2))],
                                "Model string, RMSE double, R2 double")
    return row.select("Model", F.round("RMSE", 6).alias("RMSE"), F.round("R2", 6).alias("R2"))


def q_model_comparison(spark, d):
    return ml.comparison_table(spark, _fitted(spark, d, "lr", "rf", "gbt"))


def q_feature_importance(spark, d):
    return ml.feature_importances(spark, _fitted(spark, d, "gbt").models["gbt"])


def _month_rows(facts):
    o = climate.with_obs_date(facts).where(F.month("obs_date") == 5)
    return o.select("location_id", *[F.col(src).cast("double").alias(dst) for src, dst in stats.MODEL_FEATURES.items()])


def q_scenario_scoring(spark, d):
    return ml.score(_fitted(spark, d, "gbt").models["gbt"], ml.location_scenarios(_month_rows(_obs(spark, d))))


def q_low_et0_conditions(spark, d):
    return ml.low_et0_conditions(_fitted(spark, d, "gbt").predictions["gbt"])


#: Settings under which SQL grows the very same trees: one tree on all rows, or two rounds, of two
#: levels, with more bins than a feature has values.
ONE_TREE = {"num_trees": 1, "maxDepth": 2, "maxBins": 256, "bootstrap": False}
TWO_ROUNDS = {"max_iter": 2, "max_depth": 2, "maxBins": 256}


def _signal(facts):
    """The facts with an ET0 that sun raises and rain lowers; the bound ET0 remains as noise."""
    et0 = F.col(stats.ET0) / 64 + F.col("sunshine_duration") / 8000 + (24 - F.col("precipitation_hours")) / 32
    return facts.withColumn(stats.ET0, et0)


def _fitted_exactly(spark, d, *which):
    rows = stats.modelling_set(_signal(_obs(spark, d)), keep_split_key=True)
    return ml.fit_models(rows, which, forest=ONE_TREE, boosting=TWO_ROUNDS)


def q_model_comparison_exact(spark, d):
    """Linear model, one tree and two boosting rounds side by side, on settings that SQL can solve."""
    table = ml.comparison_table(spark, _fitted_exactly(spark, d, "lr", "rf", "gbt"))
    return table.select("Model", F.round("RMSE", 6).alias("RMSE"), F.round("R2", 6).alias("R2"))


def q_feature_importance_exact(spark, d):
    models = _fitted_exactly(spark, d, "rf", "gbt").models
    parts = [ml.feature_importances(spark, m).select(F.lit(ml.MODEL_TITLES[k]).alias("Model"), "feature", F.round("importance", 6).alias("importance"))
             for k, m in models.items()]
    return parts[0].union(parts[1])


def q_scenario_scoring_exact(spark, d):
    """Each location's mean conditions scored by the boosted trees; every seventh lacks its wind."""
    scenarios = ml.location_scenarios(_month_rows(_obs(spark, d)))
    asked = scenarios.withColumn("wind_speed", F.when(F.col("location_id") % 7 != 0, F.col("wind_speed")))
    out = ml.score(_fitted_exactly(spark, d, "gbt").models["gbt"], asked)
    return out.select("location_id", *[F.round(c, 6).alias(c) for c in [*ml.FEATURE_NAMES, "prediction"]])


def q_low_et0_conditions_exact(spark, d):
    """Mean conditions of the test rows predicted below the threshold, and how many these are."""
    scored = _fitted_exactly(spark, d, "gbt").predictions["gbt"]
    share = scored.agg(F.count_if(F.col("prediction") < 1.5).alias("n_low"), F.count("*").alias("n_scored"))
    return _side_by_side(ml.low_et0_conditions(scored), share)


# ---- dashboard KPIs --------------------------------------------------------------------
def q_extreme_weather_days(spark, d):
    return kpi.extreme_weather_days(_obs(spark, d))


def q_hot_share(spark, d):
    return kpi.hot_share(_obs(spark, d))


def q_hot_share_months(spark, d):
    # monthly means of the bound temperatures centre near 22.75 (82% above 20 at sf0.01), so 20
    # (not 30, which about 1% reach) keeps both classes well populated in the check
    return kpi.hot_share(_obs(spark, d), threshold=20.0, grain="month")


def q_extreme_location_days(spark, d):
    return kpi.extreme_weather_days(_obs(spark, d), grain="location_day")


def q_top_districts_precipitation(spark, d):
    return kpi.top_districts_precipitation(_obs(spark, d), locations(spark, d))


def q_wettest_month_by_district(spark, d):
    return kpi.wettest_month_by_district(_obs(spark, d), locations(spark, d))


def _dashboard(spark, d):
    return kpi.dashboard(_obs(spark, d), locations(spark, d))


def q_dashboard_extreme_days(spark, d):
    return _dashboard(spark, d)["extreme_weather_days"]


def q_dashboard_hot_share(spark, d):
    return _dashboard(spark, d)["hot_share"]


def q_dashboard_top_districts(spark, d):
    return _dashboard(spark, d)["top_districts_precipitation"]


def q_dashboard_wettest_month(spark, d):
    return _dashboard(spark, d)["wettest_month_by_district"]


# ---- generic DataFrame / SQL surface ---------------------------------------------------
def q_project_arith(spark, d):
    o = climate.with_obs_date(_obs(spark, d))
    return generic.project_arith(o, ["location_id", "obs_date"], "et0_fao_evapotranspiration", 1,
                                 "et0_plus_one")


def q_range_filter(spark, d):
    o = climate.with_obs_date(_obs(spark, d))
    return generic.range_filter(o, "precipitation_hours", 13, 19,
                                ["location_id", "obs_date", "precipitation_hours"])


def q_prefix_label(spark, d):
    return generic.prefix_label(table(spark, d, "supplier"), "s_name")


def q_count_by_group(spark, d):
    return generic.count_by_group(_obs(spark, d), "et0_fao_evapotranspiration")


def q_sql_over_view(spark, d):
    return generic.sql_over_view(
        spark, _obs(spark, d), "observations",
        "SELECT location_id, COUNT(*) AS n_rows FROM observations "
        "WHERE precipitation_hours > :min_hours GROUP BY location_id",
        {"min_hours": 0})


def q_scan_parquet(spark, d):
    return spark.read.load(f"{d.rstrip('/')}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_quantity")


def q_sql_on_file(spark, d):
    return generic.sql_on_file(spark, f"{d.rstrip('/')}/supplier.parquet")


def q_merged_schema(spark, d):
    """Two partition folders with different column sets, read back as one merged table."""
    part = table(spark, d, "part").select("p_partkey", F.col("p_size").cast("bigint").alias("single"))
    root = scratch_path(spark, "merged-schema")
    small = part.where(F.col("single") <= 25).withColumn("double", F.col("single") * F.col("single"))
    large = part.where(F.col("single") > 25).withColumn(
        "triple", F.col("single") * F.col("single") * F.col("single"))
    generic.write_partition(small, root, "key", 1)
    generic.write_partition(large, root, "key", 2)
    return generic.read_merged(spark, root).select("p_partkey", "single", "double", "triple", "key")


def q_csv_inferred_renamed(spark, d):
    """Facts written as CSV under the raw, unit-suffixed headers, read back with inferred types
    and plain names."""
    path = scratch_path(spark, "facts-raw-csv")
    raw = {plain: header for header, plain in RAW_HEADER_NAMES.items()}
    write_csv(_obs(spark, d).select("location_id", "weather_date", "temperature_2m_max", "precipitation_hours")
              .withColumnsRenamed(raw), path)
    facts = readers.normalise_headers(readers.read_csv_inferred(spark, path))
    return facts.select(F.col("location_id").cast("bigint").alias("location_id"), parse_date("weather_date").alias("obs_date"),
                        F.col("temperature_2m_max").cast("double").alias("temperature_2m_max"),
                        F.col("precipitation_hours").cast("double").alias("precipitation_hours"))


def q_location_side_file(spark, d):
    """Location side files in which every third id comes twice: the later file wins."""
    path = scratch_path(spark, "side-file")
    locs = locations(spark, d)
    locs = locs.select(*[(F.col(f.name) if f.name in locs.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                         for f in LOCATION_SCHEMA])
    write_csv(locs, f"{path}/first")
    write_csv(locs.where("location_id % 3 = 0").withColumn("city_name", F.concat("city_name", F.lit(" new"))), f"{path}/second")
    return readers.read_location_csv(spark, [f"{path}/first", f"{path}/second"]).select("location_id", "city_name")


def q_overwrite_replaces(spark, d):
    """A second write to the same folder leaves nothing of the first."""
    path = scratch_path(spark, "replaced")
    facts = _obs(spark, d).select("location_id", "obs_date", "precipitation_hours")
    write_parquet(facts.withColumn("precipitation_hours", F.lit(-1.0)), path)
    write_parquet(facts.where("precipitation_hours >= 12"), path)
    return spark.read.parquet(path)


def q_sql_over_views(spark, d):
    """SQL text with a CTE over the registered views: warm days of each city and year."""
    with session_views(spark, catalog.view_frames(_obs(spark, d), locations(spark, d))):
        return spark.sql("""
        WITH warm AS (SELECT location_id, year(obs_date) AS year FROM weather_data WHERE temperature_2m_max > 30),
             days AS (SELECT location_id, year, count(*) AS warm_days FROM warm GROUP BY location_id, year)
        SELECT l.city_name, d.year, d.warm_days FROM days d JOIN location_data l ON l.location_id = d.location_id""")


def q_extreme_days_one_year(spark, d):
    return kpi.extreme_weather_days(_obs(spark, d), year=1996, grain="location_day")


# ---- the text path on lines with faults ----------------------------------------------
def _dirty_facts(spark, d):
    return parse_lines(dirty_lines(spark, d)).valid


def q_dirty_quality_counters(spark, d):
    return quality.quality_counters(dirty_lines(spark, d), min_year=MIN_YEAR)


def q_dirty_valid_text(spark, d):
    return quality.valid_text_counts(dirty_lines(spark, d), {
        "location_id": 0, "weather_date": 1, "temperature_2m_mean": 5,
        "precipitation_hours": 13, "et0_fao_evapotranspiration": 18})


def q_dirty_safe_numeric(spark, d):
    return climate.with_obs_date(_dirty_facts(spark, d)).select(
        "location_id", "obs_date", "temperature_2m_max", "temperature_2m_mean", "precipitation_hours",
        "shortwave_radiation_sum", "et0_fao_evapotranspiration")


def q_dirty_monthly_district_weather(spark, d):
    return climate.monthly_district_weather(_dirty_facts(spark, d), locations(spark, d), min_year=MIN_YEAR)


def q_dirty_coolest_cities(spark, d):
    return climate.city_temperature_ranking(_dirty_facts(spark, d), locations(spark, d), min_records=300)


def q_dirty_seasonal_et0(spark, d):
    return climate.seasonal_et0(_dirty_facts(spark, d), locations(spark, d))


def q_dirty_monthly_radiation(spark, d):
    return climate.monthly_radiation(_dirty_facts(spark, d), locations(spark, d))


def _stored_by_status():
    return [F.count_if(F.col("status") == s).alias(f"stored_{s}") for s in ("short_line", "bad_date")]


def q_dirty_ingest(spark, d):
    """All lines ingested in one pass: the counts by status, and what is read back from the table and
    the quarantine."""
    done = readers.ingest_lines(dirty_lines(spark, d), scratch_path(spark, "ingest"))
    counted = spark.createDataFrame([tuple(done.counts[k] for k in ("total", "header", "blank", "short_line", "bad_date", "valid"))],
                                    "lines_total bigint, header bigint, blank bigint, short_line bigint, bad_date bigint, valid bigint")
    stored = done.valid.agg(F.count("*").alias("stored_valid"), F.sum("precipitation_hours").alias("sum_hours"))
    rejected = done.rejected.agg(*_stored_by_status())
    return _side_by_side(counted, stored, rejected)


#: About so many lines a landed file holds at most.
_LINES_A_FILE = 1_000_000


def q_dirty_streaming_ingest(spark, d):
    """The same lines as files, ingested by the stream in several batches and two runs. Files are
    counted by threes, more of them where there are more lines; a batch takes two thirds of those that landed."""
    root = scratch_path(spark, "dirty-stream")
    files = -(-fact_table(spark, d).count() // (2 * 3 * _LINES_A_FILE)) or 1
    half_of = F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(2))
    for half in (0, 1):
        part = dirty_lines(spark, d, half_of == half)
        part.repartition(3 * files).write.mode("append").text(f"{root}/landing")
        incremental.start_ingest(spark, f"{root}/landing", f"{root}/typed", f"{root}/checkpoint", max_files=2 * files).awaitTermination()
    counts = spark.read.parquet(f"{root}/typed_counts")
    names = ["lines_total", "header", "blank", "short_line", "bad_date", "valid"]
    stored = spark.read.parquet(f"{root}/typed").agg(F.count("*").alias("stored_valid"), F.sum("precipitation_hours").alias("sum_hours"))
    rejected = spark.read.parquet(f"{root}/typed_rejects")
    rejected = rejected.agg(*_stored_by_status())
    return _side_by_side(counts.agg(*[F.sum(n).alias(n) for n in names]), stored, rejected)


# ---- joins with split ids, catalog ---------------------------------------------------
def q_combined_observations_salted(spark, d):
    """The row-level view with ids of more than 500 rows split; same rows as without."""
    return climate.combined_observations(_obs(spark, d), locations(spark, d), hot_rows=500)


def q_known_location_filter_salted(spark, d):
    return known_locations(_obs(spark, d), locations(spark, d, registered_only=True), hot_rows=500).select(
        "location_id", "obs_date", "shortwave_radiation_sum")


def q_catalog_tables(spark, d):
    """Tables, schema and table properties of a database of its own, as rows; it is dropped again."""
    with catalog.own_database(spark):
        catalog.save_table(_obs(spark, d).select("location_id", "obs_date", "weather_code", "precipitation_hours"), "weather_data")
        catalog.save_table(locations(spark, d), "location_data")
        catalog.set_table_properties(spark, "weather_data", {"skip.header.line.count": "1", "note": "it's"})
        return catalog.describe_tables(spark, ["skip.header.line.count", "note"])


def q_city_ranking_shown_last_first(spark, d):
    """Coolest cities, the last rank shown first."""
    return climate.city_temperature_ranking(_obs(spark, d), locations(spark, d), direction="asc", display="desc")


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {
        "monthly_district_weather": q_monthly_district_weather,
        "monthly_district_weather_text": q_monthly_district_weather_text,
        "monthly_district_weather_strict": q_monthly_district_weather_strict,
        "monthly_district_weather_files": q_monthly_district_weather_files,
        "monthly_district_weather_ingested": q_monthly_district_weather_ingested,
        "streaming_ingest": q_streaming_ingest,
        "fact_csv_scan": q_fact_csv_scan,
        "csv_inferred_renamed": q_csv_inferred_renamed,
        "location_side_file": q_location_side_file,
        "overwrite_replaces": q_overwrite_replaces,
        "sql_over_views": q_sql_over_views,
        "extreme_days_one_year": q_extreme_days_one_year,
        "json_scan": q_json_scan,
        "text_rows_scan": q_text_rows_scan,
        "district_lookup_default": q_district_lookup_default,
        "legacy_text_output": q_legacy_text_output,
        "peak_precipitation_month": q_peak_precipitation_month,
        "monthly_precipitation_totals": q_monthly_precipitation_totals,
        "combined_observations": q_combined_observations,
        "coolest_cities": q_coolest_cities,
        "warmest_cities": q_warmest_cities,
        "coolest_cities_600_records": q_coolest_cities_600,
        "seasonal_et0": q_seasonal_et0,
        "monthly_radiation": q_monthly_radiation,
        "top_radiation_months": q_top_radiation_months,
        "high_radiation_flag": q_high_radiation_flag,
        "clean_observations": q_clean_observations,
        "calendar_parts": q_calendar_parts,
        "valid_text": q_valid_text,
        "hottest_month_per_year": q_hottest_month_per_year,
        "hottest_month_weekly_max": q_hottest_month_weekly_max,
        "us_week_of_year": q_us_week_of_year,
        "year_month_key": q_year_month_key,
        "parse_dates": q_parse_dates,
        "split_date_parts": q_split_date_parts,
        "known_location_filter": q_known_location_filter,
        "safe_numeric_parse": q_safe_numeric_parse,
        "quality_counters": q_quality_counters,
        "et0_correlations": q_et0_correlations,
        "et0_correlations_exact_types": q_et0_correlations_exact_types,
        "et0_correlations_nulls_as_zero": q_et0_correlations_nulls_as_zero,
        "feature_projection": q_feature_projection,
        "feature_summary": q_feature_summary,
        "simple_regression": q_simple_regression,
        "regression_metrics": q_regression_metrics,
        "deterministic_split": q_deterministic_split,
        "global_means": q_global_means,
        "low_et0_conditions_actual": q_low_et0_conditions_actual,
        "linear_regression_eval": q_linear_regression_eval,
        "model_comparison": q_model_comparison,
        "feature_importance": q_feature_importance,
        "scenario_scoring": q_scenario_scoring,
        "low_et0_conditions": q_low_et0_conditions,
        "model_comparison_exact": q_model_comparison_exact,
        "feature_importance_exact": q_feature_importance_exact,
        "scenario_scoring_exact": q_scenario_scoring_exact,
        "low_et0_conditions_exact": q_low_et0_conditions_exact,
        "extreme_weather_days": q_extreme_weather_days,
        "hot_share": q_hot_share,
        "hot_share_months": q_hot_share_months,
        "extreme_location_days": q_extreme_location_days,
        "top_districts_precipitation": q_top_districts_precipitation,
        "wettest_month_by_district": q_wettest_month_by_district,
        "dashboard_extreme_days": q_dashboard_extreme_days,
        "dashboard_hot_share": q_dashboard_hot_share,
        "dashboard_top_districts": q_dashboard_top_districts,
        "dashboard_wettest_month": q_dashboard_wettest_month,
        "project_arith": q_project_arith,
        "range_filter": q_range_filter,
        "prefix_label": q_prefix_label,
        "count_by_group": q_count_by_group,
        "sql_over_view": q_sql_over_view,
        "scan_parquet": q_scan_parquet,
        "sql_on_file": q_sql_on_file,
        "merged_schema": q_merged_schema,
        "dirty_quality_counters": q_dirty_quality_counters,
        "dirty_valid_text": q_dirty_valid_text,
        "dirty_safe_numeric": q_dirty_safe_numeric,
        "dirty_monthly_district_weather": q_dirty_monthly_district_weather,
        "dirty_coolest_cities": q_dirty_coolest_cities,
        "dirty_seasonal_et0": q_dirty_seasonal_et0,
        "dirty_monthly_radiation": q_dirty_monthly_radiation,
        "dirty_ingest": q_dirty_ingest,
        "dirty_streaming_ingest": q_dirty_streaming_ingest,
        "combined_observations_salted": q_combined_observations_salted,
        "known_location_filter_salted": q_known_location_filter_salted,
        "catalog_tables": q_catalog_tables,
        "city_ranking_shown_last_first": q_city_ranking_shown_last_first,
    }
    return q
