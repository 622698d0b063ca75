"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Tables ``lineitem`` and ``supplier`` etc. are views in the oracle database. The observation
view below mirrors :mod:`cumulus.plans.observations`; dates are used directly (the Spark
side parses them back from ``M/d/yyyy`` text).

Rounding: Spark rounds a double half-up on its decimal form, so the oracle rounds through
DECIMAL as well (``_r``); raw double rounding would differ on exact decimal ties.
"""

from __future__ import annotations

from . import tree_sql

MIN_YEAR = 1998  # the tables span 1995-01 .. 2001-11


def _r(expr: str, n: int) -> str:
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(38,12)), {n}) AS DOUBLE)"


OBS = """obs AS (
  SELECT CAST(l_suppkey AS BIGINT) AS location_id,
         CAST(l_shipdate AS DATE) AS obs_date,
         CAST(l_orderkey % 4 AS INTEGER) AS weather_code,
         10 + l_quantity / 2 AS temperature_2m_max,
         l_quantity / 2 AS temperature_2m_min,
         5 + l_quantity / 2 AS temperature_2m_mean,
         12 + l_quantity / 2 AS apparent_temperature_max,
         2 + l_quantity / 2 AS apparent_temperature_min,
         7 + l_quantity / 2 AS apparent_temperature_mean,
         CAST(43200 + (l_partkey % 7) * 600 AS DOUBLE) AS daylight_duration,
         CAST((l_partkey % 43) * 1000 AS DOUBLE) AS sunshine_duration,
         ROUND(l_discount * 100) * 8 AS precipitation_sum,
         ROUND(l_discount * 100) * 6 AS rain_sum,
         CAST(l_orderkey % 25 AS DOUBLE) AS precipitation_hours,
         CAST(l_linenumber AS DOUBLE) AS wind_speed_10m_max,
         ROUND(l_tax * 100) * 10 AS wind_gusts_10m_max,
         CAST((l_orderkey % 36) * 10 AS DOUBLE) AS wind_direction_10m_dominant,
         l_quantity / 2 AS shortwave_radiation_sum,
         CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE (l_partkey % 160) / 8 END
           AS et0_fao_evapotranspiration
  FROM lineitem)"""

# text form of the date as it appears in the raw file
DATE_TEXT = "strftime(obs_date, '%-m/%-d/%Y')"

LOC = """loc AS (SELECT CAST(s_suppkey AS BIGINT) AS location_id, s_name AS city_name FROM supplier)"""
LOC_REGISTERED = """loc AS (SELECT CAST(s_suppkey AS BIGINT) AS location_id, s_name AS city_name
  FROM supplier WHERE s_acctbal >= 0)"""

# US week of year: weeks start Sunday, week 1 holds Jan 1 (DuckDB dayofweek: 0 = Sunday)
US_WEEK = """CASE WHEN obs_date >= make_date(year(obs_date) + 1, 1, 1)
                   - CAST(dayofweek(make_date(year(obs_date) + 1, 1, 1)) AS INTEGER)
              THEN 1
              ELSE CAST(floor((obs_date - make_date(year(obs_date), 1, 1)
                   + dayofweek(make_date(year(obs_date), 1, 1))) / 7) AS INTEGER) + 1 END"""

FEATURES = ("precipitation_hours", "sunshine_duration", "wind_speed", "et0")

MODELLING = """model_rows AS (
  SELECT precipitation_hours, sunshine_duration, wind_speed_10m_max AS wind_speed,
         et0_fao_evapotranspiration AS et0,
         ((obs_date - DATE '1970-01-01') * 31 + location_id) % 100 AS split_bucket
  FROM obs
  WHERE month(obs_date) = 5 AND precipitation_hours IS NOT NULL
    AND sunshine_duration IS NOT NULL AND wind_speed_10m_max IS NOT NULL
    AND et0_fao_evapotranspiration IS NOT NULL)"""


# the label of the tree models: sun raises it, rain lowers it, the bound ET0 is noise
SIGNAL_ROWS = """rows AS MATERIALIZED (
  SELECT precipitation_hours, sunshine_duration, wind_speed, split_bucket,
         et0 / 64 + sunshine_duration / 8000 + (24 - precipitation_hours) / 32 AS et0,
         CASE WHEN split_bucket < 80 THEN 'train' ELSE 'test' END AS kind
  FROM model_rows)"""

# mean conditions of each location in the month; every seventh location lacks its wind
SCENARIOS = """scenarios AS (
  SELECT location_id, AVG(precipitation_hours) AS precipitation_hours, AVG(sunshine_duration) AS sunshine_duration,
         CASE WHEN location_id % 7 <> 0 THEN AVG(wind_speed_10m_max) END AS wind_speed
  FROM obs WHERE month(obs_date) = 5 GROUP BY location_id)"""


def _least_squares(rows: str, label: str) -> str:
    """Ordinary least squares on the training split (3 features + intercept): covariances, then
    Cramer's rule for the 3x3 normal equations; ``test_rows`` are the test rows with prediction."""
    return f"""ols_m AS (
  SELECT COVAR_POP(precipitation_hours, precipitation_hours) AS s11,
         COVAR_POP(precipitation_hours, sunshine_duration) AS s12,
         COVAR_POP(precipitation_hours, wind_speed) AS s13,
         COVAR_POP(sunshine_duration, sunshine_duration) AS s22,
         COVAR_POP(sunshine_duration, wind_speed) AS s23,
         COVAR_POP(wind_speed, wind_speed) AS s33,
         COVAR_POP(precipitation_hours, {label}) AS c1, COVAR_POP(sunshine_duration, {label}) AS c2,
         COVAR_POP(wind_speed, {label}) AS c3,
         AVG(precipitation_hours) AS m1, AVG(sunshine_duration) AS m2, AVG(wind_speed) AS m3,
         AVG({label}) AS my
  FROM {rows} WHERE split_bucket < 80),
ols_d AS (
  SELECT *, s11 * (s22 * s33 - s23 * s23) - s12 * (s12 * s33 - s23 * s13)
            + s13 * (s12 * s23 - s22 * s13) AS det FROM ols_m),
ols_b AS (
  SELECT *,
    (c1 * (s22 * s33 - s23 * s23) - s12 * (c2 * s33 - s23 * c3) + s13 * (c2 * s23 - s22 * c3)) / det AS b1,
    (s11 * (c2 * s33 - c3 * s23) - c1 * (s12 * s33 - s23 * s13) + s13 * (s12 * c3 - c2 * s13)) / det AS b2,
    (s11 * (s22 * c3 - s23 * c2) - s12 * (s12 * c3 - c2 * s13) + c1 * (s12 * s23 - s22 * s13)) / det AS b3
  FROM ols_d),
ols_fit AS (SELECT b1, b2, b3, my - b1 * m1 - b2 * m2 - b3 * m3 AS b0 FROM ols_b),
test_rows AS (
  SELECT t.{label} AS et0, f.b0 + f.b1 * t.precipitation_hours + f.b2 * t.sunshine_duration + f.b3 * t.wind_speed AS p,
         AVG(t.{label}) OVER () AS ybar
  FROM {rows} t, ols_fit f WHERE t.split_bucket >= 80)"""


def _metrics(title: str, rows: str, prediction: str) -> str:
    return f"""SELECT '{title}' AS Model, {_r(f'SQRT(AVG(POWER(et0 - {prediction}, 2)))', 6)} AS RMSE,
       {_r(f'1 - AVG(POWER(et0 - {prediction}, 2)) / VAR_POP(et0)', 6)} AS R2
FROM {rows}"""


# the faults of the dirty lines, as typed values (mirrors plans/observations.dirty_lines)
DIRTY = f"""dirty0 AS (SELECT *, l_orderkey * 7 + l_linenumber AS k, CAST(l_shipdate AS DATE) AS day FROM lineitem),
dirty AS (
  SELECT k, day,
         CASE WHEN k % 11 = 0 THEN 'header' WHEN k % 13 IN (0, 1) THEN 'short_line' WHEN k % 43 = 0 THEN 'blank' ELSE 'body' END AS shape,
         CASE WHEN k % 23 NOT IN (0, 1, 2) THEN CAST(l_suppkey AS BIGINT) END AS location_id,
         CASE WHEN k % 17 IN (0, 1, 2, 3) THEN NULL
              WHEN k % 17 = 4 THEN CAST(make_date(year(day), 1, 1) + to_months(CAST(day(day) - 1 AS INTEGER)) AS DATE) + CAST(month(day) - 1 AS INTEGER)
              ELSE day END AS obs_date,
         CASE WHEN k % 17 IN (0, 1, 2, 3) THEN NULL WHEN k % 17 = 4 THEN day(day) ELSE month(day) END AS split_month,
         CASE k % 29 WHEN 0 THEN 99 WHEN 1 THEN -50 WHEN 2 THEN NULL WHEN 3 THEN 60 ELSE 10 + l_quantity / 2 END AS temperature_2m_max,
         CASE WHEN k % 37 NOT IN (0, 1) THEN 5 + l_quantity / 2 END AS temperature_2m_mean,
         CASE WHEN k % 19 NOT IN (0, 1, 2) THEN CAST(l_orderkey % 25 AS DOUBLE) END AS precipitation_hours,
         CASE WHEN k % 41 NOT IN (0, 1) THEN l_quantity / 2 END AS shortwave_radiation_sum,
         CASE k % 31 WHEN 0 THEN 25 WHEN 1 THEN -1 WHEN 2 THEN 20 WHEN 3 THEN NULL
              ELSE CASE WHEN l_orderkey % 97 <> 0 THEN (l_partkey % 160) / 8 END END AS et0_fao_evapotranspiration
  FROM dirty0),
body AS (SELECT * FROM dirty WHERE shape = 'body')"""


def _dirty_text(expr: str) -> str:
    """Count of lines whose text in one field is valid; a header has text everywhere."""
    return f"CAST(COUNT(*) FILTER (shape = 'header' OR ({expr})) AS BIGINT)"


def _dirty_queries() -> dict[str, str]:
    start = f"DATE '{MIN_YEAR}-01-01'"
    full = "shape = 'body'"
    obs = DIRTY.replace("\nbody AS", "\nobs AS")  # the analyses read valid lines under this name
    ingest = f"""
SELECT CAST(COUNT(*) AS BIGINT) AS lines_total, CAST(COUNT(*) FILTER (shape = 'header') AS BIGINT) AS header,
       CAST(COUNT(*) FILTER (shape = 'blank') AS BIGINT) AS blank, CAST(COUNT(*) FILTER (shape = 'short_line') AS BIGINT) AS short_line,
       CAST(COUNT(*) FILTER ({full} AND obs_date IS NULL) AS BIGINT) AS bad_date,
       CAST(COUNT(*) FILTER ({full} AND obs_date IS NOT NULL) AS BIGINT) AS valid,
       CAST(COUNT(*) FILTER ({full} AND obs_date IS NOT NULL) AS BIGINT) AS stored_valid,
       SUM(precipitation_hours) FILTER ({full} AND obs_date IS NOT NULL) AS sum_hours,
       CAST(COUNT(*) FILTER (shape = 'short_line') AS BIGINT) AS stored_short_line,
       CAST(COUNT(*) FILTER ({full} AND obs_date IS NULL) AS BIGINT) AS stored_bad_date
FROM dirty"""
    return {
        "dirty_quality_counters": _with(DIRTY, body=f"""
SELECT CAST(COUNT(*) AS BIGINT) AS lines_total, CAST(COUNT(*) FILTER (shape = 'header') AS BIGINT) AS header_lines,
       CAST(COUNT(*) FILTER (shape IN ('short_line', 'blank')) AS BIGINT) AS short_lines,
       CAST(COUNT(*) FILTER ({full} AND obs_date IS NULL) AS BIGINT) AS invalid_date,
       CAST(COUNT(*) FILTER ({full} AND et0_fao_evapotranspiration IS NULL) AS BIGINT) AS missing_et0,
       CAST(COUNT(*) FILTER ({full} AND obs_date < {start}) AS BIGINT) AS before_min_year,
       CAST(COUNT(*) FILTER ({full} AND obs_date >= {start}) AS BIGINT) AS rows_kept,
       CAST(COUNT(DISTINCT CASE WHEN {full} THEN year(obs_date) * 100 + month(obs_date) END) AS BIGINT) AS months_processed
FROM dirty"""),
        "dirty_valid_text": _with(DIRTY, body=f"""
SELECT {_dirty_text("shape IN ('body', 'short_line') AND k % 23 NOT IN (0, 1)")} AS valid_location_id,
       {_dirty_text("shape IN ('body', 'short_line') AND k % 17 NOT IN (0, 1)")} AS valid_weather_date,
       {_dirty_text(f"{full} AND k % 37 NOT IN (0, 1)")} AS valid_temperature_2m_mean,
       {_dirty_text(f"{full} AND k % 19 NOT IN (0, 1)")} AS valid_precipitation_hours,
       {_dirty_text(f"{full} AND et0_fao_evapotranspiration IS NOT NULL")} AS valid_et0_fao_evapotranspiration
FROM dirty"""),
        "dirty_safe_numeric": _with(DIRTY, body="""
SELECT location_id, obs_date, temperature_2m_max, temperature_2m_mean, precipitation_hours, shortwave_radiation_sum,
       et0_fao_evapotranspiration FROM body"""),
        "dirty_monthly_district_weather": _monthly_district(LOC).replace(OBS, obs),
        "dirty_coolest_cities": _city_rank("asc", 300).replace(OBS, obs),
        "dirty_seasonal_et0": _seasonal("split_month").replace(OBS, obs),
        "dirty_monthly_radiation": _with(obs, LOC, _CLEAN, _MONTHLY_RADIATION, body=f"""
SELECT {_RADIATION_COLS} FROM monthly"""),
        "dirty_ingest": _with(DIRTY, body=ingest),
        "dirty_streaming_ingest": _with(DIRTY, body=ingest),
    }


_CATALOG_COLUMNS = (("location_data", "loc", [("location_id", "bigint"), ("city_name", "string")], ""),
                    ("weather_data", "obs", [("location_id", "bigint"), ("obs_date", "date"), ("weather_code", "int"),
                                             ("precipitation_hours", "double")], "skip.header.line.count=1,note=it''s"))


def _catalog() -> str:
    return _with(OBS, LOC, body="\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, (SELECT COUNT(*) FROM {source}) AS n_rows, {i} AS position, '{c}' AS column_name, "
        f"'{kind}' AS column_type, '{props}' AS properties" for t, source, columns, props in _CATALOG_COLUMNS for i, (c, kind) in enumerate(columns)))


def _tree_queries() -> dict[str, str]:
    """One tree of two levels, and two boosting rounds of such trees (see tree_sql)."""
    x = list(FEATURES[:3])
    forest, boosted = tree_sql.tree("rf", "rows", "et0", 2, x), tree_sql.boosted("gbt", "rows", "et0", 2, x)
    titles = ("Linear Regression", "Random Forest", "Gradient Boosted Trees")
    both = """rows2 AS MATERIALIZED (
  SELECT * FROM (SELECT NULL AS location_id, * FROM rows UNION ALL BY NAME
                 SELECT *, 'scenario' AS kind FROM scenarios WHERE wind_speed IS NOT NULL))"""
    scored = tree_sql.boosted("gbt", "rows2", "et0", 2, x)
    return {
        "model_comparison_exact": _with(OBS, MODELLING, SIGNAL_ROWS, _least_squares("rows", "et0"), *forest, *boosted, body="\nUNION ALL\n".join([
            _metrics(titles[0], "test_rows", "p"), _metrics(titles[1], "rf_out WHERE kind = 'test'", "rf"),
            _metrics(titles[2], "gbt_out WHERE kind = 'test'", "gbt")])),
        "feature_importance_exact": _with(OBS, MODELLING, SIGNAL_ROWS, *forest, *boosted, body="\nUNION ALL\n".join(
            f"SELECT '{t}' AS Model, feature, {_r('importance', 6)} AS importance FROM ({tree_sql.importance(p, x)})"
            for t, p in zip(titles[1:], ("rf", "gbt"), strict=True))),
        "scenario_scoring_exact": _with(OBS, MODELLING, SIGNAL_ROWS, SCENARIOS, both, *scored, body=f"""
SELECT s.location_id, {', '.join(f"{_r('s.' + c, 6)} AS {c}" for c in x)}, {_r('g.gbt', 6)} AS prediction
FROM scenarios s LEFT JOIN (SELECT location_id, gbt FROM gbt_out WHERE kind = 'scenario') g USING (location_id)"""),
        "low_et0_conditions_exact": _with(OBS, MODELLING, SIGNAL_ROWS, *boosted, body=f"""
SELECT {_r('AVG(precipitation_hours) FILTER (gbt < 1.5)', 2)} AS avg_required_precip,
       {_r('AVG(sunshine_duration) FILTER (gbt < 1.5)', 2)} AS avg_required_sunshine,
       {_r('AVG(wind_speed) FILTER (gbt < 1.5)', 2)} AS avg_required_wind,
       {_r('AVG(gbt) FILTER (gbt < 1.5)', 2)} AS avg_predicted_et0,
       CAST(COUNT(*) FILTER (gbt < 1.5) AS BIGINT) AS n_low, CAST(COUNT(*) AS BIGINT) AS n_scored
FROM gbt_out WHERE kind = 'test'"""),
    }


def _with(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def _ym(col: str = "obs_date") -> str:
    return f"strftime({col}, '%Y-%m')"


def _monthly_district(loc: str) -> str:
    return _with(OBS, loc, f"""agg AS (
  SELECT location_id, {_ym()} AS year_month, SUM(precipitation_hours) AS t,
         AVG(temperature_2m_mean) AS m
  FROM obs
  WHERE location_id IS NOT NULL AND precipitation_hours IS NOT NULL
    AND temperature_2m_mean IS NOT NULL AND obs_date >= DATE '{MIN_YEAR}-01-01'
  GROUP BY 1, 2)""", body=f"""
SELECT a.location_id, a.year_month, COALESCE(l.city_name, 'Unknown') AS district,
       {_r('a.t', 2)} AS total_precipitation_hours, {_r('a.m', 2)} AS mean_temperature,
       COALESCE(l.city_name, 'Unknown') || '|' || a.year_month AS label
FROM agg a LEFT JOIN loc l ON a.location_id = l.location_id""")


def _city_rank(direction: str, min_records: int) -> str:
    order = "ASC" if direction == "asc" else "DESC"
    return _with(OBS, LOC, f"""city_avg AS (
  SELECT l.city_name, AVG(o.temperature_2m_max) AS a, COUNT(*) AS record_count
  FROM obs o JOIN loc l ON o.location_id = l.location_id
  WHERE o.temperature_2m_max IS NOT NULL AND o.temperature_2m_max > -50
    AND o.temperature_2m_max < 60
  GROUP BY l.city_name HAVING COUNT(*) >= {min_records})""", f"""ranked AS (
  SELECT city_name, a, record_count,
         ROW_NUMBER() OVER (ORDER BY a {order}, city_name ASC) AS temperature_rank
  FROM city_avg)""", body=f"""
SELECT CAST(temperature_rank AS INTEGER) AS temperature_rank, city_name,
       {_r('a', 2)} AS avg_max_temperature_celsius, CAST(record_count AS BIGINT) AS record_count
FROM ranked WHERE temperature_rank <= 10 ORDER BY temperature_rank""")


def _seasonal(month: str) -> str:
    return _with(OBS, LOC, f"""seasonal AS (
  SELECT l.city_name, o.et0_fao_evapotranspiration AS e,
         CASE WHEN {month} >= 9 OR {month} <= 3 THEN 'Sep-Mar'
              WHEN {month} IS NOT NULL THEN 'Apr-Aug' END AS agricultural_season
  FROM obs o JOIN loc l ON o.location_id = l.location_id
  WHERE o.et0_fao_evapotranspiration IS NOT NULL
    AND o.et0_fao_evapotranspiration BETWEEN 0 AND 20)""", body=f"""
SELECT city_name, agricultural_season, {_r('AVG(e)', 3)} AS avg_evapotranspiration_mm,
       CAST(COUNT(*) AS BIGINT) AS record_count
FROM seasonal WHERE agricultural_season IS NOT NULL
GROUP BY 1, 2 HAVING COUNT(*) >= 30 ORDER BY 1, 2""")


_CLEAN = f"""clean AS (
  SELECT o.*, year(obs_date) AS year_val, month(obs_date) AS month_val,
         {US_WEEK} AS week_val,
         COALESCE(shortwave_radiation_sum > 15.0, FALSE) AS is_high_radiation,
         temperature_2m_max AS temp_max
  FROM obs o
  WHERE location_id IS NOT NULL AND obs_date IS NOT NULL AND shortwave_radiation_sum IS NOT NULL)"""

_MONTHLY_RADIATION = f"""monthly AS (
  SELECT CAST(year_val AS INTEGER) AS year_val, CAST(month_val AS INTEGER) AS month_val,
         SUM(shortwave_radiation_sum) AS total_radiation_sum,
         SUM(CASE WHEN is_high_radiation THEN shortwave_radiation_sum ELSE 0.0 END)
           AS high_radiation_sum,
         AVG(shortwave_radiation_sum) AS avg_r
  FROM clean WHERE location_id IN (SELECT location_id FROM loc)
  GROUP BY 1, 2)"""

_RADIATION_COLS = f"""year_val, month_val, total_radiation_sum, high_radiation_sum,
       {_r('avg_r', 2)} AS avg_radiation,
       {_r('high_radiation_sum / NULLIF(total_radiation_sum, 0) * 100', 2)} AS high_radiation_percentage,
       CAST(year_val AS VARCHAR) || '-' || lpad(CAST(month_val AS VARCHAR), 2, '0') AS year_month"""

_HOTTEST = """monthly_t AS (
  SELECT year_val, month_val, AVG(temp_max) AS avg_monthly_temp FROM clean GROUP BY 1, 2),
hottest AS (
  SELECT year_val, month_val, avg_monthly_temp FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY year_val
                                 ORDER BY avg_monthly_temp DESC NULLS LAST, month_val) AS rk
    FROM monthly_t) WHERE rk = 1)"""


def _feature_stats() -> str:
    parts = []
    for f in FEATURES:
        parts.append(f"""SELECT '{f}' AS feature, CAST(COUNT({f}) AS BIGINT) AS count,
       {_r(f'AVG({f})', 6)} AS mean, {_r(f'STDDEV_SAMP({f})', 6)} AS stddev,
       MIN({f}) AS min, MAX({f}) AS max FROM model_rows""")
    return "\nUNION ALL\n".join(parts)


CORR_FEATURES = [
    ("location_id", "location_id"), ("weather_code", "weather_code"),
    ("temperature_2m_max", "temperature_2m_max"), ("temperature_2m_min", "temperature_2m_min"),
    ("temperature_2m_mean", "temperature_2m_mean"),
    ("apparent_temperature_max", "apparent_temperature_max"),
    ("apparent_temperature_min", "apparent_temperature_min"),
    ("apparent_temperature_mean", "apparent_temperature_mean"),
    ("daylight_duration", "daylight_duration"), ("sunshine_duration", "sunshine_duration"),
    ("precipitation_sum", "precipitation_sum"), ("rain_sum", "rain_sum"),
    ("precipitation_hours", "precipitation_hours"), ("wind_speed_10m_max", "wind_speed_10m_max"),
    ("wind_gusts_10m_max", "wind_gusts_10m_max"),
    ("wind_direction_10m_dominant", "wind_direction_10m_dominant"),
    ("shortwave_radiation_sum", "shortwave_radiation_sum"),
    ("month", "month(obs_date)"), ("year", "year(obs_date)"),
]


def _correlations(exact_types: bool = False, nulls_as_zero: bool = False) -> str:
    parts = []
    for name, expr in CORR_FEATURES:
        if exact_types and name == "location_id":  # bigint: not double/int
            continue
        if nulls_as_zero:
            c = f"CORR(COALESCE(CAST({expr} AS DOUBLE), 0), COALESCE(et0_fao_evapotranspiration, 0))"
        else:
            c = f"CORR({expr}, et0_fao_evapotranspiration)"
        parts.append(f"SELECT '{name}' AS feature, "
                     f"CASE WHEN isnan({c}) THEN NULL ELSE {_r(c, 6)} END AS correlation_with_et0 FROM obs")
    return _with(OBS, body="\nUNION ALL\n".join(parts))


_SEASON_MAP = """CASE WHEN m IN (3, 4) THEN 'First Inter-monsoon'
            WHEN m BETWEEN 5 AND 9 THEN 'Southwest Monsoon'
            WHEN m = 10 THEN 'Second Inter-monsoon'
            ELSE 'Northeast Monsoon' END"""


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["monthly_district_weather"] = _monthly_district(LOC)
    q["monthly_district_weather_text"] = _monthly_district(LOC)
    q["monthly_district_weather_strict"] = _monthly_district(LOC)
    q["monthly_district_weather_files"] = _monthly_district(LOC)
    q["monthly_district_weather_ingested"] = _monthly_district(LOC)
    q["streaming_ingest"] = _with(OBS, body="""
SELECT location_id, obs_date, precipitation_hours, et0_fao_evapotranspiration FROM obs""")
    q["fact_csv_scan"] = _with(OBS, body="""
SELECT location_id, obs_date, temperature_2m_max, precipitation_hours, et0_fao_evapotranspiration
FROM obs""")
    q["json_scan"] = _with(OBS, body="""
SELECT location_id, obs_date, precipitation_hours, et0_fao_evapotranspiration FROM obs""")
    q["text_rows_scan"] = "SELECT s_name AS name, s_nationkey AS nation FROM supplier"
    q["district_lookup_default"] = _monthly_district(LOC_REGISTERED)
    q["legacy_text_output"] = _with(OBS, LOC, f"""agg AS (
  SELECT location_id, {_ym()} AS year_month, SUM(precipitation_hours) AS t,
         AVG(temperature_2m_mean) AS m
  FROM obs WHERE obs_date >= DATE '{MIN_YEAR}-01-01' GROUP BY 1, 2)""", body=f"""
SELECT COALESCE(l.city_name, 'Unknown') || '|' || a.year_month || chr(9)
       || printf('%.2f,%.2f', {_r('a.t', 2)}, {_r('a.m', 2)}) AS value
FROM agg a LEFT JOIN loc l ON a.location_id = l.location_id""")
    q["peak_precipitation_month"] = _with(OBS, body=f"""
SELECT {_ym()} AS year_month, CAST(SUM(CAST(precipitation_hours AS INTEGER)) AS BIGINT)
       AS total_precipitation_hours
FROM obs GROUP BY 1 ORDER BY 2 DESC, 1 ASC LIMIT 1""")
    q["monthly_precipitation_totals"] = _with(OBS, body=f"""
SELECT {_ym()} AS year_month, CAST(SUM(CAST(precipitation_hours AS INTEGER)) AS BIGINT)
       AS total_precipitation_hours
FROM obs GROUP BY 1""")
    q["combined_observations"] = _with(OBS, LOC, body=f"""
SELECT o.location_id, l.city_name, CAST(year(obs_date) AS INTEGER) AS year_val,
       CAST(month(obs_date) AS INTEGER) AS month_val, CAST(day(obs_date) AS INTEGER) AS day_val,
       o.precipitation_hours, o.temperature_2m_mean, o.temperature_2m_max,
       o.temperature_2m_min, o.et0_fao_evapotranspiration
FROM obs o JOIN loc l ON o.location_id = l.location_id""")
    q["coolest_cities"] = _city_rank("asc", 365)
    q["warmest_cities"] = _city_rank("desc", 365)
    q["coolest_cities_600_records"] = _city_rank("asc", 600)
    q["seasonal_et0"] = _seasonal("month(o.obs_date)")
    q["monthly_radiation"] = _with(OBS, LOC, _CLEAN, _MONTHLY_RADIATION,
                                   body=f"SELECT {_RADIATION_COLS} FROM monthly")
    q["top_radiation_months"] = _with(OBS, LOC, _CLEAN, _MONTHLY_RADIATION, body=f"""
SELECT year_month, high_radiation_percentage, avg_radiation FROM (SELECT {_RADIATION_COLS} FROM monthly)
ORDER BY high_radiation_percentage DESC NULLS LAST, year_month ASC LIMIT 20""")
    q["high_radiation_flag"] = _with(OBS, body="""
SELECT location_id, obs_date, shortwave_radiation_sum,
       COALESCE(shortwave_radiation_sum > 15.0, FALSE) AS is_high_radiation FROM obs""")
    q["clean_observations"] = _with(OBS, _CLEAN, body="""
SELECT location_id, obs_date, CAST(year_val AS INTEGER) AS year_val,
       CAST(month_val AS INTEGER) AS month_val, CAST(week_val AS INTEGER) AS week_val,
       is_high_radiation, temp_max FROM clean""")
    q["calendar_parts"] = _with(OBS, body=f"""
SELECT location_id, obs_date, CAST(year(obs_date) AS INTEGER) AS year_val,
       CAST(month(obs_date) AS INTEGER) AS month_val, CAST({US_WEEK} AS INTEGER) AS week_val
FROM obs""")
    q["valid_text"] = _with(OBS, body="""
SELECT CAST(COUNT(location_id) AS BIGINT) AS valid_location_id,
       CAST(COUNT(obs_date) AS BIGINT) AS valid_weather_date,
       CAST(COUNT(temperature_2m_mean) AS BIGINT) AS valid_temperature_2m_mean,
       CAST(COUNT(precipitation_hours) AS BIGINT) AS valid_precipitation_hours,
       CAST(COUNT(et0_fao_evapotranspiration) AS BIGINT) AS valid_et0_fao_evapotranspiration
FROM obs""")
    q["hottest_month_per_year"] = _with(OBS, _CLEAN, _HOTTEST, body=f"""
SELECT CAST(year_val AS INTEGER) AS year_val, CAST(month_val AS INTEGER) AS month_val,
       {_r('avg_monthly_temp', 2)} AS avg_monthly_temp FROM hottest""")
    q["hottest_month_weekly_max"] = _with(OBS, _CLEAN, _HOTTEST, body="""
SELECT CAST(c.year_val AS INTEGER) AS year_val, CAST(c.month_val AS INTEGER) AS month_val,
       CAST(c.week_val AS INTEGER) AS week_val, MAX(c.temp_max) AS weekly_max_temp
FROM clean c JOIN hottest h ON c.year_val = h.year_val AND c.month_val = h.month_val
GROUP BY 1, 2, 3 ORDER BY 1, 2, 3""")
    q["us_week_of_year"] = _with(OBS, body=f"""
SELECT DISTINCT obs_date, CAST({US_WEEK} AS INTEGER) AS week_val FROM obs""")
    q["year_month_key"] = _with(OBS, body=f"SELECT DISTINCT obs_date, {_ym()} AS year_month FROM obs")
    q["parse_dates"] = _with(OBS, body=f"""
SELECT DISTINCT {DATE_TEXT} AS weather_date, obs_date AS lenient_date, obs_date AS strict_date FROM obs""")
    q["split_date_parts"] = _with(OBS, body=f"""
SELECT DISTINCT {DATE_TEXT} AS weather_date, CAST(year(obs_date) AS INTEGER) AS year_val,
       CAST(month(obs_date) AS INTEGER) AS month_val, CAST(day(obs_date) AS INTEGER) AS day_val
FROM obs""")
    q["known_location_filter"] = _with(OBS, LOC_REGISTERED, body="""
SELECT location_id, obs_date, shortwave_radiation_sum FROM obs
WHERE location_id IN (SELECT location_id FROM loc)""")
    q["safe_numeric_parse"] = _with(OBS, body="""
SELECT location_id, obs_date, et0_fao_evapotranspiration FROM obs""")
    q["quality_counters"] = _with(OBS, body=f"""
SELECT CAST(COUNT(*) AS BIGINT) AS lines_total,
       CAST(0 AS BIGINT) AS header_lines,
       CAST(0 AS BIGINT) AS short_lines,
       CAST(COUNT(*) FILTER (WHERE obs_date IS NULL) AS BIGINT) AS invalid_date,
       CAST(COUNT(*) FILTER (WHERE et0_fao_evapotranspiration IS NULL) AS BIGINT) AS missing_et0,
       CAST(COUNT(*) FILTER (WHERE obs_date < DATE '{MIN_YEAR}-01-01') AS BIGINT) AS before_min_year,
       CAST(COUNT(*) FILTER (WHERE obs_date >= DATE '{MIN_YEAR}-01-01') AS BIGINT) AS rows_kept,
       CAST(COUNT(DISTINCT {_ym()}) AS BIGINT) AS months_processed
FROM obs""")
    # ---- statistics --------------------------------------------------------------------
    q["et0_correlations"] = _correlations()
    q["et0_correlations_exact_types"] = _correlations(exact_types=True)
    q["et0_correlations_nulls_as_zero"] = _correlations(nulls_as_zero=True)
    q["feature_projection"] = _with(OBS, MODELLING, body="""
SELECT precipitation_hours, sunshine_duration, wind_speed, et0 FROM model_rows""")
    q["feature_summary"] = _with(OBS, MODELLING, body=_feature_stats())
    q["simple_regression"] = _with(OBS, body=f"""
SELECT {_r('REGR_SLOPE(et0_fao_evapotranspiration, sunshine_duration)', 6)} AS slope,
       {_r('REGR_INTERCEPT(et0_fao_evapotranspiration, sunshine_duration)', 6)} AS intercept,
       {_r('REGR_R2(et0_fao_evapotranspiration, sunshine_duration)', 6)} AS r2,
       CAST(REGR_COUNT(et0_fao_evapotranspiration, sunshine_duration) AS BIGINT) AS n
FROM obs""")
    q["regression_metrics"] = _with(OBS, MODELLING, """fit AS (
  SELECT REGR_SLOPE(et0, sunshine_duration) AS b, REGR_INTERCEPT(et0, sunshine_duration) AS a,
         AVG(et0) AS ybar FROM model_rows)""", body=f"""
SELECT {_r('SQRT(AVG(POWER(m.et0 - (f.a + f.b * m.sunshine_duration), 2)))', 6)} AS rmse,
       {_r('1 - SUM(POWER(m.et0 - (f.a + f.b * m.sunshine_duration), 2)) / SUM(POWER(m.et0 - f.ybar, 2))', 6)} AS r2,
       CAST(COUNT(*) AS BIGINT) AS n
FROM model_rows m, fit f""")
    q["deterministic_split"] = _with(OBS, MODELLING, body=f"""
SELECT split_bucket < 80 AS is_train, CAST(COUNT(*) AS BIGINT) AS n_rows,
       {_r('AVG(et0)', 6)} AS mean_et0
FROM model_rows GROUP BY 1""")
    q["global_means"] = _with(OBS, MODELLING, body=f"""
SELECT {_r('AVG(precipitation_hours)', 2)} AS avg_precip, {_r('AVG(sunshine_duration)', 2)} AS avg_sunshine,
       {_r('AVG(wind_speed)', 2)} AS avg_wind, {_r('AVG(et0)', 2)} AS avg_et0 FROM model_rows""")
    q["low_et0_conditions_actual"] = _with(OBS, MODELLING, body=f"""
SELECT {_r('AVG(precipitation_hours)', 2)} AS avg_required_precip,
       {_r('AVG(sunshine_duration)', 2)} AS avg_required_sunshine,
       {_r('AVG(wind_speed)', 2)} AS avg_required_wind, {_r('AVG(et0)', 2)} AS avg_et0
FROM model_rows WHERE et0 < 1.5""")
    ols = _least_squares("model_rows", "et0")
    q["linear_regression_eval"] = _with(OBS, MODELLING, ols, body=f"""
SELECT 'Linear Regression' AS Model,
       {_r('SQRT(AVG(POWER(et0 - p, 2)))', 6)} AS RMSE,
       {_r('1 - SUM(POWER(et0 - p, 2)) / SUM(POWER(et0 - ybar, 2))', 6)} AS R2
FROM test_rows""")
    q |= _tree_queries()
    q |= _dirty_queries()
    q["catalog_tables"] = _catalog()
    q["combined_observations_salted"] = q["combined_observations"]
    q["known_location_filter_salted"] = q["known_location_filter"]
    q["city_ranking_shown_last_first"] = q["coolest_cities"]
    # ---- dashboard KPIs ----------------------------------------------------------------
    q["extreme_weather_days"] = _with(OBS, body="""
SELECT CAST(year(obs_date) AS INTEGER) AS year, CAST(COUNT(DISTINCT obs_date) AS BIGINT) AS extreme_days
FROM obs WHERE precipitation_sum > 50 AND wind_gusts_10m_max > 40 GROUP BY 1""")
    q["extreme_days_one_year"] = _with(OBS, body="""
SELECT CAST(year(obs_date) AS INTEGER) AS year, CAST(COUNT(*) AS BIGINT) AS extreme_days
FROM obs WHERE precipitation_sum > 50 AND wind_gusts_10m_max > 40 AND year(obs_date) = 1996 GROUP BY 1""")
    q["csv_inferred_renamed"] = _with(OBS, body="""
SELECT location_id, obs_date, temperature_2m_max, precipitation_hours FROM obs""")
    q["location_side_file"] = _with(LOC, body="""
SELECT location_id, CASE WHEN location_id % 3 = 0 THEN city_name || ' new' ELSE city_name END AS city_name FROM loc""")
    q["overwrite_replaces"] = _with(OBS, body="""
SELECT location_id, obs_date, precipitation_hours FROM obs WHERE precipitation_hours >= 12""")
    q["sql_over_views"] = _with(OBS, LOC, body="""
SELECT l.city_name, CAST(year(o.obs_date) AS INTEGER) AS year, CAST(COUNT(*) AS BIGINT) AS warm_days
FROM obs o JOIN loc l ON o.location_id = l.location_id WHERE o.temperature_2m_max > 30 GROUP BY 1, 2""")
    q["hot_share"] = _with(OBS, body=f"""
SELECT CAST(year(obs_date) AS INTEGER) AS year,
       {_r('AVG(CASE WHEN temperature_2m_max > 30 THEN 1.0 ELSE 0.0 END) * 100', 2)} AS hot_pct,
       {_r('100 - AVG(CASE WHEN temperature_2m_max > 30 THEN 1.0 ELSE 0.0 END) * 100', 2)} AS not_hot_pct,
       CAST(COUNT(*) AS BIGINT) AS n_days
FROM obs WHERE temperature_2m_max IS NOT NULL GROUP BY 1""")
    q["hot_share_months"] = _with(OBS, """per_month AS (
  SELECT location_id, year(obs_date) AS y, month(obs_date) AS m, AVG(temperature_2m_max) AS t
  FROM obs WHERE temperature_2m_max IS NOT NULL GROUP BY 1, 2, 3)""", body=f"""
SELECT CAST(y AS INTEGER) AS year,
       {_r('AVG(CASE WHEN t > 20 THEN 1.0 ELSE 0.0 END) * 100', 2)} AS hot_pct,
       {_r('100 - AVG(CASE WHEN t > 20 THEN 1.0 ELSE 0.0 END) * 100', 2)} AS not_hot_pct,
       CAST(COUNT(*) AS BIGINT) AS n_months
FROM per_month GROUP BY 1""")
    q["extreme_location_days"] = _with(OBS, body="""
SELECT CAST(year(obs_date) AS INTEGER) AS year, CAST(COUNT(*) AS BIGINT) AS extreme_days
FROM obs WHERE precipitation_sum > 50 AND wind_gusts_10m_max > 40 GROUP BY 1""")
    q["top_districts_precipitation"] = _with(OBS, LOC, body=f"""
SELECT l.city_name, {_r('SUM(o.precipitation_sum)', 2)} AS total_precipitation_mm
FROM obs o JOIN loc l ON o.location_id = l.location_id
WHERE o.precipitation_sum IS NOT NULL
GROUP BY 1 ORDER BY SUM(o.precipitation_sum) DESC, 1 LIMIT 5""")
    q["wettest_month_by_district"] = _with(OBS, LOC, """per_month AS (
  SELECT l.city_name, year(o.obs_date) AS y, month(o.obs_date) AS m, SUM(o.precipitation_sum) AS s
  FROM obs o JOIN loc l ON o.location_id = l.location_id
  WHERE o.precipitation_sum IS NOT NULL GROUP BY 1, 2, 3)""", """cal AS (
  SELECT city_name, m, AVG(s) AS a FROM per_month GROUP BY 1, 2)""", f"""best AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY city_name ORDER BY a DESC, m) AS rk FROM cal)""",
                                            body=f"""
SELECT city_name, CAST(m AS INTEGER) AS peak_month, monthname(make_date(2000, m, 1)) AS month_name,
       {_SEASON_MAP} AS season, {_r('a', 2)} AS avg_monthly_rainfall_mm
FROM best WHERE rk = 1""")
    # the single-scan dashboard must equal the four separate KPI queries
    q["dashboard_extreme_days"] = q["extreme_weather_days"]
    q["dashboard_hot_share"] = q["hot_share"]
    q["dashboard_top_districts"] = q["top_districts_precipitation"]
    q["dashboard_wettest_month"] = q["wettest_month_by_district"]
    # ---- generic DataFrame / SQL surface -----------------------------------------------
    q["project_arith"] = _with(OBS, body="""
SELECT location_id, obs_date, et0_fao_evapotranspiration + 1 AS et0_plus_one FROM obs""")
    q["range_filter"] = _with(OBS, body="""
SELECT location_id, obs_date, precipitation_hours FROM obs
WHERE precipitation_hours >= 13 AND precipitation_hours <= 19""")
    q["prefix_label"] = "SELECT 'Name: ' || s_name AS label FROM supplier"
    q["count_by_group"] = _with(OBS, body="""
SELECT et0_fao_evapotranspiration, CAST(COUNT(*) AS BIGINT) AS count FROM obs GROUP BY 1""")
    q["sql_over_view"] = _with(OBS, body="""
SELECT location_id, CAST(COUNT(*) AS BIGINT) AS n_rows FROM obs WHERE precipitation_hours > 0
GROUP BY 1""")
    q["scan_parquet"] = "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem"
    q["sql_on_file"] = "SELECT * FROM supplier"
    q["merged_schema"] = """
SELECT p_partkey, CAST(p_size AS BIGINT) AS single,
       CASE WHEN p_size <= 25 THEN CAST(p_size AS BIGINT) * p_size END AS double,
       CASE WHEN p_size > 25 THEN CAST(p_size AS BIGINT) * p_size * p_size END AS triple,
       CASE WHEN p_size <= 25 THEN 1 ELSE 2 END AS key
FROM part"""
    return q
