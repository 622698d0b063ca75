"""Dashboard KPIs: extreme-weather days, hot-day share, top districts by precipitation,
wettest calendar month per district. Each KPI is computed for every year (or one
``year`` when given); per-location partial aggregates come first, names are joined on the
aggregated rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..plans.joins import attach_names
from ..session import stored
from .climate import with_obs_date


def _scoped(facts: DataFrame, year: int | None, date_mode: str) -> DataFrame:
    d = with_obs_date(facts, date_mode).where(F.col("obs_date").isNotNull())
    if year is not None:
        # a date range, not year(), so the bound can reach a typed date column's statistics
        d = d.where((F.col("obs_date") >= F.make_date(F.lit(year), F.lit(1), F.lit(1)))
                    & (F.col("obs_date") < F.make_date(F.lit(year + 1), F.lit(1), F.lit(1))))
        if "year" in d.columns:  # partition column of an ingested table: prune folders
            d = d.where(F.col("year") == year)
    return d


def extreme_weather_days(facts: DataFrame, rain_mm: float = 50.0, gust_kmh: float = 40.0,
                         year: int | None = None, grain: str = "date",
                         rain_col: str = "precipitation_sum",
                         gust_col: str = "wind_gusts_10m_max", date_mode: str = "lenient") -> DataFrame:
    """Days with rain above ``rain_mm`` and gusts above ``gust_kmh``, per year.

    ``grain="date"`` counts calendar days (any location); ``"location_day"`` counts rows."""
    d = _scoped(facts, year, date_mode).where((F.col(rain_col) > rain_mm) & (F.col(gust_col) > gust_kmh))
    n = F.count_distinct("obs_date") if grain == "date" else F.count(F.lit(1))
    return d.groupBy(F.year("obs_date").alias("year")).agg(n.alias("extreme_days"))


def hot_share(facts: DataFrame, threshold: float = 30.0, year: int | None = None,
              grain: str = "day", temperature: str = "temperature_2m_max",
              date_mode: str = "lenient") -> DataFrame:
    """Share (percent, 2 dp) above ``threshold`` and not above, per year.

    ``grain="day"``: of location-days; ``grain="month"``: of location-months, judged by
    the month's mean temperature (partial aggregate per location-month first)."""
    t = F.col(temperature)
    d = _scoped(facts, year, date_mode).where(t.isNotNull())
    if grain == "month":
        d = (d.groupBy("location_id", F.year("obs_date").alias("year"), F.month("obs_date").alias("_m"))
             .agg(F.avg(t).alias("_t")))
        t, year_col = F.col("_t"), F.col("year")
    elif grain == "day":
        year_col = F.year("obs_date").alias("year")
    else:
        raise ValueError(f"unknown grain {grain!r}")
    frac = F.avg(F.when(t > threshold, F.lit(1.0)).otherwise(F.lit(0.0))) * 100
    n_name = "n_days" if grain == "day" else "n_months"
    return (d.groupBy(year_col)
            .agg(F.round(frac, 2).alias("hot_pct"), F.round(100 - frac, 2).alias("not_hot_pct"),
                 F.count(F.lit(1)).alias(n_name)))


def top_districts_precipitation(facts: DataFrame, locations: DataFrame, n: int = 5,
                                year: int | None = None, measure: str = "precipitation_sum",
                                date_mode: str = "lenient") -> DataFrame:
    m = F.col(measure)
    d = facts if year is None else _scoped(facts, year, date_mode)
    per_loc = (d.where(F.col("location_id").isNotNull() & m.isNotNull())
               .groupBy("location_id").agg(F.sum(m).alias("_s")))
    per_city = (attach_names(per_loc, locations, how="inner")
                .groupBy("city_name").agg(F.sum("_s").alias("_s")))
    return (per_city.orderBy(F.col("_s").desc(), F.col("city_name")).limit(n)
            .select("city_name", F.round("_s", 2).alias("total_precipitation_mm")))


# --- fixed values: monsoon season of each calendar month ----------------------------------
#   Mar-Apr: First Inter-monsoon; May-Sep: Southwest Monsoon;
#   Oct: Second Inter-monsoon; Nov-Feb: Northeast Monsoon
def monsoon_season(month: Column) -> Column:
    return (F.when(month.isin(3, 4), F.lit("First Inter-monsoon"))
            .when(month.between(5, 9), F.lit("Southwest Monsoon"))
            .when(month == 10, F.lit("Second Inter-monsoon"))
            .otherwise(F.lit("Northeast Monsoon")))


def wettest_month_by_district(facts: DataFrame, locations: DataFrame, year: int | None = None,
                              measure: str = "precipitation_sum",
                              date_mode: str = "lenient") -> DataFrame:
    """Per district: the calendar month with the highest average monthly total (sum per
    year-month, averaged over years), its name, season and that average (2 dp)."""
    m = F.col(measure)
    d = _scoped(facts, year, date_mode).where(F.col("location_id").isNotNull() & m.isNotNull())
    per_loc = (d.groupBy("location_id", F.year("obs_date").alias("y"), F.month("obs_date").alias("m"))
               .agg(F.sum(m).alias("_s")))
    return _wettest_from_monthly(per_loc, locations)


def _wettest_from_monthly(per_loc: DataFrame, locations: DataFrame) -> DataFrame:
    """(location_id, y, m, _s) monthly totals -> wettest calendar month per district."""
    per_city = (attach_names(per_loc, locations, how="inner")
                .groupBy("city_name", "y", "m").agg(F.sum("_s").alias("_s")))
    cal = per_city.groupBy("city_name", "m").agg(F.avg("_s").alias("_a"))
    w = Window.partitionBy("city_name").orderBy(F.col("_a").desc(), F.col("m"))
    best = cal.withColumn("_rk", F.row_number().over(w)).where(F.col("_rk") == 1)
    return best.select(
        "city_name", F.col("m").alias("peak_month"),
        F.date_format(F.make_date(F.lit(2000), F.col("m"), F.lit(1)), "MMMM").alias("month_name"),
        monsoon_season(F.col("m")).alias("season"),
        F.round("_a", 2).alias("avg_monthly_rainfall_mm"))


def dashboard(facts: DataFrame, locations: DataFrame, year: int | None = None,
              rain_mm: float = 50.0, gust_kmh: float = 40.0, hot_c: float = 30.0, n_top: int = 5,
              rain_col: str = "precipitation_sum", gust_col: str = "wind_gusts_10m_max",
              temperature: str = "temperature_2m_max", date_mode: str = "lenient") -> dict[str, DataFrame]:
    """The four dashboard panels from ONE scan of the facts.

    A single ``GROUPING SETS`` aggregate has two sets, from which everything else adds up: by date
    (a day counts once, wherever it was extreme) and by location and month (hot counts and totals).
    Map-side partial aggregation collapses each set before the one shuffle. The result (bounded by
    locations x months + dates) is written into the shared folder while the panels are built, and
    these are derived from it - the same values as the four separate KPI functions, for a quarter
    of the reading."""
    d = with_obs_date(facts, date_mode)
    if year is not None:
        d = _scoped(facts, year, date_mode)
    t, r = F.col(temperature), F.col(rain_col)
    base = d.select(
        "location_id", F.year("obs_date").alias("year"), F.month("obs_date").alias("month"), "obs_date",
        F.coalesce((r > rain_mm) & (F.col(gust_col) > gust_kmh), F.lit(False)).alias("_extreme"),
        t.alias("_t"), r.alias("_r"))
    agg = stored(base.groupingSets([["obs_date"], ["location_id", "year", "month"]], "obs_date", "location_id", "year", "month")
                 .agg((F.grouping("obs_date") == 0).alias("_by_date"), F.max("_extreme").alias("_extreme"),
                      F.count_if(F.col("_t") > hot_c).alias("_hot"), F.count("_t").alias("_n_t"),
                      F.sum("_r").alias("_s"), F.count("_r").alias("_n_r")), "dashboard")
    by_date, by_month = agg.where("_by_date"), agg.where("NOT _by_date")
    extreme = (by_date.where(F.col("obs_date").isNotNull() & F.col("_extreme"))
               .groupBy(F.year("obs_date").alias("year")).agg(F.count(F.lit(1)).alias("extreme_days")))
    frac = F.col("_hot") / F.col("_n_t") * 100
    hot = (by_month.where(F.col("year").isNotNull()).groupBy("year").agg(F.sum("_hot").alias("_hot"), F.sum("_n_t").alias("_n_t"))
           .where(F.col("_n_t") > 0)
           .select("year", F.round(frac, 2).alias("hot_pct"), F.round(100 - frac, 2).alias("not_hot_pct"),
                   F.col("_n_t").alias("n_days")))
    per_loc = (by_month.where(F.col("location_id").isNotNull() & (F.col("_n_r") > 0))
               .groupBy("location_id").agg(F.sum("_s").alias("_s")))
    per_city = (attach_names(per_loc.select("location_id", "_s"), locations, how="inner")
                .groupBy("city_name").agg(F.sum("_s").alias("_s")))
    top = (per_city.orderBy(F.col("_s").desc(), F.col("city_name")).limit(n_top)
           .select("city_name", F.round("_s", 2).alias("total_precipitation_mm")))
    monthly = (by_month.where(F.col("location_id").isNotNull() & F.col("year").isNotNull() & (F.col("_n_r") > 0))
               .select("location_id", F.col("year").alias("y"), F.col("month").alias("m"), "_s"))
    return {
        "extreme_weather_days": extreme,
        "hot_share": hot,
        "top_districts_precipitation": top,
        "wettest_month_by_district": _wettest_from_monthly(monthly, locations),
    }
