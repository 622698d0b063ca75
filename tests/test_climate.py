import datetime as dt

import pytest

from cumulus.operators import climate, kpi
from cumulus.operators.stats import correlations
from cumulus.schema import FACT_SCHEMA


def facts(spark, rows):
    """rows: dicts with some fact columns; the rest NULL."""
    names = [f.name for f in FACT_SCHEMA.fields]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], FACT_SCHEMA)


def locs(spark, rows):
    return spark.createDataFrame(rows, "location_id bigint, city_name string")


def test_monthly_district_default_name_and_rounding(spark):
    f = facts(spark, [
        dict(location_id=1, weather_date="1/5/2014", precipitation_hours=2.0, temperature_2m_mean=20.0),
        dict(location_id=1, weather_date="1/20/2014", precipitation_hours=3.0, temperature_2m_mean=21.0),
        dict(location_id=1, weather_date="1/20/2014", precipitation_hours=1.0, temperature_2m_mean=21.0),
        dict(location_id=9, weather_date="2/2/2014", precipitation_hours=1.0, temperature_2m_mean=10.0),
        dict(location_id=1, weather_date="12/31/2013", precipitation_hours=5.0, temperature_2m_mean=5.0),
        dict(location_id=1, weather_date="bad", precipitation_hours=5.0, temperature_2m_mean=5.0),
        dict(location_id=None, weather_date="1/5/2014", precipitation_hours=5.0, temperature_2m_mean=5.0),
    ])
    out = {r["label"]: r for r in climate.monthly_district_weather(f, locs(spark, [(1, "Alphaville")])).collect()}
    assert set(out) == {"Alphaville|2014-01", "Unknown|2014-02"}
    assert out["Alphaville|2014-01"]["total_precipitation_hours"] == 6.0
    assert out["Alphaville|2014-01"]["mean_temperature"] == pytest.approx(20.67)


def test_peak_month_tie_goes_to_earliest_and_empty_gives_nothing(spark):
    f = facts(spark, [
        dict(weather_date="3/1/2014", precipitation_hours=5.0),
        dict(weather_date="1/1/2014", precipitation_hours=5.0),
        dict(weather_date="2/1/2014", precipitation_hours=4.0),
    ])
    r = climate.peak_precipitation_month(f).collect()
    assert [(x[0], x[1]) for x in r] == [("2014-01", 5.0)]
    assert climate.peak_precipitation_month(f.limit(0)).collect() == []


def test_city_ranking_having_and_tie_break(spark):
    rows = []
    for loc, temp, n in [(1, 30.0, 3), (2, 30.0, 3), (3, 20.0, 3), (4, 10.0, 2), (5, 70.0, 3)]:
        rows += [dict(location_id=loc, weather_date="1/1/2014", temperature_2m_max=temp)] * n
    f = facts(spark, rows)
    names = locs(spark, [(1, "B"), (2, "A"), (3, "C"), (4, "D"), (5, "E")])
    out = climate.city_temperature_ranking(f, names, min_records=3, n=10).collect()
    assert [(r[0], r[1]) for r in out] == [(1, "C"), (2, "A"), (3, "B")]
    warm = climate.city_temperature_ranking(f, names, direction="desc", min_records=3, n=2,
                                            display="desc").collect()
    assert [(r[0], r[1]) for r in warm] == [(2, "B"), (1, "A")]


def test_seasonal_et0_seasons_and_range(spark):
    rows = ([dict(location_id=1, weather_date="1/1/2014", et0_fao_evapotranspiration=2.0)] * 2
            + [dict(location_id=1, weather_date="6/1/2014", et0_fao_evapotranspiration=4.0)] * 2
            + [dict(location_id=1, weather_date="6/1/2014", et0_fao_evapotranspiration=25.0)]
            + [dict(location_id=1, weather_date="x/1/2014", et0_fao_evapotranspiration=1.0)])
    out = climate.seasonal_et0(facts(spark, rows), locs(spark, [(1, "K")]), min_records=2).collect()
    assert [(r[1], r[2], r[3]) for r in out] == [("Apr-Aug", 4.0, 2), ("Sep-Mar", 2.0, 2)]


def test_radiation_share_and_zero_month(spark):
    rows = [dict(location_id=1, weather_date="1/1/2014", shortwave_radiation_sum=20.0),
            dict(location_id=1, weather_date="1/2/2014", shortwave_radiation_sum=10.0),
            dict(location_id=1, weather_date="2/2/2014", shortwave_radiation_sum=0.0),
            dict(location_id=7, weather_date="1/2/2014", shortwave_radiation_sum=99.0)]
    out = {r["year_month"]: r for r in climate.monthly_radiation(facts(spark, rows), locs(spark, [(1, "K")])).collect()}
    assert out["2014-01"]["high_radiation_percentage"] == pytest.approx(66.67)
    assert out["2014-01"]["avg_radiation"] == 15.0
    assert out["2014-02"]["high_radiation_percentage"] is None


def test_hottest_month_weekly_max(spark):
    rows = [dict(location_id=1, weather_date=d, shortwave_radiation_sum=1.0, temperature_2m_max=t)
            for d, t in [("1/1/2014", 10.0), ("2/1/2014", 30.0), ("2/9/2014", 32.0), ("2/10/2014", 31.0)]]
    out = climate.hottest_month_weekly_max(facts(spark, rows)).collect()
    assert [tuple(r) for r in out] == [(2014, 2, 5, 30.0), (2014, 2, 7, 32.0)]


def test_correlation_constant_and_nulls(spark):
    df = spark.createDataFrame([(1.0, 5.0, 2.0), (2.0, 5.0, None), (3.0, 5.0, 6.0), (4.0, 5.0, 8.0)],
                               "x double, c double, y double")
    out = {r[0]: r[1] for r in correlations(df, "y", ["x", "c"]).collect()}
    assert out["c"] is None
    assert out["x"] == pytest.approx(1.0)  # the NULL pair is skipped: y = 2x exactly
    import numpy as np
    zero = {r[0]: r[1] for r in correlations(df, "y", ["x"], nulls="zero").collect()}
    assert zero["x"] == pytest.approx(round(np.corrcoef([1, 2, 3, 4], [2, 0, 6, 8])[0, 1], 6))


def test_kpis(spark):
    rows = [dict(location_id=1, weather_date="5/1/2014", precipitation_sum=60.0, wind_gusts_10m_max=50.0,
                 temperature_2m_max=31.0),
            dict(location_id=2, weather_date="5/1/2014", precipitation_sum=70.0, wind_gusts_10m_max=45.0,
                 temperature_2m_max=29.0),
            dict(location_id=2, weather_date="10/3/2014", precipitation_sum=10.0, wind_gusts_10m_max=45.0,
                 temperature_2m_max=29.0),
            dict(location_id=2, weather_date="5/1/2015", precipitation_sum=80.0, wind_gusts_10m_max=41.0,
                 temperature_2m_max=35.0)]
    f = facts(spark, rows)
    names = locs(spark, [(1, "Alphaville"), (2, "Betaport")])
    assert {r[0]: r[1] for r in kpi.extreme_weather_days(f).collect()} == {2014: 1, 2015: 1}
    assert kpi.extreme_weather_days(f, year=2014, grain="location_day").first()[1] == 2
    hs = {r[0]: (r[1], r[2]) for r in kpi.hot_share(f).collect()}
    assert hs[2014] == (pytest.approx(33.33), pytest.approx(66.67))
    top = kpi.top_districts_precipitation(f, names, n=1).collect()
    assert [(r[0], r[1]) for r in top] == [("Betaport", 160.0)]
    wet = {r[0]: tuple(r)[1:] for r in kpi.wettest_month_by_district(f, names).collect()}
    assert wet["Betaport"] == (5, "May", "Southwest Monsoon", 75.0)


def test_dashboard_for_one_year(spark):
    rows = [dict(location_id=1, weather_date="5/1/2014", precipitation_sum=60.0, wind_gusts_10m_max=50.0,
                 temperature_2m_max=31.0),
            dict(location_id=1, weather_date="5/1/2015", precipitation_sum=90.0, wind_gusts_10m_max=50.0,
                 temperature_2m_max=20.0)]
    panels = kpi.dashboard(facts(spark, rows), locs(spark, [(1, "Alphaville")]), year=2015)
    assert set(panels) == {"extreme_weather_days", "hot_share", "top_districts_precipitation",
                           "wettest_month_by_district"}
    assert [tuple(r) for r in panels["extreme_weather_days"].collect()] == [(2015, 1)]
    assert panels["hot_share"].first()["hot_pct"] == 0.0
    assert panels["top_districts_precipitation"].first()["total_precipitation_mm"] == 90.0
