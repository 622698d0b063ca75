"""The README quick start, end to end on files derived from the smallest tables."""
from pyspark.sql import functions as F

from cumulus.operators import climate, kpi, ml, stats
from cumulus.plans.observations import observation_lines, table
from cumulus.sources import readers

SF = "/root/testdata/sf0.001"


def test_quick_start(spark, tmp_dir):
    observation_lines(spark, SF).write.mode("overwrite").text(f"{tmp_dir}/raw")
    sup = table(spark, SF, "supplier")
    (sup.select(F.col("s_suppkey").alias("location_id"), F.lit(6.9).alias("latitude"),
                F.lit(79.9).alias("longitude"), F.lit(4.0).alias("elevation"),
                F.lit(19800).alias("utc_offset_seconds"), F.lit("Etc/UTC").alias("timezone"),
                F.lit("530").alias("timezone_abbreviation"), F.col("s_name").alias("city_name"))
     .coalesce(1).write.mode("overwrite").option("header", True).csv(f"{tmp_dir}/loc"))

    facts = readers.ingest_files(spark, f"{tmp_dir}/raw", f"{tmp_dir}/curated", rejects=f"{tmp_dir}/rejects")
    locs = readers.read_location_csv(spark, f"{tmp_dir}/loc")
    assert facts.count() == table(spark, SF, "lineitem").count()
    assert locs.count() == sup.count()
    results = [climate.monthly_district_weather(facts, locs, min_year=1998),
               climate.peak_precipitation_month(facts), climate.city_temperature_ranking(facts, locs),
               climate.seasonal_et0(facts, locs), climate.top_radiation_months(facts, locs),
               climate.hottest_month_weekly_max(facts), stats.et0_correlations(facts)]
    assert all(r.count() > 0 for r in results)
    fits = ml.fit_models(stats.modelling_set(facts, keep_split_key=True), forest={"num_trees": 5}, boosting={"max_iter": 5})
    assert set(fits.metrics) == {"lr", "rf", "gbt"}
    panels = kpi.dashboard(facts, locs, year=1998)
    assert panels["wettest_month_by_district"].count() == sup.count()
