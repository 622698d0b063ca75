"""Joins without a broadcast and skewed keys: same answers on every join path."""
import pytest
from pyspark.sql import functions as F

from cumulus.operators import climate, kpi
from cumulus.plans import joins
from cumulus.schema import FACT_SCHEMA


def _skewed_facts(spark):
    """Location 0 holds a third of all rows (the hot key); 30 other locations share the rest."""
    names = [f.name for f in FACT_SCHEMA.fields]
    rows = []
    for i in range(900):
        loc = 0 if i % 3 == 0 else 1 + (i % 30)
        r = dict(location_id=loc, weather_date=f"{1 + i % 12}/{1 + i % 28}/{2014 + i % 3}",
                 temperature_2m_max=20.0 + (i % 7), temperature_2m_mean=15.0 + (i % 5),
                 precipitation_hours=float(i % 11), precipitation_sum=float(i % 90),
                 shortwave_radiation_sum=float(i % 25), et0_fao_evapotranspiration=(i % 16) / 2,
                 wind_gusts_10m_max=float(i % 60))
        rows.append(tuple(r.get(n) for n in names))
    return spark.createDataFrame(rows, FACT_SCHEMA).repartition(6)


def _locs(spark):
    return spark.createDataFrame([(i, f"City{i % 20:02d}") for i in range(0, 31)],
                                 "location_id bigint, city_name string")


def _all(spark, facts, locs):
    return {
        "monthly": sorted(map(tuple, climate.monthly_district_weather(facts, locs).collect())),
        "rank": [tuple(r) for r in climate.city_temperature_ranking(facts, locs, min_records=10).collect()],
        "season": [tuple(r) for r in climate.seasonal_et0(facts, locs, min_records=5).collect()],
        "radiation": sorted(map(tuple, climate.monthly_radiation(facts, locs).collect())),
        "wettest": sorted(map(tuple, kpi.wettest_month_by_district(facts, locs).collect())),
        "top": [tuple(r) for r in kpi.top_districts_precipitation(facts, locs).collect()],
    }


@pytest.fixture()
def no_broadcast(spark):
    """Joins as with a dimension of unknown size: the planner broadcasts nothing by itself."""
    saved = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold",
                                                  "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    for k in saved:
        spark.conf.set(k, "-1")
    yield
    for k, v in saved.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_shuffle_join_fallback_matches_broadcast(spark, request):
    facts, locs = _skewed_facts(spark), _locs(spark)
    broadcast = _all(spark, facts, locs)
    request.getfixturevalue("no_broadcast")
    assert "BroadcastHashJoin" not in _plan(climate.monthly_district_weather(facts, locs))
    assert _all(spark, facts, locs) == broadcast


def test_hot_key_is_pre_aggregated_before_the_exchange(spark, no_broadcast):
    facts, locs = _skewed_facts(spark), _locs(spark)
    lines = _plan(climate.city_temperature_ranking(facts, locs)).splitlines()
    # the facts' exchange: the partial aggregate stands right below it, so the hot location leaves
    # each map task as one row
    at = next(i for i, x in enumerate(lines) if "Exchange hashpartitioning(location_id" in x and "HashAggregate" in lines[i + 1])
    assert "partial_sum" in lines[at + 1]
    below = "\n".join(lines[at + 1:])
    assert "temperature_2m_max" in below


@pytest.mark.parametrize("how", ["inner", "left_semi"])
def test_hot_id_is_split_in_a_shuffled_join(spark, no_broadcast, how):
    """A third of all rows on one id, a dimension that is not broadcast: the id's rows come in parts."""
    facts, locs = _skewed_facts(spark), _locs(spark)
    locs = locs.union(locs.where("location_id = 3")) if how == "inner" else locs  # repeated rows of the dimension count
    facts = facts.union(facts.where("location_id = 7").withColumn("location_id", F.lit(None).cast("long")))
    left, right, on = joins.salted(facts, locs, "location_id", hot_rows=50)
    joined = left.join(right, on, how)
    plain = facts.join(locs, "location_id", how)
    assert "SortMergeJoin" in _plan(joined) and "hashpartitioning(location_id" in _plan(joined) and joins.SALT in _plan(joined)
    cols = plain.columns
    assert sorted(map(repr, joined.select(*cols).collect())) == sorted(map(repr, plain.collect()))
    parts = [r["count"] for r in left.where("location_id = 0").groupBy(joins.SALT).count().collect()]
    assert len(parts) == 6 and max(parts) < 120  # 300 rows
    assert left.where("location_id <> 0").select(joins.SALT).distinct().count() == 1
    if how == "inner":
        got = climate.combined_observations(facts, locs, hot_rows=50)
        assert sorted(map(repr, got.collect())) == sorted(map(repr, climate.combined_observations(facts, locs).collect()))
    else:
        got = joins.known_locations(facts, locs, hot_rows=50)
        assert got.columns == facts.columns and got.count() == joins.known_locations(facts, locs).count()


def test_bucketed_tables_join_without_exchange(spark):
    from cumulus.plans import catalog

    facts, locs = _skewed_facts(spark), _locs(spark)
    catalog.save_bucketed(facts.select("location_id", "weather_date", "temperature_2m_max"), "facts_b", 8)
    catalog.save_bucketed(locs, "locations_b", 8)
    saved = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("facts_b").join(spark.table("locations_b"), "location_id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert joined.count() == facts.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", saved)
