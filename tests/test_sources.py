import os

from pyspark.sql import Row
from pyspark.sql import functions as F

from cumulus.operators.generic import (count_by_group, project_arith, range_filter, read_merged,
                                       sql_on_file, sql_over_view, write_partition)
from cumulus.plans import catalog
from cumulus.sources import readers, sinks
from cumulus.streaming.incremental import start_ingest

PEOPLE = ['{"name":"Michael"}', '{"name":"Andy", "age":30}', '{"name":"Justin", "age":19}']


def _write(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")


def test_json_people_operations(spark, tmp_dir):
    p = f"{tmp_dir}/people.json"
    _write(p, PEOPLE)
    df = readers.read_json(spark, p)
    assert dict((f.name, f.dataType.simpleString()) for f in df.schema.fields) == {"age": "bigint", "name": "string"}
    assert "|-- age: long" in catalog.schema_tree(df)
    plus = {r[0]: r[1] for r in project_arith(df, ["name"], "age", 1, "age_plus_one").collect()}
    assert plus == {"Michael": None, "Andy": 31, "Justin": 20}
    assert [r.name for r in df.where(F.col("age") > 21).collect()] == ["Andy"]
    counts = {r[0]: r[1] for r in count_by_group(df, "age").collect()}
    assert counts == {None: 1, 30: 1, 19: 1}
    teen = sql_over_view(spark, df, "people",
                         "SELECT name FROM people WHERE age >= :lo AND age <= :hi", {"lo": 13, "hi": 19})
    assert [r[0] for r in teen.collect()] == ["Justin"]
    fmt = readers.read_format(spark, p, "json")
    assert fmt.count() == 3


def test_text_to_rows_inferred_and_string_schema(spark, tmp_dir):
    p = f"{tmp_dir}/people.txt"
    _write(p, ["Michael, 29", "Andy, 30", "Justin, 19", "Bad, x"])
    typed = readers.text_to_rows(spark, p, "name age", {"age": "bigint"})
    assert [tuple(r) for r in typed.collect()] == [("Michael", 29), ("Andy", 30), ("Justin", 19), ("Bad", None)]
    teen = range_filter(typed, "age", 13, 19, ["name"])
    assert [f"Name: {r[0]}" for r in teen.collect()] == ["Name: Justin"]
    strings = readers.text_to_rows(spark, p, "name age")
    assert all(f.dataType.simpleString() == "string" for f in strings.schema.fields)


def test_parquet_roundtrip_sql_on_file_and_merge(spark, tmp_dir):
    df = spark.createDataFrame([Row(name="Ann", favorite_color="red"), Row(name="Bo", favorite_color=None)])
    sinks.write_format(df.select("name", "favorite_color"), f"{tmp_dir}/users.parquet")
    sinks.write_format(df.select("name"), f"{tmp_dir}/users.parquet")  # overwrite replaces
    back = readers.read_format(spark, f"{tmp_dir}/users.parquet")
    assert back.columns == ["name"] and back.count() == 2
    assert sql_on_file(spark, f"{tmp_dir}/users.parquet").count() == 2
    sq = spark.range(1, 6).select(F.col("id").alias("single"), (F.col("id") ** 2).cast("bigint").alias("double"))
    cu = spark.range(6, 11).select(F.col("id").alias("single"), (F.col("id") ** 3).cast("bigint").alias("triple"))
    write_partition(sq, f"{tmp_dir}/test_table", "key", 1)
    write_partition(cu, f"{tmp_dir}/test_table", "key", 2)
    merged = read_merged(spark, f"{tmp_dir}/test_table")
    assert sorted(merged.columns) == ["double", "key", "single", "triple"]
    rows = {r.single: (r.double, r.triple, r.key) for r in merged.collect()}
    assert rows[2] == (4, None, 1) and rows[7] == (None, 343, 2)


def test_fact_and_location_csv(spark, tmp_dir):
    header = ("location_id,date,weather_code (wmo code),temperature_2m_max (°C),x4,x5,x6,x7,x8,x9,x10,x11,"
              "x12,precipitation_hours (h),x14,x15,x16,shortwave_radiation_sum (MJ/m²),x18,sunrise,sunset")
    _write(f"{tmp_dir}/w/weather.csv", [header, "1,1/5/2014,3,30.5,,,,,,,,,,2,,,,null,,06:00,18:00",
                                        "2,1/6/2014,x,31,,,,,,,,,,1,,,,12.5,,,"])
    facts = readers.read_fact_csv(spark, f"{tmp_dir}/w/weather.csv")
    rows = {r.location_id: r for r in facts.collect()}
    assert rows[1].weather_date == "1/5/2014" and rows[1].shortwave_radiation_sum is None
    assert rows[2].weather_code is None and rows[2].shortwave_radiation_sum == 12.5
    inferred = readers.normalise_headers(readers.read_csv_inferred(spark, f"{tmp_dir}/w/weather.csv"))
    assert {"weather_date", "weather_code", "temperature_2m_max", "shortwave_radiation_sum"} <= set(inferred.columns)
    _write(f"{tmp_dir}/l/loc.csv", ["location_id,latitude,longitude,elevation,utc_offset_seconds,timezone,tz,city_name",
                                    "0,6.9,79.9,4,19800,Etc/UTC,530,Alphaville",
                                    "1,9.3,80.4,9,19800,Etc/UTC,530,Northfield[1]",
                                    "0,6.9,79.9,4,19800,Etc/UTC,530,Alphaville Two"])
    loc = {r.location_id: r.city_name for r in readers.read_location_csv(spark, f"{tmp_dir}/l/loc.csv", True).collect()}
    assert loc == {0: "Alphaville Two", 1: "Northfield"}


def test_catalog_and_legacy_sink(spark, tmp_dir):
    catalog.use_database(spark, "observations_test")
    df = spark.createDataFrame([(1, "x")], "location_id bigint, city_name string")
    catalog.save_table(df, "location_data")
    catalog.set_table_properties(spark, "location_data", {"skip.header.line.count": "1"})
    assert "location_data" in catalog.list_tables(spark)
    spark.catalog.setCurrentDatabase("default")
    m = spark.createDataFrame([("Alphaville|2014-01", 6.0, 20.666666)],
                              "label string, total_precipitation_hours double, mean_temperature double")
    line = sinks.legacy_text_lines(m).first()[0]
    assert line == "Alphaville|2014-01\t6.00,20.67"


def test_streaming_ingest_available_now(spark, tmp_dir):
    src = f"{tmp_dir}/incoming"
    _write(f"{src}/a.csv", ["location_id,date", "1,1/5/2014,1,30,20,25,31,21,25,1,1,1,1,2,1,1,1,1,1,,",
                            "2,bad,1,30,20,25,31,21,25,1,1,1,1,2,1,1,1,1,1,,"])
    q = start_ingest(spark, src, f"{tmp_dir}/typed", f"{tmp_dir}/ckpt")
    q.awaitTermination(120)
    out = spark.read.parquet(f"{tmp_dir}/typed").collect()
    assert [(r.location_id, str(r.obs_date), r.year) for r in out] == [(1, "2014-01-05", 2014)]


def test_ingest_writes_typed_table_partitioned_by_year(spark, tmp_dir):
    from cumulus.operators import climate
    from cumulus.plans.observations import locations, observations

    sf = "/root/testdata/sf0.001"
    raw = observations(spark, sf).drop("obs_date")  # text dates only, as in the raw file
    typed = readers.ingest_observations(spark, raw, f"{tmp_dir}/facts")
    assert typed.count() == raw.count()
    assert {"obs_date", "year", "month"} <= set(typed.columns)
    q = climate.monthly_district_weather(typed, locations(spark, sf), min_year=1998)
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert q.count() > 0
    # the year bound prunes whole year folders before any file is opened
    assert "PartitionFilters: [isnotnull(year" in plan and ">= 1998)]" in plan
    from cumulus.operators import kpi
    k = kpi.hot_share(typed, year=1998)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in k


def test_streaming_ingest_resumes_from_checkpoint(spark, tmp_dir):
    src, out, ckpt = f"{tmp_dir}/landing", f"{tmp_dir}/typed", f"{tmp_dir}/ckpt"
    row = "{loc},{date},1,30,20,25,31,21,25,1,1,1,1,2,1,1,1,1,1,,"
    _write(f"{src}/day1.csv", [row.format(loc=1, date="1/5/2014"), row.format(loc=2, date="1/6/2014")])
    start_ingest(spark, src, out, ckpt).awaitTermination(120)
    assert spark.read.parquet(out).count() == 2
    _write(f"{src}/day2.csv", [row.format(loc=3, date="2/7/2015")])
    start_ingest(spark, src, out, ckpt).awaitTermination(120)
    got = sorted((r.location_id, r.year) for r in spark.read.parquet(out).collect())
    assert got == [(1, 2014), (2, 2014), (3, 2015)]  # day1 not re-ingested


def test_sinks_roundtrip(spark, tmp_dir):
    df = spark.createDataFrame([(1, 2014, "a"), (2, 2015, "b"), (3, 2015, None)],
                               "location_id bigint, year int, city_name string")
    sinks.write_parquet(df, f"{tmp_dir}/p", partition_by=["year"])
    back = spark.read.parquet(f"{tmp_dir}/p")
    assert sorted(back.columns) == ["city_name", "location_id", "year"]
    assert back.where("year = 2015").count() == 2
    import os as _os
    assert sorted(d for d in _os.listdir(f"{tmp_dir}/p") if d.startswith("year=")) == ["year=2014", "year=2015"]
    sinks.write_csv(df, f"{tmp_dir}/c")
    assert spark.read.option("header", True).csv(f"{tmp_dir}/c").count() == 3
    sinks.write_text(df.selectExpr("concat_ws('|', location_id, city_name) AS value"), f"{tmp_dir}/t")
    assert sorted(r.value for r in spark.read.text(f"{tmp_dir}/t").collect()) == ["1|a", "2|b", "3"]


def test_sql_over_registered_views(spark):
    """Warm days per city and year, in SQL over the views and with the DataFrame API."""
    from cumulus.plans.observations import locations, observations

    sf = "/root/testdata/sf0.001"
    facts, locs = observations(spark, sf), locations(spark, sf)
    catalog.register_views(spark, facts, locs)
    via_sql = spark.sql("""
        SELECT l.city_name AS city, year(w.obs_date) AS y, count_if(w.temperature_2m_max > 25) AS warm_days
        FROM weather_data w JOIN location_data l ON w.location_id = l.location_id
        GROUP BY ALL""")
    via_api = (facts.join(locs, "location_id").groupBy(F.col("city_name").alias("city"), F.year("obs_date").alias("y"))
               .agg(F.sum((F.col("temperature_2m_max") > 25).cast("long")).alias("warm_days")))
    a, b = (sorted((r.city, r.y, r.warm_days or 0) for r in x.collect()) for x in (via_sql, via_api))
    assert a == b and len(a) > 0
    assert {"weather_data", "location_data", "combined_weather_data"} <= set(catalog.list_tables(spark))


def test_ingest_files_with_quarantine(spark, tmp_dir):
    row = "{loc},{date},1,30,20,25,31,21,25,1,1,1,1,2,1,1,1,1,1,,"
    _write(f"{tmp_dir}/raw/a.csv", ["location_id,date,x", row.format(loc=1, date="1/5/2014"),
                                    "2,1/6/2014,1,2,3", row.format(loc=3, date="bad"),
                                    row.format(loc=4, date="3/1/2015")])
    typed = readers.ingest_files(spark, f"{tmp_dir}/raw", f"{tmp_dir}/facts", rejects=f"{tmp_dir}/rejects")
    assert sorted((r.location_id, r.year) for r in typed.collect()) == [(1, 2014), (4, 2015)]
    rejected = [r.value for r in spark.read.text(f"{tmp_dir}/rejects/short_lines").collect()]
    assert len(rejected) == 1 and rejected[0].startswith("2,1/6/2014,1,2,3")
    bad = spark.read.parquet(f"{tmp_dir}/rejects/bad_dates").collect()
    assert [(r.location_id, r.weather_date) for r in bad] == [(3, "bad")]
