"""Ingest in one pass, quarantine in the stream, dirty lines, wide correlations, views that go."""

import glob
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from cumulus.operators import climate, kpi, ml, stats
from cumulus.plans import catalog, oracle, queries
from cumulus.plans.observations import dirty_lines, locations, observations
from cumulus.plans.views import session_views
from cumulus.sources import readers
from cumulus.streaming.incremental import start_ingest, write_batch

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw"))
    dirty_lines(spark, SF).repartition(5).write.mode("overwrite").text(path)
    return path


def test_ingest_reads_the_lines_once(spark, raw, tmp_dir):
    counts = []
    for tasks in ("20k", "128m"):  # many tasks, few tasks
        spark.conf.set("spark.sql.files.maxPartitionBytes", tasks)
        spark.conf.set("spark.sql.files.openCostInBytes", "1k")
        done = readers.ingest_lines(spark.read.text(raw), f"{tmp_dir}/{tasks}")
        counts.append(len(glob.glob(f"{tmp_dir}/{tasks}/**/*.parquet", recursive=True)))
        assert done.counts["total"] == 6000 == sum(v for k, v in done.counts.items() if k != "total")
        assert done.valid.count() == done.counts["valid"]
        by = {r.status: r["count"] for r in done.rejected.groupBy("status").count().collect()}
        assert by == {"short_line": done.counts["short_line"], "bad_date": done.counts["bad_date"]}
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")
    assert counts[0] == counts[1] < 30  # follows from the data, not from the tasks


def test_ingest_plan_has_one_scan(spark, raw, tmp_dir, monkeypatch):
    """The write's plan: one scan of the text, one exchange by status and year."""
    from pyspark.sql.readwriter import DataFrameWriter

    plans, parquet = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **b: (plans.append(_plan(self._df)), parquet(self, *a, **b))[1])
    readers.ingest_files(spark, raw, f"{tmp_dir}/facts")
    assert len(plans) == 1
    assert plans[0].count("FileScan text") == 1 and plans[0].count("Exchange") == 1 and "REBALANCE_PARTITIONS_BY_COL" in plans[0]


def test_rejected_lines_are_kept_as_they_were(spark, raw, tmp_dir):
    done = readers.ingest_lines(spark.read.text(raw), f"{tmp_dir}/facts")
    lines = {r.value for r in spark.read.text(raw).collect()}
    rejected = [r.line for r in done.rejected.collect()]
    assert len(rejected) > 500 and set(rejected) <= lines and "line" not in done.valid.columns
    nothing = readers.ingest_lines(spark.createDataFrame([], "value string"), f"{tmp_dir}/none")
    assert nothing.valid.count() == nothing.rejected.count() == nothing.counts["total"] == 0
    assert set(nothing.valid.columns) == set(done.valid.columns)


def test_month_and_year_prune_the_ingested_table(spark, raw, tmp_dir):
    facts = readers.ingest_files(spark, raw, f"{tmp_dir}/facts")
    plan = _plan(climate.monthly_district_weather(facts, locations(spark, SF), min_year=1998))
    assert "PartitionFilters: [isnotnull(year" in plan and ">= 1998)]" in plan
    model = stats.modelling_set(facts, keep_split_key=True)
    assert "EqualTo(month,5)" in _plan(model)
    assert model.count() == stats.modelling_set(facts.drop("month"), keep_split_key=True).count() > 100
    files = glob.glob(f"{tmp_dir}/facts/status=valid/year=1998/*.parquet")
    months = [r.month for r in spark.read.parquet(files[0]).collect()]
    assert months == sorted(months)


def _counted(spark, out):
    names = ("header", "blank", "short_line", "bad_date", "valid")
    rows = spark.read.parquet(f"{out}_counts").collect()
    return sum(r.lines_total for r in rows), {n: sum(r[n] for r in rows) for n in names}


def test_stream_accounts_for_every_line(spark, raw, tmp_dir):
    out, landing = f"{tmp_dir}/typed", f"{tmp_dir}/landing"
    lines = spark.read.text(raw)
    total = 0
    for part in (0, 1):  # two runs with one checkpoint
        own = lines.where(F.pmod(F.xxhash64("value"), F.lit(2)) == part)
        total += own.count()
        own.write.mode("append").text(landing)
        start_ingest(spark, landing, out, f"{tmp_dir}/ckpt", max_files=2).awaitTermination(120)
        seen, by = _counted(spark, out)
        assert seen == total == sum(by.values())
        rejects = {r.status: r["count"] for r in spark.read.parquet(f"{out}_rejects").groupBy("status").count().collect()}
        assert spark.read.parquet(out).count() == by["valid"]
        assert rejects == {"short_line": by["short_line"], "bad_date": by["bad_date"]}
    assert total == 6000 and min(by.values()) > 0
    # a batch that runs again after a failure replaces what it had written
    again = lines.limit(100)
    for _ in range(2):
        write_batch(again, 10_000, out, f"{out}_rejects", f"{out}_counts")
    assert _counted(spark, out)[0] == total + 100
    assert spark.read.parquet(out).count() == _counted(spark, out)[1]["valid"]


@pytest.mark.parametrize("name", ["dirty_quality_counters", "dirty_valid_text", "dirty_ingest", "dirty_streaming_ingest"])
def test_every_fault_occurs_in_the_dirty_lines(name):
    con = duckdb.connect()
    for t in ("lineitem", "supplier"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    assert all(v > 0 for v in con.execute(oracle.oracle_sql()[name]).fetchone())


def test_dirty_analyses_reject_rows(spark):
    """Each rule rejects something: the results differ from those without the rule."""
    facts = queries._dirty_facts(spark, SF).cache()
    t, e = F.col("temperature_2m_max"), F.col("et0_fao_evapotranspiration")
    for kept, all_rows in ((facts.where((t > -50) & (t < 60)), facts.where(t.isNotNull())),
                           (facts.where(e.between(0, 20)), facts.where(e.isNotNull())),
                           (climate.clean_observations(facts), facts), (facts.dropna(subset=["location_id"]), facts)):
        assert 0 < kept.count() < all_rows.count()
    assert facts.where(e == 20).count() > 0 and facts.where(t == -50).count() > 0
    facts.unpersist()


def test_correlations_read_each_row_once(spark):
    df = stats.et0_correlations(observations(spark, SF))
    plan = _plan(df)
    # one scan for all features, and a subquery that reads a thousand rows
    assert plan.count("FileScan parquet") == 1 + plan.count("LocalLimit 1000")
    assert "Expand" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_correlations_of_random_columns_with_nulls(spark):
    rnd = random.Random(3)
    rows = [tuple(None if rnd.random() < 0.2 else float(rnd.randrange(50)) for _ in range(4)) + (7.0,) for _ in range(400)]
    df = spark.createDataFrame(rows, "a double, b double, c double, et0_fao_evapotranspiration double, constant double").repartition(4)
    df = df.withColumns({"far": F.col("a") + 1e8, "tenth": F.lit(0.1), "none": F.lit(None).cast("double")})
    got = {r.feature: r.correlation_with_et0 for r in stats.correlations(df).collect()}
    assert got["far"] == pytest.approx(got["a"], abs=2e-6) and got["tenth"] is got["none"] is None and len(got) == 7
    assert {r.correlation_with_et0 for r in stats.correlations(df.limit(0)).collect()} == {None}
    many = df.select(df.et0_fao_evapotranspiration, *[(df.a + i * df.b).alias(f"f{i}") for i in range(70)])
    wide = {r.feature: r.correlation_with_et0 for r in stats.correlations(many).collect()}
    assert len(wide) == 70 and wide["f69"] == stats.correlations(many, features=["f69"]).first()[1]
    zero = {r.feature: r.correlation_with_et0 for r in stats.correlations(df, nulls="zero").collect()}
    filled = {r.feature: r.correlation_with_et0 for r in stats.correlations(df.fillna(0.0)).collect()}
    assert zero == filled
    for i, name in enumerate("abc"):
        x, y = zip(*[(r[i], r[3]) for r in rows if r[i] is not None and r[3] is not None], strict=True)
        mx, my = sum(x) / len(x), sum(y) / len(y)
        want = sum((p - mx) * (q - my) for p, q in zip(x, y, strict=True)) / (sum((p - mx) ** 2 for p in x) * sum((q - my) ** 2 for q in y)) ** 0.5
        assert got[name] == pytest.approx(want, abs=1e-6)
    assert got["constant"] is None


def test_no_session_view_survives_a_query(spark):
    before = {t.name for t in spark.catalog.listTables() if t.isTemporary}
    databases = {x.name for x in spark.catalog.listDatabases()}
    for name in ("sql_over_views", "sql_over_view", "catalog_tables"):
        assert queries.queries()[name](spark, SF).count() > 0
    assert {t.name for t in spark.catalog.listTables() if t.isTemporary} == before
    assert {x.name for x in spark.catalog.listDatabases()} == databases
    spark.range(3).createOrReplaceTempView("kept_view")
    with session_views(spark, {"kept_view": spark.range(5)}):
        assert spark.table("kept_view").count() == 5
    assert spark.table("kept_view").count() == 3
    spark.catalog.dropTempView("kept_view")


def test_table_properties_reach_the_table_behind_a_view(spark):
    with catalog.own_database(spark):
        spark.range(2).createOrReplaceTempView("shadowed")
        catalog.save_table(spark.range(3), "shadowed")
        catalog.set_table_properties(spark, "shadowed", {"a": "1"})
        assert catalog.table_properties(spark, "shadowed")["a"] == "1"
        spark.catalog.dropTempView("shadowed")


def test_models_read_the_facts_once(spark):
    fits = ml.fit_models(stats.modelling_set(observations(spark, SF), keep_split_key=True), ("lr", "rf", "gbt"),
                         forest=queries.ONE_TREE, boosting=queries.TWO_ROUNDS)
    assert "lineitem" not in _plan(fits.scored)
    assert set(fits.metrics) == set(fits.predictions) == {"lr", "rf", "gbt"}


def test_share_under_the_threshold_is_a_part(spark):
    row = queries.queries()["low_et0_conditions_exact"](spark, "/root/testdata/sf0.01").first()
    assert 0.2 < row.n_low / row.n_scored < 0.35


def test_scenarios_without_wind_have_no_prediction(spark):
    rows = queries.queries()["scenario_scoring_exact"](spark, "/root/testdata/sf0.01").collect()
    assert {r.prediction is None for r in rows if r.location_id % 7 == 0} == {True}
    assert all(r.prediction is not None for r in rows if r.location_id % 7)


def test_a_changed_table_gives_a_new_dashboard(spark, tmp_dir):
    facts, locs = observations(spark, SF), locations(spark, SF)
    one = kpi.dashboard(facts, locs)["hot_share"].count()
    assert one == 7 and kpi.dashboard(facts.where("year(obs_date) < 1997"), locs)["hot_share"].count() == 2
