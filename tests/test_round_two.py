"""Rows are never lost or changed without a word: splits, modes, scenarios, side files, lines."""

import random

import pytest
from pyspark.sql import functions as F

from cumulus.operators import climate, ml, stats
from cumulus.schema import FACT_COLUMNS
from cumulus.session import shared_dir
from cumulus.sources import readers
from cumulus.sources.lines import parse_lines, read_observation_files


def _facts(spark):
    rows = [(None if i % 3 == 0 else i, f"5/{i % 28 + 1}/2014", 1.0 + i, 2.0, 3.0, 4.0) for i in range(60)]
    names = [*stats.MODEL_FEATURES, stats.ET0]
    return spark.createDataFrame(rows, "location_id long, weather_date string, " + ", ".join(f"{n} double" for n in names))


def test_split_keeps_rows_without_location(spark):
    data = stats.modelling_set(_facts(spark), keep_split_key=True)
    train, test = stats.deterministic_split(data)
    assert data.count() == 60 == train.count() + test.count()


def test_a_date_mode_that_cannot_be_honoured_is_refused(spark):
    stored = climate.with_obs_date(_facts(spark))
    assert climate.with_obs_date(stored) is stored
    with pytest.raises(ValueError):
        climate.with_obs_date(stored, "strict")


def test_incomplete_scenarios_get_no_prediction(spark):
    names = ml.FEATURE_NAMES
    rows = [(i, float(i), float(i % 5), float(i % 3), float(2 * i)) for i in range(30)]
    train = spark.createDataFrame(rows, "id long, " + ", ".join(f"{n} double" for n in names) + f", {stats.MODEL_LABEL} double")
    model = ml.linear_regression().fit(ml.assemble(train.drop("id")))
    asked = train.drop(stats.MODEL_LABEL).withColumn(names[0], F.when(F.col("id") != 4, F.col(names[0])))
    out = {r.id: r.prediction for r in ml.score(model, asked).collect()}
    assert len(out) == 30 and out[4] is None and all(v is not None for k, v in out.items() if k != 4)


def test_last_duplicate_wins_by_file_order(spark, tmp_dir):
    head = ",".join(f.name for f in readers.LOCATION_SCHEMA.fields)
    width = len(readers.LOCATION_SCHEMA.fields)

    def line(i, name):
        return ",".join({"location_id": str(i), "city_name": name}.get(f.name, "") for f in readers.LOCATION_SCHEMA.fields)

    assert width > 1
    with open(f"{tmp_dir}/a_first.csv", "w") as f:
        f.write("\n".join([head, line(1, "Old"), line(2, "Only")]) + "\n")
    with open(f"{tmp_dir}/b_second.csv", "w") as f:
        f.write("\n".join([head, *[line(100 + i, "x" * 50) for i in range(2000)], line(1, "New")]) + "\n")
    got = {r.location_id: r.city_name for r in readers.read_location_csv(spark, tmp_dir).where("location_id < 3").collect()}
    assert got == {1: "New", 2: "Only"}


def test_files_and_lines_agree_on_a_random_corpus(spark, tmp_dir):
    rnd = random.Random(12)
    parts = ["", " ", "1", "2.5", "null", "NULL", "abc", ' "a', 'b" ', '"', " 7 ", "1/2/2014"]
    lines = [",".join(rnd.choice(parts) for _ in range(rnd.choice([1, 5, 13, 14, 21, 22, 25]))) for _ in range(400)]
    lines = [x for x in lines if x]
    with open(f"{tmp_dir}/in.csv", "w") as f:
        f.write("\n".join(lines) + "\n\n")
    by_files, by_lines = read_observation_files(spark, f"{tmp_dir}/in.csv"), parse_lines(spark.createDataFrame([(x,) for x in lines], "value string"))

    def rows(df):
        return sorted(map(repr, df.select(*[n for n, _ in FACT_COLUMNS]).collect()))

    assert rows(by_files.valid) == rows(by_lines.valid)
    kept = sorted(r[0] for r in by_files.rejected.collect())
    assert kept == sorted(r._line for r in by_lines.rejected.collect())
    assert set(kept) <= set(lines)  # byte for byte


def test_scratch_folder_must_be_named_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError):
        shared_dir(Session())


def test_building_a_join_starts_no_job(spark):
    from cumulus.plans.observations import locations, observations

    sf = "/root/testdata/sf0.001"
    facts, locs = observations(spark, sf), locations(spark, sf)
    tracker = spark.sparkContext.statusTracker()
    before = max([-1, *tracker.getJobIdsForGroup(None)])
    climate.combined_observations(facts, locs)
    climate.city_temperature_ranking(facts, locs)
    assert max([-1, *tracker.getJobIdsForGroup(None)]) == before
