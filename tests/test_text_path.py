from pyspark.sql import functions as F

from cumulus.functions.text import clean_city_name, is_valid_text, safe_double
from cumulus.operators.quality import quality_counters
from cumulus.sources.lines import parse_lines

HEADER = ("location_id,date,weather_code,t_max,t_min,t_mean,a_max,a_min,a_mean,daylight,sunshine,"
          "precip,rain,precip_hours,wind,gust,dir,rad,et0,sunrise,sunset")


def _line(loc, date, t_mean="20", hours="3", et0="4.5", n=21):
    f = [loc, date, "1", "30", "20", t_mean, "31", "21", "25", "40000", "30000", "5", "5", hours,
         "10", "20", "180", "18", et0, "06:00", "18:00"]
    return ",".join(f[:n])


def test_valid_text(spark):
    df = spark.createDataFrame([(v,) for v in ["a", " ", "", None, "null", " null ", "NULL"]], "v string")
    assert [r[0] for r in df.select(is_valid_text("v")).collect()] == [True, False, False, False,
                                                                      False, False, True]


def test_safe_double_and_names(spark):
    df = spark.createDataFrame([(" 7 ",), ("7.5",), ("x",), ("",)], "v string")
    assert [r[0] for r in df.select(safe_double("v")).collect()] == [7.0, 7.5, None, None]
    n = spark.createDataFrame([("Northfield[1]",)], "v string")
    assert n.select(clean_city_name("v")).first()[0] == "Northfield"


def test_parse_lines_headers_short_and_bad_values(spark):
    lines = [HEADER, _line("1", "1/5/2014"), HEADER, _line("2", "1/6/2014", t_mean="null"),
             _line("3", "1/7/2014", hours=""), _line("4", "1/8/2014", et0="abc"),
             _line("5", "1/9/2014", n=10), _line(" 6 ", " 1/10/2014 ")]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    p = parse_lines(df)
    valid = {r["location_id"]: r for r in p.valid.collect()}
    assert sorted(valid) == [1, 2, 3, 4, 6]
    assert valid[2]["temperature_2m_mean"] is None
    assert valid[3]["precipitation_hours"] is None
    assert valid[4]["et0_fao_evapotranspiration"] is None
    assert valid[6]["weather_date"] == "1/10/2014"
    assert p.rejected.count() == 1


def test_trailing_empty_fields_do_not_count(spark):
    # 14 fields, the last four empty -> only 10 count, so the line is rejected
    df = spark.createDataFrame([("1,1/5/2014,1,2,3,4,5,6,7,8,,,,",)], "value string")
    assert parse_lines(df).rejected.count() == 1


def test_quality_counters(spark):
    lines = [HEADER, _line("1", "1/5/2014"), _line("2", "2014-01-05"), _line("3", "1/5/2010"),
             _line("4", "2/1/2014", et0="null"), _line("5", "1/1/2014", n=5)]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    r = quality_counters(df, min_year=2014).first().asDict()
    assert r == {"lines_total": 6, "header_lines": 1, "short_lines": 1, "invalid_date": 1,
                 "missing_et0": 1, "before_min_year": 1, "rows_kept": 2, "months_processed": 3}


def test_observed_counters_fill_in_after_one_action(spark):
    from cumulus.operators.quality import observe_lines

    lines = [HEADER, _line("1", "1/5/2014"), _line("2", "1/5/2014", n=3), HEADER]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    observed, obs = observe_lines(df)
    assert parse_lines(observed).valid.count() == 1
    assert obs.get == {"lines_total": 4, "header_lines": 2, "short_lines": 1}


def test_keyed_split_is_layout_independent(spark):
    from cumulus.operators.stats import deterministic_split

    df = spark.range(0, 1000).selectExpr("id", "CAST(id % 100 AS INT) AS split_bucket")
    a, _ = deterministic_split(df.repartition(3))
    b, _ = deterministic_split(df.repartition(7))
    assert sorted(r.id for r in a.collect()) == sorted(r.id for r in b.collect())
    r_train, r_test = deterministic_split(df, method="random")
    assert r_train.count() + r_test.count() == 1000


def _java_split_len(s: str) -> int:
    # String.split(","): split on every comma, then drop trailing empty strings
    parts = s.split(",")
    while parts and parts[-1] == "":
        parts.pop()
    return len(parts) if s else 1


def test_reject_decision_matches_java_split_on_random_lines(spark):
    import random

    from cumulus.schema import MIN_FIELDS
    from cumulus.sources.lines import field_count

    rnd = random.Random(11)
    lines = ["".join(rnd.choice([",", ",", "a", "7", " ", ""]) for _ in range(rnd.randint(0, 40)))
             for _ in range(3000)]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = [r[0] for r in df.select(field_count(F.col("value")) >= MIN_FIELDS).collect()]
    expected = [_java_split_len(x) >= MIN_FIELDS for x in lines]
    assert got == expected


def test_file_reader_matches_line_parser(spark, tmp_dir):
    from cumulus.sources.lines import read_lines, read_observation_files

    lines = [HEADER, _line("1", "1/5/2014"), HEADER, _line("2", "1/6/2014", t_mean="null"),
             _line("3", "1/7/2014", hours=""), _line("4", "1/8/2014", et0="abc"),
             _line("5", "1/9/2014", n=10), _line(" 6 ", " 1/10/2014 "),
             "7,1/5/2014,1,2,3,4,5,6,7,8,9,10,11,,,,,,,,", "8,1/5/2014,1,2,3,4,5,6,7,8,9,10,11,,,,,,x,,", ""]
    import os
    os.makedirs(f"{tmp_dir}/in", exist_ok=True)
    with open(f"{tmp_dir}/in/a.csv", "w") as fh:
        fh.write("\n".join(lines) + "\n")
    by_lines = parse_lines(read_lines(spark, f"{tmp_dir}/in"))
    by_files = read_observation_files(spark, f"{tmp_dir}/in")
    a = sorted(map(tuple, by_lines.valid.collect()), key=str)
    b = sorted(map(tuple, by_files.valid.collect()), key=str)
    assert a == b and len(a) == 6
    assert by_files.rejected.count() == 2  # the 10-field line and the 13-field line


def test_enough_fields_by_either_rule(spark):
    """The look at the rest of the split says the same as the count of fields."""
    import random

    from pyspark.sql import functions as F

    from cumulus.sources.lines import field_count, has_fields

    rnd = random.Random(4)
    texts = [",".join(rnd.choice(["", "", " ", "x"]) for _ in range(rnd.randrange(1, 8))) for _ in range(500)] + ["", ",", ",,,,,,,"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for n in range(6):
        got = df.select(has_fields(F.split("t", ",", -1), n).alias("a"), (field_count(F.col("t")) >= n).alias("b")).collect()
        assert all(r.a == r.b for r in got)
