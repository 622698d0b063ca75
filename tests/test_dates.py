import datetime as dt

from pyspark.sql import functions as F

from cumulus.functions.dates import (parse_date, split_date_parts, us_week_of_year,
                                     year_month_key, year_month_label)


def _parse(spark, values, mode):
    df = spark.createDataFrame([(v,) for v in values], "t string")
    return [r[0] for r in df.select(parse_date("t", mode)).collect()]


def test_lenient_rollover_like_a_lenient_calendar(spark):
    got = _parse(spark, ["1/5/2014", "25/12/2014", "2/30/2014", "1/5/2014x", "01/05/14",
                         " 12/31/2014 ", "0/1/2014", "1/0/2014"], "lenient")
    assert got == [dt.date(2014, 1, 5), dt.date(2016, 1, 12), dt.date(2014, 3, 2),
                   dt.date(2014, 1, 5), dt.date(14, 1, 5), dt.date(2014, 12, 31),
                   dt.date(2013, 12, 1), dt.date(2013, 12, 31)]


def test_lenient_rejects_other_shapes(spark):
    assert _parse(spark, ["2014-01-05", "", "   ", None, "NULL", "a/b/c"], "lenient") == [None] * 6


def test_strict_falls_back_to_day_month(spark):
    got = _parse(spark, ["1/5/2014", "25/12/2014", "2/30/2014", "1/5/2014x", "", None], "strict")
    assert got == [dt.date(2014, 1, 5), dt.date(2014, 12, 25), None, None, None, None]


def test_split_parts_are_strict(spark):
    df = spark.createDataFrame([("1/5/2014",), ("13/x/2014",), ("2014",), (None,)], "t string")
    y, m, d = split_date_parts("t")
    rows = [tuple(r) for r in df.select(y, m, d).collect()]
    assert rows == [(2014, 1, 5), (2014, 13, None), (None, 2014, None), (None, None, None)]


def _us_week(d: dt.date) -> int:
    # brute force: Sunday-start weeks, week 1 contains Jan 1 (of the next year for late Dec)
    nxt = dt.date(d.year + 1, 1, 1)
    start_next = nxt - dt.timedelta(days=(nxt.weekday() + 1) % 7)
    if d >= start_next:
        return 1
    jan1 = dt.date(d.year, 1, 1)
    start = jan1 - dt.timedelta(days=(jan1.weekday() + 1) % 7)
    return (d - start).days // 7 + 1


def test_us_week_matches_brute_force_over_twenty_years(spark):
    df = spark.sql("SELECT explode(sequence(DATE'2005-01-01', DATE'2025-12-31', INTERVAL 1 DAY)) AS d")
    got = {r[0]: r[1] for r in df.select("d", us_week_of_year("d")).collect()}
    assert len(got) > 7000
    bad = [d for d, w in got.items() if w != _us_week(d)]
    assert bad == []


def test_year_month_keys(spark):
    df = spark.createDataFrame([(dt.date(2014, 3, 9),), (dt.date(987, 11, 1),)], "d date")
    assert [r[0] for r in df.select(year_month_key("d")).collect()] == ["2014-03", "0987-11"]
    df2 = spark.createDataFrame([(2014, 3)], "y int, m int")
    assert df2.select(year_month_label("y", "m")).first()[0] == "2014-03"


def test_null_date_gives_null_parts(spark):
    df = spark.createDataFrame([(None,)], "d date")
    assert df.select(F.year("d"), us_week_of_year("d")).first() == (None, None)


def _lenient_model(m: int, d: int, y: int) -> dt.date:
    # lenient calendar: months beyond 12 (or 0) roll the year, days roll the month
    months = y * 12 + (m - 1)
    first = dt.date(months // 12, months % 12 + 1, 1)
    return first + dt.timedelta(days=d - 1)


def test_lenient_parse_matches_calendar_model_on_random_triples(spark):
    import random

    rnd = random.Random(7)
    triples = [(rnd.randint(0, 40), rnd.randint(0, 120), rnd.randint(1901, 2090)) for _ in range(2000)]
    texts = [f"{m}/{d}/{y}" for m, d, y in triples]
    got = _parse(spark, texts, "lenient")
    expected = [_lenient_model(m, d, y) for m, d, y in triples]
    bad = [(t, g, e) for t, g, e in zip(texts, got, expected) if g != e]
    assert bad == []


def test_no_digit_is_cut_off(spark):
    """Long and zero-padded runs: the whole number counts, or the text is NULL."""
    import datetime
    import random

    rnd = random.Random(6)
    texts = ["1/5/20145", "1/5/02014", "12345/1/2014", "1/5/00000000000000002014", "99999999999/1/2014", "1/5/2014x"]
    texts += [f"{'0' * rnd.randrange(5)}{rnd.randrange(1, 40)}/{'0' * rnd.randrange(5)}{rnd.randrange(1, 99)}/"
              f"{'0' * rnd.randrange(5)}{rnd.randrange(1900, 12000)}" for _ in range(300)]

    def lenient(t):
        m, d, y = (int("".join(c for c in p if c.isdigit())) for p in t.split("/"))
        if y > 9999 or m > 120_000:
            return None
        y, m = y + (m - 1) // 12, (m - 1) % 12 + 1
        try:
            return datetime.date(y, m, 1) + datetime.timedelta(days=d - 1)
        except (ValueError, OverflowError):
            return None

    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(parse_date("t")).collect()] == [lenient(t) for t in texts]


def test_a_parse_matches_its_text_once(spark):
    """In any use: as a column, in filters on it, through the text path and in the counters."""
    from cumulus.operators import climate, quality
    from cumulus.plans.observations import locations, observation_lines
    from cumulus.sources.lines import classified, parse_lines

    sf = "/root/testdata/sf0.001"
    lines = observation_lines(spark, sf)
    facts = parse_lines(lines).valid
    texts = spark.createDataFrame([("1/2/2014",)], "t string")
    plans = [texts.select(parse_date("t").alias("d")),
             climate.with_obs_date(facts).where("obs_date IS NOT NULL AND obs_date >= DATE'1998-01-01'").select("obs_date", F.year("obs_date")),
             climate.monthly_district_weather(facts, locations(spark, sf)),
             climate.peak_precipitation_month(facts), quality.quality_counters(lines), classified(lines)]
    for df in plans:
        assert df._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract(") == 1


def test_digits_at_the_limits(spark):
    want = {"1/1/9999": "9999-01-01", "12/31/9999": "9999-12-31", "1/1/10000": None, "13/1/9999": None, "120000/1/0": "9999-12-01",
            "120001/1/0": None, "999999/1/0": None, "1000000/1/0": None, "1/3700000/0": None, "1/9999999/1": None,
            "1/10000000/1": None, "00000000001/0000000000002/0000002014": "2014-01-02", "1/1/0000": "0000-01-01", "0/1/0": None,
            "1/1/2014.5": "2014-01-01", "1/1/2014/7": "2014-01-01", "1/1/": None, "/1/1": None, "1//1": None}
    df = spark.createDataFrame([(k,) for k in want], "t string").select("t", parse_date("t").cast("string").alias("d"))
    got = {r.t: r.d for r in df.collect()}
    assert got == want
