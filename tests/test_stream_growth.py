"""The dirty lines and their ingest by the stream on larger tables: what grows, and what must not."""

import glob

import pytest
from pyspark.sql import functions as F

from cumulus.plans import queries
from cumulus.plans.observations import dirty_lines
from cumulus.sources.lines import classified
from cumulus.streaming import incremental

ODD = ["", " ", "null", "NaN", "-nan", "+NaN", "Infinity", "-inf", "+inf", "INF", "infinite", "\t5", " 5 ", "5\t", "\x01.5", "1e3", ".5", "-.5", "+5.",
       "0x1p3", "1d", "1f", ".", "-", "+", "--5", "e5", "n/a", "x7", "٥", " 5", "temperature_2m_max"]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """3,000 facts, some without a key, each tenth twice."""
    d = str(tmp_path_factory.mktemp("tables"))
    i = F.col("id")
    rows = spark.range(3000).select(
        F.when(i % 101 != 0, i * 3).alias("l_orderkey"), (i % 200).alias("l_partkey"), (i % 10).alias("l_suppkey"),
        (i % 7 + 1).cast("int").alias("l_linenumber"), (i % 50 + 1).cast("double").alias("l_quantity"),
        ((i % 11) / 100).alias("l_discount"), ((i % 9) / 100).alias("l_tax"),
        F.timestamp_seconds(F.lit(800_000_000) + i * 86_400 % 200_000_000).alias("l_shipdate"))
    rows.union(rows.where(i % 10 == 0)).write.parquet(f"{d}/lineitem.parquet")
    return d


def _largest_method(df):
    jvm, plan = df.sparkSession._jvm, df._jdf.queryExecution().executedPlan()
    parts = getattr(getattr(jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$").codegenStringSeq(plan)
    return max([parts.apply(i)._3().maxMethodCodeSize() for i in range(parts.size())], default=0)


def test_no_method_is_too_long_for_the_jvm_compiler(spark, tables, tmp_dir):
    lines = dirty_lines(spark, tables)
    lines.write.text(f"{tmp_dir}/lines")
    # longer methods than 8000 bytes are interpreted for good
    assert _largest_method(lines) < 8000
    assert _largest_method(classified(spark.read.text(f"{tmp_dir}/lines"))) < 8000


def test_picked_rows_give_their_lines(spark, tables):
    half = F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(2))
    parts = [dirty_lines(spark, tables, half == i) for i in (0, 1)]
    every = sorted(r.value for r in dirty_lines(spark, tables).collect())
    assert sorted(r.value for p in parts for r in p.collect()) == every and len(every) == 3300
    assert all(p.count() > 1000 for p in parts)
    # the fact rows are filtered; the line is put together once, above the filter
    plan = parts[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Project") < plan.index("Filter") and "concat_ws" not in plan[plan.index("Filter"):]


def test_numbers_are_typed_as_a_cast_types_them(spark):
    lines = spark.createDataFrame([(i, ",".join(["1", "1/5/2014", "3", t] + ["7"] * 11)) for i, t in enumerate(ODD)], "i int, value string")
    got = [r.temperature_2m_max for r in classified(lines.coalesce(1).orderBy("i")).collect()]
    odd = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)], "i int, t string")
    want = [r.d for r in odd.coalesce(1).orderBy("i").select(F.trim("t").try_cast("double").alias("d")).collect()]
    assert list(map(str, got)) == list(map(str, want)) and 10 < sum(w is not None for w in want) < len(ODD) - 10


@pytest.mark.parametrize(("lines_a_file", "files"), [(1_000_000, 6), (200, 18)])
def test_landed_files_grow_with_the_lines_and_batches_do_not(spark, tables, tmp_dir, monkeypatch, lines_a_file, files):
    monkeypatch.setattr(queries, "_LINES_A_FILE", lines_a_file, raising=False)
    monkeypatch.setattr(queries, "scratch_path", lambda spark, name: f"{tmp_dir}/{name}")
    got = queries.q_dirty_streaming_ingest(spark, tables).first().asDict()
    root = f"{tmp_dir}/dirty-stream"
    assert len(glob.glob(f"{root}/landing/*.txt")) == files
    assert len(glob.glob(f"{root}/typed_counts/batch=*")) == 4
    assert got["lines_total"] == 3300 and got["stored_valid"] == got["valid"] > 0
    assert got == queries.q_dirty_ingest(spark, tables).first().asDict()


def test_a_batch_keeps_the_line_of_what_is_rejected_only(spark, tables, tmp_dir, monkeypatch):
    held = []
    own = incremental.classified

    def watched(lines, **options):
        rows = own(lines, **options)
        held.append(rows)
        return rows

    monkeypatch.setattr(incremental, "classified", watched)
    lines = dirty_lines(spark, tables)
    incremental.write_batch(lines, 0, f"{tmp_dir}/t", f"{tmp_dir}/r", f"{tmp_dir}/c")
    want = held[0].where(F.col("status").isin("short_line", "bad_date")).select("status", "line")
    stored = spark.read.parquet(f"{tmp_dir}/r").select("status", "line")
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, want.collect())) and stored.where("line IS NULL").count() == 0
