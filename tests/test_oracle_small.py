"""Every oracle-backed registered query against its DuckDB SQL on the smallest tables,
and the ML queries for shape; plus plan assertions on the headline queries. The text operators
are optional and have their own tests."""
import math

import duckdb
import pytest

import __spark_entry__ as E
from cumulus.plans import oracle, queries
from cumulus.plans.observations import locations

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


def _canon(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return ("~",)
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, (int, float)):
        return ("n", round(float(v), 9))
    if hasattr(v, "isoformat"):
        return ("d", v.isoformat())
    return ("s", str(v))


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_canon(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    res = con.execute(E.oracle_sql()[name])
    onames = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(onames)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(onames, res.fetchall())


TREE_MODELS = {"model_comparison", "feature_importance", "scenario_scoring", "low_et0_conditions"}


def test_every_query_has_an_oracle_or_is_a_tree_model():
    missing = set(queries.queries()) - set(oracle.oracle_sql())
    assert missing == TREE_MODELS


def test_ml_queries_shapes(spark):
    q = {name: E.queries()[name](spark, SF) for name in TREE_MODELS}  # each is fitted once
    for name, df in q.items():
        _flat(name, df)
    comp = q["model_comparison"].collect()
    assert [r.Model for r in comp] == ["Linear Regression", "Random Forest", "Gradient Boosted Trees"]
    assert all(r.RMSE >= 0 for r in comp)
    imp = q["feature_importance"].collect()
    assert abs(sum(r.importance for r in imp) - 1.0) < 1e-9
    assert q["scenario_scoring"].count() == 10
    assert q["low_et0_conditions"].count() == 1


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["location_id", "year_month", "district", "total_precipitation_hours",
                          "mean_temperature", "label"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_no_python_in_plans(spark, name):
    p = _plan(E.queries()[name](spark, SF))
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                 "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in p, f"{name}: {node}"


def test_dimension_joins_are_broadcast_after_aggregation(spark):
    p = _plan(E.queries()["monthly_district_weather"](spark, SF))
    assert "BroadcastHashJoin" in p
    # the join sits above the final aggregate: raw fact rows never meet the dimension
    assert p.index("BroadcastHashJoin") < p.index("HashAggregate")


def test_ranking_uses_distributed_top_k(spark):
    p = _plan(E.queries()["coolest_cities"](spark, SF))
    assert "TakeOrderedAndProject" in p


def test_pruning_and_pushdown_reach_scan(spark):
    p = _plan(E.queries()["scan_parquet"](spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double>" in p
    p = _plan(E.queries()["range_filter"](spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_suppkey:bigint,l_shipdate:" in p
    p = _plan(E.queries()["prefix_label"](spark, SF))
    assert "ReadSchema: struct<s_name:string>" in p
    p = _plan(locations(spark, SF, registered_only=True))
    assert "GreaterThanOrEqual(s_acctbal,0.0)" in p


def test_hottest_month_weeks_scan_facts_once(spark):
    p = _plan(E.queries()["hottest_month_weekly_max"](spark, SF))
    assert p.count("FileScan parquet") == 1
    assert "Window" in p


def test_dashboard_panels_read_the_checkpoint_not_the_facts(spark):
    for name in ("dashboard_extreme_days", "dashboard_hot_share", "dashboard_top_districts",
                 "dashboard_wettest_month"):
        p = _plan(E.queries()[name](spark, SF))
        assert "lineitem" not in p, name


def _flat(name, df):
    from pyspark.sql import types as T

    names = df.columns
    assert len(names) == len(set(names)), names
    for f in df.schema.fields:
        assert not isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)), (name, f)
        assert "vector" not in f.dataType.simpleString(), (name, f)


@pytest.mark.parametrize("name", sorted(set(queries.queries()) - TREE_MODELS))
def test_outputs_are_flat_with_unique_names(spark, name):
    _flat(name, E.queries()[name](spark, SF))
