"""Catalog / SQL surface: database, tables, the joined view, table properties, schema."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ..operators.climate import combined_observations


def _ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def use_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_ident(name)}")
    spark.catalog.setCurrentDatabase(name)


@contextmanager
def own_database(spark: SparkSession, prefix: str = "cumulus") -> Iterator[str]:
    """A fresh database that is current inside the block and dropped with its tables afterwards."""
    before, name = spark.catalog.currentDatabase(), f"{prefix}_{uuid.uuid4().hex[:12]}"
    use_database(spark, name)
    try:
        yield name
    finally:
        spark.catalog.setCurrentDatabase(before)
        spark.sql(f"DROP DATABASE IF EXISTS {_ident(name)} CASCADE")


def save_table(df: DataFrame, name: str, mode: str = "overwrite") -> None:
    """Managed table in the current database (Parquet)."""
    df.write.mode(mode).format("parquet").saveAsTable(name)


def _qualified(spark: SparkSession, name: str) -> str:
    """The table of the current database, whatever temp view has its name."""
    return f"{_ident(spark.catalog.currentDatabase())}.{_ident(name)}"


def set_table_properties(spark: SparkSession, name: str, props: dict[str, str]) -> None:
    kv = ", ".join(f"{_literal(k)}={_literal(v)}" for k, v in props.items())
    spark.sql(f"ALTER TABLE {_qualified(spark, name)} SET TBLPROPERTIES ({kv})")


def table_properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {_qualified(spark, name)}").collect()}


def describe_tables(spark: SparkSession, property_names: list[str]) -> DataFrame:
    """One row per column of each table of the current database: table, its number of rows, place,
    name and type of the column, and the named table properties as ``key=value`` text."""
    rows = []
    for t in sorted(x.name for x in spark.catalog.listTables() if not x.isTemporary):
        df = spark.table(_qualified(spark, t))
        props = table_properties(spark, t)
        text = ",".join(f"{k}={props[k]}" for k in property_names if k in props)
        rows += [(t, df.count(), i, f.name, f.dataType.simpleString(), text) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "table_name string, n_rows bigint, position int, column_name string, column_type string, properties string")


def view_frames(facts: DataFrame, locations: DataFrame) -> dict[str, DataFrame]:
    """What the SQL of the analyses reads: ``weather_data``, ``location_data`` and the joined
    ``combined_weather_data``."""
    return {"weather_data": facts, "location_data": locations, "combined_weather_data": combined_observations(facts, locations)}


def register_views(spark: SparkSession, facts: DataFrame, locations: DataFrame) -> None:
    """These frames as temp views of the session, until it ends or they are dropped
    (:func:`cumulus.plans.views.session_views` keeps them for one block only)."""
    for name, df in view_frames(facts, locations).items():
        df.createOrReplaceTempView(name)


def list_tables(spark: SparkSession, database: str | None = None) -> list[str]:
    """Tables and views by name; with temp views, if no database is named and the session has some."""
    return [t.name for t in spark.catalog.listTables(database)]


def schema_tree(df: DataFrame) -> str:
    """The ``printSchema`` tree as text."""
    return df.schema.treeString()


def save_bucketed(df: DataFrame, name: str, buckets: int, key: str = "location_id",
                  mode: str = "overwrite") -> None:
    """Managed Parquet table bucketed (and sorted) by ``key``. Two tables bucketed the same
    way join on ``key`` without a shuffle on either side - the co-located form of the
    row-level fact/dimension join when the dimension is too large to broadcast."""
    (df.write.mode(mode).format("parquet").bucketBy(buckets, key).sortBy(key).saveAsTable(name))
