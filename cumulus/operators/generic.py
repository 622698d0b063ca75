"""General DataFrame / SQL operations: arithmetic projection, range filters, string
prefixing, group counts with a NULL group, SQL over a temp view, SQL over a file path, and
partition-directory discovery with schema merging."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import prefixed
from ..plans.views import session_views


def project_arith(df: DataFrame, keep: list[str], column: str, delta: float = 1,
                  alias: str | None = None) -> DataFrame:
    """``column + delta`` next to the kept columns; NULL stays NULL."""
    return df.select(*keep, (F.col(column) + delta).alias(alias or f"{column}_plus_{delta}"))


def range_filter(df: DataFrame, column: str, low, high, keep: list[str]) -> DataFrame:
    """Closed-range conjunctive filter ``low <= column <= high``."""
    c = F.col(column)
    return df.where((c >= low) & (c <= high)).select(*keep)


def prefix_label(df: DataFrame, column: str, prefix: str = "Name: ", alias: str = "label") -> DataFrame:
    return df.select(prefixed(prefix, column).alias(alias))


def count_by_group(df: DataFrame, column: str) -> DataFrame:
    """Row count per value, NULL being a group of its own."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))


def sql_over_view(spark: SparkSession, df: DataFrame, view: str, sql: str, args: dict | None = None) -> DataFrame:
    """Run parameterised SQL over ``df`` under a view name; the view goes when the query is analysed."""
    with session_views(spark, {view: df}):
        return spark.sql(sql, args=args or {})


def sql_on_file(spark: SparkSession, path: str, fmt: str = "parquet", columns: str = "*") -> DataFrame:
    """SQL straight over a file path (no table registration)."""
    if not fmt.isidentifier():
        raise ValueError(f"not a data source name: {fmt!r}")
    quoted = path.replace("`", "``")  # a backtick in the path must not end the identifier
    return spark.sql(f"SELECT {columns} FROM {fmt}.`{quoted}`")


def write_partition(df: DataFrame, root: str, key: str, value) -> str:
    """Write ``df`` into the ``root/key=value`` folder (manual partition layout)."""
    path = f"{root}/{key}={value}"
    df.write.mode("overwrite").parquet(path)
    return path


def read_merged(spark: SparkSession, root: str) -> DataFrame:
    """Discover ``key=value`` folders and merge differing file schemas by column name."""
    return spark.read.option("mergeSchema", "true").parquet(root)
