"""Temp views that last as long as the SQL that names them needs."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


@contextmanager
def session_views(spark: SparkSession, frames: dict[str, DataFrame]) -> Iterator[None]:
    """The frames as temp views inside the block. ``spark.sql`` resolves names when it is called, so
    its result may be used after the views are gone; a view that a name hid before is put back."""
    hidden = {name: spark.table(name) for name in frames if _is_temporary(spark, name)}
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    try:
        yield
    finally:
        for name in frames:
            if name in hidden:
                hidden[name].createOrReplaceTempView(name)
            else:
                spark.catalog.dropTempView(name)


def _is_temporary(spark: SparkSession, name: str) -> bool:
    return any(t.isTemporary and t.name == name for t in spark.catalog.listTables())
