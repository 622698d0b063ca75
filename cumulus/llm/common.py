"""Helpers shared by the text operators: reading, shipping code, shared tables, byte hashes."""

from __future__ import annotations

import functools
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path

PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


def ship_code(spark: SparkSession) -> None:
    """Send this package to the executors once per session, so that their Python workers can
    import it whatever their working folder is."""
    sc = spark.sparkContext
    if any("cumulus-code-" in f for f in sc._python_includes):
        return
    fd, path = tempfile.mkstemp(prefix="cumulus-code-", suffix=".zip")
    with os.fdopen(fd, "wb") as f, zipfile.ZipFile(f, "w") as z:
        for top, _, names in os.walk(PACKAGE):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(top, n)
                    z.write(full, os.path.join("cumulus", os.path.relpath(full, PACKAGE)))
    sc.addPyFile(path)


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to a fresh folder of the shared storage and read back: cuts the
    lineage, and every later use sees the same rows even if executors are lost."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def in_arrow(df: DataFrame, fn: Callable[..., Iterator[pa.RecordBatch]], schema: str, *args) -> DataFrame:
    """``mapInArrow`` with bound arguments; ``fn(batches, *args)`` is a module-level function."""
    ship_code(df.sparkSession)
    return df.mapInArrow(functools.partial(_call, fn, args), schema)


def _call(fn, args, batches):
    yield from fn(batches, *args)


def text_lists(batches: Iterable[pa.RecordBatch], *cols: str) -> Iterator[list[list]]:
    """Per batch: the named columns as Python lists; a null text is the empty text."""
    for b in batches:
        out = []
        for c in cols:
            v = b.column(c).to_pylist()
            out.append([x or "" for x in v] if c == "text" else v)
        yield out


@functools.cache
def byte_table(seed: int) -> np.ndarray:
    """256 fixed pseudo-random 64-bit words, one per byte value."""
    return np.array([xxhash.xxh3_64_intdigest(bytes([b]), seed=seed) for b in range(256)], dtype=np.uint64)


def mix64(x: np.ndarray) -> np.ndarray:
    """A finishing mix: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))
