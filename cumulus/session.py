"""Session helpers: a tuned local session for tests/bench, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "cumulus") -> SparkSession:
    """Session for tests and the bench. On a cluster the caller brings its own session.

    AQE stays on (coalesces the shuffle partitions of the small aggregated stages and
    splits skewed join partitions at runtime); the UI stays off; time zone pinned to UTC so
    date arithmetic is identical on every executor.
    """
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus)
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared scratch folder named by ``spark.checkpoint.dir``.

    Read from the session. Only a local master may leave it unset (tests, a laptop): then a
    fresh local folder is created and registered. On a cluster each executor would write to its
    own disk, so there an unset folder is an error.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="cumulus-ckpt-")
        sc.setCheckpointDir(path)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A unique sub-path of the shared folder for one write (never reused, never deleted by us)."""
    return f"{shared_dir(spark)}/cumulus-{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under the shared folder and read back: cuts the lineage, so later uses
    neither compute it again nor lose it with an executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
