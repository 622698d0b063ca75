"""Incremental ingest of observation files as they land in a folder.

The reference jobs are batch; this is the same text path (header drop, field check,
lenient typing, date parse) run by Structured Streaming over a file source, so new files
are parsed once. Every batch is classified once and written in three parts: valid rows to the typed
table (by year), rejected lines as they were to the quarantine, and one row of counts. Each part has a
folder of its own for every batch, which a repeated batch overwrites: a batch that is run again after
a failure leaves nothing twice. Progress lives in the checkpoint folder (on the shared file
system), so a restarted or moved driver resumes exactly where it stopped. ``availableNow`` processes
what is there and stops.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..schema import FACT_COLUMNS
from ..sources.lines import BAD_DATE, BLANK, HEADER, REJECTED, SHORT, VALID, classified


def write_batch(lines: DataFrame, batch: int, target_dir: str, rejects_dir: str, counts_dir: str,
                date_mode: str = "lenient") -> None:
    """One batch of lines into the typed table, the quarantine and the counts."""
    rows = classified(lines, date_mode=date_mode)
    # the line itself is kept of what is rejected only
    rows = rows.withColumn("line", F.when(F.col("status").isin(*REJECTED), F.col("line"))).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        (rows.where(F.col("status") == VALID).drop("status", "line").withColumns({"year": F.year("obs_date"), "month": F.month("obs_date")})
         .hint("rebalance", F.col("year")).sortWithinPartitions("year", "month", "location_id")
         .write.mode("overwrite").partitionBy("year").parquet(f"{target_dir}/batch={batch}"))
        (rows.where(F.col("status").isin(*REJECTED)).select("status", "line", *[n for n, _ in FACT_COLUMNS])
         .write.mode("overwrite").parquet(f"{rejects_dir}/batch={batch}"))
        rows.agg(F.count(F.lit(1)).alias("lines_total"),
                 *[F.count_if(F.col("status") == s).alias(s) for s in (HEADER, BLANK, SHORT, BAD_DATE, VALID)]) \
            .write.mode("overwrite").parquet(f"{counts_dir}/batch={batch}")
    finally:
        rows.unpersist()


def start_ingest(spark: SparkSession, source_dir: str, target_dir: str, checkpoint_dir: str,
                 available_now: bool = True, date_mode: str = "lenient", rejects_dir: str | None = None,
                 counts_dir: str | None = None, max_files: int | None = None) -> StreamingQuery:
    """Start the ingest. The quarantine and the counts are always written: unless named, beside the
    table (``<target_dir>_rejects``, ``<target_dir>_counts``). ``max_files`` bounds a batch."""
    rejects, counts = rejects_dir or f"{target_dir}_rejects", counts_dir or f"{target_dir}_counts"
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def run(lines: DataFrame, batch: int) -> None:
        write_batch(lines, batch, target_dir, rejects, counts, date_mode)

    w = reader.load(source_dir).writeStream.foreachBatch(run).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
