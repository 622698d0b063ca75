"""Reproduce the README's 10x scaling check.

Writes lineitem x N (distinct order keys per copy, ``--files`` files instead of one row
group) plus supplier into SCRATCH/sfNx, then runs bench.py on it (ML skipped).
Usage: python scripts/scale_check.py SCRATCH [--copies 10] [--files 16] [--src /root/testdata/sf0.1]
The copy is written once per SCRATCH folder; pass a fresh folder for a new copy.
"""

from __future__ import annotations

import argparse
import os
import subprocess
import sys
from functools import reduce

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from cumulus.session import build_session  # noqa: E402


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("scratch")
    ap.add_argument("--copies", type=int, default=10)
    ap.add_argument("--files", type=int, default=16)
    ap.add_argument("--src", default="/root/testdata/sf0.1")
    a = ap.parse_args()
    dst = os.path.join(a.scratch, f"sf{a.copies}x")
    if not os.path.exists(os.path.join(dst, "lineitem.parquet")):
        spark = build_session(app_name="cumulus-scale-copy")
        li = spark.read.parquet(f"{a.src}/lineitem.parquet")
        step = 10_000_000  # above every order key of the source: copies stay distinct
        copies = [li.withColumn("l_orderkey", F.col("l_orderkey") + F.lit(i * step)) for i in range(a.copies)]
        reduce(lambda x, y: x.unionByName(y), copies).repartition(a.files) \
            .write.mode("overwrite").parquet(f"{dst}/lineitem.parquet")
        spark.read.parquet(f"{a.src}/supplier.parquet").write.mode("overwrite").parquet(f"{dst}/supplier.parquet")
        spark.stop()
    env = dict(os.environ, BENCH_SF_DIR=dst, BENCH_SKIP_ML="1", BENCH_REPEAT=os.environ.get("BENCH_REPEAT", "2"))
    subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, check=True)


if __name__ == "__main__":
    main()
