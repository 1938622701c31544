"""Two jobs of the published size classes, on an ensemble Spark derives from the supplied line items.

1. ``density``: about 20.4 million rows (published case S has 20.52 million), 5 parameters, 500 x 500 cells.
2. ``ingest``: a tree of 5,110 run files (511 sets x 10 runs) to a metric checkpoint.

Prints one JSON line. Needs about 300 MB of scratch space.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tickweave.operators.sensitivity import density2d, threshold  # noqa: E402
from tickweave.session import local_session, scratch_path  # noqa: E402
from tickweave.sinks.run_files import write_run_files  # noqa: E402
from tickweave.sinks.tables import write_metric_checkpoints  # noqa: E402
from tickweave.sources.tree import read_metric, read_tree  # noqa: E402

COPIES = 34


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), app="bench-ensemble")
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    def clock(name: str, start: float) -> None:
        seconds[name] = round(time.perf_counter() - start, 2)

    line = spark.read.parquet(f"{sf_dir}/lineitem.parquet").repartition(16, "l_orderkey")
    sets = (F.col("l_linenumber") - 1) * 73 + F.col("l_partkey") % 73 + 1
    base = line.select(
        sets.cast("smallint").alias("set_num"), (F.col("l_suppkey") % 10).alias("seed"),
        ((F.year("l_shipdate") - 1990) * 12 + F.month("l_shipdate")).cast("int").alias("time_step"),
        F.col("l_extendedprice").cast("float").alias("x"),
    )
    copies = base.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(COPIES))))
    run = (F.col("seed") * COPIES + F.col("copy")).cast("smallint")
    big = copies.select("set_num", run.alias("run_num"), "time_step", (F.col("x") * (1 + F.col("copy") / 1000)).cast("float").alias("x"))
    params = line.groupBy(sets.cast("int").alias("set_num")).agg(
        *[F.avg(c).alias(f"p{i}") for i, c in enumerate(("l_discount", "l_tax", "l_quantity", "l_extendedprice", "l_suppkey"))]
    ).cache()
    params.count()

    start = time.perf_counter()
    path = write_metric_checkpoints(big, "x", scratch_path(spark, "case-s"))["x"]
    clock("write_checkpoint", start)
    rows = spark.read.parquet(path)
    start = time.perf_counter()
    cells = density2d(rows, params, "x", 500, top=threshold(rows, "x", 99.0)).count()
    clock("density_5_parameters", start)

    tree = scratch_path(spark, "many-files")
    start = time.perf_counter()
    write_run_files(base.withColumn("run_num", (F.col("seed") + 1).cast("smallint")).drop("seed"), tree, "data_Eurostat.parquet", ["time_step", "x"])
    clock("write_run_files", start)
    start = time.perf_counter()
    ingested = write_metric_checkpoints(read_metric(spark, tree, "Eurostat", "x"), "x", scratch_path(spark, "ingested"))["x"]
    clock("ingest_metric", start)
    start = time.perf_counter()
    read_tree(spark, tree, "Eurostat", mode="widen").write.format("noop").mode("overwrite").save()
    clock("scan_tree", start)
    files = 511 * 10
    print(json.dumps({
        "metric": "ensemble_jobs", "value": round(sum(seconds.values()), 2), "unit": "sec", "steps": seconds, "rows": rows.count(), "cells": cells,
        "files": files, "files_per_sec": round(files / seconds["ingest_metric"], 1), "ingested_rows": spark.read.parquet(ingested).count(),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
