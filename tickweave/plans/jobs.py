"""Whole jobs: tree to checkpoint, databases to tree, sensitivity grids, dataset report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickweave.functions.names import split_list
from tickweave.operators.audit import agent_census, first_runs, run_counts, selection_totals, status_tally, timeline
from tickweave.operators.sensitivity import density2d, log_counts, threshold
from tickweave.operators.shaping import infer_numeric_strings
from tickweave.sinks.run_files import write_run_files
from tickweave.sinks.tables import checkpoint_done, metric_path, write_checkpoint, write_metric_checkpoints
from tickweave.sources.feather import read_feather
from tickweave.sources.footers import schema_manifest, table_files
from tickweave.sources.params import read_params
from tickweave.sources.listing import source_folder
from tickweave.sources.sqlite_db import ingest_sqlite_tree
from tickweave.sources.tree import read_ledgered, read_metric, read_tree


def build_checkpoints(spark: SparkSession, root: str, out: str, agents: str, sets=None, runs=None, mode: str = "widen", suffix: bool = False, skip_unreadable: bool = False) -> dict[str, str]:
    """``checkpoint_<agent>.parquet`` for each agent type in a comma list; agents without files are skipped.

    Beside each checkpoint, ``rejects_<agent>.parquet`` tells per set and run how many values became null, and
    ``skipped_<agent>.parquet`` which files were left out and why. Footers are compared once for all three.
    """
    paths = {}
    for agent in split_list(agents):
        reading = read_ledgered(spark, root, agent, sets, runs, suffix=suffix, mode=mode, skip_unreadable=skip_unreadable)
        if len(reading.rows.columns) > 4 or not reading.rows.isEmpty():
            paths[agent] = write_checkpoint(reading.rows, out, agent)
            for name, report in (("rejects", reading.rejects), ("skipped", reading.ledger)):
                report.write.mode("overwrite").parquet(f"{out.rstrip('/')}/{name}_{agent}.parquet")
    return paths


def skip_totals(spark: SparkSession, out: str, agent: str) -> DataFrame:
    """Files and rows that a checkpoint was built without, by reason."""
    skipped = spark.read.parquet(f"{out.rstrip('/')}/skipped_{agent}.parquet")
    return skipped.groupBy("reason").agg(F.count(F.lit(1)).alias("files"), F.sum("n_rows").alias("rows"))


def reject_totals(spark: SparkSession, out: str, agent: str) -> dict[str, int]:
    """Rows of a checkpoint and, per column, the values that became null when it was built."""
    lost = spark.read.parquet(f"{out.rstrip('/')}/rejects_{agent}.parquet").drop("set_num", "run_num")
    return lost.agg(*[F.coalesce(F.sum(F.col(f"`{c}`")), F.lit(0)).alias(c) for c in lost.columns]).first().asDict()


LEDGER = "conversion_ledger.parquet"


def conversion_ledger(source: DataFrame, kept: DataFrame, written: DataFrame, root: str) -> DataFrame:
    """What became of each source file: ``path, folder, set_num, run_num, status, tables, rows, rows_written, message``.

    ``source`` is the manifest of all files, ``kept`` that of the runs that were converted, ``written`` the manifests of the
    files written (``folder`` is null where all sub-folders went to one run). ERROR and EMPTY are facts of the source; INCOMPLETE is a good file whose run was held back for another's
    error; SKIPPED is a file all of whose run's tables were there before; ``rows_written`` are those of its run.
    """
    held = source.join(kept.select("path", F.lit(True).alias("kept")), "path", "left")
    skipped = F.count_if(F.col("status") == "SKIPPED") == F.count(F.lit(1))
    runs = written.groupBy("folder", "set_num", "run_num").agg(skipped.alias("skipped"), F.sum(F.when(F.col("status") != "SKIPPED", F.col("n_rows"))).alias("rows_written"))
    runs = runs.withColumnsRenamed({"folder": "_f", "set_num": "_s", "run_num": "_r"})
    held = held.withColumn("folder", source_folder(F.col("path"), root))
    same = (F.col("_f").isNull() | (F.col("folder") == F.col("_f"))) & F.col("set_num").eqNullSafe(F.col("_s")) & F.col("run_num").eqNullSafe(F.col("_r"))
    status = (
        F.when(F.col("kept").isNull() & (F.col("status") != "ERROR"), "INCOMPLETE").when((F.col("status") == "CONVERTED") & F.col("skipped"), "SKIPPED")
        .otherwise(F.col("status"))
    )
    out = held.join(runs, same, "left").withColumn("status", status)
    rows_written = F.when(F.col("status") == "CONVERTED", F.coalesce("rows_written", F.lit(0))).otherwise(F.lit(0))
    return out.select("path", "folder", "set_num", "run_num", "status", "tables", "rows", rows_written.cast("bigint").alias("rows_written"), "message")


def convert_databases(spark: SparkSession, root: str, out: str, sets=None, runs=None, force: bool = False, by_folder: bool = False) -> DataFrame:
    """SQLite tree to ``out/set_<n>/run_<m>/data_<table>.parquet``; returns the tally per status.

    Numeric text is promoted per table over the whole ensemble, so all runs of a table get one schema.
    A run is written whole or not at all: where a file has an ERROR nothing of its run is written, and the
    other files of that run count as INCOMPLETE. The outcome of each file is in ``out/conversion_ledger.parquet``.
    ``by_folder`` keeps databases of one set and run apart that lie in different sub-folders of ``root``: each sub-folder is
    mirrored below ``out``. Without it they become one run.
    """
    tree = ingest_sqlite_tree(spark, root, sets, runs)
    whole = tree.whole_runs()
    folder = source_folder(F.col("path"), root) if by_folder else F.lit("")
    places = [r[0] for r in whole.manifest.select(folder.alias("f")).distinct().orderBy("f").toLocalIterator()]  # folders above the set folders: few
    written = None
    for place in places:
        part = whole.where(folder == place) if by_folder else whole
        target = f"{out.rstrip('/')}/{place}" if place else out
        for table in part.tables():
            rows = infer_numeric_strings(part.read(table))
            order = [c for c in ("_ITERATION_NO", "time_step", "iteration", "tick", "ID", "id", "agent_id") if c in rows.columns]
            made = write_run_files(rows, target, f"data_{table}.parquet", order, force=force).withColumn("folder", F.lit(place if by_folder else None).cast("string"))
            written = made if written is None else written.unionByName(made)
    if written is None:
        written = spark.createDataFrame([], "folder string, set_num int, run_num int, n_rows bigint, status string")
    ledger = conversion_ledger(tree.manifest, whole.manifest, written, root)
    ledger.write.mode("overwrite").parquet(f"{out.rstrip('/')}/{LEDGER}")
    return status_tally(spark.read.parquet(f"{out.rstrip('/')}/{LEDGER}"))


def sensitivity_grids(
    spark: SparkSession, root: str, params_csv: str, table: str, metrics: str, out: str, sets=None, runs=None,
    stride: int = 1, reuse: bool = False, percentile: float = 100.0, bins: int = 500, format: str = "parquet",
) -> dict[str, DataFrame]:
    """Metric checkpoints and, for each metric, the density grids of all parameters."""
    names = split_list(metrics)
    params = read_params(spark, params_csv)
    grids = {}
    for m in names:
        path = metric_path(out, m, format)
        if not (reuse and checkpoint_done(spark, path, format)):
            write_metric_checkpoints(read_metric(spark, root, table, m, sets, runs, stride), m, out, format=format)
        rows = spark.read.parquet(path) if format == "parquet" else read_feather(spark, path)
        grids[m] = log_counts(density2d(rows, params, m, bins, top=threshold(rows, m, percentile)))
    return grids


@dataclass
class Report:
    """Parts of a dataset report, each a small table."""

    totals: DataFrame
    runs: DataFrame
    timeline: DataFrame | None
    agents: DataFrame
    schema: DataFrame
    first_run: DataFrame


def inspect_tree(spark: SparkSession, root: str, sets=None, runs=None) -> Report:
    """Sets, runs, ticks, agent types and variables of a converted tree, over all runs."""
    every_file = table_files(spark, root)
    files = table_files(spark, root, sets, runs)
    if files.isEmpty():
        raise ValueError(f"no run tables in range below {root}")
    names = [r[0] for r in files.select("agent").distinct().orderBy("agent").toLocalIterator()]
    ticks = None
    for name in names:
        rows = read_tree(spark, root, name, sets, runs, mode="widen").select("set_num", "time_step")
        ticks = rows if ticks is None else ticks.unionByName(rows.select(F.col("set_num"), F.col("time_step")))
    return Report(
        selection_totals(every_file, sets, runs),
        run_counts(every_file, sets, runs),
        None if ticks is None else timeline(ticks),
        agent_census(files),
        schema_manifest(spark, root, sets, runs),
        first_runs(files),
    )

