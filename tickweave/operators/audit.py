"""What is there and what is missing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickweave.functions.names import in_bounds, parse_range


def timeline(ens: DataFrame, approximate: bool = False) -> DataFrame:
    """First tick, last tick and number of distinct ticks of every set, over all its runs."""
    distinct = F.approx_count_distinct("time_step") if approximate else F.count_distinct("time_step")
    return ens.groupBy("set_num").agg(
        F.min("time_step").alias("min_tick"), F.max("time_step").alias("max_tick"), distinct.alias("n_ticks")
    )


def run_counts(cells: DataFrame, sets=None, runs=None) -> DataFrame:
    """Per selected set: runs inside the run range and runs in total."""
    runs_in = in_bounds("run_num", parse_range(runs))
    return (
        cells.where(in_bounds("set_num", parse_range(sets)))
        .select("set_num", "run_num")
        .distinct()
        .groupBy("set_num")
        .agg(F.count_if(runs_in).alias("matching_runs"), F.count(F.lit(1)).alias("total_runs"))
    )


def selection_totals(cells: DataFrame, sets=None, runs=None) -> DataFrame:
    """One row: sets selected, sets in total, and (set, run) cells selected."""
    inside = in_bounds("set_num", parse_range(sets))
    both = inside & in_bounds("run_num", parse_range(runs))
    pairs = cells.select("set_num", "run_num").distinct()
    return pairs.agg(
        F.count_distinct(F.when(inside, F.col("set_num"))).alias("selected_sets"),
        F.count_distinct("set_num").alias("total_sets"),
        F.count_if(both).alias("cells"),
    )


def agent_census(files: DataFrame) -> DataFrame:
    """Agent types per set, from a file list with ``set_num``, ``agent`` and ``piece``; a split run counts as one file."""
    if "piece" not in files.columns:
        return files.groupBy("set_num", "agent").agg(F.count(F.lit(1)).alias("files"))
    runs = files.groupBy("set_num", "agent", "run_num").agg(F.greatest(F.count_if(F.col("piece").isNull()), F.lit(1)).alias("n"))
    return runs.groupBy("set_num", "agent").agg(F.sum("n").alias("files"))


def expected_cells(spark: SparkSession, sets, runs) -> DataFrame:
    """Every (set, run) of two inclusive ranges, numbered off one counter."""
    (s0, s1), (r0, r1) = parse_range(sets), parse_range(runs)
    width = r1 - r0 + 1
    return spark.range((s1 - s0 + 1) * width).select(
        (F.floor(F.col("id") / F.lit(width)) + F.lit(s0)).cast("int").alias("set_num"),
        (F.pmod(F.col("id"), F.lit(width)) + F.lit(r0)).cast("int").alias("run_num"),
    )


def missing_cells(cells: DataFrame, sets, runs) -> DataFrame:
    """Expected (set, run) pairs that have no data."""
    have = cells.select(F.col("set_num").cast("int"), F.col("run_num").cast("int")).distinct()
    return expected_cells(cells.sparkSession, sets, runs).join(have, ["set_num", "run_num"], "left_anti")


def complete_sets(cells: DataFrame, sets, runs) -> DataFrame:
    """Per expected set: how many expected runs exist, and whether that is all of them."""
    r0, r1 = parse_range(runs)
    have = (
        cells.where(in_bounds("run_num", (r0, r1)))
        .select(F.col("set_num").cast("int").alias("set_num"), "run_num")
        .distinct()
        .groupBy("set_num")
        .agg(F.count(F.lit(1)).alias("runs"))
    )
    s0, s1 = parse_range(sets)
    wanted = cells.sparkSession.range(s0, s1 + 1).select(F.col("id").cast("int").alias("set_num"))
    runs_seen = F.coalesce(F.col("runs"), F.lit(0))
    return wanted.join(have, "set_num", "left").select(
        "set_num", runs_seen.alias("runs"), (runs_seen == r1 - r0 + 1).alias("complete")
    )


def first_runs(cells: DataFrame) -> DataFrame:
    """Lowest-numbered run of every set."""
    return cells.groupBy("set_num").agg(F.min("run_num").alias("first_run"))


def status_tally(manifest: DataFrame) -> DataFrame:
    """Number of work items per status of a job manifest."""
    return manifest.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
