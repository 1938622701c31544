"""Column names and types of many Parquet files, read from footers on the executors."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tickweave.functions.names import in_bounds, parse_range, piece_of_file, table_of_file, whole_name
from tickweave.sources.listing import RUN_FILE, list_files, open_input, part_of_path, run_of_path, set_of_path, tree_roots

FOOTER_SCHEMA = "path string, n_rows bigint, position int, variable string, type string, spark_type string"
FILES_PER_TASK = 500
HIDDEN = ("_ITERATION_NO",)  # fixed value: the iteration index is not a variable


def spark_type(kind) -> str:
    """Type in which Spark's Parquet reader reads a column that Arrow calls ``kind``; Arrow's name if there is none."""
    from pyarrow import types
    from pyspark.errors import PySparkTypeError
    from pyspark.sql.pandas.types import from_arrow_type

    if types.is_dictionary(kind):
        kind = kind.value_type
    if types.is_unsigned_integer(kind):
        return {8: "smallint", 16: "int", 32: "bigint", 64: "decimal(20,0)"}[kind.bit_width]
    # without a zone: local times, except for the old 96-bit layout, which Arrow shows in nanoseconds
    local = types.is_timestamp(kind) and kind.unit != "ns"
    try:
        return from_arrow_type(kind, prefer_timestamp_ntz=local).simpleString()
    except PySparkTypeError:
        return str(kind)


def _read_footers(batches: Iterator[pd.DataFrame], skip_unreadable: bool = False) -> Iterator[pd.DataFrame]:
    import pyarrow as pa
    import pyarrow.parquet as pq

    for batch in batches:
        out = []
        for path in batch["path"]:
            try:
                with open_input(path) as f:
                    meta = pq.ParquetFile(f)
                    rows = meta.metadata.num_rows
                    columns = [(path, rows, i, c.name, str(c.type), spark_type(c.type)) for i, c in enumerate(meta.schema_arrow)]
                    out += columns or [(path, rows, None, None, None, None)]
            except (pa.ArrowException, OSError) as e:
                if not skip_unreadable:
                    raise ValueError(f"{path} has no readable Parquet footer: {e}") from e
                out.append((path, None, None, None, None, None))
        frame = pd.DataFrame(out, columns=["path", "n_rows", "position", "variable", "type", "spark_type"])
        yield frame.astype({"n_rows": "Int64", "position": "Int32"})


def footers(files: DataFrame, n_files: int | None = None, skip_unreadable: bool = False) -> DataFrame:
    """One row per file and column; one row without a column for a file that has none.

    A file without a readable footer fails the job, or, with ``skip_unreadable``, has one row without a number of rows.
    """
    if n_files is None:
        n_files = files.count()
    tasks = max(1, -(-n_files // FILES_PER_TASK))
    read = partial(_read_footers, skip_unreadable=skip_unreadable)
    return files.select("path").repartition(tasks, "path").mapInPandas(read, FOOTER_SCHEMA)


def table_exclusion(name: Column) -> Column:
    """Why a file of a run folder is no run table; null for one that is. Pieces of a split run are run tables."""
    own = whole_name(name)
    return (
        F.when(own.contains("_iters_"), F.lit("helper table"))
        .when(~own.startswith("data_"), F.lit("not named data_*"))
        .when(~own.endswith(".parquet"), F.lit("not Parquet"))
    )


def _run_folder_files(spark, root: str, sets, runs, glob: str) -> DataFrame:
    files = list_files(spark, tree_roots(spark, root, sets), glob, check=False).where(F.col("path").rlike(RUN_FILE))
    path = F.col("path")
    files = files.select("path", "modificationTime", "length", set_of_path(path).alias("set_num"), run_of_path(path).alias("run_num"), part_of_path(path, 1).alias("name"))
    return files.where(in_bounds("run_num", parse_range(runs)))


def table_files(spark, root: str, sets=None, runs=None) -> DataFrame:
    """Run tables ``data_<agent>.parquet`` of a tree with their coordinates; helper tables are left out.

    A run whose table is split has a row per piece, with the piece's number.
    """
    files = _run_folder_files(spark, root, sets, runs, "*data_*.parquet").where(table_exclusion(F.col("name")).isNull())
    agent = table_of_file(whole_name(F.col("name"))).alias("agent")
    return files.select("path", "modificationTime", "length", "set_num", "run_num", agent, piece_of_file(F.col("name")).alias("piece"))


def excluded_tables(spark, root: str, sets=None, runs=None) -> DataFrame:
    """Files in run folders that :func:`table_files` leaves out by their name: ``path, set_num, run_num, reason``."""
    files = _run_folder_files(spark, root, sets, runs, "*")
    return files.select("path", "set_num", "run_num", table_exclusion(F.col("name")).alias("reason")).where("reason IS NOT NULL")


def schema_manifest(spark, root: str, sets=None, runs=None) -> DataFrame:
    """Variables of each agent type with type and number of files; several types per name mean drift."""
    files = table_files(spark, root, sets, runs)
    run = F.struct(part_of_path(F.col("path"), 3), part_of_path(F.col("path"), 2))
    agent = table_of_file(whole_name(part_of_path(F.col("path"), 1)))
    per_agent = files.groupBy("agent").agg(F.count_distinct(run).alias("agent_files"))
    cols = footers(files).where(~F.col("variable").isin(*HIDDEN))
    # the pieces of a split run are one table
    once = cols.select(agent.alias("agent"), "variable", "type", run.alias("run"), "position")
    seen = (
        once.groupBy("agent", "variable", "type", "run").agg(F.min("position").alias("position"))
        .groupBy("agent", "variable", "type").agg(F.count(F.lit(1)).alias("files"), F.min("position").alias("position"))
    )
    return seen.join(per_agent, "agent").select(
        "agent", "variable", "type", "position", "files", (F.col("files") < F.col("agent_files")).alias("drift")
    )

