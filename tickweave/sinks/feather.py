"""Arrow IPC (Feather) export: one file per partition, plus a list of what was written."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tickweave.sources.listing import exists, local_path, remove_matching

MANIFEST_SCHEMA = "path string, n_rows bigint, n_batches bigint"


def _target(folder: str):
    """Arrow file system and plain path for a local or remote folder. Runs in tasks."""
    from pyarrow import fs

    plain = local_path(folder)
    return (fs.LocalFileSystem(), plain) if plain is not None else fs.FileSystem.from_uri(folder)


def write_feather(df: DataFrame, folder: str, mode: str = "overwrite") -> DataFrame:
    """Write ``part-<n>.feather`` files into ``folder`` on storage all executors share; returns the manifest.

    ``mode`` is ``overwrite`` (an earlier export in the folder goes) or ``errorifexists``.

    A task writes under a name of its own attempt and moves the file into place when it is complete, so a
    task that runs twice leaves one good file.
    """
    if mode not in ("overwrite", "errorifexists"):
        raise ValueError("mode must be 'overwrite' or 'errorifexists'")
    if mode == "errorifexists" and exists(df.sparkSession, folder):
        raise FileExistsError(folder)
    arrow = to_arrow_schema(df.schema)
    if local_path(folder) is not None:
        folder = os.path.abspath(local_path(folder))

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        system, base = _target(folder)
        system.create_dir(base, recursive=True)
        final = f"{base}/part-{task.partitionId():05d}.feather"
        draft = f"{base}/.part-{task.partitionId():05d}.{task.taskAttemptId()}"
        n_rows = n_batches = 0
        with system.open_output_stream(draft) as f, pa.ipc.new_file(f, arrow) as writer:
            for batch in batches:
                writer.write_batch(pa.RecordBatch.from_arrays([c.cast(t.type) for c, t in zip(batch.columns, arrow)], schema=arrow))
                n_rows += batch.num_rows
                n_batches += 1
        system.move(draft, final)
        yield pa.RecordBatch.from_pydict({"path": [final], "n_rows": [n_rows], "n_batches": [n_batches]})

    remove_matching(df.sparkSession, folder, "part-*.feather", ".part-*", "_manifest")
    written = df.mapInArrow(save, MANIFEST_SCHEMA)
    written.write.mode("overwrite").parquet(f"{folder}/_manifest")
    return df.sparkSession.read.parquet(f"{folder}/_manifest").where(F.col("path").isNotNull())
