"""The file-per-run layout ``root/set_<n>/run_<m>/data_<table>.parquet`` other tools read."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tickweave.session import settle
from tickweave.sinks.tables import codec
from tickweave.sources.listing import local_path

# rows of a run file that a task holds before it writes them as one row group
ROW_GROUP_BYTES = 64 * 1024 * 1024

MANIFEST_SCHEMA = "path string, set_num int, run_num int, n_rows bigint, status string"
MANIFEST_ARROW = pa.schema(
    [("path", pa.string()), ("set_num", pa.int32()), ("run_num", pa.int32()), ("n_rows", pa.int64()), ("status", pa.string())]
)


def mirror_tables(df: DataFrame, out: str, table: str, compression: str = "snappy", mode: str = "overwrite") -> str:
    """Spark's own layout of run tables: ``out/table=<t>/set_num=<n>/run_num=<m>/part-*.parquet``.

    Large runs are split over several files. Use :func:`write_run_files` where the exact old names matter.
    """
    keys = ["set_num", "run_num"]
    path = f"{out.rstrip('/')}/table={table}"
    order = keys + [c for c in ("time_step", "iteration", "tick", "_ITERATION_NO") if c in df.columns][:1]
    order += [c for c in ("ID", "id", "agent_id") if c in df.columns][:1]
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode(mode).option("compression", codec(compression)).partitionBy(*keys).parquet(path)
    return path


def write_run_files(
    df: DataFrame, out: str, file_name: str, order: list[str], compression: str = "snappy", force: bool = False,
    ticks_per_file: int | None = None,
) -> DataFrame:
    """One Parquet file per (set, run), rows in ``order``; returns one row per file with its status.

    The layout demands one file per run, so a run is written by one task; rows pass through it in Arrow
    batches, which are gathered to row groups of bounded size. With ``ticks_per_file`` (``order[0]`` is the tick) a run becomes
    several files ``<piece>_<file_name>``, written by different tasks; ``read_tree`` takes them together.
    A file that is already there is SKIPPED unless ``force``. Rows without a set or run number go to ``set_None`` or ``run_None``.
    """
    columns = [c for c in df.columns if c not in ("set_num", "run_num")]
    piece = F.lit(0) if ticks_per_file is None else F.floor(F.col(order[0]) / F.lit(ticks_per_file))
    schema = to_arrow_schema(df.select(*columns).schema)
    squeeze = codec(compression)
    squeeze = "none" if squeeze == "uncompressed" else squeeze
    base = os.path.abspath(local_path(out)) if local_path(out) is not None else out.rstrip("/")

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc
        import pyarrow.parquet as pq

        from tickweave.sinks.feather import _target

        attempt = TaskContext.get().taskAttemptId()
        system, root = _target(base)
        here = writer = None
        count, draft, final = 0, "", ""
        done: list[tuple] = []

        held: list[pa.RecordBatch] = []

        def equals(column: pa.Array, value) -> pa.Array:
            return pc.is_null(column) if value is None else pc.fill_null(pc.equal(column, value), False)

        def flush(least: int = 0):
            if held and sum(b.nbytes for b in held) >= least:
                rows = pa.Table.from_batches(held, schema=schema)
                writer.write_table(rows, row_group_size=rows.num_rows)
                held.clear()

        def finish():
            if here is None:
                return
            if writer is not None:
                flush()
                writer.close()
                system.move(draft, final)
            done.append((final, *here[:2], count, "CONVERTED" if writer is not None else "SKIPPED"))

        for batch in batches:
            s, r, k = (batch.column(c) for c in ("set_num", "run_num", "_piece"))
            start = 0
            while start < batch.num_rows:
                cell = (s[start].as_py(), r[start].as_py(), k[start].as_py())
                same = pc.and_(equals(s.slice(start), cell[0]), equals(r.slice(start), cell[1]))
                same = pc.and_(same, equals(k.slice(start), cell[2]))
                stop = pc.index(same, False).as_py()
                stop = batch.num_rows if stop < 0 else start + stop
                if cell != here:
                    finish()
                    here, count = cell, 0
                    folder = f"{root}/set_{cell[0]}/run_{cell[1]}"
                    name = file_name if ticks_per_file is None else f"{cell[2]}_{file_name}"
                    final, draft = f"{folder}/{name}", f"{folder}/.{name}.{attempt}"
                    taken = not force and system.get_file_info(final).is_file
                    system.create_dir(folder, recursive=True)
                    writer = None if taken else pq.ParquetWriter(draft, schema, filesystem=system, compression=squeeze)
                if writer is not None:
                    part = batch.slice(start, stop - start)
                    held.append(pa.RecordBatch.from_arrays([part.column(c).cast(schema.field(c).type) for c in columns], schema=schema))
                    flush(ROW_GROUP_BYTES)
                count += stop - start
                start = stop
        finish()
        if done:
            yield pa.RecordBatch.from_pydict({n: list(v) for n, v in zip(MANIFEST_ARROW.names, zip(*done))}, schema=MANIFEST_ARROW)

    keys = ["set_num", "run_num", "_piece"]
    numbers = [F.col("set_num").cast("int").alias("set_num"), F.col("run_num").cast("int").alias("run_num")]
    grouped = df.select(*numbers, piece.cast("bigint").alias("_piece"), *columns).repartition(*keys)
    return settle(grouped.sortWithinPartitions(*keys, *order).mapInArrow(save, MANIFEST_SCHEMA), "written-files")

