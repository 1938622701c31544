"""Parquet files inside uncompressed tar archives, read in place."""

from __future__ import annotations

import io
import json
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema
from pyspark.sql.types import IntegerType, StructType

from tickweave.functions.names import in_bounds, parse_range
from tickweave.session import settle
from tickweave.sources.listing import aligned_batch, list_files, merged_schema, open_input, part_of_path, run_of_path, set_of_path

MEMBER_SCHEMA = "archive string, member string, offset bigint, size bigint"
PIECE_SCHEMA = MEMBER_SCHEMA + ", set_num int, run_num int, row_group int, schema string"
MEMBERS_PER_TASK = 200


class _Part(io.RawIOBase):
    """Read-only window on a file, so that a Parquet reader can seek inside an archive member."""

    def __init__(self, f, offset: int, size: int):
        self._f, self._offset, self._size, self._at = f, offset, size, 0

    def seekable(self):
        return True

    def readable(self):
        return True

    def tell(self):
        return self._at

    def seek(self, pos, whence=io.SEEK_SET):
        self._at = pos + {io.SEEK_SET: 0, io.SEEK_CUR: self._at, io.SEEK_END: self._size}[whence]
        return self._at

    def read(self, n=-1):
        left = max(0, self._size - self._at)
        n = left if n is None or n < 0 else min(n, left)
        self._f.seek(self._offset + self._at)
        got = self._f.read(n)
        self._at += len(got)
        return got


def _open_member(f, item):
    import pyarrow.parquet as pq

    return pq.ParquetFile(pa.PythonFile(_Part(f, int(item["offset"]), int(item["size"])), mode="r"))


def _members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import tarfile

    for batch in batches:
        for path in batch["path"]:
            rows = []
            with open_input(path) as f, tarfile.open(fileobj=f, mode="r:") as tar:
                for m in tar:
                    if m.isfile():
                        rows.append((path, m.name, m.offset_data, m.size))
                    tar.members = []  # headers already seen are not needed again
                    if len(rows) == 50_000:
                        yield pd.DataFrame(rows, columns=["archive", "member", "offset", "size"])
                        rows = []
            yield pd.DataFrame(rows, columns=["archive", "member", "offset", "size"])


def tar_members(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Files inside the archives with position and, from their folders, ``set_num`` and ``run_num``."""
    archives = list_files(spark, path, "*.tar").select("path")
    found = archives.repartition(F.col("path")).mapInPandas(_members, MEMBER_SCHEMA)
    return found.select("*", set_of_path(F.col("member")).alias("set_num"), run_of_path(F.col("member")).alias("run_num"))


def _row_groups(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for item in batch.to_dict("records"):
            with open_input(item["archive"]) as f:
                meta = _open_member(f, item)
                text = from_arrow_schema(meta.schema_arrow).json()
                out += [{**item, "row_group": g, "schema": text} for g in range(meta.num_row_groups)]
        if out:
            yield pd.DataFrame(out)


def read_tar_tree(
    spark: SparkSession, path: str | list[str], target: str, sets=None, runs=None, schema: StructType | None = None
) -> DataFrame:
    """Rows of ``.../set_<i>/run_<j>/<target>`` members with ``set_num`` and ``run_num`` in front.

    The archive index is built once on the executors, one archive per task; then row groups of members
    are spread evenly over tasks, which read just their bytes. Members that are not there are simply
    absent (see ``missing_cells``).
    """
    index = tar_members(spark, path).where(
        (part_of_path(F.col("member"), 1) == target)
        & in_bounds("set_num", parse_range(sets))
        & in_bounds("run_num", parse_range(runs))
    )
    index = settle(index, "tar-index")
    tasks = max(1, -(-index.count() // MEMBERS_PER_TASK), spark.sparkContext.defaultParallelism)
    pieces = settle(index.repartition(tasks, "archive", "offset").mapInPandas(_row_groups, PIECE_SCHEMA), "tar-pieces")
    if schema is None:
        texts = [r[0] for r in pieces.select("schema").distinct().orderBy("schema").toLocalIterator()]
        if not texts:
            raise ValueError(f"no member {target} with rows in {path}")
        schema = merged_schema([StructType.fromJson(json.loads(t)) for t in texts])
    inner = to_arrow_schema(schema)
    outer = StructType().add("set_num", IntegerType()).add("run_num", IntegerType())
    for f in schema.fields:
        outer.add(f)

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for m in batch.to_pylist():
                with open_input(m["archive"]) as f:
                    for got in _open_member(f, m).iter_batches(row_groups=[m["row_group"]]):
                        n = got.num_rows
                        here = [pa.array([m["set_num"]] * n, pa.int32()), pa.array([m["run_num"]] * n, pa.int32())]
                        cols = here + aligned_batch(got, inner).columns
                        yield pa.RecordBatch.from_arrays(cols, names=["set_num", "run_num", *inner.names])

    work = pieces.drop("schema").repartition(tasks, "archive", "offset", "row_group")
    return work.mapInArrow(load, outer)
