"""Arrow IPC (Feather) files, read in parallel by record batch."""

from __future__ import annotations

import json
import warnings
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema
from pyspark.sql.types import StructType

from tickweave.session import settle
from tickweave.sources.listing import aligned_batch, list_files, merged_schema, open_input

BATCHES_PER_TASK = 64


def _index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for path in batch["path"]:
            with open_input(path) as f:
                reader = pa.ipc.open_file(f)
                n = reader.num_record_batches
                text = from_arrow_schema(reader.schema).json()
                # one row per stretch of record batches, or one marker row if there are none
                out += [(path, i, min(i + BATCHES_PER_TASK, n), text) for i in range(0, max(n, 1), BATCHES_PER_TASK)]
        yield pd.DataFrame(out, columns=["path", "first", "last", "schema"])


def read_feather(spark: SparkSession, path: str | list[str], schema: StructType | None = None) -> DataFrame:
    """All rows of the Feather files at ``path`` (file, folder or glob; several allowed).

    A file is cut into stretches of record batches, so a single large file is spread over tasks. Columns
    missing in a file become null. Files without record batches are warned about and give no rows.
    """
    files = list_files(spark, path, "*.feather").select("path")
    pieces = files.repartition(F.col("path")).mapInPandas(_index, "path string, first int, last int, schema string")
    pieces = settle(pieces, "feather-index")
    if schema is None:
        texts = [r[0] for r in pieces.select("schema").distinct().orderBy("schema").toLocalIterator()]
        if not texts:
            raise ValueError(f"no Feather file at {path}")
        schema = merged_schema([StructType.fromJson(json.loads(t)) for t in texts])
    blank = pieces.where(F.col("last") == 0).count()
    if blank:
        warnings.warn(f"{blank} Feather file(s) hold no record batches", stacklevel=2)
    work = pieces.where(F.col("last") > F.col("first")).select("path", "first", "last")
    n = work.count()
    arrow = to_arrow_schema(schema)

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item in batch.to_pylist():
                with open_input(item["path"]) as f:
                    reader = pa.ipc.open_file(f)
                    for i in range(item["first"], item["last"]):
                        yield aligned_batch(reader.get_batch(i), arrow)

    return work.repartition(max(n, 1), "path", "first").mapInArrow(load, schema)
