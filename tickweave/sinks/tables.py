"""Writing checkpoints and other Parquet tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickweave.functions.names import split_list
from tickweave.operators.shaping import coordinate_columns, metric_view, require_columns
from tickweave.sources.listing import exists

# Fixed value: codecs accepted by every sink. Stock Spark has no brotli codec.
CODECS = ("snappy", "gzip", "zstd", "none")


def codec(name: str) -> str:
    name = (name or "none").lower()
    if name == "brotli":
        raise ValueError("brotli is not part of Spark's Parquet writer; use zstd or gzip")
    if name not in CODECS:
        raise ValueError(f"compression must be one of {CODECS}")
    return "uncompressed" if name == "none" else name


def write_checkpoint(ens: DataFrame, out: str, agent: str, compression: str = "snappy", mode: str = "overwrite", files: int | None = None) -> str:
    """Unified table of one agent type at ``out/checkpoint_<agent>.parquet``, split by set and sorted.

    Rows are range-partitioned on the whole coordinate, so a set that holds a large share of the rows is
    spread over many tasks and files; each file is sorted, which makes its row-group statistics useful.
    """
    path = f"{out.rstrip('/')}/checkpoint_{agent}.parquet"
    keys = coordinate_columns(ens)
    ranged = ens.repartitionByRange(files, *keys) if files else ens.repartitionByRange(*keys)
    ranged.sortWithinPartitions(*keys).write.mode(mode).option("compression", codec(compression)).partitionBy("set_num").parquet(path)
    return path


def metric_path(out: str, metric: str, ext: str = "parquet") -> str:
    return f"{out.rstrip('/')}/{metric}/checkpoint_{metric}.{ext}"


def checkpoint_done(spark: SparkSession, path: str, format: str = "parquet") -> bool:
    """Whether a finished checkpoint is at ``path``; a half-written one does not count."""
    return exists(spark, f"{path}/_SUCCESS" if format == "parquet" else f"{path}/_manifest/_SUCCESS")


def write_metric_checkpoints(
    df: DataFrame, metrics: str | Sequence[str], out: str, compression: str = "snappy", reuse: bool = False, format: str = "parquet"
) -> dict[str, str]:
    """``out/<metric>/checkpoint_<metric>.<parquet|feather>`` for each metric; returns the paths.

    Each metric is its own job reading its own column only. With ``reuse`` a finished checkpoint stays.
    """
    from tickweave.sinks.feather import write_feather

    if format not in ("parquet", "feather"):
        raise ValueError("format must be 'parquet' or 'feather'")
    names = split_list(metrics)
    require_columns(df, *names)
    paths = {}
    for m in names:
        paths[m] = metric_path(out, m, format)
        if reuse and checkpoint_done(df.sparkSession, paths[m], format):
            continue
        if format == "feather":
            write_feather(metric_view(df, m), paths[m])
        else:
            metric_view(df, m).write.mode("overwrite").option("compression", codec(compression)).parquet(paths[m])
    return paths


def compact(df: DataFrame, out: str, rows: int = 5_000_000, compression: str = "snappy", mode: str = "overwrite") -> str:
    """Rewrite many small pieces as files of about ``rows`` rows with one large row group each.

    The rows are counted first (a metadata read for Parquet input), then spread evenly. Tables with coordinates are
    in their order, from file to file too; other tables keep no order, however small.
    """
    n = df.count()
    parts = max(1, -(-n // rows))
    keys = coordinate_columns(df)
    even = df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys) if keys else df.repartition(parts)
    (
        even.write.mode(mode)
        .option("compression", codec(compression))
        .option("maxRecordsPerFile", rows)
        .option("parquet.block.size", 512 * 1024 * 1024)
        .parquet(out)
    )
    return out


def materialize(df: DataFrame, path: str, force: bool = False, reuse: bool = True, compression: str = "snappy") -> DataFrame:
    """Write ``df`` unless a finished copy is there; ``force`` rewrites, ``reuse=False`` makes a copy an error."""
    spark = df.sparkSession
    done = exists(spark, f"{path}/_SUCCESS")
    if done and not force:
        if not reuse:
            raise FileExistsError(path)
        return spark.read.parquet(path)
    df.write.mode("overwrite").option("compression", codec(compression)).parquet(path)
    return spark.read.parquet(path)


def new_files(files: DataFrame, seen_path: str) -> DataFrame:
    """Files not yet in the list at ``seen_path``, or changed since (path, modification time, size)."""
    spark = files.sparkSession
    if not exists(spark, seen_path):
        return files
    return files.join(spark.read.parquet(seen_path), ["path", "modificationTime", "length"], "left_anti")


def remember_files(files: DataFrame, seen_path: str) -> None:
    files.select("path", "modificationTime", "length").write.mode("append").parquet(seen_path)
