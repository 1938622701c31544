"""Finding files. Folder names are read through Hadoop's file system API, so any Spark path works."""

from __future__ import annotations

import re
import uuid
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tickweave.functions.names import Range, first_number, number_of, parse_range

FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, uri string"


def _fs(spark: SparkSession, path: str):
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark._jsc.hadoopConfiguration()), hpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def remove_matching(spark: SparkSession, folder: str, *globs: str) -> None:
    """Make way for new output in ``folder``: delete entries with these names and nothing else."""
    for glob in globs:
        fs, p = _fs(spark, f"{folder.rstrip('/')}/{glob}")
        for status in fs.globStatus(p) or []:
            fs.delete(status.getPath(), True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is either there as a whole or not at all: written beside its place, then moved there."""
    fs, place = _fs(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(place.getParent(), f".{place.getName()}.{uuid.uuid4().hex}")
    out = fs.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.rename(draft, place):
        raise OSError(f"{path} could not be put in place")


def read_text(spark: SparkSession, path: str) -> str:
    fs, place = _fs(spark, path)
    stream = fs.open(place)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def children(spark: SparkSession, path: str, folders: bool) -> list[str]:
    """Names of the folders (or files) right below ``path``."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory() == folders]


def set_folders(spark: SparkSession, root: str, sets: Range | str | None = None) -> list[str]:
    """Set folders inside the range, in numeric order. A name with two groups of digits is refused."""
    bounds = parse_range(sets)
    found = []
    for name in children(spark, root, folders=True):
        if not name.startswith("set_"):
            continue
        n = number_of(name)
        if bounds is None or bounds[0] <= n <= bounds[1]:
            found.append((n, f"{root.rstrip('/')}/{name}"))
    return [p for _, p in sorted(found)]


def list_files(spark: SparkSession, paths: str | list[str], glob: str, check: bool = True) -> DataFrame:
    """(path, modificationTime, length, uri) of all files below ``paths`` whose name matches ``glob``.

    ``uri`` is the path as the rows of a scan show it in ``_metadata.file_path``, where blanks and the like are escaped.

    The ``binaryFile`` source lists in parallel and, as no content is selected, opens nothing. Like all
    Spark file sources it passes over files of zero bytes. ``check=False`` promises that the paths exist.
    """
    roots = [paths] if isinstance(paths, str) else list(paths)
    if check:
        roots = [p for p in roots if any(ch in p for ch in "*?{[") or exists(spark, p)]
    if not roots:
        return spark.createDataFrame([], FILE_SCHEMA)
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
    return reader.load(roots).select("path", "modificationTime", "length", F.col("_metadata.file_path").alias("uri"))


def part_of_path(path: Column, back: int) -> Column:
    """Path component counted from the end: 1 is the file name, 2 its folder."""
    tail = F.substring_index(path, "/", -back)
    return tail if back == 1 else F.substring_index(tail, "/", 1)


def folder_number(name: Column) -> Column:
    """Number in a folder name; the usual ``set_<n>`` and ``run_<n>`` are read without a regular expression,
    which counts because this runs for every row of a scan."""
    return F.coalesce(F.substring(name, 5, 12).try_cast("int"), first_number(name))


def set_of_path(path: Column, back: int = 3) -> Column:
    return folder_number(part_of_path(path, back))


def run_of_path(path: Column, back: int = 2) -> Column:
    return folder_number(part_of_path(path, back))


def source_folder(path: Column, root: str) -> Column:
    """Folders between ``root`` and the set folder of a file, '' if there are none; for a flat name, all folders below ``root``."""
    plain = F.regexp_replace(path, r"^[A-Za-z][A-Za-z0-9+.-]*:/+", "/")
    base = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:/+", "/", root).rstrip("/") + "/"
    below = F.regexp_replace(F.substring_index(plain, base, -1), r"[^/]*$", "")
    return F.rtrim(F.regexp_replace(below, r"(?i)(^|/)set_[a-z0-9]+/.*$", "$1"), F.lit("/"))


# Fixed value: the place of a run file in a tree.
RUN_FILE = r"/set_[^/]*/run_[^/]*/[^/]*$"


def tree_roots(spark: SparkSession, root: str, sets: Range | str | None) -> list[str]:
    """Where to list a tree from: the root itself if all sets are wanted, else the set folders in range."""
    folders = set_folders(spark, root, sets)
    return [root] if folders and parse_range(sets) is None else folders


def local_path(uri: str) -> str | None:
    """Plain path of a ``file:`` URI, None for other schemes. Runs in tasks."""
    if uri.startswith("file:"):
        return unquote(re.sub(r"^file:/+", "/", uri))
    return uri if uri.startswith("/") else None


def open_input(uri: str):
    """Random-access Arrow input file for any URI Arrow knows (local, hdfs, s3, ...). Runs in tasks."""
    from pyarrow import fs

    plain = local_path(uri)
    if plain is not None:
        return fs.LocalFileSystem().open_input_file(plain)
    system, path = fs.FileSystem.from_uri(uri)
    return system.open_input_file(path)


def merged_schema(schemas: list[StructType]) -> StructType:
    """Columns of all schemas by name; one name with two types is an error, an explicit schema solves it."""
    out = StructType()
    for schema in schemas:
        for f in schema.fields:
            if f.name not in out.fieldNames():
                out.add(f.name, f.dataType, True)
            elif out[f.name].dataType != f.dataType:
                raise ValueError(f"column {f.name} has several types; read the files with an explicit schema")
    return out


def aligned_batch(batch, schema):
    """Arrow batch with exactly the columns of an Arrow schema; absent ones are null. Runs in tasks."""
    import pyarrow as pa

    cols = [
        batch.column(f.name).cast(f.type) if f.name in batch.schema.names else pa.nulls(batch.num_rows, f.type) for f in schema
    ]
    return pa.RecordBatch.from_arrays(cols, names=schema.names)
