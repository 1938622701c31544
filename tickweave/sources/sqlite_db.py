"""Ensembles kept as SQLite files, one per run, read on the executors with the standard library."""

from __future__ import annotations

import sqlite3
import warnings
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, DoubleType, IntegerType, LongType, StringType, StructType

from tickweave.functions.names import flat_db_part, first_number, in_bounds, parse_range
from tickweave.session import settle
from tickweave.sources.listing import list_files, local_path, open_input, part_of_path

ROWS_PER_PIECE = 250_000
FILES_PER_TASK = 20
PIECE_SCHEMA = "path string, set_num int, run_num int, table string, first bigint, last bigint, status string, message string"
SURVEY_SCHEMA = PIECE_SCHEMA + ", n_rows bigint, columns string"


def database_files(spark: SparkSession, root: str, sets=None, runs=None) -> DataFrame:
    """Database files with coordinates from flat names ``set_X_run_Y[_..].db`` or from the folders above.

    A file without set or run in its name or path keeps a null there and passes the range filter.
    """
    path = F.col("path")
    base = F.regexp_replace(path, r"^[a-z0-9]+:/+", "/")
    name = part_of_path(path, 1)
    folders = F.split(F.regexp_replace(base, r"/[^/]*$", ""), "/")

    def folder(prefix: str):
        return F.try_element_at(F.filter(folders, lambda p: p.rlike(rf"(?i)^{prefix}_[a-z0-9]+$")), F.lit(-1))

    flat = flat_db_part(name, 1).isNotNull()
    set_label = F.when(flat, flat_db_part(name, 1)).otherwise(folder("set"))
    run_label = F.when(flat, flat_db_part(name, 2)).otherwise(folder("run"))
    files = list_files(spark, root, "*.{db,sqlite,sqlite3}")
    out = files.select("*", first_number(set_label).alias("set_num"), first_number(run_label).alias("run_num"))
    for label, bounds in ((set_label, sets), (run_label, runs)):
        out = out.where(label.isNull() | in_bounds(first_number(label), parse_range(bounds)))
    return out


def _connect(uri: str) -> sqlite3.Connection:
    plain = local_path(uri)
    if plain is not None:
        return sqlite3.connect(f"file:{quote(plain)}?mode=ro&immutable=1", uri=True)
    con = sqlite3.connect(":memory:")
    with open_input(uri) as f:
        con.deserialize(f.read())
    return con


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


# Storage classes of SQLite and the Spark types that hold them.
STORAGE_TYPES = {"integer": "bigint", "real": "double", "text": "string", "blob": "binary"}
SPARK_CLASSES = {"bigint": LongType(), "double": DoubleType(), "string": StringType(), "binary": BinaryType()}


def _column_type(classes: set[str]) -> str:
    """Spark type for the storage classes seen in a column, ``null`` if there were only nulls."""
    classes = classes - {"null"}
    if not classes:
        return "null"
    if classes <= {"integer", "real"}:
        return "double" if "real" in classes else "bigint"
    return STORAGE_TYPES[classes.pop()] if len(classes) == 1 else "string"


def _row_number(con: sqlite3.Connection, table: str) -> str | None:
    """The name under which SQLite gives row numbers: the first that no column of the table takes."""
    taken = {row[1].lower() for row in con.execute(f"PRAGMA table_xinfo({_quoted(table)})")}
    return next((name for name in ("rowid", "_rowid_", "oid") if name not in taken), None)


def _row_numbers(con: sqlite3.Connection, table: str) -> tuple[int | None, int | None]:
    """First and last row number, both from the ends of the table; None for a table without row numbers."""
    key = _row_number(con, table)
    if key is None:
        return None, None
    try:
        t = _quoted(table)
        return con.execute(f"SELECT (SELECT min({key}) FROM {t}), (SELECT max({key}) FROM {t})").fetchone()
    except sqlite3.OperationalError:
        return None, None


def _frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])
    for c in ("set_num", "run_num", "first", "last"):
        frame[c] = frame[c].astype("Int64")
    return frame


def _number(v) -> int | None:
    return None if pd.isna(v) else int(v)


def _pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Tables of each file, cut into stretches of row numbers. Reads catalogues only."""
    for batch in batches:
        out = []
        for path, s, r in zip(batch["path"], batch["set_num"], batch["run_num"]):
            who = (path, _number(s), _number(r))
            try:
                con = _connect(path)
                try:
                    q = "SELECT name FROM sqlite_master WHERE type = 'table' AND name NOT LIKE 'sqlite_%' ORDER BY name"
                    tables = [row[0] for row in con.execute(q)]
                    for table in tables:
                        try:
                            lo, hi = _row_numbers(con, table)
                        except sqlite3.Error as e:
                            out.append((*who, table, None, None, "ERROR", str(e)))
                            continue
                        cuts = [(None, None)] if lo is None else [(a, min(a + ROWS_PER_PIECE - 1, hi)) for a in range(lo, hi + 1, ROWS_PER_PIECE)]
                        out += [(*who, table, a, z, "CONVERTED", None) for a, z in cuts]
                    if not tables:
                        out.append((*who, None, None, None, "EMPTY", None))
                finally:
                    con.close()
            except Exception as e:  # a broken file is a row of the report, not a failed job
                out.append((*who, None, None, None, "ERROR", str(e)))
        yield _frame(out, PIECE_SCHEMA)


def _stretch(con: sqlite3.Connection, table: str, item: dict) -> tuple[str, tuple]:
    if pd.isna(item["first"]):
        return "", ()
    return f" WHERE {_row_number(con, table)} BETWEEN ? AND ?", (int(item["first"]), int(item["last"]))


def _survey(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Adds to each piece its row count and ``name<TAB>type`` lines, from one statement."""
    for batch in batches:
        out = []
        for item in batch.to_dict("records"):
            head = (item["path"], _number(item["set_num"]), _number(item["run_num"]), item["table"], _number(item["first"]), _number(item["last"]))
            if item["table"] is None or item["status"] == "ERROR":
                out.append((*head, item["status"], item["message"], 0, None))
                continue
            try:
                con = _connect(item["path"])
                try:
                    names = [row[1] for row in con.execute(f"PRAGMA table_info({_quoted(item['table'])})")]
                    seen = ", ".join(f"group_concat(DISTINCT typeof({_quoted(c)}))" for c in names)
                    where, args = _stretch(con, item["table"], item)
                    n, *kinds = con.execute(f"SELECT count(*), {seen} FROM {_quoted(item['table'])}{where}", args).fetchone()
                    lines = "\n".join(f"{c}\t{_column_type(set((k or 'null').split(',')))}" for c, k in zip(names, kinds))
                    out.append((*head, "CONVERTED", None, n, lines))
                finally:
                    con.close()
            except Exception as e:
                out.append((*head, "ERROR", str(e), 0, None))
        yield _frame(out, SURVEY_SCHEMA)


def _tasks(spark: SparkSession, items: int) -> int:
    return max(1, -(-items // FILES_PER_TASK), min(items, spark.sparkContext.defaultParallelism))


def ingest_sqlite_tree(spark: SparkSession, root: str, sets=None, runs=None) -> "SqliteTree":
    """Survey all databases below ``root`` once; tables are then read from the result.

    Files are first cut into stretches of row numbers, which only looks at catalogues; counting and type
    detection then run per stretch, so one huge database is surveyed by many tasks.
    """
    files = database_files(spark, root, sets, runs).select("path", "set_num", "run_num")
    pieces = settle(files.repartition(_tasks(spark, files.count()), "path").mapInPandas(_pieces, PIECE_SCHEMA), "sqlite-pieces")
    spread = pieces.repartition(_tasks(spark, pieces.count()), "path", "table", "first")
    return SqliteTree(spark, settle(spread.mapInPandas(_survey, SURVEY_SCHEMA), "sqlite-survey"))


class SqliteTree:
    """Outcome of the survey: what each file holds, and readers for its tables."""

    def __init__(self, spark: SparkSession, plan: DataFrame):
        self._spark, self._plan = spark, plan

    @property
    def manifest(self) -> DataFrame:
        """One row per file: CONVERTED, EMPTY (no tables) or ERROR, with non-empty tables, rows and message."""
        failed = F.max(F.when(F.col("status") == "ERROR", "ERROR"))
        return self._plan.groupBy("path", "set_num", "run_num").agg(
            F.coalesce(failed, F.max("status")).alias("status"),
            F.max("message").alias("message"),
            F.count_distinct(F.when(F.col("n_rows") > 0, F.col("table"))).alias("tables"),
            F.sum("n_rows").alias("rows"),
        )

    def whole_runs(self) -> "SqliteTree":
        """The same without the runs that have a file with an ERROR, of which only part could be read."""
        bad = self._plan.where(F.col("status") == "ERROR").select(F.col("set_num").alias("_s"), F.col("run_num").alias("_r")).distinct()
        same = F.col("set_num").eqNullSafe(F.col("_s")) & F.col("run_num").eqNullSafe(F.col("_r"))
        return SqliteTree(self._spark, self._plan.join(bad, same, "left_anti"))

    def where(self, condition: Column) -> "SqliteTree":
        """The same for the files (``path, set_num, run_num``) that meet a condition."""
        return SqliteTree(self._spark, self._plan.where(condition))

    def tables(self) -> list[str]:
        """Names of all tables that hold rows somewhere."""
        rows = self._plan.where(F.col("n_rows") > 0).select("table").distinct().orderBy("table")
        return [r[0] for r in rows.toLocalIterator()]

    def schema(self, table: str) -> StructType:
        """Columns of a table over all files; whole and fractional numbers meet in double, else text."""
        lines = self._plan.where((F.col("table") == table) & (F.col("n_rows") > 0))
        entry = lines.select(F.posexplode(F.split("columns", "\n")).alias("pos", "entry"))
        parts = F.split("entry", "\t")
        kinds_of = (
            entry.groupBy(parts[0].alias("name"))
            .agg(F.min("pos").alias("pos"), F.collect_set(parts[1]).alias("kinds"))
            .orderBy("pos", "name")
        )
        out = StructType()
        for row in kinds_of.toLocalIterator():
            kinds = set(row["kinds"]) - {"null"}
            kind = "string" if not kinds else next(iter(kinds)) if len(kinds) == 1 else "double" if kinds <= {"bigint", "double"} else "string"
            out.add(row["name"], SPARK_CLASSES[kind])
        return out

    def read(self, table: str) -> DataFrame:
        """Rows of one table from all files, ``set_num`` and ``run_num`` first.

        The unit of work is a stretch of row numbers, not a file, so one huge database is read by many
        tasks. A file whose catalogue can't be read is left out with a warning; a file that has the table
        but could not be surveyed in full is an error. :meth:`whole_runs` leaves out both.
        """
        failed = self._plan.where(F.col("status") == "ERROR")
        lost = failed.where(F.col("table") == table).orderBy("path").first()
        if lost is not None:
            raise ValueError(f"table {table!r} of {lost['path']} can't be read in full: {lost['message']}")
        if unread := failed.where(F.col("table").isNull()).count():
            warnings.warn(f"{unread} databases could not be opened and are left out; the manifest lists them", stacklevel=2)
        schema = self.schema(table)
        if not schema.fields:
            raise ValueError(f"no table {table!r} with rows")
        arrow = to_arrow_schema(schema)
        outer = StructType().add("set_num", IntegerType()).add("run_num", IntegerType())
        for f in schema.fields:
            outer.add(f)
        text = [pa.types.is_string(f.type) for f in arrow]

        def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for item in batch.to_pylist():
                    have = {entry.split("\t")[0] for entry in item["columns"].split("\n")}
                    cols = ", ".join(_quoted(c) if c in have else "NULL" for c in arrow.names)
                    con = _connect(item["path"])
                    try:
                        where, args = _stretch(con, table, item)
                        cursor = con.execute(f"SELECT {cols} FROM {_quoted(table)}{where}", args)
                        while rows := cursor.fetchmany(20_000):
                            n = len(rows)
                            got = [pa.array([item["set_num"]] * n, pa.int32()), pa.array([item["run_num"]] * n, pa.int32())]
                            for values, f, is_text in zip(zip(*rows), arrow, text):
                                if is_text:
                                    values = [v if v is None or isinstance(v, str) else str(v) for v in values]
                                got.append(pa.array(values, f.type))
                            yield pa.RecordBatch.from_arrays(got, names=["set_num", "run_num", *arrow.names])
                    finally:
                        con.close()

        work = self._plan.where((F.col("table") == table) & (F.col("n_rows") > 0))
        work = work.select("path", "set_num", "run_num", "first", "last", "columns")
        return work.repartition(_tasks(self._spark, work.count()), "path", "first").mapInArrow(load, outer)
