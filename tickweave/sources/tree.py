"""Ensemble trees ``root/set_<n>/run_<m>/<file>.parquet``."""

from __future__ import annotations

import re
import warnings
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from tickweave.functions.names import TICK_NAMES, in_bounds, parse_range, piece_of_file, token_regex, whole_name
from tickweave.operators.joining import attach
from tickweave.operators.shaping import canonicalize, coordinate_columns, downcast, reject_counts, resolve_roles, union_runs
from tickweave.sources.footers import footers
from tickweave.session import settle
from tickweave.sources.listing import RUN_FILE, children, list_files, part_of_path, run_of_path, set_folders, set_of_path, tree_roots

EMPTY = "set_num int, run_num int, time_step int, ID bigint"


def _path() -> Column:
    return F.col("_metadata.file_path")


def tree_files(spark: SparkSession, root: str, glob: str, sets=None, runs=None) -> DataFrame:
    """Files of a tree with ``set_num`` and ``run_num``. Only set folders in range are listed."""
    files = list_files(spark, tree_roots(spark, root, sets), glob, check=False).where(F.col("path").rlike(RUN_FILE))
    files = files.select("*", set_of_path(F.col("path")).alias("set_num"), run_of_path(F.col("path")).alias("run_num"))
    return files.where(in_bounds("run_num", parse_range(runs)))


INT_ORDER = ("tinyint", "smallint", "int", "bigint")


def _common_type(a: str, b: str) -> str | None:
    """Type in which Spark's Parquet reader can read files of both types, None if there is none."""
    if a == b:
        return a
    if a in INT_ORDER and b in INT_ORDER:
        return max(a, b, key=INT_ORDER.index)
    if {a, b} <= {"tinyint", "smallint", "int", "float", "double"}:
        return "double"
    return None


@dataclass
class FileGroup:
    """Files one scan can read: same roles, compatible types."""

    roles: tuple[str | None, str | None]
    columns: dict[str, str]

    def try_add(self, columns: dict[str, str]) -> bool:
        merged = dict(self.columns)
        for name, kind in columns.items():
            kind = _common_type(merged.get(name, kind), kind)
            if kind is None:
                return False
            merged[name] = kind
        self.columns = merged
        return True

    @property
    def schema(self) -> str:
        return ", ".join(f"`{n}` {t}" for n, t in self.columns.items())


@dataclass
class TreeScan:
    """How to read the files of a tree.

    ``ledger`` has a row per file: ``path, set_num, run_num, piece, n_rows``, the group that reads it or the ``reason`` why
    none does, and ``start``, the rows that earlier pieces of its run have; unless ``whole``, ``uri`` as well.
    """

    groups: list[FileGroup]
    ledger: DataFrame
    whole: bool  # one group has all files
    split: bool  # some file is a piece of its run

    def stretches(self) -> list:
        """Where along the tree each group has its files: one row per change of layout, not per file.

        Files of a set folder are ordered by their address as a scan shows it; neighbours of one group make a stretch. Only
        its ends come to the driver, in this order, with ``only``: whether the whole folder is one stretch.
        """
        above = F.regexp_replace("uri", r"/[^/]*/[^/]*$", "")
        files = self.ledger.select(part_of_path(F.col("path"), 3).alias("folder"), above.alias("above"), "grp", "uri")
        along = Window.partitionBy("above").orderBy("uri")
        files = files.withColumn("new", F.when(F.col("grp").eqNullSafe(F.lag("grp").over(along)) & (F.row_number().over(along) > 1), 0).otherwise(1))
        files = files.withColumn("stretch", F.sum("new").over(along))
        ends = files.groupBy("folder", "above", "stretch", "grp").agg(F.min("uri").alias("first"), F.max("uri").alias("last"))
        ends = ends.withColumn("only", F.count(F.lit(1)).over(Window.partitionBy("folder")) == 1)
        return list(ends.where("grp IS NOT NULL").orderBy("first").toLocalIterator())


def _within(value: Column, ranges: list[tuple[str, str]]) -> Column:
    """Whether ``value`` lies in one of these ranges, which are in order and apart.

    Spark keeps a filter on the file path for the rows of the files it has chosen by it. So this is a search by halves: a row
    costs a few comparisons of whole texts, however many ranges there are.
    """
    if len(ranges) == 1:
        return value.between(*ranges[0])
    half = len(ranges) // 2
    return F.when(value < ranges[half][0], _within(value, ranges[:half])).otherwise(_within(value, ranges[half:]))


def plan_scan(files: DataFrame, wanted: list[str] | None = None, skip_unreadable: bool = False, need_tick: bool = True) -> TreeScan:
    """Group files by what their footers hold. Only the distinct signatures come to the driver.

    ``wanted`` narrows the comparison to these metrics (and the tick); files lacking one are left out, as are files without
    rows and, where all columns are wanted and ``need_tick``, files without a tick. ``skip_unreadable`` leaves out files that are no Parquet.
    """
    cols = footers(files, skip_unreadable=skip_unreadable)
    line = F.concat_ws("\t", F.col("variable"), F.col("spark_type"))
    if wanted is not None:
        line = F.when(F.col("variable").isin(*wanted, *TICK_NAMES), line)
    lines = F.collect_list(F.when(line.isNotNull(), F.struct(F.col("position"), line.alias("line"))))
    per_file = cols.groupBy("path").agg(
        F.max("n_rows").alias("n_rows"), F.concat_ws("\n", F.transform(F.array_sort(lines), lambda s: s["line"])).alias("signature")
    )
    per_file = settle(per_file, "footers")
    groups: list[FileGroup] = []
    members: list[tuple[str, int | None, str | None]] = []
    piece = piece_of_file(part_of_path(F.col("path"), 1))
    full = F.col("n_rows") > 0
    seen = per_file.groupBy("signature").agg(F.count_if(full).alias("k"), F.count_if(full.isNull() | ~full).alias("bad"), F.count(piece).alias("pieces"))
    left_out = split = False
    for row in seen.orderBy(F.desc("k"), "signature").toLocalIterator():
        left_out, split = left_out or row["bad"] > 0, split or row["pieces"] > 0
        if not row["k"]:
            continue
        kinds = dict(entry.split("\t") for entry in row["signature"].split("\n") if entry)
        roles = resolve_roles(list(kinds))
        lacking = [m for m in wanted or () if m not in kinds]
        if lacking or (wanted is None and need_tick and roles.tick is None):
            members.append((row["signature"], None, "no column " + ", ".join(lacking) if lacking else "no tick column"))
            left_out = True
            continue
        who = (roles.tick, roles.agent if wanted is None else None)
        k = next((k for k, g in enumerate(groups) if g.roles == who and g.try_add(kinds)), None)
        if k is None:
            groups.append(FileGroup(who, kinds))
            k = len(groups) - 1
        members.append((row["signature"], k, None))
    path = F.col("path")
    known = files.sparkSession.createDataFrame(members, "signature string, grp int, reason string")
    reason = F.when(F.col("n_rows").isNull(), "not readable").when(F.col("n_rows") == 0, "no rows").otherwise(F.col("reason"))
    ledger = (
        per_file.join(known, "signature", "left").withColumn("reason", reason).withColumn("grp", F.when(F.col("reason").isNull(), F.col("grp")))
        .select("path", set_of_path(path).alias("set_num"), run_of_path(path).alias("run_num"), piece_of_file(part_of_path(path, 1)).alias("piece"), "n_rows", "grp", "reason")
    )
    folders = [part_of_path(path, 3), part_of_path(path, 2), whole_name(part_of_path(path, 1))]
    earlier = Window.partitionBy(*folders).orderBy("piece", "path").rowsBetween(Window.unboundedPreceding, -1)
    read = F.when(F.col("reason").isNull(), F.col("n_rows"))
    ledger = ledger.withColumn("start", F.coalesce(F.sum(read).over(earlier), F.lit(0)))
    whole = len(groups) == 1 and not left_out
    if not whole:
        ledger = ledger.join(files.select("path", "uri"), "path")
    return TreeScan(groups, ledger if whole and not split else settle(ledger, "ledger"), whole, split)


def left_out(scan: TreeScan) -> DataFrame:
    """Files that no scan reads: ``path, set_num, run_num, piece, n_rows, reason``."""
    return scan.ledger.where("reason IS NOT NULL").select("path", "set_num", "run_num", "piece", "n_rows", "reason")


def _empty(spark: SparkSession, what: str) -> DataFrame:
    warnings.warn(f"no files match {what}", stacklevel=3)
    return spark.createDataFrame([], EMPTY)


def _scan(spark: SparkSession, paths: list[str], schema: str | None) -> DataFrame:
    """Rows with coordinates from the path and ``_row``, the place in the file, from the Parquet reader."""
    df = (spark.read.schema(schema) if schema else spark.read).parquet(*paths)
    return df.select(
        set_of_path(_path()).alias("set_num"),
        run_of_path(_path()).alias("run_num"),
        *[F.col(f"`{c}`") for c in df.columns if c not in ("set_num", "run_num")],
        F.col("_metadata.row_index").alias("_row"),
        _path().alias("_file"),
    )


def _stem(path: Column) -> Column:
    """File name without ``.parquet``, in which every glob here ends."""
    name = part_of_path(path, 1)
    return F.left(name, F.length(name) - F.lit(len(".parquet")))


@dataclass
class Source:
    """Which files of a tree: a glob for the file name, ranges, and a pattern that the name without ``.parquet`` must match.

    ``flat`` files lie in ``root`` itself and have neither set nor run.
    """

    spark: SparkSession
    root: str
    glob: str
    sets: str | tuple | None
    runs: str | tuple | None
    stem: str | None
    flat: bool = False

    def files(self) -> DataFrame:
        if self.flat:
            found = list_files(self.spark, f"{self.root.rstrip('/')}/{self.glob}", "*")
        else:
            found = tree_files(self.spark, self.root, self.glob, self.sets, self.runs)
        if self.stem is None:
            return found
        return found.where(_stem(F.col("path")).rlike(self.stem))

    def scan(self, schema: str | None, folders: list[str] | None = None) -> DataFrame:
        """One scan over globs. Filters on the file path drop files while the scan is planned."""
        base = self.root.rstrip("/")
        if self.flat:
            globs = [f"{base}/{self.glob}"]
        elif folders is None and parse_range(self.sets) is None:
            globs = [f"{base}/set_*/run_*/{self.glob}"]
        else:
            chosen = set_folders(self.spark, self.root, self.sets) if folders is None else [f"{base}/{f}" for f in folders]
            globs = [f"{d}/run_*/{self.glob}" for d in chosen]
        rows = _scan(self.spark, globs, schema)
        if parse_range(self.runs) is not None:
            rows = rows.where(in_bounds(run_of_path(F.col("_file")), parse_range(self.runs)))
        return rows if self.stem is None else rows.where(_stem(F.col("_file")).rlike(self.stem))

    def parts(self, plan: TreeScan) -> list[tuple[FileGroup, DataFrame]]:
        """The rows of each group, with ``_row`` counted from the start of the run.

        Set folders that belong to one group are read by glob. Elsewhere the ends of the group's stretches make a filter on
        the file path, which drops all other files while the scan is planned, before any is opened.
        """
        if plan.whole:
            found = [(plan.groups[0], self.scan(plan.groups[0].schema))]
        else:
            found, ends = [], plan.stretches()
            for k, g in enumerate(plan.groups):
                own = [e for e in ends if e["grp"] == k]
                plain = [e["folder"] for e in own if e["only"]]
                if plain:
                    found.append((g, self.scan(g.schema, plain)))
                mixed = [e for e in own if not e["only"]]
                if mixed:
                    inside = _within(F.col("_file"), [(e["first"], e["last"]) for e in mixed])
                    found.append((g, self.scan(g.schema, sorted({e["folder"] for e in mixed})).where(inside)))
        return [(g, self.placed(rows, plan.ledger) if plan.split else rows) for g, rows in found]

    def placed(self, rows: DataFrame, ledger: DataFrame) -> DataFrame:
        """``_row`` counted from the start of the run: later pieces begin where the earlier ones end."""
        starts = ledger.where("reason IS NULL AND start > 0").select(F.col("path").alias("_file"), F.col("start").alias("_start"))
        met = attach(rows, starts, ["_file"], "left", name="piece-starts")
        return met.withColumn("_row", F.col("_row") + F.coalesce("_start", F.lit(0))).drop("_start")


@dataclass
class Reading:
    """A tree read as one table, and what was left out of it."""

    rows: DataFrame
    ledger: DataFrame
    rejects: DataFrame


REJECTS = "set_num int, run_num int, rows bigint"
LEFT_OUT = "path string, set_num int, run_num int, piece bigint, n_rows bigint, reason string"


def read_tree(
    spark: SparkSession, root: str, agent: str, sets=None, runs=None, suffix: bool = False, mode: str = "widen",
    schema: str | T.StructType | None = None, skip_unreadable: bool = False,
) -> DataFrame:
    """All runs of one agent type as one canonical table.

    The agent name must be a whole word of the file name; ``suffix=True`` takes every name that ends in
    it. Footers decide how the files are read: usually one scan in the merged schema; files with other
    role names or clashing types get scans of their own, united by name after the casts. Files without a
    tick column or without rows are skipped (:func:`read_ledgered` lists them). Surrogate IDs run on through the pieces of a
    split run. ``schema`` promises a schema and saves comparing the footers.
    No match gives a warning and an empty table. ``mode`` is that of :func:`downcast`.
    """
    return read_ledgered(spark, root, agent, sets, runs, suffix, mode, schema, skip_unreadable).rows


def read_ledgered(
    spark: SparkSession, root: str, agent: str, sets=None, runs=None, suffix: bool = False, mode: str = "widen",
    schema: str | T.StructType | None = None, skip_unreadable: bool = False,
) -> Reading:
    """:func:`read_tree` with the files it leaves out and why, and per set and run the values that became null.

    Rows are counted from the footers, and values only where some can be lost: files are not read again for columns that
    every value fits.
    """
    source = Source(spark, root, f"*{agent}.parquet", sets, runs, None if suffix else token_regex(agent))
    files = source.files()
    if schema is not None and not files.isEmpty():
        text = schema if isinstance(schema, str) else ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        scanned = source.scan(text)
        pieces = files.where(piece_of_file(part_of_path(F.col("path"), 1)).isNotNull())
        parts = [scanned if pieces.isEmpty() else source.placed(scanned, plan_scan(files).ledger)]
        ledger, counted = spark.createDataFrame([], LEFT_OUT), None
    else:
        plan = plan_scan(files, skip_unreadable=skip_unreadable)
        parts = [rows for _, rows in source.parts(plan)]
        ledger = left_out(plan)
        counted = plan.ledger.where("reason IS NULL").groupBy("set_num", "run_num").agg(F.sum("n_rows").alias("rows"))
    if not parts:
        return Reading(_empty(spark, f"*{agent}.parquet in {root}"), ledger, spark.createDataFrame([], REJECTS))
    parts = [canonicalize(rows.drop("_file"), F.col("_row")).drop("_row") for rows in parts]
    return Reading(union_runs(*[downcast(rows, mode) for rows in parts]), ledger, _rejects(parts, mode, counted))


def _rejects(parts: list[DataFrame], mode: str, counted: DataFrame | None) -> DataFrame:
    """Per set and run: rows, and how many values of each column become null in this mode."""
    if counted is not None and mode == "widen" and all(isinstance(rows.schema["ID"].dataType, T.IntegralType) for rows in parts):
        whole = {f.name for rows in parts for f in rows.schema.fields if f.name not in ("set_num", "run_num") and (isinstance(f.dataType, T.IntegralType) or f.name == "ID")}
        names = [c for c in dict.fromkeys(c for rows in parts for c in rows.columns) if c in whole]
        return counted.select("set_num", "run_num", "rows", *[F.lit(0).cast("bigint").alias(c) for c in names])
    lost = union_runs(*[reject_counts(rows, mode=mode) for rows in parts])
    counts = [c for c in lost.columns if c not in ("set_num", "run_num")]
    return lost.groupBy("set_num", "run_num").agg(*[F.coalesce(F.sum(F.col(f"`{c}`")), F.lit(0)).alias(c) for c in counts])


def tree_rejects(spark: SparkSession, root: str, agent: str, sets=None, runs=None, suffix: bool = False, mode: str = "widen") -> DataFrame:
    """Per set and run: rows, and how many values of each column :func:`read_tree` turns into null in this mode."""
    return read_ledgered(spark, root, agent, sets, runs, suffix, mode).rejects


def _metric_source(spark: SparkSession, root: str, table: str, sets, runs) -> Source:
    return Source(spark, root, f"*data_{table}.parquet", sets, runs, rf"^(-?[0-9]+_)?data_{re.escape(table)}$")


def read_metric(
    spark: SparkSession, root: str, table: str, metric: str | list[str], sets=None, runs=None, stride: int = 1
) -> DataFrame:
    """Metrics of ``data_<table>.parquet`` as ``set_num, run_num, time_step, tick, <metrics>``.

    ``time_step`` counts 1..n after keeping every ``stride``-th row of a run, ``tick`` is the tick the
    file holds (null if none). The place in the file comes from the Parquet reader, the place of a piece in a split run
    from the footers: one map-only pass over the wanted columns, with no sort and no shuffle.
    """
    return read_metric_ledgered(spark, root, table, metric, sets, runs, stride)[0]


def read_metric_ledgered(
    spark: SparkSession, root: str, table: str, metric: str | list[str], sets=None, runs=None, stride: int = 1, skip_unreadable: bool = False
) -> tuple[DataFrame, DataFrame]:
    """:func:`read_metric` with the files it leaves out and why."""
    if stride < 1:
        raise ValueError("stride must be at least 1")
    metrics = [metric] if isinstance(metric, str) else list(metric)
    source = _metric_source(spark, root, table, sets, runs)
    plan = plan_scan(source.files(), metrics, skip_unreadable)
    if not plan.groups:
        _empty(spark, f"{source.glob} with {metrics} in {root}")
        cols = "set_num int, run_num int, time_step int, tick bigint, " + ", ".join(f"`{m}` float" for m in metrics)
        return spark.createDataFrame([], cols), left_out(plan)
    parts = []
    for g, rows in source.parts(plan):
        tick = g.roles[0]
        parts.append(
            rows.where(F.col("_row") % F.lit(stride) == 0).select(
                "set_num",
                "run_num",
                (F.floor(F.col("_row") / F.lit(stride)) + 1).cast("int").alias("time_step"),
                (F.col(tick).cast("bigint") if tick else F.lit(None).cast("bigint")).alias("tick"),
                *[F.col(f"`{m}`").cast("float").alias(m) for m in metrics],
            )
        )
    return union_runs(*parts), left_out(plan)


def resolve_agent(spark: SparkSession, folder: str, agent: str) -> DataFrame:
    """The one checkpoint in ``folder`` whose name holds the agent as a whole word, Parquet or Feather."""
    from tickweave.sources.feather import read_feather

    names = children(spark, folder, folders=False) + children(spark, folder, folders=True)
    hits = []
    for name in sorted(set(names)):
        stem, _, ext = name.rpartition(".")
        if name.startswith(("rejects_", "skipped_")):  # the reports beside a checkpoint are none themselves
            continue
        if ext.lower() in ("parquet", "feather") and re.search(token_regex(agent), stem):
            hits.append((name, ext.lower()))
    if len(hits) != 1:
        raise ValueError(f"{len(hits)} checkpoints match agent {agent!r} in {folder}: {[h[0] for h in hits]}")
    name, ext = hits[0]
    path = f"{folder.rstrip('/')}/{name}"
    df = spark.read.parquet(path) if ext == "parquet" else read_feather(spark, path)
    first = coordinate_columns(df)
    return df.select(*first, *[F.col(f"`{c}`") for c in df.columns if c not in first])


def _tick_of_name(path: Column) -> Column:
    """Tick of ``<agent>_<tick>.parquet``, without a regular expression, as this runs for every row of a scan."""
    return F.substring_index(F.substring_index(path, "_", -1), ".", 1).try_cast("bigint")


def read_snapshot_tree(
    spark: SparkSession, root: str, agent: str, sets=None, runs=None, mode: str = "widen", flat: bool = False, skip_unreadable: bool = False
) -> Reading:
    """Per-tick files ``<agent>_<tick>.parquet`` of a tree as one canonical table, with the files left out and why.

    Files lie in ``set_<n>/run_<m>`` folders, or, ``flat``, in ``root`` itself; then set and run are null. As in
    :func:`read_tree`, footers decide how files of differing columns and types are read. The tick is that of the file's tick
    column, and the job fails where it is not the one in the file's name; a file without such a column has the tick of its name.
    Without IDs, agents are numbered by their place in the file.
    """
    source = Source(spark, root, f"{agent}_[0-9]*.parquet", sets, runs, rf"^{re.escape(agent)}_[0-9]+$", flat)
    plan = plan_scan(source.files(), skip_unreadable=skip_unreadable, need_tick=False)
    parts = []
    for g, rows in source.parts(plan):
        named = _tick_of_name(F.col("_file"))
        if g.roles[0] is None:
            rows = rows.withColumn("time_step", named)
        else:
            held = F.col(f"`{g.roles[0]}`")
            wrong = F.raise_error(F.concat(F.col("_file"), F.lit(" holds tick "), F.coalesce(held.cast("string"), F.lit("null"))))
            rows = rows.withColumn(g.roles[0], F.when(held.eqNullSafe(named), held).otherwise(wrong.cast(rows.schema[g.roles[0]].dataType)))
        rows = canonicalize(rows.drop("_file"), F.col("_row")).drop("_row")
        parts.append(rows.withColumns({c: F.lit(None).cast("int") for c in ("set_num", "run_num")}) if flat else rows)
    left = left_out(plan)
    if flat:
        left = left.withColumns({c: F.lit(None).cast("int") for c in ("set_num", "run_num")})
    if not parts:
        return Reading(_empty(spark, f"{source.glob} in {root}"), left, spark.createDataFrame([], REJECTS))
    return Reading(union_runs(*[downcast(rows, mode) for rows in parts]), left, _rejects(parts, mode, None))


def read_snapshots(spark: SparkSession, folder: str, agent: str, schema: T.StructType | None = None) -> DataFrame:
    """Per-tick files ``<agent>_<tick>.parquet`` as one table; the tick is a column of the files.

    Columns of any file appear; they are null where a file lacks them.
    """
    reader = spark.read.option("mergeSchema", "true") if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{folder.rstrip('/')}/{agent}_[0-9]*.parquet")
