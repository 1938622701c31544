"""Row positions inside a run without pulling the run into one task.

A plain ``row_number() over (partition by run)`` sorts a whole run in one task. Here rows are dealt by ranges of the full
sort order into partitions of about equal size, and ``row_number`` only runs inside a piece, the part of a run that lies in one
range. Only the first run of a range can have begun in an earlier one, so ranges must tell each other one number each.

Only the sort columns and the address of each row (its file and place in it) are dealt, written and numbered; the positions
return to the rows by address. So what is sorted and written does not depend on the other columns, however many there are.
A table that is no plain selection from files gets addresses by being written once. As an address is a fact of the file and
not of a task, a task that runs again after a lost executor deals every row as before, copies of a row included.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tickweave.session import settle

HASHED_ROWS = 250_000  # positions that a task may hold as a hash table, some 200 bytes each
ADDRESS = ["_in_file", "_in_row"]


def addressable(df: DataFrame) -> bool:
    """Whether ``df`` only selects from files, so that each of its rows is one row of one file."""
    node = df._jdf.queryExecution().analyzed()
    while node.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        node = node.child()
    return node.nodeName() == "LogicalRelation" and node.relation().getClass().getSimpleName() == "HadoopFsRelation"


def with_address(df: DataFrame) -> DataFrame:
    """``df``, or a written copy of it, with the file and place of each row."""
    if set(ADDRESS) <= set(df.columns):
        return df
    rows = df if addressable(df) else settle(df, "addressed")
    return rows.select("*", F.col("_metadata.file_path").alias("_in_file"), F.col("_metadata.row_index").alias("_in_row"))


def ranged(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Columns ``by`` and address of ``df``, dealt by ranges of both, with ``_part``, a number that grows with the range; written once."""
    narrow = with_address(df).select(*dict.fromkeys([*by, *ADDRESS]))
    return settle(narrow.repartitionByRange(*by, *ADDRESS).withColumn("_part", F.spark_partition_id()), "ranges")


def with_position(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], tie: Sequence[str] = (), name: str = "position"
) -> DataFrame:
    """Adds 1..n per ``keys`` in the order of ``order`` then ``tie``; null keys make a run of their own.

    Rows that are equal in all of these stand in the order of their files.
    """
    rows = with_address(df)
    dealt = ranged(rows, [*keys, *order, *tie])
    run = F.struct(F.lit(0), *keys)  # one struct as join key: unlike separate columns it also matches where a part is null
    sizes = dealt.groupBy(run.alias("_run"), F.col("_part").alias("_of")).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy("_run").orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("_start", F.sum("_size").over(before)).where("_start > 0").select("_run", "_of", "_start")
    starts = F.broadcast(starts)  # at most one row per range
    within = Window.partitionBy("_part", *keys).orderBy(*order, *tie, *ADDRESS)
    placed = dealt.withColumn("_at", F.row_number().over(within)).withColumn("_key", run)
    placed = placed.join(starts, (F.col("_part") == F.col("_of")) & (F.col("_key") == F.col("_run")), "left")
    placed = placed.select(*ADDRESS, (F.coalesce("_start", F.lit(0)) + F.col("_at")).alias(name))
    # addresses spread evenly, so a task's share of the positions is known; where it is small no side needs sorting
    if dealt.count() <= HASHED_ROWS * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        placed = placed.hint("shuffle_hash")
    return rows.join(placed, ADDRESS).select(*[F.col(f"`{c}`") for c in df.columns], name)


def with_label_position(df: DataFrame, keys: Sequence[str], label: str, name: str = "position") -> DataFrame:
    """Distinct (keys, label) with the 0-based place of the label in its group, spread the same way.

    Rows without a label or key have no place.
    """
    labels = df.select(*keys, label).dropna().distinct()
    return with_position(labels, keys, [label], name=name).withColumn(name, F.col(name) - 1)
