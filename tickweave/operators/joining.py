"""Joins of a large table with a per-group or per-set table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tickweave.operators.numbering import addressable
from tickweave.session import BROADCAST_BYTES, BROADCAST_ROWS, settle

SALTS = 32


def hashable(df: DataFrame) -> list[str]:
    """Columns whose type Spark can hash (all but those that hold maps or variants)."""
    return [f"`{f.name}`" for f in df.schema if not any(t in f.dataType.simpleString() for t in ("map<", "variant"))]


def fixed_width(df: DataFrame) -> bool:
    return all(isinstance(f.dataType, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)) for f in df.schema)


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row as it lies in memory: fixed widths as they are, text and binaries by their length, nested values as JSON."""
    parts = [F.lit(8 * len(df.columns))]
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            parts.append(F.coalesce(F.octet_length(c), F.lit(0)))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            parts.append(F.coalesce(F.octet_length(F.to_json(F.struct(c.alias("v")))), F.lit(0)))
    return reduce(lambda a, b: a + b, [x.cast("bigint") for x in parts])


def salted_join(big: DataFrame, small: DataFrame, on: Sequence[str], how: str = "inner", salts: int = SALTS) -> DataFrame:
    """Equi-join that spreads every key of ``big`` over ``salts`` tasks, so one hot key is no straggler.

    The salt is a hash of the row, not a random number: a task that runs again after a lost executor
    sends each row to the same place as before.
    """
    left = big.withColumn("_salt", F.pmod(F.xxhash64(*hashable(big)), F.lit(salts)))
    right = small.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))))
    return left.join(right.hint("merge"), [*on, "_salt"], how).drop("_salt")  # small files can hold much: no broadcast by their size


def attach(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    at_most: int | None = None,
    name: str = "bounds",
    weight: str | None = None,
) -> DataFrame:
    """Join ``small`` (one row per key) to ``big``: broadcast if it is provably small, salted otherwise.

    ``at_most`` is a bound the caller can prove, for example number of sets times number of ticks asked
    for. Without one, or where columns of any width (text, lists) make a bound on rows say nothing about bytes, ``small`` is
    written to the shared folder once, unless it only reads files, and its rows and bytes are counted there.

    Equal rows cannot be told apart by a salt. A caller that only counts names a ``weight`` column: it
    tells how many equal rows of ``big`` a row stands for, 1 under a broadcast; before a salted join equal
    rows are folded into one on the map side.
    """
    if at_most is None or not fixed_width(small):
        small = small if addressable(small) else settle(small, name)
        rows, size = small.agg(F.count(F.lit(1)), F.coalesce(F.sum(row_bytes(small)), F.lit(0))).first()
    else:
        rows, size = at_most, at_most * small._jdf.schema().defaultSize()
    if rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES:
        left = big if weight is None else big.withColumn(weight, F.lit(1))
        return left.join(F.broadcast(small), list(on), how)
    left = big if weight is None else big.groupBy(*big.columns).agg(F.count(F.lit(1)).alias(weight))
    return salted_join(left, small, on, how)
