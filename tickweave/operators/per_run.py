"""User functions on the rows of a run."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F, types as T
from pyspark.sql.types import StructType

from tickweave.operators.joining import attach
from tickweave.operators.numbering import with_position
from tickweave.session import settle

PandasFn = Callable[[pd.DataFrame], pd.DataFrame]

RUN = ["set_num", "run_num"]
PIECE = [*RUN, "_piece", "_part"]
ROWS_PER_PIECE = 1_000_000
FAN_IN = 64


def _cut_by_count(rows: DataFrame, sizes: DataFrame, order: list[str], rows_per_piece: int) -> DataFrame:
    """Adds ``_sub``: pieces with more rows than allowed are cut by ranges of their order, each as long as allowed."""
    big = sizes.where(F.col("n") > rows_per_piece).select(F.struct(*PIECE).alias("_key"), F.lit(True).alias("_big"))
    if big.isEmpty():
        return rows.withColumn("_sub", F.lit(0).cast("bigint"))
    told = attach(rows.withColumn("_key", F.struct(*PIECE)), big, ["_key"], "left", name="big-pieces").drop("_key")
    few = told.where(F.col("_big").isNull()).drop("_big").withColumn("_sub", F.lit(0).cast("bigint"))
    many = with_position(told.where("_big").drop("_big"), PIECE, order, name="_at")
    return few.unionByName(many.withColumn("_sub", F.expr(f"(_at - 1) div {rows_per_piece}")).drop("_at"))


def per_run(
    ens: DataFrame, fn: PandasFn, schema: StructType | str, combine: PandasFn | None = None,
    ticks_per_piece: int = 1_000, agents_per_piece: int | None = None, rows_per_piece: int = ROWS_PER_PIECE, fan_in: int = FAN_IN,
) -> DataFrame:
    """Call ``fn`` on pieces of each run and, if given, ``combine`` on what the pieces of a run returned.

    A piece holds ``ticks_per_piece`` consecutive ticks sorted by tick and agent (and, if set, a range of
    ``agents_per_piece`` agent IDs). Pieces are counted first; one with more than ``rows_per_piece`` rows is cut by ranges of
    tick and agent into pieces of that many, so no call gets more, be it one tick of very many agents. ``fn`` must return
    ``set_num`` and ``run_num`` in ``schema``. ``combine`` gets partial results of one run and returns the same schema;
    without it the rows of all pieces are returned.

    A call of ``combine`` gets the results of ``fan_in`` neighbouring pieces at most. For runs of more pieces it is applied as
    a tree, to results of its own too, in the order of the pieces; there it must be associative.
    """
    if fan_in < 2 or rows_per_piece < 1:
        raise ValueError("a piece has at least one row and a combination at least two parts")
    out = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    order = [c for c in ("time_step", "ID") if c in ens.columns]
    cut = F.floor(F.col("time_step") / F.lit(ticks_per_piece)).alias("_piece")
    part = F.lit(0).cast("bigint") if agents_per_piece is None else F.floor(F.col("ID") / F.lit(agents_per_piece))
    rows = ens.select("*", cut, part.alias("_part"))
    sizes = settle(rows.groupBy(*PIECE).agg(F.count(F.lit(1)).alias("n")), "piece-sizes")
    rows = _cut_by_count(rows, sizes, order, rows_per_piece)
    own = [c for c in rows.columns if c not in ("_piece", "_part", "_sub")]

    def piece(pdf: pd.DataFrame) -> pd.DataFrame:
        return fn(pdf.sort_values(order, kind="stable")[own])

    if combine is None:
        return rows.groupBy(*PIECE, "_sub").applyInPandas(piece, out)
    pieces = sizes.select(*PIECE, F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(n - 1) div {rows_per_piece}"))).alias("_sub"))
    along = Window.partitionBy(*RUN).orderBy("_piece", "_part", "_sub")
    pieces = pieces.withColumn("_node", (F.row_number().over(along) - 1).cast("bigint"))  # one small row per piece
    most = pieces.agg(F.max("_node")).first()[0]
    if most is None or most < fan_in:
        return rows.groupBy(*PIECE, "_sub").applyInPandas(piece, out).groupBy(*RUN).applyInPandas(combine, out)

    noted = T.StructType([*out.fields, *[T.StructField(c, T.LongType()) for c in ("_piece", "_part", "_sub")]])
    tree = T.StructType([*out.fields, T.StructField("_node", T.LongType())])
    result = [f.name for f in out.fields]

    def noting(pdf: pd.DataFrame) -> pd.DataFrame:
        where = {c: None if pd.isna(v := pdf[c].iloc[0]) else int(v) for c in ("_piece", "_part", "_sub")}
        return piece(pdf).assign(**where)[[*result, *where]]

    def joint(pdf: pd.DataFrame) -> pd.DataFrame:
        above = int(pdf["_node"].iloc[0]) // fan_in
        return combine(pdf.sort_values("_node", kind="stable")[result]).assign(_node=above)[[*result, "_node"]]

    key = F.struct(*PIECE, "_sub").alias("_key")
    parts = settle(rows.groupBy(*PIECE, "_sub").applyInPandas(noting, noted), "run-parts")
    parts = attach(parts.select("*", key), pieces.select(key, "_node"), ["_key"], name="pieces").select(*result, "_node")
    while most > 0:
        parts = settle(parts.groupBy(*RUN, F.expr(f"_node div {fan_in}").alias("_above")).applyInPandas(joint, tree), "run-parts")
        most //= fan_in
    return parts.drop("_node")
