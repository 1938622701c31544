"""Bringing any run table to the canonical columns ``set_num, run_num, time_step, ID, <metrics>``."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tickweave.functions.names import COORDINATES, ID_NAMES, TICK_NAMES
from tickweave.functions.numeric import NUMBER_TEXT, WHOLE_NUMBER_TEXT, number_from_text, stripped

MODES = ("checked", "strict", "widen")


@dataclass(frozen=True)
class Roles:
    tick: str | None
    agent: str | None
    metrics: tuple[str, ...]


def resolve_roles(columns: DataFrame | Sequence[str]) -> Roles:
    """Which column is the tick, which the agent ID, and which are metrics. Names only."""
    names = list(columns.columns if isinstance(columns, DataFrame) else columns)
    tick = next((c for c in TICK_NAMES if c in names), None)
    agent = next((c for c in ID_NAMES if c in names), None)
    taken = {tick, agent, "set_num", "run_num", "time_step", "ID", "id"}
    return Roles(tick, agent, tuple(c for c in names if c not in taken and not c.startswith("_metadata")))


def _is_float(t: T.DataType) -> bool:
    return isinstance(t, (T.FloatType, T.DoubleType))


def _narrow(c: Column, t: T.DataType, to: str, mode: str) -> Column:
    """Cast an integer column down: null, error or no change when the value does not fit."""
    if mode == "widen":
        return c
    fitted = c.try_cast(to)
    if mode == "checked":
        return fitted
    failed = c.isNotNull() & fitted.isNull()
    return F.when(failed, F.raise_error(F.concat(F.lit(f"value does not fit {to}: "), c.cast("string"))).cast(to)).otherwise(
        fitted
    )


def _whole_id(c: Column, t: T.DataType, mode: str) -> Column:
    """A non-integer ID becomes a bigint; one with a fraction is rejected, not truncated."""
    number = c.cast("double") if _is_float(t) else c.try_cast("double")
    whole = F.when(number == F.floor(number), number.try_cast("bigint"))
    if mode != "strict":
        return whole
    failed = c.isNotNull() & whole.isNull()
    return F.when(failed, F.raise_error(F.concat(F.lit("ID is not a whole number: "), c.cast("string"))).cast("bigint")).otherwise(whole)


def _fit(name: str, t: T.DataType, mode: str) -> Column:
    c = F.col(f"`{name}`")
    if name == "ID" and not isinstance(t, T.IntegralType):
        return _whole_id(c, t, mode)
    if _is_float(t):
        return c.cast("float")
    if isinstance(t, T.IntegralType):
        return _narrow(c, t, "smallint", mode)
    return c


def downcast(df: DataFrame, mode: str = "widen") -> DataFrame:
    """Floating point to 32 bit and, on request, integers to 16 bit; everything else untouched.

    ``widen`` keeps the integer width, ``checked`` turns an integer that does not fit 16 bits into null (see
    :func:`reject_counts`), ``strict`` fails the job. Too large floating-point values become infinite. An ID with a
    fraction is null in all modes but ``strict``.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    return df.select(*[_fit(f.name, f.dataType, mode).alias(f.name) for f in df.schema.fields])


def reject_counts(df: DataFrame, by: Sequence[str] = ("set_num", "run_num"), mode: str = "checked") -> DataFrame:
    """Per group: how many values of each column ``downcast`` in this mode would turn into null."""
    lost = []
    for f in df.schema.fields:
        if f.name in by or not (isinstance(f.dataType, T.IntegralType) or f.name == "ID"):
            continue
        bad = F.col(f"`{f.name}`").isNotNull() & _fit(f.name, f.dataType, "checked" if mode == "strict" else mode).isNull()
        lost.append(F.count_if(bad).alias(f.name))
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), *lost)


def canonicalize(df: DataFrame, surrogate: Column | None = None) -> DataFrame:
    """Canonical columns first, metrics after them in their original order.

    ``df`` carries ``set_num`` and ``run_num``. Without an ID column, ``surrogate`` is used, by default
    the row's place in its file (``_metadata.row_index``), which needs no shuffle.
    """
    roles = resolve_roles(df)
    if roles.tick is None:
        raise ValueError(f"no tick column among {df.columns}; expected one of {TICK_NAMES}")
    agent = F.col(roles.agent) if roles.agent else (F.col("_metadata.row_index") if surrogate is None else surrogate)
    return df.select(
        F.col("set_num"),
        F.col("run_num"),
        F.col(roles.tick).alias("time_step"),
        agent.alias("ID"),
        *[F.col(f"`{m}`") for m in roles.metrics],
    )


def with_surrogate_id(df: DataFrame, keys: Sequence[str] = ("set_num", "run_num"), order: Sequence[str] = ("time_step",)) -> DataFrame:
    """ID 0..n-1 per run for tables that no longer know their file positions."""
    from tickweave.operators.numbering import with_position

    numbered = with_position(df, keys, order, name="_pos")
    return numbered.withColumn("ID", F.col("_pos") - 1).drop("_pos")


def metric_view(ens: DataFrame, metric: str) -> DataFrame:
    """Coordinates of run and tick with one metric in single precision."""
    return ens.select("set_num", "run_num", "time_step", F.col(f"`{metric}`").cast("float").alias(metric))


def infer_numeric_strings(df: DataFrame) -> DataFrame:
    """Text columns in which every non-blank value looks like a number become numeric.

    One aggregate over all text columns decides; blanks turn into null and do not stop a promotion,
    nor do nulls. Columns of whole numbers become bigint if all of them fit 64 bits, all others double.
    """
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not texts:
        return df
    checks = []
    for c in texts:
        t = stripped(F.col(f"`{c}`"))
        filled = t != ""
        checks += [
            F.count_if(filled).alias(f"{c}#filled"),
            F.bool_and(F.when(filled, t.rlike(NUMBER_TEXT))).alias(f"{c}#number"),
            F.bool_and(F.when(filled, t.rlike(WHOLE_NUMBER_TEXT) & t.try_cast("bigint").isNotNull())).alias(f"{c}#whole"),
        ]
    seen = df.agg(*checks).first().asDict()
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name in texts and seen[f"{f.name}#filled"] and seen[f"{f.name}#number"]:
            c = number_from_text(c, seen[f"{f.name}#whole"])
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _widest(types: list[T.DataType]) -> T.DataType:
    kinds = {t.typeName() for t in types}
    if len(kinds) == 1:
        return types[0]
    ints = [t for t in types if isinstance(t, T.IntegralType)]
    floats = [t for t in types if _is_float(t)]
    if len(ints) + len(floats) < len(types):
        raise ValueError(f"columns of one name cannot be merged: {sorted(kinds)}")
    if not floats:
        order = ["byte", "short", "integer", "long"]
        return max(ints, key=lambda t: order.index(t.typeName()))
    small = all(t.typeName() in ("byte", "short") for t in ints)
    return T.FloatType() if small and all(isinstance(t, T.FloatType) for t in floats) else T.DoubleType()


def union_runs(*frames: DataFrame) -> DataFrame:
    """Union by name; a column missing in one frame is null there, differing numeric types are widened."""
    seen: dict[str, list[T.DataType]] = {}
    for df in frames:
        for f in df.schema.fields:
            seen.setdefault(f.name, []).append(f.dataType)
    target = {n: _widest(t) for n, t in seen.items()}
    cast = [df.select(*[F.col(f"`{c}`").cast(target[c]).alias(c) for c in df.columns]) for df in frames]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), cast)


def coordinate_columns(df: DataFrame) -> list[str]:
    return [c for c in COORDINATES if c in df.columns]


def coordinate_sort(ens: DataFrame) -> DataFrame:
    """Global ascending order by set, run, tick and agent."""
    return ens.orderBy(*coordinate_columns(ens))


def require_columns(df: DataFrame, *names: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"unknown column(s) {missing}; have {df.columns}")
