"""Row selection: ranges, lists, sampling by tick or position, hierarchy slices, quantile subsets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from tickweave.functions.names import in_bounds, parse_range
from tickweave.functions.ticks import axis, selected
from tickweave.operators.joining import attach
from tickweave.operators.numbering import with_label_position, with_position
from tickweave.operators.quantiles import exact_quantiles


def in_ranges(df: DataFrame, sets=None, runs=None) -> DataFrame:
    """Inclusive set and run ranges, given as ``'1-5'``, ``(1, 5)`` or None."""
    return df.where(in_bounds("set_num", parse_range(sets)) & in_bounds("run_num", parse_range(runs)))


def pick(df: DataFrame, sets: Sequence[int] | None = None, its=None, tick: str = "time_step") -> DataFrame:
    """Set list and tick selection of a view; both reach the Parquet scan."""
    if sets is not None:
        df = df.where(F.col("set_num").isin(*[int(s) for s in sets]))
    if its is not None:
        df = df.where(selected(tick, its))
    return df


def clip_window(df: DataFrame, v: str, hi: float) -> DataFrame:
    """Keep 0 <= v <= hi. NaN is greater than any bound and goes, as do nulls."""
    c = F.col(v)
    return df.where((c >= 0) & (c <= F.lit(float(hi))) & ~F.isnan(c))


def strided(
    df: DataFrame, n: int, by: Sequence[str] = ("set_num", "run_num"), order: Sequence[str] = ("time_step", "ID"), tie: Sequence[str] = ()
) -> DataFrame:
    """Every ``n``-th row of a run, the first kept, with ``ordinal`` 1..k counted after the thinning.

    Both follow from one position: kept where (position - 1) mod n = 0, ordinal (position - 1) / n + 1.
    """
    if n < 1:
        raise ValueError("stride must be at least 1")
    have = [c for c in order if c in df.columns]
    zero = F.col("_pos") - 1
    return (
        with_position(df, by, have, tie, "_pos")
        .where(zero % F.lit(n) == 0)
        .withColumn("ordinal", (F.floor(zero / F.lit(n)) + 1).cast("int"))
        .drop("_pos")
    )


def every(df: DataFrame, period: int, phase: int = 0, tick: str = "time_step") -> DataFrame:
    """Ticks with tick mod period = phase."""
    if period < 1:
        raise ValueError("period must be at least 1")
    if not 0 <= phase < period:
        raise ValueError("phase must be at least 0 and below the period")
    return df.where(F.pmod(F.col(tick), F.lit(period)) == phase)


def slice_ens(ens: DataFrame, set=None, run=None, major=None, minor=None, minor_is: str = "label") -> DataFrame:
    """Slice on set, run, tick (major) and agent (minor); each a list or ``['range', [a, b(, step)]]``.

    ``minor`` selects agent IDs, or with ``minor_is='position'`` 0-based places among the sorted IDs of
    the run, taken before ticks are sliced.
    """
    out = ens
    for col, spec in (("set_num", set), ("run_num", run)):
        if spec is not None:
            out = out.where(selected(col, axis(spec)))
    keep_agents = None
    if minor is not None:
        sel = axis(minor)
        if minor_is == "label":
            out = out.where(selected("ID", sel))
        elif minor_is == "position":
            placed = with_label_position(out, ["set_num", "run_num"], "ID", "_place")
            keep_agents = placed.where(selected("_place", sel)).select("set_num", "run_num", "ID")
        else:
            raise ValueError("minor_is must be 'label' or 'position'")
    if major is not None:
        out = out.where(selected("time_step", axis(major)))
    return out if keep_agents is None else out.join(keep_agents, ["set_num", "run_num", "ID"], "left_semi")


def quantile_subset(
    ens: DataFrame, v: str, lo: float = 0.0, hi: float = 1.0, by: Sequence[str] = ("set_num", "time_step"), at_most_groups: int | None = None
) -> DataFrame:
    """Rows whose value lies between two quantiles of its own cross-section, bounds included."""
    q = exact_quantiles(ens, v, {"_qlo": lo, "_qhi": hi}, by).drop("n")
    c = F.col(v).cast("double")
    return attach(ens, q, by, at_most=at_most_groups).where(c.between(F.col("_qlo"), F.col("_qhi"))).select(*ens.columns)


def strip_outliers(
    ens: DataFrame, v: str, by: Sequence[str] = ("set_num", "time_step"), reach: float = 1.5, at_most_groups: int | None = None
) -> DataFrame:
    """Rows within ``reach`` interquartile ranges of the quartiles of their cross-section."""
    q = exact_quantiles(ens, v, {"_q1": 0.25, "_q3": 0.75}, by).drop("n")
    pad = (F.col("_q3") - F.col("_q1")) * F.lit(reach)
    c = F.col(v).cast("double")
    joined = attach(ens, q, by, at_most=at_most_groups)
    return joined.where(c.between(F.col("_q1") - pad, F.col("_q3") + pad)).select(*ens.columns)


def cap_points(df: DataFrame, n: int, seed: int = 42, key: Sequence[str] | None = None) -> DataFrame:
    """Reproducible uniform sample of exactly min(n, rows) rows.

    Rows are ranked by a seeded 64-bit hash of ``key`` and the n smallest are kept. The cut-off is found
    from counts over the top 16 and next 16 bits of the hash (at most 65,536 small rows each), so nothing
    is sorted and no task sees more than the tie at the cut-off.
    """
    key = list(key or df.columns)
    h = F.xxhash64(*key, F.lit(seed))
    high, low = F.shiftrightunsigned(h, 48), F.pmod(F.shiftrightunsigned(h, 32), F.lit(65_536))

    def cut(counts: DataFrame, room: int) -> tuple[int | None, int]:
        """First slot that does not fit whole, and the room left before it."""
        for slot, rows in sorted((r[0], r[1]) for r in counts.collect()):
            if rows > room:
                return slot, room
            room -= rows
        return None, room

    a, room = cut(df.groupBy(high.alias("slot")).count(), n)
    if a is None:
        return df
    in_a = df.where(high == a)
    b, room = cut(in_a.groupBy(low.alias("slot")).count(), room)
    if b is None:
        return df.where(high <= a)
    whole = df.where((high < a) | ((high == a) & (low < b)))
    edge = in_a.where(low == b)
    if room == 0:
        return whole
    return whole.unionAll(edge.orderBy(h, *[F.col(c) for c in key if _orderable(df, c)]).limit(room))


def _orderable(df: DataFrame, c: str) -> bool:
    return not isinstance(df.schema[c].dataType, T.MapType)


def drop_missing(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null or NaN."""
    return df.dropna(subset=list(cols) if cols else None)
