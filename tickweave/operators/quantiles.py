"""Exact quantiles whose memory per task does not grow with the group.

Spark's ``percentile`` keeps every distinct value of a group in one task, which is fine for small groups
only. So the largest group is counted first. If it is small, each group's values are sorted as one array.
If not, the first pass counts rows per (group, bucket of magnitude), where buckets are fixed and ordered;
cumulative counts tell which one or two buckets hold a wanted rank. Such a bracket, known by its least and greatest value,
is divided into equal parts and counted again as long as it has many rows and more than one value, which bounds the last
window for integers and doubles of any spread; most data need no division.
The result equals linear interpolation between order statistics (numpy's default) either way.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickweave.operators.joining import attach
from tickweave.session import settle

SMALL_GROUP = 100_000  # rows of a group whose values may be held as one array

BRACKET = 500_000  # rows of a bracket whose values one window may order; one value alone may have any number of rows
DIVIDE = 4096  # parts of a bracket; neighbouring doubles of one bucket are apart after four divisions

_PER_OCTAVE = 16  # buckets per factor of two
_OFFSET = 20_000  # above 16 * 1075, so that buckets of positive values are positive numbers


def magnitude_bucket(v: Column) -> Column:
    """Non-decreasing map from doubles to a bounded range of integers; NaN is the greatest value."""
    size = (F.floor(F.log2(F.abs(v)) * F.lit(_PER_OCTAVE)) + F.lit(_OFFSET)).cast("int")
    return (
        F.when(F.isnan(v), F.lit(2 * _OFFSET + 1))
        .when(v == F.lit(float("inf")), F.lit(2 * _OFFSET))
        .when(v == F.lit(float("-inf")), F.lit(-2 * _OFFSET))
        .when(v == 0, F.lit(0))
        .when(v > 0, size)
        .otherwise(-size)
    )


def _rank(p: float, up: bool, total: str = "_total") -> str:
    """0-based rank next below or above quantile ``p``, as an SQL expression."""
    return f"{'ceil' if up else 'floor'}(({total} - 1) * {float(p)!r}D)"


def exact_quantiles(
    df: DataFrame,
    value: str,
    probs: Mapping[str, float],
    by: Sequence[str] = (),
    drop_nan: bool = True,
) -> DataFrame:
    """One row per group: the group columns, ``n`` (rows used) and one column per entry of ``probs``.

    Rows without a value or with a null in a group column belong to no group.
    """
    for p in probs.values():
        if not 0.0 <= p <= 1.0:
            raise ValueError(f"quantile {p} is outside 0..1")
    keys = list(by) or ["_all"]
    v = F.col(value).cast("double")
    rows = df.where(v.isNotNull() & ~F.isnan(v) if drop_nan else v.isNotNull())
    rows = rows.dropna(subset=list(by)) if by else rows
    rows = rows.select(*by, *([] if by else [F.lit(0).alias("_all")]), v.alias("_v"))
    largest = rows.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
    if largest <= SMALL_GROUP:
        ranked = _rank_small(rows, keys, probs)
    else:
        ranked = _rank_large(rows, keys, probs)
    return ranked.select(*by, "n", *[c.alias(name) for name, c in interpolated(probs).items()])


def _rank_small(rows: DataFrame, keys: list[str], probs: Mapping[str, float]) -> DataFrame:
    """Per group ``n`` and, for each quantile, the values at the two ranks next to it."""
    return with_ranks(rows, keys, probs).drop("_a")


def with_ranks(rows: DataFrame, keys: list[str], probs: Mapping[str, float]) -> DataFrame:
    """Per group all values in order as ``_a``, ``n`` and the values at the wanted ranks."""
    sorted_values = rows.groupBy(*keys).agg(F.sort_array(F.collect_list("_v")).alias("_a"))
    sized = sorted_values.withColumn("n", F.size("_a").cast("bigint"))
    picks = []
    for i, p in enumerate(probs.values()):
        for name, up in ((f"_lo{i}", False), (f"_hi{i}", True)):
            picks.append(F.expr(f"element_at(_a, cast({_rank(p, up, 'n')} as int) + 1)").alias(name))
    return sized.select(*keys, "_a", "n", *picks)


BRACKET_COLUMNS = ["_bucket", "_lo", "_hi", "_start", "_total", "_n"]


def bucket_counts(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows ``_n`` per (group, bucket) of ``_v`` with the least and greatest value; written once."""
    bucketed = rows.withColumn("_bucket", magnitude_bucket(F.col("_v")))
    return settle(bucketed.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")), "buckets")


def ranked_buckets(counted: DataFrame, keys: list[str]) -> DataFrame:
    """Bucket counts with the ranks ``[_start, _end)`` that each takes in its group of ``_total`` rows."""
    run = Window.partitionBy(*keys)
    upto = F.sum("_n").over(run.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0))
    return counted.withColumns({"_total": F.sum("_n").over(run), "_end": upto}).withColumn("_start", F.col("_end") - F.col("_n"))


def inside_brackets(rows: DataFrame, brackets: DataFrame, keys: list[str], many: int) -> DataFrame:
    """Rows (``_v``) that lie in a bracket, folded to ``_w`` where they are joined by shuffle."""
    met = attach(rows.withColumn("_bucket", magnitude_bucket(F.col("_v"))), brackets, [*keys, "_bucket"], at_most=many, weight="_w")
    return met.where(F.col("_v").between(F.col("_lo"), F.col("_hi")))


def find_brackets(rows: DataFrame, counted: DataFrame, keys: list[str], probs: Mapping[str, float]) -> tuple[DataFrame, int]:
    """Brackets that hold a wanted rank, divided until each is small or one value, and how many there are."""
    ranks = {_rank(p, up) for p in probs.values() for up in (False, True)}
    wanted = " OR ".join(f"({r} >= _start AND {r} < _end)" for r in sorted(ranks))
    ends = [F.min("_v").alias("_lo"), F.max("_v").alias("_hi")]

    def settled(counted: DataFrame) -> tuple[DataFrame, int, int]:
        """Brackets with a wanted rank, how many there are, and the rows of the largest that can be divided."""
        out = settle(counted.where(wanted).select(*keys, *BRACKET_COLUMNS), "brackets")
        many, most = out.agg(F.count(F.lit(1)), F.max(F.when(F.col("_lo") < F.col("_hi"), F.col("_n")))).first()
        return out, many, most or 0

    brackets, many, most = settled(counted)
    while most > BRACKET:
        place = F.least(F.floor((F.col("_v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * DIVIDE), F.lit(DIVIDE - 1))
        slot = F.when((F.col("_n") > BRACKET) & (F.col("_lo") < F.col("_hi")), place).otherwise(0)
        old = {c: f"{c}_of" for c in ("_lo", "_hi", "_start", "_n")}
        parts = inside_brackets(rows, brackets, keys, many).withColumn("_slot", slot).withColumnsRenamed(old)  # brackets of one bucket do not overlap
        counted = parts.groupBy(*keys, "_bucket", "_lo_of", "_start_of", "_total", "_slot").agg(F.sum("_w").alias("_n"), *ends)
        upto = F.sum("_n").over(Window.partitionBy(*keys, "_bucket", "_lo_of").orderBy("_slot").rowsBetween(Window.unboundedPreceding, 0))
        counted = counted.withColumn("_end", F.col("_start_of") + upto).withColumn("_start", F.col("_end") - F.col("_n"))
        brackets, many, most = settled(counted)
    return brackets, many


def pick_ranks(per_value: DataFrame, keys: list[str], probs: Mapping[str, float]) -> DataFrame:
    """``n`` and the values at the wanted ranks from counts ``_m`` per bracket and value."""
    up_to = Window.partitionBy(*keys, "_bucket", "_lo").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = per_value.withColumn("_to", F.col("_start") + F.sum("_m").over(up_to)).withColumn("_from", F.col("_to") - F.col("_m"))
    picks = [F.max("_total").alias("n")]
    for i, p in enumerate(probs.values()):
        for name, r in ((f"_lo{i}", _rank(p, False)), (f"_hi{i}", _rank(p, True))):
            picks.append(F.expr(f"max(CASE WHEN {r} >= _from AND {r} < _to THEN _v END)").alias(name))
    return ranked.groupBy(*keys).agg(*picks)


def _rank_large(rows: DataFrame, keys: list[str], probs: Mapping[str, float]) -> DataFrame:
    """Same as :func:`_rank_small` by brackets: each holds a wanted rank and is divided until it is small or one value."""
    brackets, many = find_brackets(rows, ranked_buckets(bucket_counts(rows, keys), keys), keys, probs)
    met = inside_brackets(rows, brackets, keys, many)
    return pick_ranks(met.groupBy(*keys, "_bucket", "_lo", "_start", "_total", "_v").agg(F.sum("_w").alias("_m")), keys, probs)


def interpolated(probs: Mapping[str, float]) -> dict[str, Column]:
    """Each quantile from the values at its two ranks, from the nearer end, as numpy does."""
    out = {}
    for i, (name, p) in enumerate(probs.items()):
        part = f"((n - 1) * {float(p)!r}D - {_rank(p, False, 'n')})"  # distance between the two ranks, 0..1
        lo, hi = f"_lo{i}", f"_hi{i}"
        out[name] = F.expr(f"CASE WHEN {lo} = {hi} THEN {lo} WHEN {part} < 0.5D THEN {lo} + ({hi} - {lo}) * {part} ELSE {hi} - ({hi} - {lo}) * (1 - {part}) END")
    return out


def approx_quantiles(
    df: DataFrame, value: str, probs: Mapping[str, float], by: Sequence[str] = (), accuracy: int = 10_000
) -> DataFrame:
    """One-pass version; the rank error is at most n / ``accuracy``. Returns values that occur in the data."""
    v = F.col(value).cast("double")
    rows = df.where(v.isNotNull() & ~F.isnan(v))
    picked = F.percentile_approx(v, [float(p) for p in probs.values()], accuracy)
    out = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), picked.alias("_q"))
    return out.select(*by, "n", *[F.col("_q")[i].alias(name) for i, name in enumerate(probs)])
