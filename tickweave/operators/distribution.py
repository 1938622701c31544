"""Histograms and box-plot statistics per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tickweave.functions.numeric import bin_edge, bin_index, is_finite
from tickweave.functions.ticks import iterations
from tickweave.operators import quantiles
from tickweave.operators.joining import attach
from tickweave.operators.quantiles import (
    BRACKET_COLUMNS, bucket_counts, exact_quantiles, find_brackets, inside_brackets, interpolated, pick_ranks,
    ranked_buckets, with_ranks,
)
from tickweave.operators.shaping import require_columns
from tickweave.session import settle

SNAPSHOT_KEYS = ("iteration", "set_num")


def most_groups(sets: Sequence[int] | None, its) -> int | None:
    """Bound on (tick, set) groups of a view, when the request itself gives one."""
    return None if sets is None or its is None else len(sets) * len(iterations(its))


def histogram(df: DataFrame, v: str, by: Sequence[str] = SNAPSHOT_KEYS, bins: int = 30, at_most_groups: int | None = None) -> DataFrame:
    """Equal-width bins over each group's own min..max: ``bin, bin_lo, bin_hi, n``, empty bins included.

    If all values of a group are equal the range is widened by one half each way, so they fall into the
    middle bin. Values that are missing or not finite cannot be binned and are left out.
    """
    if bins < 1:
        raise ValueError("bins must be at least 1")
    require_columns(df, v, *by)
    keys = list(by) or ["_all"]
    c = F.col(v).cast("double")
    rows = df.where(is_finite(c)).select(*by, *([] if by else [F.lit(0).alias("_all")]), c.alias("_v"))
    ends = rows.groupBy(*keys).agg(F.min("_v").alias("_a"), F.max("_v").alias("_z"))
    half = F.when(F.col("_a") == F.col("_z"), F.lit(0.5)).otherwise(F.lit(0.0))
    ends = ends.select(*keys, (F.col("_a") - half).alias("_lo"), (F.col("_z") + half).alias("_hi"))
    lo, hi = F.col("_lo"), F.col("_hi")
    group_bound = at_most_groups if by else 1
    counted = (
        attach(rows, ends, keys, at_most=group_bound, name="histogram-ends", weight="_w")
        .withColumn("bin", bin_index(F.col("_v"), lo, hi, bins))
        .groupBy(*keys, "_lo", "_hi", "bin")
        .agg(F.sum("_w").alias("n"))
    )
    # at most ``bins`` counts per group are folded into a map, then every bin is looked up in it
    cells = F.map_from_entries(F.collect_list(F.struct("bin", "n")))
    folded = counted.groupBy(*keys, "_lo", "_hi").agg(cells.alias("_cells"))
    out = folded.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1)))).withColumn(
        "n", F.coalesce(F.try_element_at("_cells", F.col("bin")), F.lit(0).cast("bigint"))
    )
    return out.select(
        *by,
        "bin",
        bin_edge(lo, hi, F.col("bin"), bins).alias("bin_lo"),
        bin_edge(lo, hi, F.col("bin") + 1, bins).alias("bin_hi"),
        "n",
    )


def _with_fences(
    df: DataFrame, v: str, by: Sequence[str], reach: float, at_most_groups: int | None, weight: str | None = None
) -> DataFrame:
    c = F.col(v).cast("double")
    q = exact_quantiles(df, v, {"q1": 0.25, "median": 0.5, "q3": 0.75}, by)
    pad = (F.col("q3") - F.col("q1")) * F.lit(reach)
    q = q.withColumn("_low", F.col("q1") - pad).withColumn("_high", F.col("q3") + pad)
    rows = df.where(c.isNotNull() & ~F.isnan(c)).select(*by, c.alias("_v"))
    return attach(rows, q, by, at_most=at_most_groups, name="box-fences", weight=weight)


QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def box_stats(
    df: DataFrame, v: str, by: Sequence[str] = SNAPSHOT_KEYS, reach: float = 1.5, at_most_groups: int | None = None
) -> DataFrame:
    """Quartiles, whiskers (furthest points within ``reach`` interquartile ranges) and outlier counts.

    A whisker never lies inside the box: without a point beyond the quartile it equals the quartile.

    The source is read twice. The first pass counts rows per (group, bucket of magnitude) with least and greatest value. If
    all groups are small, the second gathers each group's values in order, and everything is read off that. If not, the
    quartiles are known up to a bracket and with them the fences up to a few buckets, so the second pass takes the rows of these
    brackets and buckets only; all other buckets lie wholly inside or outside and are settled by the counts of the first.
    """
    require_columns(df, v, *by)
    keys = list(by) or ["_all"]
    x = F.col(v).cast("double")
    rows = df.where(x.isNotNull() & ~F.isnan(x))
    rows = rows.dropna(subset=list(by)) if by else rows
    rows = rows.select(*by, *([] if by else [F.lit(0).alias("_all")]), x.alias("_v"))
    counted = bucket_counts(rows, keys)
    largest = counted.groupBy(*keys).agg(F.sum("_n").alias("n")).agg(F.max("n")).first()[0] or 0
    box = _small_boxes(rows, keys, reach) if largest <= quantiles.SMALL_GROUP else _large_boxes(rows, ranked_buckets(counted, keys), keys, reach, at_most_groups)
    return box.select(
        *by, "n", "q1", "median", "q3", F.least("q1", "_least").alias("whisker_lo"), F.greatest("q3", "_greatest").alias("whisker_hi"), "n_outliers"
    )


def _fenced(quartiles: DataFrame, reach: float) -> DataFrame:
    pad = (F.col("q3") - F.col("q1")) * F.lit(reach)
    return quartiles.withColumn("_low", F.col("q1") - pad).withColumn("_high", F.col("q3") + pad)


def _small_boxes(rows: DataFrame, keys: list[str], reach: float) -> DataFrame:
    ranked = with_ranks(rows, keys, QUARTILES)
    box = _fenced(ranked.withColumns(interpolated(QUARTILES)), reach)
    box = box.withColumn("_in", F.filter("_a", lambda x: (x >= F.col("_low")) & (x <= F.col("_high"))))
    return box.withColumns({
        "_least": F.get("_in", F.lit(0)), "_greatest": F.try_element_at("_in", F.lit(-1)), "n_outliers": (F.col("n") - F.size("_in")).cast("bigint")
    })


def _large_boxes(rows: DataFrame, counted: DataFrame, keys: list[str], reach: float, at_most_groups: int | None) -> DataFrame:
    brackets, many = find_brackets(rows, counted, keys, QUARTILES)
    # what the brackets say about the first and third quartile, and so about the fences
    rank = {q: [F.expr(f"{e}((_total - 1) * {p!r}D)") for e in ("floor", "ceil")] for q, p in QUARTILES.items() if q != "median"}
    holds = lambda q: (rank[q][1] >= F.col("_start")) & (rank[q][0] < F.col("_start") + F.col("_n"))
    known = brackets.groupBy(*keys).agg(
        *[f(F.when(holds(q), F.col(c))).alias(f"_{q}{c}") for q in rank for f, c in ((F.min, "_lo"), (F.max, "_hi"))]
    )
    q1a, q1z, q3a, q3z = (F.col(c) for c in ("_q1_lo", "_q1_hi", "_q3_lo", "_q3_hi"))
    most, least = (q3z - q1a) * F.lit(reach), F.greatest(q3a - q1z, F.lit(0.0)) * F.lit(reach)
    known = known.select(*keys, (q1a - most).alias("_low_a"), (q1z - least).alias("_low_z"), (q3a + least).alias("_high_a"), (q3z + most).alias("_high_z"))
    spread = lambda name: (F.col("_hi") >= F.col(f"{name}_a")) & (F.col("_lo") <= F.col(f"{name}_z"))
    open_ = (F.col("_lo") < F.col("_hi")) & (spread("_low") | spread("_high"))
    buckets = settle(counted.join(known, keys).withColumn("_open", open_).select(*keys, *BRACKET_COLUMNS, "_open"), "box-buckets")
    fences = buckets.where("_open").drop("_open")
    wanted = brackets.withColumn("_kind", F.lit("rank")).unionByName(fences.withColumn("_kind", F.lit("fence")))
    wanted = settle(wanted, "box-brackets")
    met = inside_brackets(rows, wanted, keys, wanted.count())
    per_value = settle(met.groupBy(*keys, "_kind", "_bucket", "_lo", "_start", "_total", "_v").agg(F.sum("_w").alias("_m")), "box-values")

    ranked = pick_ranks(per_value.where("_kind = 'rank'"), keys, QUARTILES)
    box = _fenced(ranked.withColumns(interpolated(QUARTILES)), reach).select(*keys, "n", *QUARTILES, "_low", "_high")
    # values one by one in open buckets, all others bucket by bucket
    points = per_value.where("_kind = 'fence'").select(*keys, F.col("_v").alias("_lo"), F.col("_v").alias("_hi"), "_m")
    points = points.unionByName(buckets.where("NOT _open").select(*keys, "_lo", "_hi", F.col("_n").alias("_m")))
    within = (F.col("_lo") >= F.col("_low")) & (F.col("_hi") <= F.col("_high"))
    return attach(points, box, keys, at_most=at_most_groups, name="box-fences").groupBy(*keys, "n", *QUARTILES).agg(
        F.min(F.when(within, F.col("_lo"))).alias("_least"), F.max(F.when(within, F.col("_hi"))).alias("_greatest"),
        F.sum(F.when(within, 0).otherwise(F.col("_m"))).alias("n_outliers"),
    )


def box_outliers(
    df: DataFrame, v: str, by: Sequence[str] = SNAPSHOT_KEYS, reach: float = 1.5, at_most_groups: int | None = None
) -> DataFrame:
    """The points a box plot draws one by one."""
    x = F.col("_v")
    rows = _with_fences(df, v, by, reach, at_most_groups).where((x < F.col("_low")) | (x > F.col("_high")))
    return rows.select(*by, x.alias("outlier"))
