"""Summaries at the four levels of the hierarchy."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tickweave.operators.quantiles import exact_quantiles
from tickweave.operators.shaping import require_columns

# Level names and the columns each keeps apart.
LEVELS = {
    "agent": ("set_num", "run_num", "time_step", "ID"),
    "multiple_run": ("set_num", "run_num", "time_step"),
    "multiple_batch": ("set_num", "time_step"),
    "multiple_set": ("time_step",),
}
SUMMARIES = ("mean", "full", "custom_quantile")


def level_keys(level: str) -> list[str]:
    if level not in LEVELS:
        raise ValueError(f"level must be one of {tuple(LEVELS)}, got {level!r}")
    return list(LEVELS[level])


def analyze(
    ens: DataFrame,
    v: str | Sequence[str],
    level: str,
    summary: str = "mean",
    lo: float = 0.2,
    hi: float = 0.8,
) -> DataFrame:
    """Level keys plus, by ``summary``: the mean (under the metric's name), the raw values, or for one
    metric ``q_lo``, ``q_mid`` and ``q_hi``. Neither raw values nor quantiles exist at agent level."""
    keys = level_keys(level)
    metrics = [v] if isinstance(v, str) else list(v)
    require_columns(ens, *metrics)
    if summary not in SUMMARIES:
        raise ValueError(f"summary must be one of {SUMMARIES}, got {summary!r}")
    if level == "agent" and summary != "mean":
        raise ValueError(f"summary {summary!r} does not exist at agent level")
    if summary == "mean":
        return ens.groupBy(*keys).agg(*[F.avg(m).alias(m) for m in metrics])
    if summary == "full":
        return ens.select(*keys, *metrics)
    if len(metrics) != 1:
        raise ValueError("a quantile band takes one metric")
    if not 0 <= lo <= hi <= 1:
        raise ValueError("need 0 <= lower <= upper <= 1")
    return exact_quantiles(ens, metrics[0], {"q_lo": lo, "q_mid": 0.5, "q_hi": hi}, keys)


def analyze_all(ens: DataFrame, v: str) -> DataFrame:
    """Means (doubles) of all four levels with the level's name.

    Rows are added up once, per agent; each coarser level adds up the sums and counts of the finer one, so no row is
    copied per level and the scan happens once (the levels share the exchange).
    """
    require_columns(ens, v)
    cols = LEVELS["agent"]
    sums = ens.groupBy(*cols).agg(F.sum(F.col(v).cast("double")).alias("_sum"), F.count(v).alias("n"))
    parts = []
    for level, keys in LEVELS.items():
        if level != "agent":
            sums = sums.groupBy(*keys).agg(F.sum("_sum").alias("_sum"), F.sum("n").alias("n"))
        shown = [F.col(c) if c in keys else F.lit(None).cast(ens.schema[c].dataType).alias(c) for c in cols]
        parts.append(sums.select(F.lit(level).alias("level"), *shown, F.try_divide("_sum", "n").alias("mean_val"), "n"))
    return reduce(DataFrame.unionAll, parts)


def analyze_xy(ens: DataFrame, x: str, y: str, level: str) -> DataFrame:
    """Mean pair per group of a level, for a scatter of means."""
    require_columns(ens, x, y)
    return ens.groupBy(*level_keys(level)).agg(F.avg(x).alias("x_mean"), F.avg(y).alias("y_mean"))
