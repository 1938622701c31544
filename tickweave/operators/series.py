"""Views over time: bands, lagged phase space, snapshots, scatter, terminal values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tickweave.operators.selecting import pick
from tickweave.operators.shaping import require_columns


def time_series(ens: DataFrame, v: str, sets: Sequence[int] | None = None, tick: str = "time_step", sort: bool = True) -> DataFrame:
    """Mean, min and max per (set, tick) over all runs and agents, sorted by set and tick."""
    require_columns(ens, v, tick)
    c = F.col(v)
    out = (
        pick(ens, sets)
        .groupBy("set_num", F.col(tick).alias("iteration"))
        .agg(F.avg(c).alias("mean_val"), F.min(c).alias("min_val"), F.max(c).alias("max_val"))
    )
    return out.orderBy("set_num", "iteration") if sort else out


def snapshot(ens: DataFrame, v: str, sets: Sequence[int] | None = None, its=0, tick: str = "time_step") -> DataFrame:
    """Raw values at the chosen ticks."""
    require_columns(ens, v, tick)
    return pick(ens, sets, its, tick).select("set_num", F.col(tick).alias("iteration"), F.col(v).alias("target_value"))


def scatter(ens: DataFrame, x: str, y: str, sets: Sequence[int] | None = None, its=0, tick: str = "time_step") -> DataFrame:
    """Pairs of two metrics at the chosen ticks."""
    require_columns(ens, x, y, tick)
    return pick(ens, sets, its, tick).select(
        "set_num", F.col(tick).alias("iteration"), F.col(x).alias("x_val"), F.col(y).alias("y_val")
    )


def delay(ens: DataFrame, v: str, sets: Sequence[int] | None = None, lag: int = 1, tick: str = "time_step") -> DataFrame:
    """Mean per (set, tick) against the mean ``lag`` ticks of the series earlier; incomplete rows dropped.

    The window runs over one row per tick, so its partitions do not grow with runs or agents.
    """
    require_columns(ens, v, tick)
    means = pick(ens, sets).groupBy("set_num", F.col(tick).alias("iteration")).agg(F.avg(v).alias("current_val"))
    earlier = F.lag("current_val", lag).over(Window.partitionBy("set_num").orderBy("iteration"))
    return means.withColumn("lagged_val", earlier).dropna()


def delay_tail(delayed: DataFrame, points: int = 2) -> DataFrame:
    """Last points of each delay curve, for the direction of its last step."""
    latest = Window.partitionBy("set_num").orderBy(F.desc("iteration"))
    return delayed.withColumn("_back", F.row_number().over(latest)).where(F.col("_back") <= points).drop("_back")


def last_value(ens: DataFrame, v: str, by: Sequence[str] = ("set_num", "run_num"), order: Sequence[str] = ("time_step", "ID")) -> DataFrame:
    """Value of ``v`` in the last row of each run."""
    latest = F.struct(*[F.col(c) for c in order if c in ens.columns])
    return ens.groupBy(*by).agg(F.max_by(F.col(v), latest).alias("last_val"))
