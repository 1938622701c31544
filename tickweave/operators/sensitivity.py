"""Parameter against response: clipping threshold, 2-D density and first-order sensitivity."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tickweave.functions.numeric import bin_edge, bin_index, single
from tickweave.operators.params import long_params
from tickweave.operators.quantiles import approx_quantiles, exact_quantiles
from tickweave.operators.selecting import clip_window
from tickweave.session import settle


def threshold(df: DataFrame, v: str, p: float = 100.0, exact: bool = True) -> float | None:
    """Percentile ``p`` of a metric over all rows (NaN left out), as a plain number.

    Being a literal afterwards, it is pushed down to the scan by the filter that uses it. None if there
    are no values.
    """
    if not 0 <= p <= 100:
        raise ValueError("percentile must lie in 0..100")
    values = df.select(F.col(v).cast("float").alias("v"))
    if p == 100:
        top = values.where(~F.isnan("v")).agg(F.max("v"))
    elif exact:
        top = exact_quantiles(values, "v", {"q": p / 100}).select("q")
    else:
        top = approx_quantiles(values, "v", {"q": p / 100}).select("q")
    row = top.first()
    return None if row is None else row[0]


def density2d(df: DataFrame, params: DataFrame, v: str, bins: int = 500, pct: float = 100.0, top: float | None = None) -> DataFrame:
    """Counts over (parameter value, response value) for all parameters at once, empty cells left out.

    The response bin depends on the row, the parameter bin on the set only. So the data is reduced once
    to (set, response bin), at most sets x ``bins`` rows, and the parameters meet that small table.
    """
    if top is None:
        top = threshold(df, v, pct)
    if top is None:
        top = -1.0
    if top == float("inf"):
        raise ValueError("the clipping threshold is infinite; choose a lower percentile")
    y = single(F.col(v))
    high = F.lit(float(top))
    cells = (
        clip_window(df.select("set_num", y.alias("_y")), "_y", top)
        .withColumn("y_bin", bin_index(F.col("_y"), F.lit(0.0), high, bins))
        .groupBy("set_num", "y_bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    xs = long_params(params, v)
    ends = xs.groupBy("param").agg(F.min("x").alias("x_min"), F.max("x").alias("x_max"))
    places = xs.join(ends, "param").withColumn("x_bin", bin_index(F.col("x"), F.col("x_min"), F.col("x_max"), bins))
    grid = cells.join(places, "set_num").groupBy("param", "x_bin", "y_bin", "x_min", "x_max").agg(F.sum("n").alias("n"))
    return grid.select(
        "param",
        "x_bin",
        "y_bin",
        bin_edge(F.col("x_min"), F.col("x_max"), F.col("x_bin"), bins).alias("x_lo"),
        bin_edge(F.lit(0.0), high, F.col("y_bin"), bins).alias("y_lo"),
        "n",
    )


def log_counts(grid: DataFrame) -> DataFrame:
    """Adds the logarithm of the counts, the colour scale of a density picture."""
    return grid.withColumn("log_n", F.log10("n"))


def first_order(df: DataFrame, params: DataFrame, v: str, bins: int = 10) -> DataFrame:
    """Var(E[Y | parameter bin]) / Var(Y) for each parameter (variance-based first-order index).

    The data is reduced once to count, mean and variance per set; everything else works on that. Bins
    are equal-width over each parameter's range and weighted by their number of rows.
    """
    y = F.col(v).cast("double")
    per_set = (
        df.where(y.isNotNull() & ~F.isnan(y))
        .groupBy("set_num")
        .agg(F.count(y).alias("n"), F.avg(y).alias("m"), F.var_pop(y).alias("s2"))
    )
    xs = long_params(params, v)
    ends = xs.groupBy("param").agg(F.min("x").alias("x_min"), F.max("x").alias("x_max"))
    placed = xs.join(ends, "param").select(
        "set_num", "param", bin_index(F.col("x"), F.col("x_min"), F.col("x_max"), bins).alias("x_bin")
    )
    n, m = F.col("n"), F.col("m")
    rows = settle(per_set, "per-set").join(placed, "set_num")
    means = rows.groupBy("param").agg((F.sum(n * m) / F.sum(n)).alias("mean"))  # one row per parameter column
    rows = rows.join(F.broadcast(means), "param")
    mean = F.col("mean")
    per_bin = rows.groupBy("param", "x_bin", "mean").agg(
        F.sum(n).alias("bn"),
        (F.sum(n * m) / F.sum(n)).alias("bm"),
        F.sum(n * (F.col("s2") + F.pow(m - mean, F.lit(2.0)))).alias("spread"),
    )
    bn = F.col("bn")
    totals = per_bin.groupBy("param").agg(
        F.count(F.lit(1)).alias("bins_used"),
        F.sum(bn).alias("rows"),
        F.sum(bn * F.pow(F.col("bm") - mean, F.lit(2.0))).alias("between"),
        F.sum("spread").alias("spread"),
    )
    return totals.select("param", "bins_used", "rows", (F.col("between") / F.nullif(F.col("spread"), F.lit(0.0))).alias("s1"))
