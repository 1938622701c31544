"""The parameter table: one row per set."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from tickweave.operators.joining import attach

# Columns of a parameter table that are not parameters.
NOT_PARAMETERS = ("set_num", "run_num", "time_step", "set_id")


def parameter_names(params: DataFrame, metric: str | None = None) -> list[str]:
    return [
        f.name
        for f in params.schema.fields
        if f.name not in NOT_PARAMETERS and f.name != metric and isinstance(f.dataType, T.NumericType)
    ]


def with_params(df: DataFrame, params: DataFrame) -> DataFrame:
    """Parameters of the row's set on every row; sets without parameters keep nulls."""
    return attach(df, params, ["set_num"], "left", name="params")


def set_spine(params: DataFrame) -> DataFrame:
    """All sets 1..max, with nulls where the table has a gap. A set listed twice is an error."""
    check = params.agg(F.max("set_num"), F.count(F.lit(1)), F.count_distinct("set_num")).first()
    top, rows, distinct = check
    if rows != distinct:
        raise ValueError("a set number occurs more than once in the parameter table")
    spine = params.sparkSession.range(1, (top or 0) + 1).select(F.col("id").cast("int").alias("set_num"))
    return spine.join(params.withColumn("set_num", F.col("set_num").cast("int")), "set_num", "left")


def parameter_domain(params: DataFrame, metric: str | None = None) -> DataFrame:
    """Smallest and largest value of each parameter, in single precision."""
    return long_params(params, metric).groupBy("param").agg(F.min("x").alias("x_min"), F.max("x").alias("x_max"))


def long_params(params: DataFrame, metric: str | None = None) -> DataFrame:
    """(set_num, param, x): one row per set and parameter, nulls and NaN left out."""
    names = parameter_names(params, metric)
    if not names:
        raise ValueError("the parameter table has no numeric parameter column")
    wide = params.select("set_num", *[F.col(f"`{n}`").cast("float").cast("double").alias(n) for n in names])
    return wide.unpivot("set_num", names, "param", "x").where(F.col("x").isNotNull() & ~F.isnan("x"))
