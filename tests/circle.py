"""Closed-form data: agents on circles, every aggregate is known beforehand."""

import math

from pyspark.sql import functions as F

TICKS = 628
PI = 3.1415926535


def circle(spark, sets=4, runs=2, agents=6, ticks=TICKS):
    """x = a + r cos s, y = b + r sin s with s = (t / 100) mod 2 pi, a = agent, b = run, r = set."""
    n = sets * runs * agents * ticks
    i = F.col("id")
    base = spark.range(n).select(
        (F.floor(i / (runs * agents * ticks)) + 1).cast("int").alias("set_num"),
        (F.floor(i / (agents * ticks)) % runs + 1).cast("int").alias("run_num"),
        (F.floor(i / agents) % ticks + 1).cast("int").alias("time_step"),
        (i % agents + 1).cast("bigint").alias("ID"),
    )
    s = (F.col("time_step") * F.lit(0.01)) % F.lit(2 * PI)
    r, a, b = F.col("set_num").cast("double"), F.col("ID").cast("double"), F.col("run_num").cast("double")
    return base.select("*", (a + r * F.cos(s)).alias("x"), (b + r * F.sin(s)).alias("y"), a.alias("a"), b.alias("b"))


def x_of(set_num, tick, agent):
    return agent + set_num * math.cos((tick * 0.01) % (2 * PI))
