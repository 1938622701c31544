"""Views that share a scan, and joins whose small side is wide."""

import pytest
from pyspark.sql import functions as F

from circle import circle
from tickweave.operators import joining
from tickweave.plans import views


def counted(spark, df):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    return df.mapInPandas(count, df.schema), seen


def plot(style, name, **more):
    return {"plot_style": style, "agent_type": "Agent", "variable_name": "x", "output_filename": name, **more}


PLOTS = [
    plot("time_series", "a"), plot("delay_plot", "b", delay_lag=3), plot("scatter_plot", "c", secondary_variable="y", target_iteration=[3, 9]),
    plot("histogram", "d", target_iteration={"start": 2, "stop": 8, "step": 2}), plot("box_plot", "e", target_iteration=5),
]


@pytest.mark.parametrize("plots", [PLOTS, PLOTS[2:]])
def test_views_of_one_agent_read_it_once(spark, plots):
    df = circle(spark, 3, 2, 4, 30).select("set_num", "time_step", "x", "y", "a").repartition(3)
    source, seen = counted(spark, df)
    spec = {"comparison_sets": ["set_1", "set_3"], "plots": plots}
    made = views.run_views(spark, spec, {"Agent": source})
    shared = {n: sorted(map(tuple, t.collect())) for n, t in made.items()}
    assert seen.value == df.count()
    for p in plots:  # one view alone keeps its own filters
        [(name, alone)] = views.run_views(spark, {**spec, "plots": [p]}, {"Agent": df}).items()
        assert [[pytest.approx(x) for x in r] for r in sorted(map(tuple, alone.collect()))] == [list(r) for r in shared[name]]


def test_only_wanted_ticks_and_columns_are_written(spark, monkeypatch):
    kept = []
    settle = views.settle
    monkeypatch.setattr(views, "settle", lambda df, name: kept.append(settle(df, name)) or kept[-1])
    df = circle(spark, 3, 2, 4, 30)
    views.run_views(spark, {"comparison_sets": ["2"], "plots": PLOTS[2:]}, df)
    assert kept[0].columns == ["set_num", "time_step", "x", "y"]
    assert {tuple(r) for r in kept[0].select("set_num", "time_step").distinct().collect()} == {(2, t) for t in (2, 3, 4, 5, 6, 8, 9)}


def test_wide_text_is_not_broadcast(spark):
    """Few rows, much text: the files are small and the rows are few, but the table in memory is not."""
    big = spark.range(3_000).selectExpr("id % 400 AS k", "id")
    wide = spark.range(400).selectExpr("id AS k", "repeat('x', 100000) AS t")
    for bound in (None, 400):
        met = joining.attach(big, wide, ["k"], at_most=bound)
        plan = met._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
        got = met.select("id", F.length("t").alias("n")).agg(F.count_distinct("id"), F.min("n")).first()
        assert tuple(got) == (3_000, 100_000)
    short = wide.withColumn("t", F.substring("t", 1, 3))
    assert "BroadcastHashJoin" in joining.attach(big, short, ["k"], at_most=400)._jdf.queryExecution().executedPlan().toString()


def test_nested_values_are_measured(spark):
    df = spark.range(3).selectExpr("id", "array_repeat('abcdefgh', 1000) AS a", "binary(repeat('z', 500)) AS b", "string(NULL) AS c")
    size = df.agg(F.sum(joining.row_bytes(df))).first()[0]
    assert 3 * 8_500 < size < 3 * 13_000
    assert joining.fixed_width(df.select("id")) and not joining.fixed_width(df)
