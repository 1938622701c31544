"""Operators against the closed form, and the properties the parts must share."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from circle import TICKS, circle, x_of
from tickweave.operators import audit, distribution, levels, selecting, sensitivity, series
from tickweave.plans.views import run_analysis, run_views


@pytest.fixture(scope="module")
def ens(spark):
    df = circle(spark).cache()
    assert df.count() == 4 * 2 * 6 * 628
    return df


def test_band_is_mean_plus_minus_agents(ens):
    rows = {(r.set_num, r.iteration): r for r in series.time_series(ens, "x", [1, 3]).collect()}
    assert len(rows) == 2 * TICKS
    for s in (1, 3):
        for t in (1, 100, 628):
            r = rows[s, t]
            assert r.mean_val == pytest.approx(x_of(s, t, 3.5))
            assert r.min_val == pytest.approx(x_of(s, t, 1)) and r.max_val == pytest.approx(x_of(s, t, 6))


def test_band_is_sorted(ens):
    rows = [(r.set_num, r.iteration) for r in series.time_series(ens, "x").collect()]
    assert rows == sorted(rows)


def test_mean_over_a_period_is_the_centre(ens):
    got = ens.groupBy("ID").agg(F.avg("x").alias("m")).collect()
    assert all(abs(r.m - r.ID) < 0.01 for r in got)


def test_delay_is_shifted_band(ens):
    rows = series.delay(ens, "x", [2], 50).orderBy("iteration").collect()
    assert len(rows) == TICKS - 50
    assert rows[0].iteration == 51
    assert rows[0].lagged_val == pytest.approx(x_of(2, 1, 3.5)) and rows[0].current_val == pytest.approx(x_of(2, 51, 3.5))


def test_delay_tail_is_last_two(ens):
    tail = series.delay_tail(series.delay(ens, "x", [1, 2], 5)).collect()
    assert sorted((r.set_num, r.iteration) for r in tail) == [(1, 627), (1, 628), (2, 627), (2, 628)]


def test_dataset_report_numbers(ens):
    t = {r.set_num: r for r in audit.timeline(ens).collect()}
    assert {s: (r.min_tick, r.max_tick, r.n_ticks) for s, r in t.items()} == {s: (1, 628, 628) for s in range(1, 5)}
    assert {r.set_num: (r.matching_runs, r.total_runs) for r in audit.run_counts(ens).collect()} == {s: (2, 2) for s in range(1, 5)}
    assert audit.selection_totals(ens).first().asDict() == {"selected_sets": 4, "total_sets": 4, "cells": 8}


def test_histogram_equals_numpy(ens):
    snap = series.snapshot(ens, "x", [1, 4], [10, 300])
    got = {}
    for r in distribution.histogram(snap, "target_value", bins=30).collect():
        got.setdefault((r.set_num, r.iteration), {})[r.bin] = r.n
    raw = snap.toPandas()
    for (s, t), cells in got.items():
        v = raw[(raw.set_num == s) & (raw.iteration == t)].target_value
        assert [cells[i] for i in range(30)] == list(np.histogram(v, bins=30)[0])


def test_histogram_counts_every_value(ens):
    h = distribution.histogram(ens, "y", ["set_num"], 17)
    assert {r.set_num: r.n for r in h.groupBy("set_num").agg(F.sum("n").alias("n")).collect()} == {s: 2 * 6 * 628 for s in range(1, 5)}


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([(1, 5.0)] * 4 + [(2, None), (3, float("nan")), (3, 1.0), (3, 2.0)], "g int, v double")
    rows = distribution.histogram(df, "v", ["g"], 30).where("n > 0").orderBy("g", "bin").collect()
    want = list(np.histogram([5.0] * 4, bins=30)[0])
    assert [(r.g, r.bin, r.n) for r in rows] == [(1, want.index(4), 4), (3, 0, 1), (3, 29, 1)]


def test_histogram_without_groups(spark):
    df = spark.range(101).select(F.col("id").cast("double").alias("v"))
    rows = distribution.histogram(df, "v", [], 10).orderBy("bin").collect()
    assert [r.n for r in rows] == list(np.histogram(np.arange(101.0), bins=10)[0])


def test_box_statistics(spark):
    rng = np.random.default_rng(7)
    v = {g: np.concatenate([rng.normal(g, 1, 500), [g + 30.0, g - 25.0]]) for g in (1, 2, 3)}
    df = spark.createDataFrame([(g, float(x)) for g, xs in v.items() for x in xs], "g int, v double")
    out = {r.g: r for r in distribution.box_stats(df, "v", ["g"]).collect()}
    for g, xs in v.items():
        q1, med, q3 = np.percentile(xs, [25, 50, 75])
        lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        inside = xs[(xs >= lo) & (xs <= hi)]
        r = out[g]
        assert (r.n, r.q1, r.median, r.q3) == (502, pytest.approx(q1), pytest.approx(med), pytest.approx(q3))
        assert (r.whisker_lo, r.whisker_hi, r.n_outliers) == (inside.min(), inside.max(), len(xs) - len(inside))
    points = distribution.box_outliers(df, "v", ["g"]).groupBy("g").count().collect()
    assert {r.g: r["count"] for r in points} == {g: out[g].n_outliers for g in v}


def test_whisker_never_inside_the_box(spark):
    # every point beyond the third quartile is an outlier
    df = spark.createDataFrame([(1, x) for x in (0.0, 0.0, 0.0, 10.0)], "g int, v double")
    r = distribution.box_stats(df, "v", ["g"]).first()
    assert r.q3 == 2.5 and r.whisker_hi == 2.5 and r.n_outliers == 1


def test_levels_are_weighted_means_of_finer_levels(ens):
    fine = levels.analyze(ens.groupBy(*levels.LEVELS["agent"]).agg(F.avg("x").alias("x")), "x", "multiple_run")
    coarse = {r.time_step: r.x for r in levels.analyze(ens, "x", "multiple_set").collect()}
    again = {r.time_step: r.x for r in levels.analyze(fine, "x", "multiple_set").collect()}
    assert again == pytest.approx(coarse)


def test_all_levels_in_one_pass(ens):
    counts = {r.level: r["count"] for r in levels.analyze_all(ens, "x").groupBy("level").count().collect()}
    assert counts == {"agent": 30144, "multiple_run": 4 * 2 * 628, "multiple_batch": 4 * 628, "multiple_set": 628}


@pytest.mark.parametrize("summary", ["full", "custom_quantile"])
def test_agent_level_has_means_only(ens, summary):
    with pytest.raises(ValueError):
        levels.analyze(ens, "x", "agent", summary)


def test_bad_level_and_summary(ens):
    with pytest.raises(ValueError):
        levels.analyze(ens, "x", "everything")
    with pytest.raises(ValueError):
        levels.analyze(ens, "x", "multiple_run", "median")


def test_slice_by_position_and_label(ens):
    by_place = selecting.slice_ens(ens, set=["range", [1, 2]], run=[2], major=["range", [1, 628, 100]], minor=["range", [0, 1]], minor_is="position")
    rows = by_place.collect()
    assert {r.ID for r in rows} == {1, 2} and {r.time_step for r in rows} == {1, 101, 201, 301, 401, 501, 601}
    assert len(rows) == 2 * 1 * 7 * 2
    by_label = selecting.slice_ens(ens, minor=[3, 4])
    assert {r.ID for r in by_label.select("ID").distinct().collect()} == {3, 4}


def test_missing_cells_after_a_run_is_lost(ens):
    kept = ens.where(~((F.col("set_num") == 3) & (F.col("run_num") == 2)))
    assert [tuple(r) for r in audit.missing_cells(kept, "1-4", "1-2").collect()] == [(3, 2)]
    full = {r.set_num: r.complete for r in audit.complete_sets(kept, "1-4", "1-2").collect()}
    assert full == {1: True, 2: True, 3: False, 4: True}


def test_density_counts_every_value_once_per_parameter(spark, ens):
    params = spark.createDataFrame([(s, s / 10, 2.0) for s in range(1, 5)], "set_num int, alpha double, flat double")
    grid = sensitivity.density2d(ens, params, "x")
    inside = ens.where("x >= 0").count()
    assert {r.param: r.n for r in grid.groupBy("param").agg(F.sum("n").alias("n")).collect()} == {"alpha": inside, "flat": inside}
    assert {r.x_bin for r in grid.where("param = 'flat'").collect()} == {499}


def test_density_equals_numpy(spark):
    rng = np.random.default_rng(3)
    sets, vals = rng.integers(1, 6, 4000), rng.exponential(5, 4000).astype(np.float32)
    alpha = np.array([0.1, 0.5, 0.2, 0.9, 0.4], dtype=np.float32)
    df = spark.createDataFrame([(int(s), float(v)) for s, v in zip(sets, vals)], "set_num int, m double")
    params = spark.createDataFrame([(i + 1, float(a)) for i, a in enumerate(alpha)], "set_num int, alpha double")
    top = np.percentile(vals.astype(np.float64), 95)
    assert sensitivity.threshold(df, "m", 95) == pytest.approx(top, rel=1e-12)
    keep = vals <= top
    a64 = alpha.astype(np.float64)
    want, _, _ = np.histogram2d(a64[sets[keep] - 1], vals[keep].astype(np.float64),
                                bins=[np.linspace(a64.min(), a64.max(), 51), np.linspace(0, top, 51)])
    got = np.zeros((50, 50))
    for r in sensitivity.density2d(df, params, "m", 50, 95).collect():
        got[r.x_bin, r.y_bin] = r.n
    assert got.sum() == want.sum() and np.abs(got - want).sum() <= 2  # a value on an edge may differ by rounding


def test_first_order_index(spark):
    # y depends on alpha alone; beta is noise of the design
    rows = [(s, t, float(s % 4) * 3.0) for s in range(16) for t in range(20)]
    df = spark.createDataFrame(rows, "set_num int, time_step int, y double")
    params = spark.createDataFrame([(s, float(s % 4), float(s // 4)) for s in range(16)], "set_num int, alpha double, beta double")
    s1 = {r.param: r.s1 for r in sensitivity.first_order(df, params, "y", 4).collect()}
    assert s1["alpha"] == pytest.approx(1.0) and s1["beta"] == pytest.approx(0.0, abs=1e-12)


def test_view_runner_and_unknown_style(spark, ens):
    def plot(style, **more):
        return {"plot_style": style, "agent_type": "Agent", "variable_name": "x", "output_filename": f"{style}.png", **more}

    its = {"start": 1, "stop": 640, "step": 1}
    spec = {
        "comparison_sets": ["set_1", "set_2"], "time_variable": "time_step",
        "plots": [plot("time_series"), plot("scatter_plot", secondary_variable="y", target_iteration=its), plot("box_plot", target_iteration=5),
                  plot("histogram", target_iteration=5), plot("delay_plot", delay_lag=3)],
    }
    out = run_views(spark, spec, {"Agent": ens})
    assert {k: v.count() for k, v in out.items()} == {
        "time_series.png": 2 * 628, "scatter_plot.png": 2 * 2 * 6 * 628, "box_plot.png": 2, "histogram.png": 60, "delay_plot.png": 2 * 625,
    }
    with pytest.raises(ValueError):
        run_views(spark, {**spec, "plots": [plot("pie")]}, ens)
    with pytest.raises(ValueError):
        run_views(spark, {**spec, "plots": [plot("scatter_plot")]}, ens)
    with pytest.raises(ValueError):
        run_views(spark, {**spec, "plots": [{**plot("time_series"), "variable_name": "nope"}]}, ens)


@pytest.mark.parametrize("kind, level, summary, rows", [
    ("timeseries", "multiple_run", "custom_quantile", 4 * 2 * 628), ("timeseries", "multiple_set", "mean", 628),
    ("histogram", "multiple_batch", "full", 4 * 50), ("histogram", "agent", "mean", 4 * 2 * 6 * 50), ("boxplot", "multiple_batch", "full", 4 * 628),
    ("scatterplot", "multiple_run", "mean", 4 * 2 * 628), ("scatterplot", "multiple_batch", "full", 30144),
])
def test_analysis_specs(ens, kind, level, summary, rows):
    spec = {
        "analysis": level, "variables": {"var1": ["x", "y"]}, "set": ["range", [1, 4]], "run": ["range", [1, 2]],
        "major": ["range", [1, 628, 1]], "minor": ["range", [0, 5]], "summary": summary,
    }
    out = run_analysis(ens, kind, spec)
    assert all(t.count() == rows for t in out.values()) and len(out) == (1 if kind == "scatterplot" else 2)
