"""Running a list of views given as JSON-like specification."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from tickweave.functions.names import number_of
from tickweave.functions.ticks import iterations, selected
from tickweave.operators.distribution import box_stats, histogram, most_groups
from tickweave.operators.levels import analyze, analyze_xy, level_keys
from tickweave.operators.selecting import pick, slice_ens
from tickweave.operators.series import delay, scatter, snapshot, time_series
from tickweave.operators.shaping import require_columns
from tickweave.session import settle
from tickweave.sources.tree import resolve_agent


STYLES = ("time_series", "box_plot", "histogram", "scatter_plot", "delay_plot")
WHOLE_TIME = ("time_series", "delay_plot")


def load_spec(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def _need(view: Mapping, key: str):
    if key not in view:
        raise ValueError(f"view {view.get('output_filename')!r} needs {key!r}")
    return view[key]


def run_view(ens: DataFrame, view: Mapping, sets: list[int], tick: str) -> DataFrame:
    """Numbers behind one view: what is drawn, not the drawing."""
    style, v = _need(view, "plot_style"), _need(view, "variable_name")
    its = iterations(view.get("target_iteration", 0))
    if style == "time_series":
        return time_series(ens, v, sets, tick)
    if style == "box_plot":
        return box_stats(snapshot(ens, v, sets, its, tick), "target_value", at_most_groups=most_groups(sets, its))
    if style == "histogram":
        return histogram(snapshot(ens, v, sets, its, tick), "target_value", at_most_groups=most_groups(sets, its))
    if style == "scatter_plot":
        return scatter(ens, v, _need(view, "secondary_variable"), sets, its, tick)
    if style == "delay_plot":
        return delay(ens, v, sets, int(_need(view, "delay_lag")), tick)
    raise ValueError(f"unknown plot style {style!r}")


def shared_rows(ens: DataFrame, views: Sequence[Mapping], sets: list[int], tick: str, agent: str) -> DataFrame:
    """What several views of one agent type need, read from the source once and written: their columns, sets and ticks.

    Views over the whole time need every tick; if there are none, only ticks that some view asks for are kept.
    """
    names = [v[k] for v in views for k in ("variable_name", "secondary_variable") if k in v]
    require_columns(ens, tick, *names)
    rows = pick(ens, sets)
    if not any(v["plot_style"] in WHOLE_TIME for v in views):
        asked = [selected(tick, iterations(v.get("target_iteration", 0))) for v in views]
        rows = rows.where(reduce(lambda a, b: a | b, asked))
    return settle(rows.select(*dict.fromkeys(["set_num", tick, *names])), f"views-{agent}")


def run_views(spark: SparkSession, spec: Mapping, ens: DataFrame | Mapping[str, DataFrame] | str) -> dict[str, DataFrame]:
    """``{output name: DataFrame}`` for every view of a specification.

    ``ens`` is one table, a table per agent type, or a folder of checkpoints. Set labels such as
    ``set_12`` become numbers. A view that is alone on its agent type reads the source with its own filters; several views of
    one type share one scan of it (:func:`shared_rows`), and their filters work on that.
    """
    sets = [number_of(s) for s in spec["comparison_sets"]]
    tick = spec.get("time_variable", "time_step")
    by_agent: dict[str, list[Mapping]] = {}
    for v in spec["plots"]:
        for key in ("output_filename", "plot_style", "variable_name"):
            _need(v, key)
        if v["plot_style"] not in STYLES:
            raise ValueError(f"unknown plot style {v['plot_style']!r}")
        by_agent.setdefault(_need(v, "agent_type"), []).append(v)
    tables: dict[str, DataFrame] = {}
    for agent, views in by_agent.items():
        rows = resolve_agent(spark, ens, agent) if isinstance(ens, str) else ens[agent] if isinstance(ens, Mapping) else ens
        tables[agent] = shared_rows(rows, views, sets, tick, agent) if len(views) > 1 else rows
    return {v["output_filename"]: run_view(tables[v["agent_type"]], v, sets, tick) for v in spec["plots"]}


def run_analysis(ens: DataFrame, kind: str, spec: Mapping) -> dict[str, DataFrame]:
    """One entry of a hierarchical analysis specification: slice, then summarise at a level.

    ``kind`` is timeseries, boxplot, histogram or scatterplot. Variables may be a name or a list; all that
    are named are analysed; a scatter needs two, and ``full`` or ``mean``.
    """
    level, summary = spec["analysis"], spec["summary"]
    names = [n for v in spec["variables"].values() for n in ([v] if isinstance(v, str) else v)]
    part = slice_ens(ens, spec.get("set"), spec.get("run"), spec.get("major"), spec.get("minor"), spec.get("minor_is", "position"))
    if kind == "scatterplot":
        if len(names) < 2:
            raise ValueError("a scatter plot needs two variables")
        if len(names) > 2:
            raise ValueError(f"a scatter plot needs two variables, not {names}")
        x, y = names
        if summary == "full":
            return {f"{x},{y}": analyze(part, [x, y], level, "full")}
        if summary != "mean":
            raise ValueError(f"a scatter plot shows full data or means, not {summary!r}")
        return {f"{x},{y}": analyze_xy(part, x, y, level)}
    q = spec.get("quantile_values", {})
    out = {}
    for v in names:
        table = analyze(part, v, level, summary, q.get("lower_percentile", 0.2), q.get("upper_percentile", 0.8))
        by = [k for k in ("set_num", "run_num", "ID") if k in level_keys(level)]
        if kind == "timeseries":
            out[v] = table
        elif kind == "histogram":
            out[v] = histogram(table, v, by, int(spec.get("number_bins", 50)))
        elif kind == "boxplot":
            out[v] = box_stats(table, v, [*by, "time_step"])
        else:
            raise ValueError(f"unknown analysis kind {kind!r}")
    return out
