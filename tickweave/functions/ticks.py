"""Tick selections: one tick, a list of ticks, or start/stop/step."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F


@dataclass(frozen=True)
class Ticks:
    """Inclusive arithmetic range; never goes past ``stop``."""

    start: int
    stop: int
    step: int = 1

    def __post_init__(self):
        if self.step < 1:
            raise ValueError("step must be at least 1")
        if self.start > self.stop:
            raise ValueError("start must not be above stop")

    def __len__(self) -> int:
        return (self.stop - self.start) // self.step + 1


def iterations(spec=0) -> list[int] | Ticks:
    """``7`` -> [7]; a list stays; ``{start, stop, step}`` -> :class:`Ticks`. The default is tick 0."""
    if isinstance(spec, Ticks):
        return spec
    if isinstance(spec, dict):
        return Ticks(int(spec["start"]), int(spec["stop"]), int(spec.get("step", 1)))
    if isinstance(spec, (list, tuple, range)):
        return [int(t) for t in spec]
    return [int(spec)]


def selected(c: Column | str, spec) -> Column:
    """Predicate for a selection. Ranges become BETWEEN (pushed to the scan) plus a modulo test."""
    col = F.col(c) if isinstance(c, str) else c
    sel = iterations(spec)
    if isinstance(sel, Ticks):
        inside = col.between(sel.start, sel.stop)
        return inside if sel.step == 1 else inside & (F.pmod(col - F.lit(sel.start), F.lit(sel.step)) == 0)
    return col.isin(*sel)


def axis(spec) -> list[int] | Ticks:
    """Hierarchy-slice notation: ``[1, 4]`` is a list, ``['range', [1, 4]]`` or ``['range', [1, 628, 2]]`` a range."""
    if isinstance(spec, (list, tuple)) and len(spec) == 2 and spec[0] == "range":
        return Ticks(*[int(v) for v in spec[1]])
    return iterations(spec)
