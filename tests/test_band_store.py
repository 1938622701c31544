"""The band store: few live runs, repeated batches, and writers that die."""

import math
import os

import pytest
from pyspark.sql import DataFrameWriter

from tickweave.streaming.incremental import BandStore


def batch(spark, n):
    """Batch n changes ticks n to n + 3 of set 1 and tick 0 of set 2."""
    rows = [(1, t, float(n), 0.0, 1.0, n) for t in range(n, n + 4)] + [(2, 0, float(n), 0.0, 1.0, n)]
    return spark.createDataFrame(rows, "set_num int, iteration int, mean_val double, min_val double, max_val double, n long")


def wanted(last):
    out = {}
    for n in range(last + 1):
        out.update({(1, t): n for t in range(n, n + 4)} | {(2, 0): n})
    return out


def held(store):
    return {(r.set_num, r.iteration): r.n for r in store.read().collect()}


def test_few_runs_are_live(spark, tmp_path):
    store = BandStore(spark, str(tmp_path / "b"), fan_in=3)
    for n in range(28):
        store.add(batch(spark, n), n)
        runs = store.live()["runs"]
        assert len(runs) <= 2 * (1 + math.log(n + 1, 3)) and sum(r["last"] - r["first"] + 1 for r in runs) == n + 1
    assert held(store) == wanted(27)
    folders = [f for f in os.listdir(tmp_path / "b") if f.startswith("level")]
    assert len(folders) <= len(runs) + 3 and len(os.listdir(tmp_path / "b" / "_live")) <= 6  # with checksums
    store.add(batch(spark, 5), 5)  # a batch that is told again changes nothing
    assert held(store) == wanted(27) and store.live()["runs"] == runs


def test_merge_killed_half_way(spark, tmp_path, monkeypatch):
    store = BandStore(spark, str(tmp_path / "b"), fan_in=3)
    for n in range(2):
        store.add(batch(spark, n), n)
    write = DataFrameWriter.parquet

    def dies(self, path, *a, **b):
        write(self, path, *a, **b)
        if "level-1" in path:  # the merged run lies there in part, the pointer does not know it
            for f in os.listdir(path):
                if f.endswith(".parquet"):
                    os.truncate(f"{path}/{f}", 10)
            raise KeyboardInterrupt

    monkeypatch.setattr(DataFrameWriter, "parquet", dies)
    with pytest.raises(KeyboardInterrupt):
        store.add(batch(spark, 2), 2)
    assert held(store) == wanted(2) and len(store.live()["runs"]) == 3
    monkeypatch.undo()
    store.add(batch(spark, 2), 2)  # what Spark does after a restart
    store.add(batch(spark, 3), 3)
    assert held(store) == wanted(3) and [r["level"] for r in store.live()["runs"]] == [1]
    monkeypatch.setattr("tickweave.streaming.incremental.write_text", lambda *a: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError):
        store.add(batch(spark, 4), 4)
    monkeypatch.undo()
    assert held(store) == wanted(3)
    store.add(batch(spark, 4), 4)
    assert held(store) == wanted(4)
