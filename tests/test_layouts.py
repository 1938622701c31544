"""Files of many layouts in one folder: each scan opens its own, and a row pays little for the choice."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tickweave.sources import tree


def put_snapshots(folder, ticks):
    """Every third file without a tick of its own, every fifth with text under the name of a number."""
    folder.mkdir(parents=True)
    for t in ticks:
        columns = {"iteration": pa.array([t, t], pa.int32()), "agent_id": pa.array([1, 2], pa.int64() if t % 2 else pa.int32()), "x": pa.array([t + 0.5, t + 0.25])}
        if t % 3 == 0:
            del columns["iteration"]
        if t % 5 == 0:
            columns["x"] = pa.array(["a", "b"])
        pq.write_table(pa.table(columns), folder / f"A_{t}.parquet")
    (folder / "A_1x.parquet").write_bytes(b"no footer here")  # between others, and none of them


def plans_of(source):
    plan = tree.plan_scan(source.files(), need_tick=False)
    parts = source.parts(plan)
    got = sorted((r["_file"].rsplit("_", 1)[1], r["agent_id"], str(r["x"])) for _, rows in parts for r in rows.select("_file", "agent_id", "x").collect())
    return got, [rows.select("x")._jdf.queryExecution().optimizedPlan().toString() for _, rows in parts]


@pytest.mark.parametrize("name", ["runs", "my runs, 10%"])
def test_work_of_a_row_does_not_grow_with_the_layouts(spark, tmp_path, name):
    calls = []
    for n in (7, 61):
        folder = tmp_path / f"{name} {n}" if " " in name else tmp_path / f"{name}{n}"
        put_snapshots(folder, range(1, n))
        got, plans = plans_of(tree.Source(spark, str(folder), "A_[0-9]*.parquet", None, None, r"^A_[0-9]+$", True))
        want = [(f"{t}.parquet", i, x) for t in range(1, n) for i, x in ((1, "a" if t % 5 == 0 else f"{t + 0.5}"), (2, "b" if t % 5 == 0 else f"{t + 0.25}"))]
        assert got == sorted(want)
        calls.append(max(p.count("substring_index(") + p.lower().count("regexp") for p in plans))
    assert calls[0] == calls[1]


def test_ranges_by_halves(spark):
    names = [f"f{i:03}" for i in range(200)]
    rows = spark.createDataFrame([(n,) for n in names], "n string")
    inside = tree._within(F.col("n"), [(names[i], names[i + 1]) for i in range(0, 200, 5)])
    assert [r.n for r in rows.where(inside).collect()] == [n for i, n in enumerate(names) if i % 5 < 2]


def test_runs_of_a_set_in_two_layouts(spark, tmp_path):
    """Runs in the order of their names, 1, 10, 11, 2: a stretch takes in no file of another layout."""
    kind = {r: pa.array(["t"]) if r in (2, 10, 19, 20) else pa.array([float(r)]) for r in range(1, 31)}
    for s in (1, 10, 2):
        for r, v in kind.items():
            folder = tmp_path / f"set_{s}" / f"run_{r}"
            folder.mkdir(parents=True)
            pq.write_table(pa.table({"tick": pa.array([r], pa.int32()), "v": v if s != 2 else pa.array([2.0])}), folder / "data_A.parquet")
    source = tree.Source(spark, str(tmp_path), "*A.parquet", None, None, None)
    got = sorted((r["set_num"], r["run_num"], str(r["v"])) for _, rows in source.parts(tree.plan_scan(source.files())) for r in rows.collect())
    assert got == sorted((s, r, "2.0" if s == 2 else str(v[0].as_py())) for s in (1, 10, 2) for r, v in kind.items())
