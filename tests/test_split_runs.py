"""Runs split over several files, files left out, and trees whose files differ."""

import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from circle import circle
from tickweave.operators import audit
from tickweave.plans import jobs
from tickweave.sinks import run_files
from tickweave.sources import footers, tree

I32, I64 = pa.int32(), pa.int64()


def put(root, s, r, name, **columns):
    folder = root / f"set_{s}" / f"run_{r}"
    folder.mkdir(parents=True, exist_ok=True)
    pq.write_table(pa.table(columns), folder / name)


@pytest.fixture
def two_trees(spark, tmp_path):
    """The same rows, a file per run and ten or more pieces per run."""
    rows = circle(spark, 2, 2, 3, 120).select("set_num", "run_num", "time_step", "x", "a")
    for name, ticks in (("whole", None), ("split", 11)):
        run_files.write_run_files(rows, str(tmp_path / name), "data_Agent.parquet", ["time_step", "x", "a"], ticks_per_file=ticks)
    return str(tmp_path / "whole"), str(tmp_path / "split")


def test_split_and_whole_runs_read_alike(spark, two_trees):
    whole, split = two_trees
    assert len(os.listdir(f"{split}/set_1/run_1")) > 10  # so that 10 must come after 9, not after 1
    shape = lambda df: sorted(map(tuple, df.collect()))
    by_tree = [shape(tree.read_tree(spark, p, "Agent")) for p in two_trees]
    assert by_tree[0] == by_tree[1] and sorted(r[3] for r in by_tree[1] if r[:2] == (1, 1)) == list(range(360))
    declared = [shape(tree.read_tree(spark, p, "Agent", schema="time_step int, x double, a double")) for p in two_trees]
    assert declared[0] == declared[1] and len(declared[1]) == len(by_tree[1])
    for stride in (1, 7):
        metric = [shape(tree.read_metric(spark, p, "Agent", "x", "1-2", "2", stride)) for p in two_trees]
        assert metric[0] == metric[1] and len(metric[0]) == 2 * -(-360 // stride)
    census = [shape(audit.agent_census(footers.table_files(spark, p))) for p in two_trees]
    assert census[0] == census[1] == [(1, "Agent", 2), (2, "Agent", 2)]
    manifest = [shape(footers.schema_manifest(spark, p)) for p in two_trees]
    assert manifest[0] == manifest[1] and not any(r[-1] for r in manifest[1])
    assert footers.table_files(spark, split).where("piece IS NULL").count() == 0
    assert jobs.inspect_tree(spark, split).totals.first()["cells"] == 4


def test_pieces_need_no_shuffle(spark, two_trees):
    plan = tree.read_metric(spark, two_trees[1], "Agent", "x")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("FileScan") <= 2


def test_negative_and_missing_pieces(spark, tmp_path):
    for piece, ticks in ((-2, [-40, -39]), (10, [200]), (9, [180, 181])):
        put(tmp_path, 1, 1, f"{piece}_data_A.parquet", tick=pa.array(ticks, I32), v=pa.array([float(t) for t in ticks]))
    put(tmp_path, 1, 1, "0_data_A.parquet", tick=pa.array([], I32), v=pa.array([], pa.float64()))
    put(tmp_path, 1, 1, "0_data_BA.parquet", tick=pa.array([5], I32), v=pa.array([5.0]))
    rows = sorted((r.time_step, r.tick, r.v) for r in tree.read_metric(spark, str(tmp_path), "A", "v").collect())
    assert rows == [(1, -40, -40.0), (2, -39, -39.0), (3, 180, 180.0), (4, 181, 181.0), (5, 200, 200.0)]
    assert sorted((r.ID, r.time_step) for r in tree.read_tree(spark, str(tmp_path), "A").collect()) == [(0, -40), (1, -39), (2, 180), (3, 181), (4, 200)]


def odd_files(root):
    put(root, 1, 1, "data_A.parquet", tick=pa.array([1, 2], I32), v=pa.array([1, 2], I32))
    put(root, 1, 2, "data_A.parquet", tick=pa.array([1], I32), v=pa.array(["word"]))
    put(root, 1, 3, "data_A.parquet", tick=pa.array([1], I32), v=pa.array([3], I64))
    put(root, 1, 4, "data_A.parquet", v=pa.array([9, 9, 9], I32))
    put(root, 1, 5, "data_A.parquet", tick=pa.array([], I32), v=pa.array([], I32))
    put(root, 1, 6, "data_A.parquet", tick=pa.array([1], I32), w=pa.array([7], I32))
    put(root, 2, 1, "data_A.parquet", tick=pa.array([4], I32), v=pa.array(["other"]))
    put(root, 2, 2, "data_A.parquet", tick=pa.array([5], I32), v=pa.array(["names"]))


def test_ledger_lists_what_is_left_out(spark, tmp_path):
    odd_files(tmp_path)
    ledger = tree.read_metric_ledgered(spark, str(tmp_path), "A", "w")[1]
    assert {(r.set_num, r.run_num): (r.n_rows, r.reason) for r in ledger.collect()} == {
        (1, 1): (2, "no column w"), (1, 2): (1, "no column w"), (1, 3): (1, "no column w"), (1, 4): (3, "no column w"), (1, 5): (0, "no rows"),
        (2, 1): (1, "no column w"), (2, 2): (1, "no column w"),
    }
    folder = tmp_path / "set_1" / "run_1"
    (folder / "data_B.parquet").write_bytes(b"no footer here")
    put(tmp_path, 1, 2, "data_B.parquet", tick=pa.array([1], I32), v=pa.array([1.5]))
    put(tmp_path, 1, 4, "data_B.parquet", v=pa.array([9.0]))
    with pytest.raises(Exception, match="no readable Parquet footer"):
        tree.read_tree(spark, str(tmp_path), "B")
    reading = tree.read_ledgered(spark, str(tmp_path), "B", skip_unreadable=True)
    assert [tuple(r) for r in reading.rows.collect()] == [(1, 2, 1, 0, 1.5)]
    assert {(r.run_num, r.n_rows, r.reason) for r in reading.ledger.collect()} == {(1, None, "not readable"), (4, 1, "no tick column")}
    out = str(tmp_path / "out")
    jobs.build_checkpoints(spark, str(tmp_path), out, "B", skip_unreadable=True)
    assert {tuple(r) for r in jobs.skip_totals(spark, out, "B").collect()} == {("not readable", 1, None), ("no tick column", 1, 1)}
    assert tree.resolve_agent(spark, out, "B").count() == 1


def test_two_layouts_in_one_folder(spark, tmp_path):
    """Text and numbers under one name: each scan must open its own files only, and no list of paths is made."""
    odd_files(tmp_path)
    for r in range(10, 40):  # a longer stretch of text files between numbers
        put(tmp_path, 1, r, "data_A.parquet", tick=pa.array([r], I32), v=pa.array([f"t{r}"] if r < 30 else [r], None if r < 30 else I32))
    source = tree.Source(spark, str(tmp_path), "*A.parquet", None, None, None)
    plan = tree.plan_scan(source.files())
    assert not plan.whole and not hasattr(plan, "paths")
    assert len(plan.stretches()) <= 8  # by change of layout, not by file
    parts = source.parts(plan)
    seen = {(r.set_num, r.run_num, r.tick, str(r.v)) for g, rows in parts if "v" in g.columns for r in rows.select("set_num", "run_num", "tick", F.col("v").cast("string").alias("v")).collect()}
    want = {(1, 1, 1, "1"), (1, 1, 2, "2"), (1, 2, 1, "word"), (1, 3, 1, "3"), (2, 1, 4, "other"), (2, 2, 5, "names"), (1, 6, 1, "None")}
    assert want - {(1, 6, 1, "None")} | {(1, r, r, f"t{r}" if r < 30 else str(r)) for r in range(10, 40)} == {x for x in seen if x[3] != "None"}
    assert sum(rows.count() for _, rows in parts) == 7 + 30
    numbers = tree.read_metric(spark, str(tmp_path), "A", "w")
    assert [(r.run_num, r.w) for r in numbers.collect()] == [(6, 7.0)]


def test_excluded_tables(spark, tmp_path):
    odd_files(tmp_path)
    put(tmp_path, 1, 1, "data_A_iters_1.parquet", tick=pa.array([1], I32))
    put(tmp_path, 1, 1, "3_data_A_iters_1.parquet", tick=pa.array([1], I32))
    put(tmp_path, 1, 2, "log.parquet", tick=pa.array([1], I32))
    put(tmp_path, 1, 2, "7_data_A.parquet", tick=pa.array([1], I32))
    (tmp_path / "set_1" / "run_2" / "data_notes.txt").write_text("x")
    out = {(os.path.basename(r.path), r.reason) for r in footers.excluded_tables(spark, str(tmp_path)).collect()}
    assert out == {("data_A_iters_1.parquet", "helper table"), ("3_data_A_iters_1.parquet", "helper table"), ("log.parquet", "not named data_*"), ("data_notes.txt", "not Parquet")}
    assert not footers.table_files(spark, str(tmp_path)).where("path LIKE '%iters%' OR path LIKE '%log%'").count()


def test_no_second_read_where_nothing_can_be_lost(spark, tmp_path):
    put(tmp_path, 1, 1, "data_A.parquet", tick=pa.array([1, 2], I32), ID=pa.array([1, 2], I64), v=pa.array([70000, 7], I64))
    calm = tree.read_ledgered(spark, str(tmp_path), "A")
    assert [tuple(r) for r in calm.rejects.select("set_num", "run_num", "rows", "time_step", "ID", "v").collect()] == [(1, 1, 2, 0, 0, 0)]
    assert "data_A" not in calm.rejects._jdf.queryExecution().executedPlan().toString()
    strict = tree.read_ledgered(spark, str(tmp_path), "A", mode="checked")
    assert strict.rejects.first()["v"] == 1
