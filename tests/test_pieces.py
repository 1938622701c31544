"""User functions on pieces of bounded size, combined as a tree; snapshots with coordinates."""

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tickweave.operators.per_run import per_run
from tickweave.sources import tree

SCHEMA = "set_num int, run_num int, rows long, total double, first long, last long, most long"


def functions():
    """Made inside a function, so that workers get them by value."""

    def run_of(pdf):
        """Set and run as whole numbers or null, which pandas would make NaN."""
        return {c: pd.array([None if pd.isna(pdf[c].iloc[0]) else int(pdf[c].iloc[0])], "Int32") for c in ("set_num", "run_num")}

    def part(pdf):
        return pd.DataFrame({**run_of(pdf), "rows": len(pdf), "total": pdf.x.sum(), "first": pdf.ID.iloc[0], "last": pdf.ID.iloc[-1], "most": len(pdf)})

    def whole(pdf):
        """Associative, and not commutative in first and last."""
        return pd.DataFrame({**run_of(pdf), "rows": pdf.rows.sum(), "total": pdf.total.sum(), "first": pdf["first"].iloc[0], "last": pdf["last"].iloc[-1], "most": max(pdf.most.max(), len(pdf))})

    return part, whole


part, whole = functions()


@pytest.fixture
def hot(spark):
    """Run 1 is one tick of 20,000 agents, run 2 has few rows, and some rows have no run."""
    one = spark.range(20_000).selectExpr("1 AS set_num", "1 AS run_num", "5 AS time_step", "id AS ID", "1.0D AS x")
    two = spark.range(90).selectExpr("1 AS set_num", "2 AS run_num", "int(id / 30) AS time_step", "id AS ID", "2.0D AS x")
    none = spark.range(2_000).selectExpr("1 AS set_num", "int(NULL) AS run_num", "7 AS time_step", "id AS ID", "3.0D AS x")
    return one.union(two).union(none).repartition(5)


@pytest.mark.parametrize("rows,fan", [(1_000_000, 64), (700, 64), (700, 2), (700, 5)])
def test_one_tick_of_many_agents(spark, hot, rows, fan):
    got = {r.run_num: r for r in per_run(hot, part, SCHEMA, whole, rows_per_piece=rows, fan_in=fan).collect()}
    assert {k: (r.rows, r.total, r["first"], r["last"]) for k, r in got.items()} == {
        1: (20_000, 20_000.0, 0, 19_999), 2: (90, 180.0, 0, 89), None: (2_000, 6_000.0, 0, 1_999),
    }
    assert max(r.most for r in got.values()) <= max(rows, 90, fan)


def test_pieces_are_spread_and_bounded(spark, hot):
    pieces = per_run(hot, part, SCHEMA, rows_per_piece=700).collect()
    assert max(p.rows for p in pieces) <= 700 and sum(p.rows for p in pieces) == 22_090
    assert sorted((p["first"], p["last"]) for p in pieces if p.run_num == 1) == [(k, min(k + 699, 19_999)) for k in range(0, 20_000, 700)]
    assert per_run(hot.limit(0), part, SCHEMA, whole, rows_per_piece=700).count() == 0


def test_snapshots_with_coordinates(spark, tmp_path):
    def put(s, r, t, **columns):
        folder = tmp_path / f"set_{s}" / f"run_{r}"
        folder.mkdir(parents=True, exist_ok=True)
        pq.write_table(pa.table(columns), folder / f"A_{t}.parquet")

    put(1, 1, 9, iteration=pa.array([9, 9], pa.int32()), agent_id=pa.array([4, 5], pa.int32()), x=pa.array([0.5, 1.5]))
    put(1, 1, 10, iteration=pa.array([10], pa.int64()), agent_id=pa.array([2**40], pa.int64()), x=pa.array([2.5], pa.float32()))
    put(1, 2, 9, agent_id=pa.array([6], pa.int64()), x=pa.array([3.5]), y=pa.array(["s"]))
    put(2, 1, 9, iteration=pa.array([9, 9], pa.int32()), x=pa.array([4.5, 5.5]))
    put(2, 1, 11, iteration=pa.array([], pa.int32()), x=pa.array([], pa.float64()))
    put(2, 1, "11x", iteration=pa.array([1], pa.int32()), x=pa.array([9.0]))
    read = tree.read_snapshot_tree(spark, str(tmp_path), "A")
    rows = sorted((r.set_num, r.run_num, r.time_step, r.ID, r.x, r.y) for r in read.rows.collect())
    assert rows == [(1, 1, 9, 4, 0.5, None), (1, 1, 9, 5, 1.5, None), (1, 1, 10, 2**40, 2.5, None), (1, 2, 9, 6, 3.5, "s"), (2, 1, 9, 0, 4.5, None), (2, 1, 9, 1, 5.5, None)]
    assert read.rows.columns == ["set_num", "run_num", "time_step", "ID", "x", "y"]
    assert [(r.set_num, r.n_rows, r.reason) for r in read.ledger.collect()] == [(2, 0, "no rows")]
    assert tree.read_snapshot_tree(spark, str(tmp_path), "A", "1", "2").rows.count() == 1
    flat = tree.read_snapshot_tree(spark, str(tmp_path / "set_1" / "run_1"), "A", flat=True).rows
    assert sorted((r.set_num, r.time_step, r.ID) for r in flat.collect()) == [(None, 9, 4), (None, 9, 5), (None, 10, 2**40)]
    put(1, 1, 12, iteration=pa.array([12, 13], pa.int32()), agent_id=pa.array([4, 5], pa.int32()), x=pa.array([0.5, 1.5]))
    with pytest.raises(Exception, match="holds tick 13"):
        tree.read_snapshot_tree(spark, str(tmp_path), "A").rows.agg(F.sum("time_step")).collect()
