"""Trees, databases, archives, Feather and XML on disk, with the odd files that occur in practice."""

import os
import sqlite3
import tarfile
import warnings

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from circle import circle
from tickweave.operators import audit
from tickweave.plans import jobs
from tickweave.sinks import feather as feather_sink, run_files, tables
from tickweave.sources import feather, footers, listing, params, sqlite_db, tar, tree, xml_states
from tickweave.streaming import incremental


def put(root, s, r, name, **columns):
    folder = root / f"set_{s}" / f"run_{r}"
    folder.mkdir(parents=True, exist_ok=True)
    pq.write_table(pa.table(columns), folder / name)


@pytest.fixture
def odd_tree(tmp_path):
    """Numeric order of folders, other names, other types, no tick, no rows, overflow."""
    i32, f32 = pa.int32(), pa.float32()
    put(tmp_path, 1, 1, "data_Firm.parquet", time_step=pa.array([1, 2], i32), ID=pa.array([7, 8], i32), k=pa.array([1, 40000], i32))
    put(tmp_path, 2, 1, "data_Firm.parquet", time_step=pa.array([1], i32), ID=pa.array([7], i32), k=pa.array([2.5], f32), extra=pa.array(["s"]))
    put(tmp_path, 10, 1, "data_Firm.parquet", iteration=pa.array([1, 2], i32), agent_id=pa.array([5, 6], pa.int64()), k=pa.array([3, 4], pa.int64()))
    put(tmp_path, 10, 2, "data_Firm.parquet", k=pa.array([9, 9], i32))
    put(tmp_path, 10, 3, "data_Firm.parquet", time_step=pa.array([], i32), k=pa.array([], pa.string()))
    put(tmp_path, 2, 2, "data_SmallFirm.parquet", time_step=pa.array([1], i32), ID=pa.array([1], i32), k=pa.array([99], i32))
    put(tmp_path, 2, 3, "data_Firm_iters_0.parquet", time_step=pa.array([1], i32), k=pa.array([99], i32))
    return str(tmp_path)


def test_mixed_files_become_one_table(spark, odd_tree):
    ens = tree.read_tree(spark, odd_tree, "Firm")
    rows = sorted(tuple(r) for r in ens.select("set_num", "run_num", "time_step", "ID", "k").collect())
    assert rows == [(1, 1, 1, 7, 1.0), (1, 1, 2, 8, 40000.0), (2, 1, 1, 7, 2.5), (10, 1, 1, 5, 3.0), (10, 1, 2, 6, 4.0)]
    assert dict(ens.dtypes)["k"] in ("float", "double") and ens.where("extra is not null").count() == 1


def test_ranges_suffix_and_no_match(spark, odd_tree):
    assert {r.set_num for r in tree.read_tree(spark, odd_tree, "Firm", "2-10", "1").collect()} == {2, 10}
    assert tree.read_tree(spark, odd_tree, "Firm", "2", suffix=True).where("k = 99").count() == 1
    with warnings.catch_warnings(record=True) as seen:
        warnings.simplefilter("always")
        assert tree.read_tree(spark, odd_tree, "Bank").count() == 0
        assert tree.read_metric(spark, odd_tree, "Firm", "nope").count() == 0
    assert len(seen) >= 2


def test_one_schema_is_one_scan_with_pruned_files(spark, tmp_path):
    for s in (1, 2):
        for r in (1, 2, 3):
            put(tmp_path, s, r, "data_Agent.parquet", tick=pa.array([1, 2], pa.int32()), v=pa.array([0.5, 1.5]), w=pa.array(["a", "b"]))
    ens = tree.read_tree(spark, str(tmp_path), "Agent", "2", "1-2")
    assert ens.count() == 4 and [r.ID for r in ens.orderBy("run_num", "time_step").collect()] == [0, 1, 0, 1]
    plan = ens.select("v")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Union" not in plan
    read = {r[0] for r in ens.select("run_num").distinct().collect()}
    assert read == {1, 2}
    declared = tree.read_tree(spark, str(tmp_path), "Agent", schema="tick int, v double, w string")
    assert declared.count() == 12


def test_name_with_two_numbers_is_refused(spark, tmp_path):
    put(tmp_path, "1_v2", 1, "data_A.parquet", tick=pa.array([1], pa.int32()))
    with pytest.raises(ValueError):
        listing.set_folders(spark, str(tmp_path))


def test_stride_counts_in_file_order(spark, tmp_path):
    n = 1_000
    put(tmp_path, 1, 4, "data_Eurostat.parquet", _ITERATION_NO=pa.array(np.arange(6020, 26020, 20), pa.int32()), u=pa.array(np.arange(n) / 7.0))
    df = tree.read_metric(spark, str(tmp_path), "Eurostat", "u", stride=10)
    rows = df.orderBy("time_step").collect()
    assert len(rows) == 100 and [r.time_step for r in rows] == list(range(1, 101))
    assert rows[1].tick == 6220 and rows[1].u == np.float32(10 / 7.0)
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_long_runs_do_not_wrap(spark, tmp_path):
    n = 40_000
    put(tmp_path, 1, 1, "data_T.parquet", tick=pa.array(np.arange(n), pa.int32()), v=pa.array(np.zeros(n)))
    assert tree.read_metric(spark, str(tmp_path), "T", "v").agg(F.max("time_step")).first()[0] == n


def test_checkpoint_by_agent_token(spark, tmp_path):
    ens = circle(spark, 2, 1, 2, 10)
    out = str(tmp_path)
    tables.write_checkpoint(ens, out, "Agent")
    tables.write_checkpoint(ens, out, "SmallAgent")
    assert tree.resolve_agent(spark, out, "Agent").count() == 40
    with pytest.raises(ValueError):
        tree.resolve_agent(spark, out, "Bank")
    tables.write_checkpoint(ens, out, "Agent_old")
    with pytest.raises(ValueError):
        tree.resolve_agent(spark, out, "Agent")
    plan = tree.resolve_agent(spark, out, "SmallAgent").where("set_num = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(set_num" in plan


def test_checkpoint_splits_a_hot_set(spark, tmp_path):
    hot = circle(spark, 1, 1, 10, 3_000)
    path = tables.write_checkpoint(hot, str(tmp_path), "Agent", files=6)
    files = os.listdir(os.path.join(path, "set_num=1"))
    assert sum(f.endswith(".parquet") for f in files) >= 5


def test_codecs(spark, tmp_path):
    df = spark.range(10)
    for c in tables.CODECS:
        assert spark.read.parquet(tables.compact(df, str(tmp_path / c), 4, c)).count() == 10
    for bad in ("brotli", "lzo2"):
        with pytest.raises(ValueError):
            tables.compact(df, str(tmp_path / "bad"), 4, bad)


def test_compaction_file_sizes(spark, tmp_path):
    out = tables.compact(spark.range(1_000).repartition(40), str(tmp_path / "c"), 300)
    sizes = [pq.read_metadata(os.path.join(out, f)).num_rows for f in os.listdir(out) if f.endswith(".parquet")]
    assert sum(sizes) == 1_000 and len(sizes) <= 8


def test_materialize_and_reuse(spark, tmp_path):
    path = str(tmp_path / "m")
    tables.materialize(spark.range(5), path)
    assert tables.materialize(spark.range(9), path).count() == 5
    assert tables.materialize(spark.range(9), path, force=True).count() == 9
    with pytest.raises(FileExistsError):
        tables.materialize(spark.range(9), path, reuse=False)


def test_new_and_changed_files(spark, tmp_path):
    put(tmp_path, 1, 1, "data_A.parquet", tick=pa.array([1], pa.int32()))
    seen = str(tmp_path / "seen")
    files = tree.tree_files(spark, str(tmp_path), "data_A.parquet")
    assert tables.new_files(files, seen).count() == 1
    tables.remember_files(files, seen)
    put(tmp_path, 1, 2, "data_A.parquet", tick=pa.array([1, 2], pa.int32()))
    fresh = tables.new_files(tree.tree_files(spark, str(tmp_path), "data_A.parquet"), seen)
    assert [(r.set_num, r.run_num) for r in fresh.collect()] == [(1, 2)]


def test_run_files_mirror_and_report(spark, tmp_path):
    ens = circle(spark, 4, 2, 6, 628).withColumnRenamed("time_step", "_ITERATION_NO").withColumnRenamed("ID", "id")
    root = str(tmp_path / "tree")
    made = run_files.write_run_files(ens, root, "data_Agent.parquet", ["_ITERATION_NO", "id"])
    assert {(r.set_num, r.run_num, r.n_rows, r.status) for r in made.collect()} == {
        (s, r, 6 * 628, "CONVERTED") for s in range(1, 5) for r in (1, 2)
    }
    one = pq.read_table(f"{root}/set_3/run_2/data_Agent.parquet")
    assert one.column_names == ["_ITERATION_NO", "id", "x", "y", "a", "b"]
    ticks = one["_ITERATION_NO"].to_pylist()
    assert ticks == sorted(ticks)

    report = jobs.inspect_tree(spark, root)  # the numbers of the published report for this data set
    assert report.totals.first().asDict() == {"selected_sets": 4, "total_sets": 4, "cells": 8}
    assert all((r.matching_runs, r.total_runs) == (2, 2) for r in report.runs.collect())
    assert all((r.min_tick, r.max_tick, r.n_ticks) == (1, 628, 628) for r in report.timeline.collect())
    assert [r.variable for r in report.schema.orderBy("position").collect()] == ["id", "x", "y", "a", "b"]
    assert not report.schema.where("drift").count() and {r.agent for r in report.agents.collect()} == {"Agent"}
    part = jobs.inspect_tree(spark, root, "2-3", "1")
    assert part.totals.first().asDict() == {"selected_sets": 2, "total_sets": 4, "cells": 2}

    paths = jobs.build_checkpoints(spark, root, str(tmp_path / "out"), "Agent, Bank", "1-2", "1-2")
    assert list(paths) == ["Agent"] and spark.read.parquet(paths["Agent"]).count() == 2 * 2 * 6 * 628


def test_schema_drift_shows(spark, odd_tree):
    rows = footers.schema_manifest(spark, odd_tree).where("agent = 'Firm'").collect()
    assert {(r.variable, r.type) for r in rows} >= {("k", "int32"), ("k", "float"), ("k", "int64"), ("extra", "string")}
    assert all(r.drift for r in rows if r.variable == "k")
    assert not footers.table_files(spark, odd_tree).where("agent like '%iters%'").count()


def test_sensitivity_job(spark, tmp_path):
    root, out = str(tmp_path / "t"), str(tmp_path / "o")
    run_files.write_run_files(circle(spark, 3, 2, 1, 100), root, "data_Macro.parquet", ["time_step"])
    csv = tmp_path / "p.csv"
    csv.write_text("set_num,alpha,beta\nset_1,0.1,5\nset_2,0.2,5\nset_3,0.4,5\n")
    for fmt in ("parquet", "feather"):
        grids = jobs.sensitivity_grids(spark, root, str(csv), "Macro", "x,y", out, "1-3", "1-2", stride=2, format=fmt)
        for m, grid in grids.items():
            inside = tree.read_metric(spark, root, "Macro", m, stride=2).where(f"{m} >= 0").count()
            assert {r.param: r.n for r in grid.groupBy("param").agg(F.sum("n").alias("n")).collect()} == {"alpha": inside, "beta": inside}
    before = os.path.getmtime(f"{out}/x/checkpoint_x.parquet/_SUCCESS")
    jobs.sensitivity_grids(spark, root, str(csv), "Macro", "x", out, reuse=True)
    assert os.path.getmtime(f"{out}/x/checkpoint_x.parquet/_SUCCESS") == before


def test_param_csv(spark, tmp_path):
    csv = tmp_path / "p.csv"
    csv.write_text("set_num,alpha\nset_12,0.5\n3,1.5\n")
    assert sorted(map(tuple, params.read_params(spark, str(csv)).collect())) == [(3, 1.5), (12, 0.5)]


@pytest.fixture
def databases(tmp_path):
    def db(name, *statements):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        with sqlite3.connect(path) as con:
            for s in statements:
                con.execute(s)

    bank = "CREATE TABLE Bank (_ITERATION_NO INTEGER, cash TEXT, note TEXT)"
    db("set_1_run_1_iters.db", bank, "INSERT INTO Bank VALUES (1, ' 1', '1e5'), (2, '', '+3'), (3, NULL, 'x')", "CREATE TABLE Empty (a INTEGER)")
    db("SET_2_RUN_1.sqlite", bank, "INSERT INTO Bank VALUES (1, '-4', 'y')")
    db("set_3/run_7/whatever.sqlite3", "CREATE TABLE Bank (_ITERATION_NO INTEGER, cash REAL)", "INSERT INTO Bank VALUES (1, 2.5)")
    db("set_4_run_1.db", "PRAGMA user_version = 1")
    (tmp_path / "set_5_run_1.db").write_bytes(b"this is no database, just some bytes" * 50)
    return str(tmp_path)


def test_databases(spark, databases):
    got = sqlite_db.ingest_sqlite_tree(spark, databases)
    status = {(r.set_num, r.run_num): r.status for r in got.manifest.collect()}
    assert status == {(1, 1): "CONVERTED", (2, 1): "CONVERTED", (3, 7): "CONVERTED", (4, 1): "EMPTY", (5, 1): "ERROR"}
    assert got.tables() == ["Bank"]
    rows = sorted(tuple(r) for r in got.read("Bank").select("set_num", "run_num", "_ITERATION_NO", "cash").collect())
    assert rows[0] == (1, 1, 1, " 1") and rows[-1] == (3, 7, 1, "2.5") and len(rows) == 5
    ranged = sqlite_db.ingest_sqlite_tree(spark, databases, "1-3", "1")
    assert ranged.manifest.count() == 2


def test_database_conversion(spark, databases, tmp_path):
    out = str(tmp_path / "out")
    tally = {r.status: r.n for r in jobs.convert_databases(spark, databases, out).collect()}
    assert tally == {"CONVERTED": 3, "EMPTY": 1, "ERROR": 1}
    t = pq.read_table(f"{out}/set_1/run_1/data_Bank.parquet")
    assert t["cash"].to_pylist() == [1.0, None, None] and t["note"].to_pylist() == ["1e5", "+3", "x"]


def test_big_database_is_read_in_pieces(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sqlite_db, "ROWS_PER_PIECE", 1_000)
    with sqlite3.connect(tmp_path / "set_1_run_1.db") as con:
        con.execute("CREATE TABLE T (k INTEGER, v REAL)")
        con.executemany("INSERT INTO T VALUES (?, ?)", [(i, i / 2) for i in range(2_500)])
        con.execute("CREATE TABLE W (k INTEGER PRIMARY KEY, v TEXT) WITHOUT ROWID")
        con.execute("INSERT INTO W VALUES (1, 'a'), (2, 'b')")
        con.execute("CREATE TABLE N (k INTEGER, v REAL)")  # a stretch of nulls does not decide a type
        con.executemany("INSERT INTO N VALUES (?, ?)", [(i, None if i < 1_500 else i) for i in range(2_000)])
    got = sqlite_db.ingest_sqlite_tree(spark, str(tmp_path))
    assert dict(got.read("N").dtypes)["v"] == "double" and got.manifest.first()["rows"] == 2_500 + 2 + 2_000
    assert got.read("T").agg(F.count("*"), F.sum("k"), F.sum("v")).first() == (2_500, 3123750, 1561875.0)
    assert sorted(r.v for r in got.read("W").collect()) == ["a", "b"]


def test_column_called_rowid(spark, tmp_path):
    with sqlite3.connect(tmp_path / "set_1_run_1.db") as con:
        con.execute("CREATE TABLE T (RowID INTEGER, v TEXT)")
        con.execute("INSERT INTO T VALUES (1, 'a'), (NULL, 'b'), (3, 'c')")
        con.execute("CREATE TABLE A (rowid INTEGER, _rowid_ INTEGER, oid INTEGER)")
        con.execute("INSERT INTO A VALUES (1, NULL, 2), (NULL, NULL, NULL), (NULL, 5, NULL)")
    got = sqlite_db.ingest_sqlite_tree(spark, str(tmp_path))
    assert sorted(r.v for r in got.read("T").collect()) == ["a", "b", "c"]
    assert got.read("A").count() == 3 and got.manifest.first()["rows"] == 6


def test_broken_stretch_is_no_shorter_table(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sqlite_db, "ROWS_PER_PIECE", 500)
    root, out = tmp_path / "in", tmp_path / "out"
    for name in ("set_1_run_1_a.db", "set_1_run_1_b.db", "set_1_run_2_a.db"):
        root.mkdir(exist_ok=True)
        with sqlite3.connect(root / name) as con:
            con.execute("CREATE TABLE T (k INTEGER, v TEXT)")
            con.executemany("INSERT INTO T VALUES (?, ?)", [(i, "x" * 100) for i in range(2_500)])
    with open(root / "set_1_run_1_a.db", "r+b") as f:  # one page in the middle of the table
        f.seek(30 * 4096)
        f.write(b"\xff" * 4096)
    got = sqlite_db.ingest_sqlite_tree(spark, str(root))
    assert sorted(r.status for r in got.manifest.collect()) == ["CONVERTED", "CONVERTED", "ERROR"]
    with pytest.raises(ValueError, match="set_1_run_1_a.db"):
        got.read("T")
    assert {tuple(r) for r in got.whole_runs().read("T").groupBy("set_num", "run_num").count().collect()} == {(1, 2, 2_500)}
    tally = {r.status: r.n for r in jobs.convert_databases(spark, str(root), str(out)).collect()}
    assert tally == {"CONVERTED": 1, "ERROR": 1, "INCOMPLETE": 1}
    assert not (out / "set_1" / "run_1").exists() and pq.read_table(out / "set_1" / "run_2" / "data_T.parquet").num_rows == 2_500


def test_feather_round_trip(spark, tmp_path):
    df = spark.range(1_000).select("id", F.sin("id").cast("float").alias("v"), F.col("id").cast("string").alias("s")).repartition(5)
    folder = str(tmp_path / "f")
    manifest = feather_sink.write_feather(df, folder)
    assert manifest.agg(F.sum("n_rows")).first()[0] == 1_000
    back = feather.read_feather(spark, folder)
    feather_sink.write_feather(df.coalesce(2), folder)  # a second writing leaves nothing of the first
    assert len([f for f in os.listdir(folder) if f.endswith(".feather")]) == 2
    back = feather.read_feather(spark, folder)
    with pytest.raises(FileExistsError):
        feather_sink.write_feather(df, folder, mode="errorifexists")
    assert back.dtypes == df.dtypes and sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_feather_without_batches(spark, tmp_path):
    schema = pa.schema([("a", pa.int64())])
    with pa.ipc.new_file(str(tmp_path / "e.feather"), schema):
        pass
    with pytest.warns(UserWarning):
        assert feather.read_feather(spark, str(tmp_path)).count() == 0


def test_tar_members(spark, tmp_path):
    for s in (1, 2):
        for r in (1, 2):
            if (s, r) != (2, 2):
                put(tmp_path / "sets", s, r, "data_Eurostat.parquet", _ITERATION_NO=pa.array([1, 2, 3], pa.int32()), u=pa.array([s * 10.0 + r] * 3))
    put(tmp_path / "sets", 1, 1, "data_Other.parquet", z=pa.array([1]))
    with tarfile.open(tmp_path / "all.tar", "w:") as t:
        t.add(tmp_path / "sets", arcname="sets")
    rows = tar.read_tar_tree(spark, str(tmp_path / "all.tar"), "data_Eurostat.parquet", "1-2", "1-2")
    assert rows.count() == 9 and {(r.set_num, r.run_num, r.u) for r in rows.collect()} == {(1, 1, 11.0), (1, 2, 12.0), (2, 1, 21.0)}
    assert [tuple(r) for r in audit.missing_cells(rows, "1-2", "1-2").collect()] == [(2, 2)]


XML = """<states>
<itno>{t}</itno>
<environment>
<set_no>0</set_no>
<const_radius>1.5</const_radius>
</environment>
{agents}
</states>
"""


def test_xml_states(spark, tmp_path):
    for t in (0, 10):
        agents = "".join(f"<xagent>\n<name>{n}</name>\n<id>{i}</id><x>{i}.5</x>\n</xagent>\n" for i, n in enumerate(["Agent", "Agent", "Bank"]))
        (tmp_path / f"{t}.xml").write_text(XML.format(t=t, agents=agents))
    rows = xml_states.read_xml_snapshots(spark, str(tmp_path / "*.xml"))
    assert rows.count() == 6 and dict(rows.dtypes)["x"] == "double"
    only = xml_states.read_xml_snapshots(spark, str(tmp_path / "*.xml"), "Agent")
    assert {(r.itno, r.id, r.env.const_radius) for r in only.collect()} == {(t, i, 1.5) for t in (0, 10) for i in (0, 1)}


def test_snapshot_files(spark, tmp_path):
    for t in (1, 2, 10):
        pq.write_table(pa.table({"iteration": pa.array([t] * 2, pa.int32()), "agent_id": [1, 2], "x": [0.5, 1.5]}), tmp_path / f"Agent_{t}.parquet")
    pq.write_table(pa.table({"iteration": pa.array([1], pa.int32())}), tmp_path / "AgentX_1.parquet")
    assert sorted({r.iteration for r in tree.read_snapshots(spark, str(tmp_path), "Agent").collect()}) == [1, 2, 10]


def test_only_new_files_are_ingested(spark, tmp_path):
    root, out, state = tmp_path / "t", str(tmp_path / "o"), str(tmp_path / "s")

    def one(s, r, value):
        put(root, s, r, "data_A.parquet", tick=pa.array([1, 2], pa.int32()), ID=pa.array([1, 1], pa.int64()), v=pa.array([value, value]))

    def step():
        rows = incremental.stream_tree(spark, f"{root}/set_*/run_*/data_A.parquet", "tick int, ID bigint, v double")
        incremental.ingest_new(rows, out, state).awaitTermination()
        band = incremental.stream_tree(spark, f"{root}/set_*/run_*/data_A.parquet", "tick int, ID bigint, v double")
        incremental.keep_band(band, "v", str(tmp_path / "b"), str(tmp_path / "bs")).awaitTermination()

    one(1, 1, 1.0)
    step()
    assert spark.read.parquet(out).count() == 2
    one(1, 2, 3.0)  # a late run of the same ticks
    one(2, 1, 5.0)
    step()
    assert spark.read.parquet(out).count() == 6
    got = {(r.set_num, r.iteration): (r.mean_val, r.min_val, r.max_val, r.n) for r in incremental.read_band(spark, str(tmp_path / "b")).collect()}
    assert got == {(1, 1): (2.0, 1.0, 3.0, 2), (1, 2): (2.0, 1.0, 3.0, 2), (2, 1): (5.0, 5.0, 5.0, 1), (2, 2): (5.0, 5.0, 5.0, 1)}


def test_long_runs_can_be_split_over_files(spark, tmp_path):
    ens = circle(spark, 1, 1, 2, 100)
    made = run_files.write_run_files(ens, str(tmp_path), "data_Agent.parquet", ["time_step", "ID"], ticks_per_file=30)
    assert sorted(r.n_rows for r in made.collect()) == [22, 58, 60, 60]
    assert sorted(os.listdir(tmp_path / "set_1" / "run_1"))[-1] == "3_data_Agent.parquet"
    back = tree.read_tree(spark, str(tmp_path), "Agent")
    assert back.count() == 200 and back.agg(F.count_distinct("time_step")).first()[0] == 100


def test_view_filters_reach_the_scan(spark, tmp_path):
    from tickweave.operators import series

    tables.write_checkpoint(tree_like(spark), str(tmp_path), "Agent")
    view = series.snapshot(tree.resolve_agent(spark, str(tmp_path), "Agent"), "x", [1, 3], {"start": 5, "stop": 9, "step": 1})
    plan = view._jdf.queryExecution().executedPlan().toString()
    assert "set_num" in plan.split("PartitionFilters: ")[1].split("]")[0]
    assert "GreaterThanOrEqual(time_step,5)" in plan and "LessThanOrEqual(time_step,9)" in plan
    assert plan.split("ReadSchema: ")[1].startswith("struct<time_step:smallint,x:float>")


def tree_like(spark):
    from tickweave.operators.shaping import downcast

    return downcast(circle(spark, 3, 1, 2, 20), "checked")


def test_command_line(spark, tmp_path, databases):
    import json

    from tickweave.__main__ import main

    out = tmp_path / "cli"
    main(["convert", "-i", databases, "-o", str(out / "tree")])
    main(["etl", "-i", str(out / "tree"), "-o", str(out / "chk"), "--agent-types", "Bank", "--sets", "1-2", "--runs", "1-1", "--mode", "widen"])
    assert spark.read.parquet(str(out / "chk" / "checkpoint_Bank.parquet")).count() == 4
    spec = {"comparison_sets": ["set_1", "set_2"], "time_variable": "time_step",
            "plots": [{"plot_style": "time_series", "agent_type": "Bank", "variable_name": "cash", "output_filename": "cash.png"}]}
    (out / "views.json").write_text(json.dumps(spec))
    main(["views", "-i", str(out / "chk"), "-o", str(out / "views"), "-c", str(out / "views.json")])
    assert spark.read.parquet(str(out / "views" / "cash.png.parquet")).count() == 4
    main(["inspect", "-i", str(out / "tree"), "-o", str(out / "report")])
    assert spark.read.option("header", "true").csv(str(out / "report" / "totals")).first()["cells"] == "3"
    main(["to-feather", "-i", str(out / "chk" / "checkpoint_Bank.parquet"), "-o", str(out / "f")])
    main(["from-feather", "-i", str(out / "f"), "-o", str(out / "back"), "--compression", "gzip"])
    assert spark.read.parquet(str(out / "back")).count() == 4
    (out / "p.csv").write_text("set_num,alpha\n1,0.5\n2,0.7\n3,0.9\n")
    main(["sensitivity", "-i", str(out / "tree"), "-o", str(out / "gsa"), "--parameters", str(out / "p.csv"), "--table", "Bank", "--metric", "cash"])
    assert spark.read.parquet(str(out / "gsa" / "cash" / "density_cash.parquet")).agg(F.sum("n")).first()[0] >= 2


def test_rejects_are_reported(spark, tmp_path):
    rows = spark.createDataFrame([(1, 1, 1, 5, 70000), (1, 1, 2, 40000, 7), (2, 1, 1, 6, 8)], "set_num int, run_num int, time_step int, ID bigint, v int")
    root = str(tmp_path / "tree")
    run_files.write_run_files(rows, root, "data_Agent.parquet", ["time_step"])
    for mode, lost in (("widen", 0), ("checked", 1)):
        out = str(tmp_path / mode)
        paths = jobs.build_checkpoints(spark, root, out, "Agent", mode=mode)
        assert spark.read.parquet(paths["Agent"]).where("v is null").count() == lost
        assert jobs.reject_totals(spark, out, "Agent")["v"] == lost and jobs.reject_totals(spark, out, "Agent")["rows"] == 3


def test_null_keys_do_not_swallow_other_runs(spark, tmp_path):
    rows = spark.createDataFrame([(None, None, 0, 1), (1, 1, 0, 2), (1, 1, 1, 3), (2, 5, 0, 4)], "set_num int, run_num int, time_step int, v int")
    root = str(tmp_path / "tree")
    files = run_files.write_run_files(rows.coalesce(1), root, "data_A.parquet", ["time_step"])
    assert {(r.set_num, r.run_num, r.n_rows) for r in files.collect()} == {(None, None, 1), (1, 1, 2), (2, 5, 1)}
    held = {(r.set_num, r.run_num): pq.read_table(r.path)["v"].to_pylist() for r in files.collect()}
    assert held == {(None, None): [1], (1, 1): [2, 3], (2, 5): [4]}


def test_row_groups_of_run_files_are_large(spark, tmp_path):
    rows = spark.range(40_000).selectExpr("1 AS set_num", "1 AS run_num", "id AS time_step", "id * 2.5D AS v")
    path = run_files.write_run_files(rows, str(tmp_path), "data_A.parquet", ["time_step"]).first().path
    assert pq.ParquetFile(path).num_row_groups == 1 and pq.read_table(path)["time_step"].to_pylist() == list(range(40_000))


def test_columns_of_later_snapshots(spark, tmp_path):
    for name, sql in (("A_1", "1 AS tick, 2 AS a"), ("A_2", "2 AS tick, 3 AS a, 4 AS b")):
        spark.sql(f"SELECT {sql}").toPandas().to_parquet(tmp_path / f"{name}.parquet")
    assert sorted((r.tick, r.a, r.b) for r in tree.read_snapshots(spark, str(tmp_path), "A").collect() if r.b) == [(2, 3, 4)]


@pytest.mark.parametrize("rows", (30, 1000))
def test_compacted_order(spark, tmp_path, rows):
    df = spark.range(200).selectExpr("199 - id AS time_step", "1 AS set_num", "1 AS run_num", "id AS v").repartition(7)
    tables.compact(df, str(tmp_path / "c"), rows)
    files = sorted((tmp_path / "c").glob("*.parquet"))

    assert [t for f in files for t in pq.read_table(f)["time_step"].to_pylist()] == list(range(200))
