"""The ledger of a conversion."""

import sqlite3

import pytest
from pyspark.sql import functions as F

from tickweave.plans import jobs
from tickweave.sources import listing, tree


@pytest.fixture
def databases(tmp_path):
    def db(name, rows):
        path = tmp_path / "in" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        with sqlite3.connect(path) as con:
            con.execute("PRAGMA user_version = 1")  # so that no file is of zero bytes
            if rows is not None:
                con.execute("CREATE TABLE Bank (_ITERATION_NO INTEGER, cash TEXT)")
                con.executemany("INSERT INTO Bank VALUES (?, ?)", rows)
        con.close()

    db("set_1_run_1_iters.db", [(1, "5"), (2, "6")])
    db("old/set_1_run_1.db", [(1, "7")])
    db("old/set_2/run_3/a.sqlite", [(4, "8")])
    db("set_3_run_1.db", None)
    db("set_4_run_1_a.db", [(1, "1")])
    (tmp_path / "in" / "set_4_run_1_b.db").write_bytes(b"no database " * 100)
    return str(tmp_path / "in")


def outcome(spark, out):
    rows = spark.read.parquet(f"{out}/{jobs.LEDGER}").collect()
    return {r.path.split("/in/")[1]: (r.folder, r.set_num, r.run_num, r.status, r.rows_written) for r in rows}


def test_every_outcome(spark, databases, tmp_path):
    out = str(tmp_path / "out")
    tally = {r.status: r.n for r in jobs.convert_databases(spark, databases, out, by_folder=True).collect()}
    first = {
        "set_1_run_1_iters.db": ("", 1, 1, "CONVERTED", 2), "old/set_1_run_1.db": ("old", 1, 1, "CONVERTED", 1), "old/set_2/run_3/a.sqlite": ("old", 2, 3, "CONVERTED", 1),
        "set_3_run_1.db": ("", 3, 1, "EMPTY", 0), "set_4_run_1_a.db": ("", 4, 1, "INCOMPLETE", 0), "set_4_run_1_b.db": ("", 4, 1, "ERROR", 0),
    }
    assert outcome(spark, out) == first and tally == {"CONVERTED": 3, "EMPTY": 1, "INCOMPLETE": 1, "ERROR": 1}
    cash = lambda root: sorted((r.set_num, r.run_num, r.cash) for r in tree.read_tree(spark, root, "Bank").collect())
    assert cash(out) == [(1, 1, 5), (1, 1, 6)] and cash(f"{out}/old") == [(1, 1, 7), (2, 3, 8)]
    jobs.convert_databases(spark, databases, out, by_folder=True)
    assert outcome(spark, out) == {k: (*v[:3], "SKIPPED", 0) if v[3] == "CONVERTED" else v for k, v in first.items()}
    jobs.convert_databases(spark, databases, out, by_folder=True, force=True)
    assert outcome(spark, out) == first


def test_one_run_from_several_folders(spark, databases, tmp_path):
    out = str(tmp_path / "one")
    jobs.convert_databases(spark, databases, out, "1")
    got = outcome(spark, out)
    assert got == {"set_1_run_1_iters.db": ("", 1, 1, "CONVERTED", 3), "old/set_1_run_1.db": ("old", 1, 1, "CONVERTED", 3)}
    assert tree.read_tree(spark, out, "Bank").count() == 3


def test_source_folders(spark):
    paths = {"file:///r/x/set_1_run_2.db": "", "file:/r/x/a/b/set_1_run_2.db": "a/b", "/r/x/a/set_1/run_2/z.db": "a", "/r/x/SET_1/b/run_2/z.db": ""}
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    assert {r.p: r.f for r in df.select("p", listing.source_folder(F.col("p"), "/r/x/").alias("f")).collect()} == paths
