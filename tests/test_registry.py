"""Every registered query against its SQL on the smallest test tables."""

import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return con


def plain(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple("~" if r[i] is None else repr(float(r[i])) if isinstance(r[i], (int, float)) else str(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_same_rows_as_sql(spark, duck, name):
    df = queries()[name](spark, SF)
    cur = duck.execute(oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    assert plain(df.columns, df.collect()) == plain(cols, cur.fetchall())


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_rows_only(spark, name):
    assert queries()[name](spark, SF).count() > 0


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["set_num", "iteration", "mean_val", "min_val", "max_val"] and df.count() > 0


def test_large_set_numbers_reads_a_range_of_a_whole_tree(spark, monkeypatch):
    from tickweave.plans import registry

    sets, write = [], registry.write_run_files

    def note(rows, *a, **b):
        sets.extend(r[0] for r in rows.select("set_num").distinct().collect())
        return write(rows, *a, **b)

    monkeypatch.setattr(registry, "write_run_files", note)
    got = queries()["large_set_numbers"](spark, SF)
    assert sorted(sets) == list(range(40001, 40008)) and {r[0] for r in got.select("set_num").distinct().collect()} == {40001, 40002, 40003}
