"""The supplied test tables seen as an ensemble, and file layouts Spark derives from them."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from tickweave.session import scratch_path
from tickweave.sinks.run_files import write_run_files
from tickweave.sources.listing import local_path

# The same adapter for both engines: line number = set, supplier = run, month of shipping = tick.
ENS_SQL = """SELECT CAST(l_linenumber AS SMALLINT) AS set_num, CAST(l_suppkey % 10 + 1 AS SMALLINT) AS run_num,
  CAST((year(l_shipdate) - 1990) * 12 + month(l_shipdate) AS SMALLINT) AS time_step, l_orderkey AS "ID",
  CAST(l_extendedprice AS FLOAT) AS x, CAST(l_quantity AS FLOAT) AS y, l_partkey AS part, l_extendedprice AS price
  FROM lineitem"""
PARAMS_SQL = """SELECT CAST(l_linenumber AS INT) AS set_num, round(avg(l_discount), 6) AS alpha, round(avg(l_tax), 6) AS beta,
  CAST(l_linenumber * l_linenumber AS DOUBLE) AS gamma FROM lineitem GROUP BY l_linenumber"""

TIE = ("part", "price")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_linenumber").cast("smallint").alias("set_num"),
        (F.col("l_suppkey") % 10 + 1).cast("smallint").alias("run_num"),
        ((F.year("l_shipdate") - 1990) * 12 + F.month("l_shipdate")).cast("smallint").alias("time_step"),
        F.col("l_orderkey").alias("ID"),
        F.col("l_extendedprice").cast("float").alias("x"),
        F.col("l_quantity").cast("float").alias("y"),
        F.col("l_partkey").alias("part"),
        F.col("l_extendedprice").alias("price"),
    )


def params(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("l_linenumber")
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(n.cast("int").alias("set_num"))
        .agg(
            F.round(F.avg("l_discount"), 6).alias("alpha"),
            F.round(F.avg("l_tax"), 6).alias("beta"),
            F.max((n * n).cast("double")).alias("gamma"),
        )
    )


_made: dict[tuple, str] = {}


def once(spark: SparkSession, sf_dir: str, what: str, make: Callable[[str], object]) -> str:
    """Path of a derived layout, written once per application and data folder."""
    key = (spark.sparkContext.applicationId, sf_dir, what)
    if key not in _made:
        path = scratch_path(spark, what)
        make(path)
        _made[key] = path
    return _made[key]


def run_tree(spark: SparkSession, sf_dir: str) -> str:
    """``set_<n>/run_<m>/data_Agent.parquet``: tick column ``_ITERATION_NO``, rows in tick order."""
    rows = ens(spark, sf_dir).withColumnRenamed("time_step", "_ITERATION_NO")
    order = ["_ITERATION_NO", "ID", *TIE]
    return once(spark, sf_dir, "tree", lambda p: write_run_files(rows, p, "data_Agent.parquet", order))



def databases(spark: SparkSession, sf_dir: str, odd: bool = False) -> str:
    """One SQLite file per run, flat names, with ``y`` kept as text.

    ``odd`` adds to each set run 11 without tables, run 12 that is no database, and run 13 with a good and a broken file.
    """

    def make(path: str) -> None:
        base = os.path.abspath(local_path(path) or path)
        os.makedirs(base, exist_ok=True)

        def save(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            import sqlite3

            open_dbs: dict[tuple, sqlite3.Connection] = {}
            for batch in batches:
                for (s, r), part in batch.groupby(["set_num", "run_num"]):
                    if (s, r) not in open_dbs:
                        draft = f"{base}/set_{s}_run_{r}_iters.db"
                        con = sqlite3.connect(draft)
                        con.executescript(
                            'DROP TABLE IF EXISTS Agent; CREATE TABLE Agent (_ITERATION_NO INTEGER, "ID" INTEGER, x REAL, y TEXT, part INTEGER, price REAL);'
                        )
                        open_dbs[(s, r)] = con
                    cols = ["time_step", "ID", "x", "y", "part", "price"]
                    open_dbs[(s, r)].executemany("INSERT INTO Agent VALUES (?, ?, ?, ?, ?, ?)", part[cols].astype(object).values.tolist())
            for con in open_dbs.values():
                con.commit()
                con.close()
            yield pd.DataFrame({"n": [len(open_dbs)]})

        def spoil(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            import sqlite3

            for batch in batches:
                for s in batch["set_num"]:
                    for name, sql in ((f"set_{s}_run_11.db", "PRAGMA user_version = 1"), (f"set_{s}_run_13_a.db", "CREATE TABLE Agent AS SELECT 1 AS _ITERATION_NO, 2 AS ID")):
                        con = sqlite3.connect(f"{base}/{name}")
                        con.execute(sql)
                        con.commit()
                        con.close()
                    for name in (f"set_{s}_run_12.db", f"set_{s}_run_13_b.db"):
                        with open(f"{base}/{name}", "wb") as f:
                            f.write(b"this is no database " * 100)
                yield pd.DataFrame({"n": [len(batch)]})

        rows = ens(spark, sf_dir).withColumn("y", F.concat(F.lit(" "), F.col("y").cast("int").cast("string")))
        rows.repartition("set_num", "run_num").sortWithinPartitions("set_num", "run_num").mapInPandas(save, "n int").agg(F.sum("n")).collect()
        if odd:
            rows.select("set_num").distinct().mapInPandas(spoil, "n int").agg(F.sum("n")).collect()

    return once(spark, sf_dir, "odd-databases" if odd else "databases", make)


def archives(spark: SparkSession, sf_dir: str) -> str:
    """One uncompressed tar per set with the run files of :func:`run_tree`."""
    tree = os.path.abspath(local_path(run_tree(spark, sf_dir)) or "")

    def make(path: str) -> None:
        base = os.path.abspath(local_path(path) or path)
        os.makedirs(base, exist_ok=True)

        def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            import tarfile

            for batch in batches:
                for s in batch["set_num"]:
                    with tarfile.open(f"{base}/set_{s}.tar", "w:") as tar:
                        tar.add(f"{tree}/set_{s}", arcname=f"sets/set_{s}", filter=lambda m: None if "/." in m.name else m)
                yield batch[["set_num"]]

        sets = ens(spark, sf_dir).select(F.col("set_num").cast("int").alias("set_num")).distinct()
        sets.repartition("set_num").mapInPandas(pack, "set_num int").collect()

    return once(spark, sf_dir, "tar", make)


def snapshots_xml(spark: SparkSession, sf_dir: str) -> str:
    """One XML state per tick: iteration number, environment, then the agents."""
    rows = ens(spark, sf_dir)
    tick = F.col("time_step").cast("string")
    head = rows.select("time_step").distinct().select(
        "time_step", F.lit(0).alias("place"),
        F.concat(F.lit("<states>\n<itno>"), tick, F.lit("</itno>\n<environment>\n<set_no>0</set_no>\n<const_radius>1.5</const_radius>\n</environment>")).alias("value"),
    )
    foot = rows.select("time_step").distinct().select("time_step", F.lit(2).alias("place"), F.lit("</states>").alias("value"))

    def tag(name: str, c: str):
        return F.concat(F.lit(f"<{name}>"), F.col(c).cast("string"), F.lit(f"</{name}>"))

    body = rows.select(
        "time_step", F.lit(1).alias("place"),
        F.concat(
            F.lit("<xagent>\n<name>Agent</name>\n"), tag("id", "ID"), tag("set_num", "set_num"), tag("run_num", "run_num"),
            tag("part", "part"), tag("x", "x"), tag("y", "y"), tag("price", "price"), F.lit("\n</xagent>"),
        ).alias("value"),
    )

    def make(path: str) -> None:
        lines = head.unionByName(body).unionByName(foot).repartition("time_step").sortWithinPartitions("time_step", "place")
        lines.select("value", "time_step").write.partitionBy("time_step").text(path)

    return once(spark, sf_dir, "xml", make)


def snapshot_files(spark: SparkSession, sf_dir: str, mixed: bool = False) -> str:
    """Simulator output ``Agent_<tick>.parquet``: iteration, agent_id, then variables in double.

    ``mixed`` keeps the ids of odd ticks in 32 bits and leaves the tick out of every third file.
    """

    def make(path: str) -> None:
        base = os.path.abspath(local_path(path) or path)
        os.makedirs(base, exist_ok=True)

        def save(batches: Iterator) -> Iterator[pd.DataFrame]:
            import pyarrow as pa
            import pyarrow.compute as pc
            import pyarrow.parquet as pq

            writers: dict[int, pq.ParquetWriter] = {}
            for batch in batches:
                t = pa.Table.from_batches([batch])
                for tick in t.column("iteration").unique().to_pylist():
                    part = t.filter(pc.equal(t.column("iteration"), tick))
                    if mixed and tick % 2:
                        part = part.set_column(1, "agent_id", part.column("agent_id").cast(pa.int32()))
                    if mixed and tick % 3 == 0:
                        part = part.drop_columns(["iteration"])
                    if tick not in writers:
                        writers[tick] = pq.ParquetWriter(f"{base}/Agent_{tick}.parquet", part.schema)
                    writers[tick].write_table(part)
            for w in writers.values():
                w.close()
            yield pa.RecordBatch.from_pydict({"n": pa.array([len(writers)], pa.int32())})

        rows = ens(spark, sf_dir).select(
            F.col("time_step").cast("int").alias("iteration"), F.col("ID").alias("agent_id"), F.col("part").cast("double").alias("a"),
            F.col("price").alias("b"), F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"),
        )
        rows.repartition("iteration").mapInArrow(save, "n int").agg(F.sum("n")).collect()

    return once(spark, sf_dir, "mixed-snapshots" if mixed else "snapshots", make)
