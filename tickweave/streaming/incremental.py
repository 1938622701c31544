"""Keeping a checkpoint and its band up to date while a simulation still writes files.

Ticks are logical integers and a late run simply updates its tick, so there is no watermark; the state of
the band is one small row per (set, tick).
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tickweave.operators.shaping import canonicalize, downcast
from tickweave.sources.listing import children, read_text, remove_matching, run_of_path, set_of_path, write_text


def stream_tree(spark: SparkSession, glob: str, schema: StructType | str, mode: str = "widen", max_files: int = 5_000) -> DataFrame:
    """Canonical rows of the run files matching ``glob``, as a stream; coordinates come from the path."""
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(glob)
    path = F.col("_metadata.file_path")
    own = [F.col(f"`{c}`") for c in rows.columns if c not in ("set_num", "run_num")]
    rows = rows.select(
        set_of_path(path).alias("set_num"), run_of_path(path).alias("run_num"), *own,
        F.col("_metadata.row_index").alias("_row"),
    )
    return downcast(canonicalize(rows, F.col("_row")).drop("_row"), mode)


def ingest_new(rows: DataFrame, out: str, state: str) -> StreamingQuery:
    """Append everything that is new to the checkpoint at ``out`` and stop; ``state`` remembers what was read."""
    return (
        rows.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", state)
        .partitionBy("set_num")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def running_band(rows: DataFrame, v: str, tick: str = "time_step") -> DataFrame:
    """Streaming mean, min and max per (set, tick)."""
    c = F.col(v)
    return rows.groupBy("set_num", F.col(tick).alias("iteration")).agg(
        F.avg(c).alias("mean_val"), F.min(c).alias("min_val"), F.max(c).alias("max_val"), F.count(c).alias("n")
    )


FAN_IN = 8


class BandStore:
    """Changed rows of a band in levels, so that reading looks at few files however many batches there were.

    Every batch is a run of level 0. ``fan_in`` runs of one level are merged into one run of the next, which keeps the latest
    row of each (set, tick); so there are fewer than ``fan_in`` runs a level, and levels grow with the logarithm of the
    batches. A pointer file names the live runs. It is written beside its place and moved there once the runs it names are
    complete: a writer that dies at any time leaves the last pointer, and all its runs, as they were. Runs that a pointer
    no longer names are deleted one pointer later, for readers that still have the one before.
    """

    def __init__(self, spark: SparkSession, out: str, fan_in: int = FAN_IN):
        if fan_in < 2:
            raise ValueError("runs are merged two at a time at least")
        self.spark, self.out, self.fan_in = spark, out.rstrip("/"), fan_in

    def _pointers(self) -> list[int]:
        names = children(self.spark, f"{self.out}/_live", folders=False)
        return sorted(int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit())

    def live(self) -> dict:
        """``version``, ``runs`` (``path, level, first, last``: a folder and its batches) and ``retired`` folders."""
        versions = self._pointers()
        if not versions:
            return {"version": 0, "runs": [], "retired": []}
        return json.loads(read_text(self.spark, f"{self.out}/_live/{versions[-1]}.json"))

    def _point(self, state: dict, runs: list[dict], retired: list[str]) -> dict:
        new = {"version": state["version"] + 1, "runs": runs, "retired": retired}
        write_text(self.spark, f"{self.out}/_live/{new['version']}.json", json.dumps(new))
        for path in state["retired"]:
            remove_matching(self.spark, self.out, path)
        for version in self._pointers()[:-2]:
            remove_matching(self.spark, f"{self.out}/_live", f"{version}.json")
        return new

    def _rows(self, runs: list[dict]) -> DataFrame:
        return self.spark.read.parquet(*[f"{self.out}/{r['path']}" for r in runs])

    def add(self, changed: DataFrame, batch: int) -> None:
        """Takes the rows ``set_num, iteration, ...`` that a batch changed. A batch that is already in is passed over."""
        state = self.live()
        if any(r["first"] <= batch <= r["last"] for r in state["runs"]):
            return
        run = {"path": f"level-0-batch-{batch}", "level": 0, "first": batch, "last": batch}
        changed.withColumn("batch", F.lit(batch).cast("bigint")).write.mode("overwrite").parquet(f"{self.out}/{run['path']}")
        state = self._point(state, [*state["runs"], run], [])
        level = 0
        while len(full := [r for r in state["runs"] if r["level"] == level]) >= self.fan_in:
            level += 1
            first, last = min(r["first"] for r in full), max(r["last"] for r in full)
            run = {"path": f"level-{level}-batch-{first}-{last}", "level": level, "first": first, "last": last}
            latest(self._rows(full)).write.mode("overwrite").parquet(f"{self.out}/{run['path']}")
            state = self._point(state, [*[r for r in state["runs"] if r not in full], run], [r["path"] for r in full])

    def read(self) -> DataFrame:
        return latest(self._rows(self.live()["runs"])).drop("batch")


def latest(rows: DataFrame) -> DataFrame:
    """The row of the latest batch for each (set, tick)."""
    values = [c for c in rows.columns if c not in ("set_num", "iteration", "batch")]
    newest = rows.groupBy("set_num", "iteration").agg(F.max_by(F.struct(*values), F.col("batch")).alias("s"), F.max("batch").alias("batch"))
    return newest.select("set_num", "iteration", "s.*", "batch")


def keep_band(rows: DataFrame, v: str, out: str, state: str, tick: str = "time_step", fan_in: int = FAN_IN) -> StreamingQuery:
    """Update mode: every trigger adds the changed (set, tick) rows to the :class:`BandStore` at ``out``.

    A batch that is repeated after a failure overwrites its own run. :func:`read_band` gives the latest row of each (set, tick).
    """

    def save(changed: DataFrame, batch: int) -> None:
        BandStore(changed.sparkSession, out, fan_in).add(changed, batch)

    return (
        running_band(rows, v, tick)
        .writeStream.outputMode("update")
        .option("checkpointLocation", state)
        .foreachBatch(save)
        .trigger(availableNow=True)
        .start()
    )


def read_band(spark: SparkSession, out: str) -> DataFrame:
    """Latest state of a band kept by :func:`keep_band`, from the live runs only."""
    return BandStore(spark, out).read()
