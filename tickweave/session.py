"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Most rows we are willing to ship to every executor. At about 100 bytes a row this is 20 MB.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 * 1024 * 1024  # by the widths of fixed types, else as counted in the table itself

_fallback_dirs: dict[str, str] = {}


# For trees of very many small files: pack thousands of them into one task. Worth setting on a cluster too.
SMALL_FILES = {"spark.sql.files.openCostInBytes": str(64 * 1024)}
# On a local disk, listing from the driver is far quicker than a listing job; on an object store it is not.
LOCAL_DISK = {"spark.sql.sources.parallelPartitionDiscovery.threshold": "1000000"}


def local_session(cores: int | str = "*", memory: str = "12g", app: str = "tickweave") -> SparkSession:
    """A session for tests and the bench. On a cluster, pass in the session the cluster gives."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in {**SMALL_FILES, **LOCAL_DISK}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the workers, for sessions whose executors do not have it installed."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="tickweave-package-"), "tickweave.zip")  # on the driver, which hands it out as long as it lives
    with zipfile.ZipFile(path, "w") as z:
        for here, _, names in os.walk(os.path.join(root, "tickweave")):
            for name in names:
                if name.endswith(".py"):
                    z.write(os.path.join(here, name), os.path.relpath(os.path.join(here, name), root))
    spark.sparkContext.addPyFile(path)


def scratch_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, for intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``; a folder given to ``setCheckpointDir`` counts too. Only where both
    are unset and all tasks run on this machine (tests, a laptop) is a fresh temporary folder made, once per application.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    chosen = spark.sparkContext._jsc.sc().getCheckpointDir()
    if chosen.isDefined():
        return chosen.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _fallback_dirs:
        _fallback_dirs[app] = tempfile.mkdtemp(prefix="tickweave-")
    return _fallback_dirs[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the scratch folder."""
    return os.path.join(scratch_dir(spark), f"{name}-{uuid.uuid4().hex}")


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut and its size is known."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
