"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A table is broadcast only after its rows were counted against this bound.
BROADCAST_ROWS = 1_000_000

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # An aggregate on the join key would otherwise keep a skewed join partition whole.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Hash join without sorting, where every shuffled partition of a side was seen to be this small.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    # Spilling state store, so that state is not bound by executor heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # A micro-batch then uploads its changes, not a snapshot of the whole state.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Set the runtime SQL settings the jobs rely on."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints.

    Where none is named, a session that runs in one process (tests, bench) gets a temporary one.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="baleflow-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def new_dir(spark: SparkSession, name: str) -> str:
    """A path no other run uses, below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write `df` to the shared folder and read it back: evaluated once, lineage cut."""
    spark = df.sparkSession
    path = new_dir(spark, name)
    df.write.parquet(path, partitionBy=partition_by)
    return spark.read.schema(df.schema).parquet(path)


def _place(spark: SparkSession, path: str):
    """A path and its store."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    """Is there a file or folder of that name, in whatever store the path is."""
    place, store = _place(spark, path)
    return store.exists(place)


def rename(spark: SparkSession, old: str, new: str) -> None:
    """Give a file or folder the name `new`, which nothing has yet, in one step."""
    place, store = _place(spark, old)
    if exists(spark, new) or not store.rename(place, _place(spark, new)[0]):
        raise OSError(f"cannot rename {old} to {new}")


def make_dir(spark: SparkSession, path: str) -> None:
    """Make a folder, and those above it, unless it is there."""
    place, store = _place(spark, path)
    store.mkdirs(place)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of what is in a folder; none if there is no such folder."""
    place, store = _place(spark, folder)
    return [entry.getPath().getName() for entry in store.listStatus(place)] if store.exists(place) else []


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file, or a folder with all that is in it."""
    place, store = _place(spark, path)
    store.delete(place, True)


def file_times(spark: SparkSession, folder: str) -> dict[str, int]:
    """All files below a folder and the millisecond each was last written."""
    place, store = _place(spark, folder)
    found, files = {}, store.listFiles(place, True)
    while files.hasNext():
        file = files.next()
        found[file.getPath().toString()] = file.getModificationTime()
    return found


def set_file_times(spark: SparkSession, times: dict[str, int]) -> None:
    for file, time in times.items():
        place, store = _place(spark, file)
        store.setTimes(place, time, -1)


def broadcast_if_small(table: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint for a written table of at most `max_rows` rows, else left to Catalyst."""
    return F.broadcast(table) if table.count() <= max_rows else table
