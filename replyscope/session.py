"""Spark session helpers: building a session, the checkpoint folder, and
cutting lineage with a reliable checkpoint."""
from __future__ import annotations

import atexit
import os
import uuid

from pyspark import SparkContext, StorageLevel
from pyspark.sql import DataFrame, SparkSession

# Used where neither the caller, the submitter nor an existing session has set
# anything.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}
QUIET = {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}
# Sides known to have at most this many rows may be broadcast without a look at
# their size; beyond it the join is left to adaptive execution.
BROADCAST_ROWS = 100_000


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "replyscope", conf: dict | None = None) -> SparkSession:
    """Create (or return) a session. ``master``, ``shuffle_partitions`` and
    ``conf`` are set because the caller says so; a default is only set where
    the session has no value of its own, so a submitted or running session
    keeps its settings."""
    running = SparkSession.getActiveSession()
    builder = SparkSession.builder.appName(app_name)
    settings = dict(conf or {})
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if running is None and master:      # a session of our own making
        builder = builder.master(master)
        settings = {**QUIET, **settings}
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    known = dict(spark.sparkContext.getConf().getAll())
    for key, value in DEFAULTS.items():
        if running is None and key not in known and key not in settings:
            spark.conf.set(key, value)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def small(rows: int | None) -> bool:
    """Whether a row bound allows a broadcast hint."""
    return rows is not None and rows <= BROADCAST_ROWS


def spread(df: DataFrame, bytes_per_core: int = 128 << 20) -> DataFrame:
    """Deal the rows of a few small files over all cores, for work that costs
    far more than moving them. Files that keep the cores busy by themselves,
    large ones and frames that read no files stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    files = len(df.inputFiles())
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    if 0 < files < cores and int(str(size)) < cores * bytes_per_core:
        return df.repartition(cores)
    return df


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: ``spark.checkpoint.dir``, or
    where that is not set a folder in the warehouse, which a cluster shares
    too. The library never falls back to a machine's temporary folder."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "_checkpoints")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def materialize(df: DataFrame, reliable: bool = True) -> DataFrame:
    """Cut lineage of a DataFrame that later stages read several times.

    ``reliable=True`` writes it as a table of the innermost open ``Scratch``:
    one job, a compact columnar copy, a lineage that starts at files (a lost
    executor does not send the job back to its sources) and real file sizes for
    the optimizer's join choices. Without an open one the table lasts until
    the program ends. Otherwise the frame is persisted in memory and on disk."""
    if not reliable:
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    return Scratch.of(df.sparkSession).table(df)


_OPEN: list["Scratch"] = []
_ROOTS: dict[str, tuple] = {}


@atexit.register
def _delete_roots() -> None:
    """Delete what this program's runs have left; a stopped session doesn't
    matter, its file system handle is kept."""
    for files, target in list(_ROOTS.values()):
        try:
            files.delete(target, True)
        except Exception:  # noqa: BLE001  the JVM has ended before
            return


class Scratch:
    """Intermediate tables of one run.

    Every table is Parquet in a folder of its own under the shared checkpoint
    folder, so it outlives a lost executor. ``drop`` deletes a table once what
    follows from it is written; ``close`` (or leaving the ``with`` block)
    deletes whatever is left. A frame read from a dropped table must not be
    used again."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = os.path.join(checkpoint_dir(spark), "replyscope", uuid.uuid4().hex)
        self._paths: dict[int, tuple[DataFrame, str]] = {}

    @classmethod
    def of(cls, spark: SparkSession) -> "Scratch":
        """The innermost open one of the session, or one that lasts until the
        program ends."""
        mine = [s for s in _OPEN if s.spark.sparkContext is spark.sparkContext]
        return mine[-1] if mine else cls(spark)

    def claim(self) -> str:
        """The run's folder, to be deleted with it."""
        if self.root not in _ROOTS:
            _ROOTS[self.root] = _located(self.spark.sparkContext, self.root)
        return self.root

    def table(self, df: DataFrame) -> DataFrame:
        self.claim()
        path = os.path.join(self.root, uuid.uuid4().hex)
        df.write.mode("error").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(out)] = (out, path)
        return out

    def drop(self, *frames: DataFrame) -> None:
        for df in frames:
            if id(df) in self._paths:
                _delete(self.spark.sparkContext, self._paths.pop(id(df))[1])

    def close(self) -> None:
        self._paths.clear()
        _delete(self.spark.sparkContext, self.root)
        _ROOTS.pop(self.root, None)

    def __enter__(self) -> "Scratch":
        _OPEN.append(self)
        return self

    def __exit__(self, *exc) -> None:
        _OPEN.remove(self)
        self.close()


def _located(sc: SparkContext, path: str):
    """The file system that a path names, and the path for it."""
    target = sc._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(sc._jsc.hadoopConfiguration()), target


def delete_tree(spark: SparkSession, path: str) -> None:
    _delete(spark.sparkContext, path)


def complete(spark: SparkSession, path: str) -> bool:
    """Whether there is a file, or a folder whose write has ended."""
    files, target = _located(spark.sparkContext, path)
    if not files.exists(target):
        return False
    return files.getFileStatus(target).isFile() or files.exists(
        _located(spark.sparkContext, os.path.join(path, "_SUCCESS"))[1])


def _delete(sc: SparkContext, path: str) -> None:
    files, target = _located(sc, path)
    files.delete(target, True)


def versions(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the folders under ``folder`` whose write has ended."""
    files, target = _located(spark.sparkContext, folder)
    if not files.exists(target):
        return []
    names = [s.getPath().getName() for s in files.listStatus(target)]
    return sorted(int(n) for n in names if n.isdigit() and files.exists(
        _located(spark.sparkContext, os.path.join(folder, n, "_SUCCESS"))[1]))


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
