"""Spark session settings and shared work folders.

Every job takes a ``SparkSession`` from the caller; nothing here keeps a
global session.  ``build_session`` is a convenience for tests, the bench
and command-line use.
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.csv.parser.columnPruning.enabled": "false",
}


def build_session(master: str = "local[8]", app: str = "tableops",
                  shuffle_partitions: int = 8, driver_memory: str = "16g",
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(_BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = driver_memory
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared file system folder and is
    only read, and must be set.  Where it is unset in local mode (tests) a
    fresh folder is made and set once for the session.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tableops-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def work_dir(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared checkpoint folder.

    Used for stage tables, reject tables, copies and chunk output, so that
    every executor sees them and a lost executor's work can be redone.
    """
    base = ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/work/{name}-{uuid.uuid4().hex[:12]}"
    passing = _passing.get()
    if passing is not None:
        passing.append(path)
    return path


_passing: ContextVar[list[str] | None] = ContextVar("passing", default=None)


def drop_folders(spark: SparkSession, *paths: str) -> None:
    """Delete work folders (a folder that is not there is no error)."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)


@contextmanager
def passing_folders(spark: SparkSession) -> Iterator[None]:
    """Work folders that this thread makes inside go at the end: nothing that is
    read later may depend on them."""
    made: list[str] = []
    token = _passing.set(made)
    try:
        yield
    finally:
        _passing.reset(token)
        drop_folders(spark, *made)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_cleanup_lock, _cleanup_users = threading.Lock(), Counter()


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries that are written inside go when their query
    ends, unless the session names a value.  By Spark's own default they stay until
    the driver happens to collect its garbage: the larger the input, the more
    of them lie side by side."""
    session = spark._jsparkSession.sessionUUID()
    with _cleanup_lock:  # threads of one session may be inside at once
        ours = _cleanup_users[session] > 0 or spark.conf.get(_CLEANUP, None) is None
        if ours:
            spark.conf.set(_CLEANUP, "true")
            _cleanup_users[session] += 1
    try:
        yield
    finally:
        with _cleanup_lock:
            if ours:
                _cleanup_users[session] -= 1
                if not _cleanup_users[session]:
                    spark.conf.unset(_CLEANUP)


def land(df: DataFrame, path: str, **how) -> DataFrame:
    """``df`` written to a work folder (``how``: mode, compression) and read back;
    its shuffle files go at once."""
    with shuffles_removed(df.sparkSession):
        df.write.parquet(path, **how)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Bytes of rows that go to a Python worker at once.
BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Let rows of long values go to Python workers in batches of ``BATCH_BYTES``
    (a longer row is a batch) where the session names no size.  By Spark's
    own default a batch has up to 64 MB, several times over: in the rows' reader,
    in Arrow's buffers, in those that are sent, and in the worker."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(BATCH_BYTES))


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def input_bytes(df: DataFrame) -> int:
    """Bytes of the relations a DataFrame reads: the sum of the planner's
    size statistics of the plan's leaves (for files, the listed file sizes
    after partition pruning).  No job and no file-system call.  A leaf whose
    size the planner does not know (it then assumes the largest long) counts 0."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    it = leaves.iterator()
    total = 0
    while it.hasNext():
        size = int(it.next().stats().sizeInBytes())
        total += size if size < 1 << 60 else 0
    return total


def sized_partitions(df: DataFrame, bytes_per_partition: int | None = None) -> int:
    """Partition count for a full shuffle of ``df``: the configured shuffle
    partitions, or more when the input is larger than that many partitions
    of ``bytes_per_partition`` (default: the AQE advisory partition size), so
    sort partitions stay near a target size as the input grows."""
    spark = df.sparkSession
    base = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if bytes_per_partition is None:
        adv = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64MB")
        bytes_per_partition = _parse_bytes(adv)
    return max(base, -(-input_bytes(df) // max(bytes_per_partition, 1)))


def _parse_bytes(text: str) -> int:
    t = text.strip().lower().rstrip("b")
    mult = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}
    if t and t[-1] in mult:
        return int(float(t[:-1]) * mult[t[-1]])
    return int(t)
