"""Directory sources (S5) and the file-copy sink (K8)."""

from __future__ import annotations

import os

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import work_dir

_LISTED = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("file_name", T.StringType()),
    T.StructField("is_folder", T.BooleanType()),
    T.StructField("skipped", T.BooleanType()),
    T.StructField("length", T.LongType()),
])
_FILE_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("file_name", T.StringType()),
    T.StructField("folder", T.StringType()),
    T.StructField("length", T.LongType()),
    T.StructField("content", T.BinaryType()),
])
# Names that a listing task hands on at once.
NAMES_PER_BATCH = 10_000
# Files that a task reads, and bytes of contents after which it hands them on.
FILES_PER_TASK = 2_000
BYTES_PER_BATCH = 16 << 20
# Tasks that list the folders of one level.
MAX_LIST_TASKS = 1_000


def _local(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path


def _mounted_folder(spark: SparkSession, directory: str) -> str | None:
    """``file:`` path of a folder in a mounted file system (Spark's tasks read its
    files there, too), None for patterns, single files and other stores."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(directory)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.getUri().getScheme() != "file" or any(x in directory for x in "*?[]{}\\,"):
        return None
    if not fs.exists(path) or not fs.getFileStatus(path).isDirectory():
        return None
    return "file:" + fs.makeQualified(path).toUri().getPath()


def _skipped(name: str, is_folder: bool) -> bool:
    """Names that Spark's file index leaves out."""
    if is_folder and name.startswith(("_common_metadata", "_metadata")):
        return False
    return (name.startswith("_") and "=" not in name) or name.startswith(".") \
        or name.endswith("._COPYING_")


def _list_folders(batches):
    """Entries of folders, handed on in pieces.  Checksum files are no entries, as in
    Spark's listing of a mounted folder."""
    for pdf in batches:
        for folder in pdf["path"]:
            rows = []
            with os.scandir(_local(folder)) as entries:
                for e in entries:
                    is_folder = e.is_dir()
                    if not (is_folder or e.is_file()) \
                            or e.name.startswith(".") and e.name.endswith(".crc"):
                        continue
                    rows.append((f"{folder.rstrip('/')}/{e.name}", e.name, is_folder,
                                 _skipped(e.name, is_folder),
                                 0 if is_folder else e.stat().st_size))
                    if len(rows) == NAMES_PER_BATCH:
                        yield pd.DataFrame(rows, columns=_LISTED.names)
                        rows = []
            if rows:
                yield pd.DataFrame(rows, columns=_LISTED.names)


def _entries(spark: SparkSession, folder: str, recursive: bool) -> DataFrame:
    """Entries of a mounted folder, listed by tasks, a task at least per level and
    folder; names go to a table, none of them through the driver.  Sub-folders are
    entered if ``recursive``, and where their names give partitions."""
    out = work_dir(spark, "listing")
    folders, level = spark.createDataFrame([(folder,)], "path string"), 0
    while True:
        listed = f"{out}/level={level}"
        folders.mapInPandas(_list_folders, _LISTED).write.parquet(listed)
        below = spark.read.schema(_LISTED).parquet(listed).filter("is_folder and not skipped")
        if not recursive:
            below = below.filter(F.col("file_name").contains("="))
        n = below.count()
        if not n:
            return spark.read.schema(_LISTED).parquet(*[f"{out}/level={i}" for i in range(level + 1)])
        folders, level = below.select("path").repartition(min(n, MAX_LIST_TASKS), "path"), level + 1


def list_files(spark: SparkSession, directory: str, recursive: bool = False) -> DataFrame:
    """Names of the files in a directory as a one-column table ``file_name``.

    Tasks list a mounted folder (``_entries``); the listing of any other store, or of
    a pattern, is Spark's file index, which the driver holds, and only ``path`` is
    selected, so file contents are never read (the plan's ReadSchema is empty).
    Sub-folders are not listed as names (files only).  As in Spark's listing, empty
    files are left out, and names that start with ``_`` or ``.``: ``hidden_files``
    gives those names."""
    folder = _mounted_folder(spark, directory)
    if folder is not None:
        return (_entries(spark, folder, recursive)
                .filter("not is_folder and not skipped and length > 0")
                .select("file_name", "path"))
    return (spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
            .load(directory).select(F.col("path")).select(
                F.substring_index(F.col("path"), "/", -1).alias("file_name"),
                F.col("path")))


def hidden_names(spark: SparkSession, directory: str) -> DataFrame:
    """``file_name`` of the files in a folder that ``list_files`` leaves out (``_x``,
    ``.x``); tasks list a mounted folder, the driver any other store."""
    folder = _mounted_folder(spark, directory)
    if folder is not None:
        return (_entries(spark, folder, False)
                .filter("not is_folder and (startswith(file_name, '_') or startswith(file_name, '.'))")
                .filter(F.col("path") == F.concat(F.lit(folder.rstrip("/") + "/"), "file_name"))
                .select("file_name"))
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(directory)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return spark.createDataFrame([(s.getPath().getName(),) for s in fs.listStatus(path)
                                  if s.isFile() and s.getPath().getName()[:1] in "_."],
                                 "file_name string")


def hidden_files(spark: SparkSession, directory: str) -> list[str]:
    """The names of ``hidden_names``, sorted, on the driver."""
    return sorted(r.file_name for r in hidden_names(spark, directory).collect())


def _read_contents(batches):
    for pdf in batches:
        rows, held = [], 0
        for path in pdf["path"]:
            with open(_local(path), "rb") as fh:
                content = fh.read()
            parts = path.split("/")
            rows.append((path, parts[-1], parts[-2], len(content), content))
            held += len(content)
            if held >= BYTES_PER_BATCH:
                yield pd.DataFrame(rows, columns=_FILE_SCHEMA.names)
                rows, held = [], 0
        if rows:
            yield pd.DataFrame(rows, columns=_FILE_SCHEMA.names)


def read_files(spark: SparkSession, directory: str, recursive: bool = False) -> DataFrame:
    """Files with content: ``(path, file_name, folder, length, content)``.  Of a
    mounted folder the names are dealt over tasks, ``FILES_PER_TASK`` to each."""
    if _mounted_folder(spark, directory) is not None:
        names = list_files(spark, directory, recursive).select("path")
        tasks = max(spark.sparkContext.defaultParallelism, -(-names.count() // FILES_PER_TASK))
        return names.repartition(tasks, "path").mapInPandas(_read_contents, _FILE_SCHEMA)
    df = (spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
          .load(directory))
    parent = F.element_at(F.split(F.col("path"), "/"), -2)
    return df.select("path", F.substring_index("path", "/", -1).alias("file_name"),
                     parent.alias("folder"), "length", "content")


_COPY_SCHEMA = T.StructType([
    T.StructField("file_name", T.StringType()),
    T.StructField("target", T.StringType()),
    T.StructField("bytes", T.LongType()),
])


def copy_files(files: DataFrame, target_prefix: str) -> DataFrame:
    """K8: copy every file under ``target_prefix`` keeping its name; one row
    per copied file ``(file_name, target, bytes)``.

    Runs as ``mapInPandas`` over the file rows, so copies are spread over
    all tasks; a rerun overwrites the same names (idempotent).  The target
    must be a file system path every executor can write (a mounted shared
    folder); object stores use their own copy tools."""
    prefix = _local(target_prefix.rstrip("/"))

    def _copy(batches):
        os.makedirs(prefix, exist_ok=True)
        for pdf in batches:
            targets, sizes = [], []
            for name, content in zip(pdf["file_name"], pdf["content"]):
                dest = f"{prefix}/{name}"
                with open(dest, "wb") as fh:
                    fh.write(content)
                targets.append(dest)
                sizes.append(len(content))
            yield pd.DataFrame({"file_name": pdf["file_name"], "target": targets,
                                "bytes": sizes})

    return files.select("file_name", "content").mapInPandas(_copy, _COPY_SCHEMA)


def file_list_job(spark: SparkSession, directory: str, system_name: str, target_base: str
                  ) -> str:
    """S5 + K7 + K1: all names in ``directory``, hidden ones included, written as
    text lines (``<SYSTEM>_FILES``) and as the one-column table ``<SYSTEM>_FILE_LIST``
    (``FILE_NAME``), replacing an earlier list.  Returns the table path."""
    names = list_files(spark, directory).unionByName(
        hidden_names(spark, directory), allowMissingColumns=True).select(
            F.col("file_name").alias("FILE_NAME"))
    base = target_base.rstrip("/")
    names.write.mode("overwrite").text(f"{base}/{system_name}_FILES")
    table = f"{base}/{system_name}_FILE_LIST"
    (spark.read.schema("FILE_NAME string").text(f"{base}/{system_name}_FILES")
     .write.mode("overwrite").parquet(table))
    return table
