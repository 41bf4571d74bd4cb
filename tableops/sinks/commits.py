"""Commit files and idempotent appends (K2).

A commit file appears whole or not at all: its text is written under another
name and renamed in one step of the file system, which fails if the name is
taken.  What no commit file names does not exist for readers, so a job that
dies leaves files behind but no rows.

``append_table`` adds the rows of one load under a token that the caller
chooses (a file name and its date, a run id).  The ledger has one commit file
per token with the folder of its rows: a token that is replayed adds nothing,
also after a crash between writing and answering, and loads with different
tokens never wait for each other.  The first load fixes the table's columns;
later ones are matched by name and cast to them (strict casts).
"""

from __future__ import annotations

import hashlib
import json
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .writers import path_exists


def _hadoop(spark: SparkSession, path: str):
    """The file system of a path, and the qualified path."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(target)


def publish(spark: SparkSession, path: str, text: str) -> bool:
    """Make the file ``path`` with ``text`` appear at once; False if it exists."""
    sc = spark.sparkContext
    hadoop = sc._jvm.org.apache.hadoop.fs
    fs, target = _hadoop(spark, path)
    if fs.exists(target):
        return False
    temp = hadoop.Path(target.getParent(), f".{target.getName()}.{uuid.uuid4().hex}")
    out = fs.create(temp, True)
    out.write(bytearray(text.encode()))
    out.close()
    rename = getattr(hadoop, "Options$Rename")
    options = sc._gateway.new_array(rename, 1)
    options[0] = rename.NONE  # never over an existing file
    context = hadoop.FileContext.getFileContext(fs.getUri(), sc._jsc.hadoopConfiguration())
    try:
        context.rename(temp, target, options)
    except Py4JJavaError as e:
        fs.delete(temp, False)
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    return True


def published(spark: SparkSession, folder: str) -> list[str]:
    """Names of the commit files of a folder, ascending."""
    fs, root = _hadoop(spark, folder)
    if not fs.exists(root):
        return []
    names = (s.getPath().getName() for s in fs.listStatus(root))
    return sorted(n for n in names if not n.startswith(("_", ".")))


def read_published(spark: SparkSession, path: str) -> str:
    """The text of a commit file (small, read on the driver)."""
    fs, target = _hadoop(spark, path)
    stream = fs.open(target)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


# -- K2 ------------------------------------------------------------------------
SCHEMA_FILE, LEDGER, DATA = "schema.json", "ledger", "data"


@dataclass
class AppendResult:
    token: str
    added: bool
    folder: str


def _entry(base: str, token: str) -> str:
    return f"{base}/{LEDGER}/{hashlib.sha256(token.encode()).hexdigest()}"


def table_schema(spark: SparkSession, base: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(read_published(spark, f"{base}/{SCHEMA_FILE}")))


def append_table(df: DataFrame, base: str, token: str) -> AppendResult:
    """K2: append the rows of ``df`` to the table at ``base`` once per ``token``."""
    spark, base = df.sparkSession, base.rstrip("/")
    entry = _entry(base, token)
    if path_exists(spark, entry):
        return AppendResult(token, False, json.loads(read_published(spark, entry))["folder"])
    publish(spark, f"{base}/{SCHEMA_FILE}", df.schema.json())
    schema = table_schema(spark, base)
    if sorted(df.columns) != sorted(schema.names):
        raise ValueError(f"columns {df.columns} do not match the table's {schema.names}")
    folder = f"{DATA}/{uuid.uuid4().hex}"
    df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields]) \
        .write.parquet(f"{base}/{folder}")
    if publish(spark, entry, json.dumps({"token": token, "folder": folder})):
        return AppendResult(token, True, folder)
    # another attempt of this token came first: its rows count, these do not
    fs, mine = _hadoop(spark, f"{base}/{folder}")
    fs.delete(mine, True)
    return AppendResult(token, False, json.loads(read_published(spark, entry))["folder"])


def appended_loads(spark: SparkSession, base: str) -> DataFrame:
    """The ledger: one row per committed load."""
    loads = [json.loads(read_published(spark, f"{base}/{LEDGER}/{n}"))
             for n in published(spark, f"{base}/{LEDGER}")]
    return spark.createDataFrame([(x["token"], x["folder"]) for x in loads],
                                 "token string, folder string")


def read_appended(spark: SparkSession, base: str) -> DataFrame:
    """The rows of all committed loads, with the columns that the first load fixed."""
    schema = table_schema(spark, base)
    folders = [json.loads(read_published(spark, f"{base}/{LEDGER}/{n}"))["folder"]
               for n in published(spark, f"{base}/{LEDGER}")]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{base}/{f}" for f in folders])
