"""R3 ``replicate_table``: keyed, chunked, restartable copy of a source table.

Every call copies the whole source again, as the next run: a folder
``run=<n>`` under the target with the chunks and a manifest (source rows, a
hash over all rows, batch size, key, schema).  Source rows are ranked by the
primary key (distributed ``global_rank``), split into chunks of ``batch``
ranks and written under ``chunk_id=<n>`` with dynamic partition overwrite: a
chunk appears only when the job that wrote it commits, and re-writing it
replaces it.  A run that was interrupted is resumed only if its manifest is
that of the source as it is now; otherwise a new run starts.  A run is marked
committed when it is complete, and readers take the newest committed one
(``read_copy``), so a changed source never mixes with an older copy.  A table
without a key is copied as one chunk.
"""

from __future__ import annotations

import json
import time
import uuid
import warnings
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.paging import CHUNK_COL, DEFAULT_BATCH, RANK_COL, ranked_with_count, with_chunks
from ..sinks.writers import path_exists


@dataclass
class ReplicationResult:
    table_name: str
    target_path: str
    total_chunks: int
    written_chunks: int
    skipped_chunks: int


def primary_key_columns(keys: DataFrame, table_name: str) -> list[str]:
    """Key columns of one table, in key order, from key metadata
    ``(table_name, column_name, key_ordinal)``.  One small group."""
    row = (keys.filter(F.col("table_name") == table_name)
           .agg(F.array_sort(F.collect_list(F.struct("key_ordinal", "column_name")))
                .alias("k")).first())
    return [r["column_name"] for r in (row["k"] or [])]


def finished_chunks(spark: SparkSession, target_path: str) -> DataFrame | None:
    if not path_exists(spark, target_path):
        return None
    return spark.read.parquet(target_path).select(CHUNK_COL).distinct()


RUN_PREFIX, DONE_MARK = "run=", "_COMMITTED"


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def runs(spark: SparkSession, target_path: str) -> list[str]:
    """Run folders of a target, newest first (a listing of folder names)."""
    fs, root = _fs(spark, target_path)
    if not fs.exists(root):
        return []
    names = sorted((s.getPath().getName() for s in fs.listStatus(root)), reverse=True)
    return [f"{target_path.rstrip('/')}/{n}" for n in names if n.startswith(RUN_PREFIX)]


def is_committed(spark: SparkSession, run: str) -> bool:
    return path_exists(spark, f"{run}/{DONE_MARK}")


def read_copy(spark: SparkSession, target_path: str) -> DataFrame:
    """The newest complete copy, with its ``chunk_id``."""
    for run in runs(spark, target_path):
        if is_committed(spark, run):
            return spark.read.parquet(f"{run}/data").withColumn(
                CHUNK_COL, F.col(CHUNK_COL).cast("long"))
    raise FileNotFoundError(f"no committed copy under {target_path}")


def source_manifest(source: DataFrame, key_cols: list[str] | None, batch: int) -> str:
    """What a run copies: rows, an order-free hash of all values, batch, key, schema."""
    values = [F.to_json(F.col(f"`{f.name}`")) if isinstance(f.dataType, T.MapType)
              else F.col(f"`{f.name}`") for f in source.schema.fields]
    n, total = source.agg(F.count(F.lit(1)), F.sum(
        F.xxhash64(*values).cast("decimal(38,0)"))).first()
    return json.dumps({"rows": n, "hash": str(total), "batch": batch, "key": key_cols,
                       "schema": source.schema.simpleString()}, sort_keys=True)


def _open_run(spark: SparkSession, target_path: str, manifest: str) -> str:
    """The newest run if it is unfinished and has this manifest, else a new one."""
    for run in runs(spark, target_path)[:1]:
        if not is_committed(spark, run) and path_exists(spark, f"{run}/manifest/_SUCCESS"):
            if spark.read.text(f"{run}/manifest").first()["value"] == manifest:
                return run
    run = (f"{target_path.rstrip('/')}/{RUN_PREFIX}{int(time.time() * 1e6):018d}-"
           f"{uuid.uuid4().hex[:8]}")
    spark.createDataFrame([(manifest,)], "value string").coalesce(1).write.text(f"{run}/manifest")
    return run


def replicate_table(spark: SparkSession, source: DataFrame, table_name: str,
                    target_path: str, key_cols: list[str] | None,
                    batch: int = DEFAULT_BATCH,
                    target_schema: T.StructType | None = None,
                    max_chunks: int | None = None) -> ReplicationResult:
    """Copy ``source`` as the next run under ``target_path``, or go on with an
    interrupted run of the same source.  ``max_chunks`` ends the call after
    that many chunks and leaves the run open for the next call."""
    if target_schema is not None:
        source = source.select(*[F.col(f.name).cast(f.dataType).alias(f.name)
                                 for f in target_schema.fields])
    manifest = source_manifest(source, key_cols, batch)
    run = _open_run(spark, target_path, manifest)
    if key_cols:
        ranked, n_rows = ranked_with_count(source, key_cols)
        chunked = with_chunks(ranked, batch).drop(RANK_COL)
        total = -(-n_rows // batch)          # ceil, from the rank's partition sizes
    else:
        warnings.warn(f"{table_name}: no primary key, copied as one chunk", stacklevel=2)
        chunked = source.withColumn(CHUNK_COL, F.lit(0).cast("long"))
        total = 1
    data = f"{run}/data"
    done = finished_chunks(spark, data)
    skipped = 0
    if done is not None:
        done = done.checkpoint()
        skipped = done.count()
        chunked = chunked.join(done, CHUNK_COL, "left_anti")
    last = total if max_chunks is None else skipped + max_chunks
    if last < total:
        # chunks are finished in order of their numbers
        chunked = chunked.filter(F.col(CHUNK_COL) < last)
    (chunked.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(CHUNK_COL).parquet(data))
    if last >= total:
        fs, mark = _fs(spark, f"{run}/{DONE_MARK}")
        fs.create(mark, True).close()
    return ReplicationResult(table_name, data, total, min(last, total) - skipped, skipped)


def replicate_tables(spark: SparkSession, frames: dict[str, DataFrame], keys: DataFrame,
                     target_base: str, tables: list[str] | None = None,
                     batch: int = DEFAULT_BATCH) -> DataFrame:
    """R3 over a list of tables (the argument, or every table given): each
    copied with its key columns from the key metadata (S10), one status row
    per table; a table that fails is reported and the others continue."""
    rows = []
    for name in tables or sorted(frames):
        try:
            key_cols = primary_key_columns(keys, name)
            with warnings.catch_warnings():
                warnings.simplefilter("ignore")
                r = replicate_table(spark, frames[name], name, f"{target_base}/{name}",
                                    key_cols or None, batch)
            rows.append((name, r.total_chunks, r.written_chunks, r.skipped_chunks,
                         "copied" if key_cols else "copied as one chunk (no key)", None))
        except Exception as e:  # noqa: BLE001 - reported per table
            rows.append((name, None, None, None, "failed", str(e)))
    return spark.createDataFrame(rows, "table_name string, total_chunks long, "
                                       "written_chunks long, skipped_chunks long, "
                                       "status string, error string")
