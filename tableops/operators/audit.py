"""Row-count audits: source vs target counts with an active-flag history.

The counts of the sources are one Spark job: a ``unionByName`` of one global
count per table (each a column-free scan with a map-side partial count), so
nothing but one row per table reaches the driver.  Targets are counted by a job
each, side by side, as one that cannot be read must not hide the others.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from ..sinks.commits import _hadoop, publish, published, read_published

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's behaviour
# ---------------------------------------------------------------------------
ACTIVE, RETIRED = "Y", "N"          # md_active_flag values
AUDIT_ENABLED = "Y"                 # audit_enabled_flag of a registered source
AUDITED_SOURCE_TYPE = "SQL SERVER"  # source type the count audit runs for
MISSING_COUNT = -1                  # target count of a target that cannot be read

RESULT_COLUMNS = ["source_key", "table_name", "source_count", "source_date", "target_count",
                  "target_date", "md_active_flag"]


def table_counts(tables: dict[str, DataFrame], prefix: str) -> DataFrame:
    """A5 per side: (table_name, <prefix>_count, <prefix>_date), one row per table.

    One job: the column-free scans of all tables are tagged with the table
    name and unioned with one zero-weight row per name (so an empty table
    still gets a row), then summed by name: partial sums per task, one
    small shuffle, no join."""
    if not tables:
        raise ValueError("no tables to count")
    spark = next(iter(tables.values())).sparkSession
    names = spark.createDataFrame([(n, 0) for n in tables], "table_name string, _w int")
    tagged = reduce(DataFrame.unionByName,
                    [df.select(F.lit(name).alias("table_name"), F.lit(1).alias("_w"))
                     for name, df in tables.items()] + [names])
    return tagged.groupBy("table_name").agg(
        F.sum("_w").cast("long").alias(f"{prefix}_count"),
        F.localtimestamp().alias(f"{prefix}_date"))


def registry_filter(registry: DataFrame, source_type: str = AUDITED_SOURCE_TYPE) -> DataFrame:
    """Enabled sources of one type."""
    return registry.filter((F.col("audit_enabled_flag") == AUDIT_ENABLED)
                           & (F.col("source_type") == source_type))


def isolated_counts(spark: SparkSession,
                    tables: dict[str, DataFrame | Callable[[], DataFrame] | None],
                    parallel: int = 8) -> DataFrame:
    """(table_name, target_count, target_date), each table counted by a job
    of its own.  One that is absent (None), cannot be found (a function that
    fails) or cannot be read has count -1 and no timestamp."""

    def count(item: tuple) -> tuple:
        name, table = item
        if table is None:
            return name, MISSING_COUNT, None
        try:
            frame = table if isinstance(table, DataFrame) else table()
            n, at = frame.agg(F.count(F.lit(1)), F.localtimestamp()).first()
        except Exception:  # noqa: BLE001 - whatever the failure, this target has no count
            return name, MISSING_COUNT, None
        return name, n, at

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        rows = list(pool.map(count, tables.items()))
    return spark.createDataFrame(
        rows, "table_name string, target_count long, target_date timestamp_ntz")


def count_audit(source_key: int, sources: dict[str, DataFrame],
                targets: dict[str, DataFrame | Callable[[], DataFrame] | None]) -> DataFrame:
    """A6 + J4 + P8.

    Every source table with a non-zero count gives one row; its target is
    the same-named table.  A target that does not exist or cannot be read
    gets count -1 and no timestamp (``isolated_counts``).
    """
    src = table_counts(sources, "source")
    joined = src.join(isolated_counts(next(iter(sources.values())).sparkSession, targets),
                      "table_name", "left")
    return (joined.filter(F.col("source_count") != 0)
            .select(F.lit(source_key).cast("long").alias("source_key"), "table_name",
                    "source_count", "source_date",
                    F.coalesce("target_count", F.lit(MISSING_COUNT).cast("long"))
                     .alias("target_count"),
                    "target_date", F.lit(ACTIVE).alias("md_active_flag")))


def retire_and_append(old: DataFrame, new: DataFrame, source_key: int) -> DataFrame:
    """Earlier rows of this source become 'N', new rows are appended as 'Y'.

    When the new run produced no rows nothing changes.  The caller writes the
    result to a new path (parquet has no UPDATE) and then switches to it.
    """
    if new.isEmpty():
        return old
    retired = old.withColumn(
        "md_active_flag",
        F.when(F.col("source_key") == source_key, F.lit(RETIRED))
         .otherwise(F.col("md_active_flag")))
    return retired.unionByName(new.select(*old.columns))


def copy_count_check(table_name: str, source: DataFrame,
                     target: DataFrame) -> DataFrame:
    """Source and target counts in one row with a ``matched`` flag.
    One aggregate over the tagged union of both sides (column-free scans)."""
    both = (source.select(F.lit(True).alias("_src"))
            .unionByName(target.select(F.lit(False).alias("_src"))))
    counts = both.agg(F.count_if(F.col("_src")).alias("source_count"),
                      F.count_if(~F.col("_src")).alias("target_count"))
    return counts.select(
        F.lit(table_name).alias("table_name"), "source_count", "target_count",
        (F.col("source_count") == F.col("target_count")).alias("matched"))


RESULT_SCHEMA = T.StructType([
    T.StructField("source_key", T.LongType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("source_count", T.LongType()),
    T.StructField("source_date", T.TimestampNTZType()),
    T.StructField("target_count", T.LongType()),
    T.StructField("target_date", T.TimestampNTZType()),
    T.StructField("md_active_flag", T.StringType()),
])


def _source_folder(base: str, source_key: int) -> str:
    return f"{base.rstrip('/')}/source_key={source_key}"


def _newest(spark: SparkSession, folder: str) -> tuple[int, str | None]:
    """Number and data folder of a source's newest commit."""
    names = published(spark, f"{folder}/commits")
    if not names:
        return -1, None
    return int(names[-1]), json.loads(read_published(spark, f"{folder}/commits/{names[-1]}"))["data"]


def commit_results(base: str, new: DataFrame, source_key: int) -> str | None:
    """R5 end to end: retire this source's rows, append the new ones and commit
    both as the source's next version (nothing is written when the new run has
    no rows).  Each source has a folder of its own, so what is written depends
    on that source alone and sources may finish at the same time.  Of two runs
    of one source the later commit builds on the earlier one.  Returns the
    folder of the source's rows."""
    spark, folder = new.sparkSession, _source_folder(base, source_key)
    new = cut_lineage(new.select(*RESULT_COLUMNS))  # counted once; the steps below see one result
    while True:
        number, data = _newest(spark, folder)
        if new.isEmpty():
            return data and f"{folder}/{data}"
        rows = new if data is None else retire_and_append(
            spark.read.schema(RESULT_SCHEMA).parquet(f"{folder}/{data}"), new, source_key)
        mine = f"data/{uuid.uuid4().hex}"
        rows.write.parquet(f"{folder}/{mine}")
        if publish(spark, f"{folder}/commits/{number + 1:012d}", json.dumps({"data": mine})):
            return f"{folder}/{mine}"


def read_results(spark: SparkSession, base: str) -> DataFrame:
    """The committed results of all sources (one folder per source is listed)."""
    fs, root = _hadoop(spark, base)
    sources = [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []
    found = [(f"{base.rstrip('/')}/{n}", _newest(spark, f"{base.rstrip('/')}/{n}")[1])
             for n in sorted(sources) if n.startswith("source_key=")]
    paths = [f"{folder}/{data}" for folder, data in found if data]
    if not paths:
        return spark.createDataFrame([], RESULT_SCHEMA)
    return spark.read.schema(RESULT_SCHEMA).parquet(*paths)
