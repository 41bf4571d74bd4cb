"""Table and file sinks."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOAD_HISTORY_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("started", T.TimestampNTZType()),
    T.StructField("finished", T.TimestampNTZType()),
    T.StructField("rows_before", T.LongType()),
    T.StructField("rows_after", T.LongType()),
    T.StructField("rejects", T.LongType()),
    T.StructField("status", T.StringType()),
])


def _now() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)


def count_or_zero(spark: SparkSession, path: str) -> int:
    """Row count of a parquet table (answered from footers), 0 if it is absent."""
    return spark.read.parquet(path).count() if path_exists(spark, path) else 0


def replace_table(df: DataFrame, path: str, name: str | None = None,
                  comment: str | None = None) -> None:
    """K1: create-or-replace.  Writes the new data, then (optionally) points a
    catalog table at it with a comment.  Never write over a path being read."""
    df.write.mode("overwrite").parquet(path)
    if name:
        spark = df.sparkSession
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.catalog.createTable(name, path=path, source="parquet",
                                  description=comment)


# Spark writes milliseconds by default.
TIME_FORMATS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
                "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def write_csv(df: DataFrame, path: str, quote_all: bool = False, header: bool = True,
              sep: str = ",", compression: str = "none", file_rows: int = 0) -> None:
    """K4/K5: CSV sink, all fields quoted or minimal quoting; files of ``file_rows``
    rows at the most, where given."""
    (df.write.option("compression", compression).option("maxRecordsPerFile", file_rows)
     .mode("overwrite").option("header", header).option("sep", sep)
     .option("quoteAll", quote_all).option("escape", '"').option("nullValue", "")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .options(**TIME_FORMATS).csv(path))


def write_json_lines(df: DataFrame, path: str) -> None:
    """K6: one JSON object per line, null fields kept."""
    (df.write.mode("overwrite").option("ignoreNullFields", False).options(**TIME_FORMATS)
     .json(path))


def write_text_lines(df: DataFrame, column: str, path: str, ordered: bool = False) -> None:
    """K7: one line per row.  ``ordered`` range-sorts the lines; Spark writes
    one file per range partition, so the files in name order hold the lines
    in order without gathering them in one task."""
    out = df.select(F.col(column).cast("string").alias("value"))
    if ordered:
        out = out.orderBy("value")
    out.write.mode("overwrite").text(path)


def history_row(spark: SparkSession, table_name: str, started: _dt.datetime,
                rows_before: int, rows_after: int, rejects: int, status: str) -> DataFrame:
    """One history row per load."""
    return spark.createDataFrame(
        [(table_name, started, _now(), rows_before, rows_after, rejects, status)],
        LOAD_HISTORY_SCHEMA)
