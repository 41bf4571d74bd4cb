"""R1 ``load_file``: delimited file -> all-text stage -> profile -> typed table.

Passes over the data:
  1. parse the file(s) once and write the stage (text columns plus the raw
     text of malformed rows) as parquet in the shared work folder;
  2. one aggregate over the stage computes the whole type profile;
  3. one projection of casts writes the typed table.
Rejected rows are read from the stage by a pushed-down ``IS NOT NULL``
filter.  Every step is a distributed Spark job; only the one-row-per-column
profile reaches the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.profiling import ColumnProfile, profile_columns, typed_projection
from ..session import work_dir
from ..sinks.writers import _now, count_or_zero, history_row, replace_table
from ..sources.delimited import (CORRUPT_COL, good_rows, land_delimited, number_rejects,
                                 reject_rows)

STATUS_LOADED = "loaded"
STATUS_NO_DATA = "no data in source file"


@dataclass
class LoadResult:
    table_path: str | None
    stage_path: str
    profile: list[ColumnProfile]
    history: DataFrame
    status: str
    source_path: str = ""
    file_format: str = "CSV"

    def stage(self, spark: SparkSession) -> DataFrame:
        return good_rows(spark.read.parquet(self.stage_path))

    def rejects(self, spark: SparkSession, table_name: str, with_lines: bool = True
                ) -> DataFrame:
        """The load-error table; ``with_lines`` numbers the rejected lines
        (one extra text scan of the source files)."""
        raw = spark.read.parquet(self.stage_path)
        numbered = number_rejects(spark, self.source_path, raw) if with_lines else None
        return reject_rows(raw, table_name, numbered, self.file_format)


def load_file(spark: SparkSession, source_path: str, table_name: str,
              file_format: str = "CSV", target_dir: str | None = None,
              register: bool = False) -> LoadResult:
    started = _now()
    base = target_dir or work_dir(spark, f"load-{table_name.lower()}")
    stage_path = f"{base}/stage_{table_name.lower()}"
    final_path = f"{base}/{table_name.lower()}"

    # pass 1: stage (all columns written, so CSV pruning cannot hide bad rows)
    raw = land_delimited(spark, source_path, stage_path, file_format)
    stage = good_rows(raw)
    rejects = raw.filter(F.col(CORRUPT_COL).isNotNull()).count()

    # pass 2: one aggregate for the whole profile
    profile = profile_columns(stage)
    rows_before = count_or_zero(spark, final_path)
    if not any(p.data_type for p in profile):
        hist = history_row(spark, table_name, started, rows_before, rows_before, rejects,
                           STATUS_NO_DATA)
        return LoadResult(None, stage_path, profile, hist, STATUS_NO_DATA, source_path, file_format)

    # pass 3: typed projection, create-or-replace with the source file comment
    source_name = source_path.replace("\\", "/").rstrip("/").rsplit("/", 1)[-1]
    replace_table(typed_projection(stage, profile), final_path,
                  name=table_name if register else None,
                  comment=f"Source file: {source_name}")
    rows_after = spark.read.parquet(final_path).count()
    hist = history_row(spark, table_name, started, rows_before, rows_after, rejects,
                       STATUS_LOADED)
    return LoadResult(final_path, stage_path, profile, hist, STATUS_LOADED, source_path, file_format)
