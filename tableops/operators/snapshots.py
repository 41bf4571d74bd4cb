"""Dated snapshots with retention."""

from __future__ import annotations

import datetime as _dt
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import BACKUP_DATE_FORMAT, BACKUP_PREFIX
from ..sinks.writers import LOAD_HISTORY_SCHEMA, _now, count_or_zero, history_row

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's behaviour
# ---------------------------------------------------------------------------
RETENTION_DAYS = 15

MODE_EXACT, MODE_OLDER = "exact", "older_or_equal"


def snapshot_date(name: Column | str) -> Column:
    """Date of a snapshot name ``zBACKUP_<db>_<MM_dd_yyyy>``; NULL, and so
    never dropped, if the name ends in no date."""
    n = F.col(name) if isinstance(name, str) else name
    return F.try_to_date(F.substring_index(n, "_", -3), BACKUP_DATE_FORMAT)


def snapshot_db(name: Column | str) -> Column:
    """Database part of a snapshot name."""
    n = F.col(name) if isinstance(name, str) else name
    return F.regexp_extract(n, rf"^{BACKUP_PREFIX}(.*)_[0-9]{{2}}_[0-9]{{2}}_[0-9]{{4}}$", 1)


def retention_plan(snapshots: DataFrame, today: _dt.date | Column,
                   days: int = RETENTION_DAYS, mode: str = MODE_EXACT) -> DataFrame:
    """Mark snapshots to drop.  ``exact`` drops only the one dated
    exactly ``today - days`` (the reference: a missed run leaves a snapshot
    for ever); ``older_or_equal`` drops every snapshot at least that old."""
    t = F.lit(today) if not isinstance(today, Column) else today
    d = snapshot_date("name")
    return snapshots.select("name", d.alias("snapshot_date"),
                            F.datediff(t, d).alias("age_days"),
                            drop_flag(d, t, days, mode).alias("drop"))


def drop_flag(snap_date: Column, today: Column, days: int = RETENTION_DAYS,
              mode: str = MODE_EXACT) -> Column:
    """Whether a snapshot of ``snap_date`` is dropped on ``today``."""
    cutoff = F.date_sub(today, days)
    drop = (snap_date == cutoff) if mode == MODE_EXACT else (snap_date <= cutoff)
    return F.coalesce(drop, F.lit(False))


def snapshot_tables(spark: SparkSession, tables: dict[str, DataFrame], base_path: str,
                    db: str, day: _dt.date, parallel: int = 4) -> DataFrame:
    """Copy every table into ``<base>/zBACKUP_<db>_<MM_dd_yyyy>/<table>``,
    replacing an existing snapshot of the same day; one history row per
    table.  Each copy is a distributed write; several tables are copied at
    once (independent Spark jobs from a small thread pool)."""
    name = f"{BACKUP_PREFIX}{db}_{day:%m_%d_%Y}"   # same text as backup_name()

    def _copy(item):
        table, df = item
        path = f"{base_path}/{name}/{table}"
        started = _now()
        before = count_or_zero(spark, path)
        df.write.mode("overwrite").parquet(path)
        after = spark.read.parquet(path).count()
        return table, started, before, after

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        done = list(pool.map(_copy, tables.items()))
    out = spark.createDataFrame([], LOAD_HISTORY_SCHEMA)
    for t, s, b, a in done:
        out = out.unionByName(history_row(spark, t, s, b, a, 0, f"snapshot {name}"))
    return out
