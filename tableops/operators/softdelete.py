"""Soft-delete views over replicated tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's behaviour
# ---------------------------------------------------------------------------
DELETE_FLAG = "_FIVETRAN_DELETED"
AUDIT_TABLE = "FIVETRAN_AUDIT"


def visible_columns(df: DataFrame, flag: str = DELETE_FLAG) -> list[str]:
    """Every column in ordinal order except the delete flag."""
    return [c for c in df.columns if c.upper() != flag.upper()]


def soft_delete_filter(df: DataFrame, flag: str = DELETE_FLAG) -> DataFrame:
    """P3 + P4: ``flag <> TRUE``.  A NULL flag is dropped too (NULL <> TRUE
    is NULL), exactly as in the reference's view."""
    return df.filter(F.col(flag) != F.lit(True)).select(*visible_columns(df, flag))


def view_sql(source: str, columns: list[str], flag: str = DELETE_FLAG) -> str:
    cols = ", ".join(f"`{c}`" for c in columns)
    return f"SELECT {cols} FROM {source} WHERE `{flag}` <> TRUE"


def soft_delete_views(spark: SparkSession, source_db: str, target_db: str,
                      flag: str = DELETE_FLAG, exclude: str = AUDIT_TABLE) -> DataFrame:
    """One create-or-replace view per table of ``source_db`` (except the
    audit table, P6) in ``target_db``; safe to re-run.  Loops over table
    names on the driver; every view is a plan, no data moves.  Returns
    ``(table_name, view_name, status)``; a table without the flag has no view."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {target_db}")
    made = []
    for t in sorted(spark.catalog.listTables(source_db), key=lambda t: t.name):
        if t.name == exclude or t.name.upper() == exclude:
            continue
        cols = [c.name for c in spark.catalog.listColumns(f"{source_db}.{t.name}")]
        keep = [c for c in cols if c.upper() != flag.upper()]
        if len(keep) == len(cols):
            made.append((t.name, None, f"no column {flag}"))
            continue
        spark.sql(f"CREATE OR REPLACE VIEW {target_db}.{t.name} AS "
                  + view_sql(f"{source_db}.{t.name}", keep, flag))
        made.append((t.name, f"{target_db}.{t.name}", "created"))
    return spark.createDataFrame(made, "table_name string, view_name string, status string")
