"""Type inference over an all-text stage table.

The reference issues up to 14 statements per column (null count, number
check, scale, one count per timestamp mask).  Here every test for every
column runs in a single aggregate job — one scan, one partial (map-side)
aggregation per task.  The result (one row per column) is bounded by the
column count, so it is brought to the driver to build the typed
projection.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import decimal_scale, to_number, try_number
from ..functions.timestamps import (NOT_A_DATE, TIMESTAMP_INPUT_FORMATS, first_zero_mask,
                                    parses_as_timestamp, to_timestamp)

VARCHAR, NUMBER, DATETIME = "VARCHAR", "NUMBER", "DATETIME"

PROFILE_SCHEMA = T.StructType([
    T.StructField("ordinal", T.IntegerType(), False),
    T.StructField("column_name", T.StringType(), False),
    T.StructField("non_null", T.LongType(), False),
    T.StructField("data_type", T.StringType(), True),
    T.StructField("scale", T.IntegerType(), True),
    T.StructField("date_mask", T.StringType(), True),
])


@dataclass(frozen=True)
class ColumnProfile:
    ordinal: int
    column_name: str
    non_null: int
    data_type: str | None   # None: all-null, left out of the typed table
    scale: int | None
    date_mask: str | None


def _fail_count(c: Column, parsed: Column) -> Column:
    return F.count_if(c.isNotNull() & parsed.isNull())


def profile_aggregate(stage: DataFrame) -> DataFrame:
    """All tests for all columns in one scan: the stage is unpivoted to
    ``(column_name, v)`` and grouped by column with nine aggregates.  The
    generated code has the same size for 5 or 500 columns, and the partial
    aggregate per task holds one small row per column before the shuffle."""
    names = stage.columns
    if not names:
        raise ValueError("stage has no columns")
    long = stage.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("column_name"), F.col(f"`{n}`").alias("v")) for n in names]))
        .alias("kv")).select("kv.column_name", "kv.v")
    v = F.col("v")
    return long.groupBy("column_name").agg(
        F.count(v).alias("nn"),
        _fail_count(v, try_number(v)).alias("num"),
        F.coalesce(F.max(decimal_scale(v)), F.lit(0)).alias("scale"),
        *[F.count_if(v.isNotNull() & ~parses_as_timestamp(v, m)).alias(f"ts{j}")
          for j, m in enumerate(TIMESTAMP_INPUT_FORMATS)])


def profile_frame(stage: DataFrame) -> DataFrame:
    """Profile as a DataFrame (one row per column) computed by one aggregate.

    Order of tests (T4): all-null -> dropped (data_type NULL); number
    (zero tolerant-parse failures) with scale = max characters after '.';
    else the first timestamp mask with zero failures; else VARCHAR.
    """
    spark = stage.sparkSession
    ordinals = spark.createDataFrame(list(enumerate(stage.columns, start=1)),
                                     "ordinal int, column_name string")
    agg = profile_aggregate(stage)
    j = ordinals.join(agg, "column_name", "left")
    nn = F.coalesce(F.col("nn"), F.lit(0))
    num_ok = F.col("num") == 0
    mask = first_zero_mask([F.col(f"ts{k}") for k in range(len(TIMESTAMP_INPUT_FORMATS))])
    return j.select(
        F.col("ordinal"), F.col("column_name"), nn.alias("non_null"),
        F.when(nn == 0, F.lit(None).cast("string")).when(num_ok, F.lit(NUMBER))
         .when(mask != NOT_A_DATE, F.lit(DATETIME)).otherwise(F.lit(VARCHAR)).alias("data_type"),
        F.when(nn == 0, F.lit(None)).when(num_ok, F.col("scale").cast("int")).alias("scale"),
        F.when(nn == 0, F.lit(None)).when(num_ok, F.lit(None).cast("string"))
         .otherwise(mask).alias("date_mask"))


def profile_columns(stage: DataFrame) -> list[ColumnProfile]:
    """Run the single profiling job and return the (column-count sized) profile."""
    rows = sorted(profile_frame(stage).collect(), key=lambda r: r.ordinal)
    return [ColumnProfile(r.ordinal, r.column_name, r.non_null, r.data_type, r.scale,
                          r.date_mask) for r in rows]


def typed_column(name: str, p: ColumnProfile) -> Column:
    c = F.col(f"`{name}`")
    if p.data_type == NUMBER:
        return to_number(c, p.scale or 0).alias(name)
    if p.data_type == DATETIME:
        return to_timestamp(c, p.date_mask).alias(name)
    return c.alias(name)


def typed_projection(stage: DataFrame, profile: list[ColumnProfile]) -> DataFrame:
    """Cast every surviving column to its inferred type (P2 + T5).

    All-null columns are left out.  Casts are strict (ANSI), so a value
    that stops parsing fails the job, like the reference's INSERT.
    """
    return stage.select(*[typed_column(p.column_name, p) for p in profile
                          if p.data_type is not None])
