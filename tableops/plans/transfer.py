"""R18 ``transfer_dataset``: for each table of a dataset, count, export to
CSV (one folder per table), empty the target, load the export strictly
(any bad row fails) and count again; one result row per table.

The export keeps every value: a column is written as text that casts back to
the same value (JSON for arrays and structs, base64 for binary), NULL as
``\\N`` and a text that starts with a backslash with one more, so that
NULL, '' and line breaks inside quotes differ.  The files are gzipped, as a
table's text is several times its parquet, and have ``FILE_ROWS`` rows at the
most, so that many tasks read them back (``read_strict``)."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shuffles_removed
from ..sinks.writers import count_or_zero, write_csv
from ..sources.delimited import read_strict
from .replicate import source_manifest

RESULT_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("source_count", T.LongType()),
    T.StructField("rows_before", T.LongType()),
    T.StructField("rows_after", T.LongType()),
    T.StructField("matched", T.BooleanType()),
])
NULL_MARK = "\\N"
# A gzipped file is read by one task.
FILE_ROWS = 200_000
_NESTED = (T.ArrayType, T.StructType, T.MapType)


def to_text(field: T.StructField) -> Column:
    """A column as text that ``from_text`` turns back into the same values."""
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.StringType):
        text = F.when(F.startswith(c, F.lit("\\")), F.concat(F.lit("\\"), c)).otherwise(c)
    elif isinstance(field.dataType, T.BinaryType):
        text = F.base64(c)
    elif isinstance(field.dataType, _NESTED):
        text = F.to_json(c, {"ignoreNullFields": "false"})
    else:
        text = c.cast("string")
    return F.coalesce(text, F.lit(NULL_MARK)).alias(field.name)


def from_text(field: T.StructField) -> Column:
    raw = F.coalesce(F.col(f"`{field.name}`"), F.lit(""))  # the reader's NULL is ''
    text = F.when(raw != NULL_MARK, raw)
    if isinstance(field.dataType, T.StringType):
        value = F.when(F.startswith(text, F.lit("\\")), F.substr(text, F.lit(2))).otherwise(text)
    elif isinstance(field.dataType, T.BinaryType):
        value = F.unbase64(text)
    elif isinstance(field.dataType, _NESTED):
        value = F.from_json(text, field.dataType, {"mode": "FAILFAST"})
    else:
        value = text.cast(field.dataType)
    return value.alias(field.name)


def transfer_table(spark: SparkSession, name: str, df: DataFrame, export_base: str,
                   target_base: str) -> tuple:
    export = f"{export_base}/{name}"
    target = f"{target_base}/{name}"
    source_count = df.count()
    fields = df.schema.fields
    write_csv(df.select(*map(to_text, fields)), export, quote_all=True, header=True,  # K5
              compression="gzip", file_rows=FILE_ROWS)
    before = count_or_zero(spark, target)                                # K3: count before
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in fields])
    loaded = read_strict(spark, export, texts, header=True)          # S3
    loaded.select(*map(from_text, fields)).write.mode("overwrite").parquet(target)
    after = spark.read.parquet(target).count()                           # count after
    return name, source_count, before, after, source_count == after      # A7


def transfer_dataset(spark: SparkSession, tables: dict[str, DataFrame], export_base: str,
                     target_base: str, parallel: int = 4) -> DataFrame:
    """S8 loop over the dataset's tables (names only on the driver), ``parallel``
    at a time; each is moved by jobs of its own."""
    with shuffles_removed(spark), ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        rows = list(pool.map(lambda t: transfer_table(spark, *t, export_base, target_base),
                             sorted(tables.items())))
    return spark.createDataFrame(rows, RESULT_SCHEMA)


def equal_values(spark: SparkSession, tables: dict[str, DataFrame], target_base: str,
                 parallel: int = 4) -> list[tuple[str, bool]]:
    """Whether each table and its target hold the same values (``source_manifest``),
    ``parallel`` tables at a time."""
    def compare(name: str) -> tuple[str, bool]:
        target = spark.read.parquet(f"{target_base}/{name}")
        return name, source_manifest(tables[name], None, 0) == source_manifest(target, None, 0)

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        return list(pool.map(compare, sorted(tables)))
