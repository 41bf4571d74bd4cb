"""Catalog metadata jobs: type mapping, column folding, schema conversion
(S7, S9, T7, J1, P5, A9, R2).

Catalogs are DataFrames with the information-schema shape
``catalog_tables(table_catalog, table_schema, table_name, table_type)`` and
``catalog_columns(table_catalog, table_schema, table_name, column_name,
data_type, numeric_scale, ordinal_position)``; they can come from
``spark.catalog`` (``session_catalog``), from a JDBC read of a source's
information schema, or from any DataFrame of that shape.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import work_dir

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's behaviour
# ---------------------------------------------------------------------------
# Source types that become NUMBER(38, scale) and DATETIME; anything else is VARCHAR.
NUMBER_TYPES = ["smallint", "tinyint", "decimal", "float", "int", "money", "numeric"]
DATETIME_TYPES = ["datetime", "datetime2", "smalldatetime"]
# Source column types left out of replication.
BINARY_TYPES = ["varbinary", "image", "binary"]
BASE_TABLE = "BASE TABLE"

TABLE_KEYS = ["table_catalog", "table_schema", "table_name"]


def map_source_type(data_type: Column | str, numeric_scale: Column | str) -> Column:
    """Target type text for a source column type."""
    t = F.col(data_type) if isinstance(data_type, str) else data_type
    s = F.col(numeric_scale) if isinstance(numeric_scale, str) else numeric_scale
    scale = F.coalesce(s.cast("string"), F.lit("0"))
    return (F.when(t.isin(*NUMBER_TYPES), F.concat(F.lit("NUMBER(38, "), scale, F.lit(")")))
            .when(t.isin(*DATETIME_TYPES), F.lit("DATETIME"))
            .otherwise(F.lit("VARCHAR")))


def spark_type_for(target_type: str) -> T.DataType:
    """Spark type of a mapped target type text."""
    if target_type.startswith("NUMBER("):
        scale = int(target_type[len("NUMBER("):-1].split(",")[1])
        return T.DecimalType(38, scale)
    if target_type == "DATETIME":
        return T.TimestampNTZType()
    return T.StringType()


def base_table_columns(tables: DataFrame, columns: DataFrame) -> DataFrame:
    """J1 + P5: columns of base tables (3-key equi-join), binary types dropped."""
    base = tables.filter(F.col("table_type") == BASE_TABLE).select(*TABLE_KEYS)
    return (columns.join(base, TABLE_KEYS, "inner")
            .filter(~F.col("data_type").isin(*BINARY_TYPES)))


def type_mapping(tables: DataFrame, columns: DataFrame) -> DataFrame:
    """Target type for every replicable column."""
    return base_table_columns(tables, columns).withColumn(
        "target_type", map_source_type("data_type", "numeric_scale"))


def group_columns(mapped: DataFrame, sep: str = ", ") -> DataFrame:
    """One row per table with its ``name TYPE`` list in ordinal order.

    A group is one table's columns (bounded by the table width), folded
    with a sorted ``collect_list`` after a map-side partial aggregate."""
    item = F.struct(F.col("ordinal_position").alias("o"),
                    F.concat_ws(" ", "column_name", "target_type").alias("t"))
    return (mapped.groupBy(*TABLE_KEYS)
            .agg(F.count(F.lit(1)).alias("n_columns"),
                 F.array_join(F.transform(F.array_sort(F.collect_list(item)),
                                          lambda x: x["t"]), sep).alias("column_list")))


def convert_schema(df: DataFrame, mapping: list[tuple[str, str]]) -> DataFrame:
    """R2: cast a copied table to its mapped target types.

    ``mapping`` is ``[(column_name, target_type), ...]`` in ordinal order;
    columns not listed (binary ones) are left out."""
    return df.select(*[F.col(f"`{c}`").cast(spark_type_for(t)).alias(c) for c, t in mapping])


REJECTS_COL, KEY_COL = "_conversion_rejects", "_conversion_key"
CONVERTED, IN_PART, FAILED = "converted", "converted in part", "failed"
REJECT_SCHEMA = "table_name string, key string, column_name string, value string, target_type string"


def convert_with_rejects(df: DataFrame, mapping: list[tuple[str, str]],
                         key: list[str] | None = None) -> DataFrame:
    """R2: ``convert_schema`` with each cast paired with its tolerant twin.

    A value that its target type cannot hold becomes NULL and an entry of
    ``_conversion_rejects`` (column, value, target type); rows with entries keep
    their key as JSON in ``_conversion_key``.  Nothing fails at run time."""
    columns, entries = [], []
    for name, target in mapping:
        c = F.col(f"`{name}`")
        cast = c.try_cast(spark_type_for(target))
        columns.append(cast.alias(name))
        if not isinstance(spark_type_for(target), T.StringType):
            entries.append(F.when(c.isNotNull() & cast.isNull(), F.struct(
                F.lit(name).alias("column_name"), c.cast("string").alias("value"),
                F.lit(target).alias("target_type"))))
    none = F.array().cast("array<struct<column_name:string,value:string,target_type:string>>")
    rejects = F.array_compact(F.array(*entries)) if entries else none
    row_key = F.to_json(F.struct(*[F.col(f"`{k}`") for k in key])) if key else F.lit(None)
    return (df.select(*columns, rejects.alias(REJECTS_COL), row_key.cast("string").alias(KEY_COL))
            .withColumn(KEY_COL, F.when(F.size(REJECTS_COL) > 0, F.col(KEY_COL))))


@dataclass
class Conversion:
    """``frames`` the copies by table, ``status`` a row per table, ``rejects`` a row
    per value that its target type cannot hold."""
    frames: dict[str, DataFrame]
    status: DataFrame
    rejects: DataFrame


def _copy_converted(df: DataFrame, mapping: list[tuple[str, str]], key: list[str] | None,
                    path: str) -> tuple:
    """Copy one table in one pass and read its counts from the copy."""
    convert_with_rejects(df, mapping, key).write.parquet(path)
    copied = df.sparkSession.read.parquet(path).select(REJECTS_COL)
    n = F.size(REJECTS_COL)
    counts = copied.agg(F.count(F.lit(1)), F.count_if(n > 0), F.coalesce(F.sum(n), F.lit(0)),
                        F.min(F.when(n > 0, F.get(REJECTS_COL, F.lit(0))))).first()
    return tuple(counts)


def convert_tables(spark: SparkSession, frames: dict[str, DataFrame], mapped: DataFrame,
                   target_base: str | None = None, keys: dict[str, list[str]] | None = None,
                   keep_good_rows: bool = False, parallel: int = 4) -> Conversion:
    """R2 over several tables: each copied with its columns cast to their
    target types, one status row per table.

    A table fails if its mapping cannot be applied, if it cannot be read, or if
    a value cannot be converted; it is reported, its bad values are in
    ``rejects``, and the others continue.  With ``keep_good_rows`` a table with
    bad values is kept without the rows that hold them.  Tables are copied
    ``parallel`` at a time, each by a distributed write into a folder of its own
    (``<target_base>/<table>-<id>``; the shared work folder by default)."""
    per_table: dict[str, list[tuple[int, str, str]]] = {}
    wanted = mapped.filter(F.col("table_name").isin(list(frames)))
    for r in wanted.select("table_name", "ordinal_position", "column_name",
                           "target_type").collect():
        per_table.setdefault(r.table_name, []).append(
            (r.ordinal_position, r.column_name, r.target_type))
    base = (target_base or work_dir(spark, "converted")).rstrip("/")
    keys = keys or {}

    def attempt(name: str) -> tuple:
        path = f"{base}/{name}-{uuid.uuid4().hex[:12]}"
        if name not in per_table:
            return name, path, None, "no columns are mapped"
        try:
            mapping = [(c, t) for _, c, t in sorted(per_table[name])]
            return name, path, _copy_converted(frames[name], mapping, keys.get(name), path), None
        except Exception as e:  # noqa: BLE001 - reported per table, like the reference
            return name, path, None, str(e)[:2000]

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        done = list(pool.map(attempt, frames))
    out, status = {}, []
    rejects = spark.createDataFrame([], REJECT_SCHEMA)
    for name, path, counts, error in done:
        if counts is None:
            status.append((name, FAILED, error, None, None, None))
            continue
        n_rows, bad_rows, bad_values, first = counts
        if bad_values:
            error = (f"{bad_values} values cannot be converted; one is {first['value']!r} in "
                     f"{first['column_name']} for {first['target_type']}")
            copied = spark.read.parquet(path).filter(F.size(REJECTS_COL) > 0)
            rejects = rejects.unionByName(
                copied.select(KEY_COL, F.explode(REJECTS_COL).alias("r")).select(
                    F.lit(name).alias("table_name"), F.col(KEY_COL).alias("key"), "r.*"))
        state = CONVERTED if not bad_values else IN_PART if keep_good_rows else FAILED
        if state != FAILED:
            out[name] = (spark.read.parquet(path).filter(F.size(REJECTS_COL) == 0)
                         .drop(REJECTS_COL, KEY_COL))
        status.append((name, state, error, n_rows, bad_rows, bad_values))
    return Conversion(out, spark.createDataFrame(
        status, "table_name string, status string, error string, n_rows long, "
                "rejected_rows long, rejected_values long"), rejects)


# -- S7 / S9 from the session catalog ----------------------------------------
_SPARK_TO_SOURCE = {
    "bigint": "bigint", "int": "int", "smallint": "smallint", "tinyint": "tinyint",
    "double": "float", "float": "float", "string": "varchar", "boolean": "bit",
    "timestamp_ntz": "datetime2", "timestamp": "datetime2", "date": "date",
    "binary": "varbinary",
}


def session_catalog(spark: SparkSession, database: str,
                    catalog: str = "spark_catalog") -> tuple[DataFrame, DataFrame]:
    """S7 + S9: information-schema shaped tables/columns of one database."""
    trows, crows = [], []
    for t in spark.catalog.listTables(database):
        ttype = "VIEW" if t.tableType in ("VIEW", "TEMPORARY") else BASE_TABLE
        trows.append((catalog, database, t.name, ttype))
        for i, c in enumerate(spark.catalog.listColumns(f"{database}.{t.name}")):
            dt = c.dataType
            scale = int(dt.split(",")[1].rstrip(")")) if dt.startswith("decimal(") else None
            src = "decimal" if dt.startswith("decimal(") else _SPARK_TO_SOURCE.get(dt, dt)
            crows.append((catalog, database, t.name, c.name, src, scale, i + 1))
    tables = spark.createDataFrame(
        trows, "table_catalog string, table_schema string, table_name string, table_type string")
    columns = spark.createDataFrame(
        crows, "table_catalog string, table_schema string, table_name string, "
               "column_name string, data_type string, numeric_scale int, ordinal_position int")
    return tables, columns


def list_tables(tables: DataFrame, schema: str | None = None,
                base_only: bool = True, exclude: str | None = None) -> DataFrame:
    """S7 variants: base tables of one schema ordered by name; all base
    tables; or everything except one named table."""
    out = tables
    if schema is not None:
        out = out.filter(F.col("table_schema") == schema)
    if base_only:
        out = out.filter(F.col("table_type") == BASE_TABLE)
    if exclude is not None:
        out = out.filter(F.col("table_name") != exclude)
    return out.orderBy("table_name")


def frame_catalog(frames: dict[str, DataFrame], catalog: str = "spark_catalog",
                  schema: str = "default") -> tuple[DataFrame, DataFrame]:
    """S7 + S9 for DataFrames that are not in a catalog (their schemas)."""
    spark = next(iter(frames.values())).sparkSession
    trows, crows = [], []
    for name, df in frames.items():
        trows.append((catalog, schema, name, BASE_TABLE))
        for i, f in enumerate(df.schema.fields):
            dt = f.dataType.simpleString()
            scale = f.dataType.scale if isinstance(f.dataType, T.DecimalType) else None
            src = "decimal" if scale is not None else _SPARK_TO_SOURCE.get(dt, dt)
            crows.append((catalog, schema, name, f.name, src, scale, i + 1))
    tables = spark.createDataFrame(
        trows, "table_catalog string, table_schema string, table_name string, table_type string")
    columns = spark.createDataFrame(
        crows, "table_catalog string, table_schema string, table_name string, "
               "column_name string, data_type string, numeric_scale int, ordinal_position int")
    return tables, columns


def dataset_tables(spark: SparkSession, database: str) -> list[str]:
    """Names of every table of one database (names only, on the driver)."""
    return sorted(t.name for t in spark.catalog.listTables(database))
