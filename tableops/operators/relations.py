"""Relationship inference from naming rules and relationship checks on data
(T10, T11, P9, J3, U1, O1, A10, R12, R13)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import entity_class

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's behaviour
# ---------------------------------------------------------------------------
KEY_PATTERN = "%KEY"
MONTH_KEY_PATTERN = "%MONTH%KEY"
DATE_KEY_PATTERN = "%DATE%KEY"
MONTH_PATTERN = "%MONTH%"
EXCLUDED_COLUMNS = ["MD_NATURAL_KEY", "PKEY"]
EXCLUDED_DATE_COLUMNS = ["MD_NATURAL_KEY", "PKEY", "DATE_KEY"]
DIM_SUFFIX, DFACT_SUFFIX = "_DIM", "_DFACT"
MONTH_TARGET, DATE_TARGET = "MONTH_DIM_VIEW", "DATE_DIM"
RIGHT_COLUMN = "PKEY"
KEY_SUFFIX_LEN = 4  # the characters of "_KEY" cut from a key column

EDGE_COLUMNS = ["left_table", "left_column", "right_table", "right_column"]


def infer_relationships(tables: DataFrame, columns: DataFrame, schema: str = "PUBLIC") -> DataFrame:
    """R12 (T11 + J3 + P9 + U1): edges from naming rules.

    All four rules apply (a column may give several edges):
      1. ``X_KEY`` -> table ``X_DIM`` if it exists (and has a column);
      2. ``X_KEY`` -> table ``X_DFACT`` if it exists (and has a column);
      3. ``%MONTH%KEY`` -> ``MONTH_DIM_VIEW`` (not checked);
      4. ``%DATE%KEY`` without MONTH, not ``DATE_KEY`` -> ``DATE_DIM`` (not checked).
    Rules 1-2 are one equi-join of the computed target name against the
    tables that have at least one column (a semi-join, so the number of
    columns does not multiply edges); the UNION's duplicate removal is a
    ``distinct`` (hash aggregate).
    """
    in_schema = tables.filter(F.col("table_schema") == schema).select("table_name").distinct()
    cols = columns.join(in_schema, "table_name", "left_semi").select(
        F.col("table_name").alias("left_table"), F.col("column_name").alias("left_column"))

    keyed = cols.filter(F.col("left_column").like(KEY_PATTERN)
                        & ~F.col("left_column").isin(*EXCLUDED_COLUMNS))
    stem = F.expr(f"substring(left_column, 1, length(left_column) - {KEY_SUFFIX_LEN})")
    candidates = keyed.select(
        "left_table", "left_column",
        F.explode(F.array(F.concat(stem, F.lit(DIM_SUFFIX)),
                          F.concat(stem, F.lit(DFACT_SUFFIX)))).alias("right_table"))
    targets = cols.select(F.col("left_table").alias("right_table")).distinct()
    by_name = candidates.join(targets, "right_table", "left_semi")

    month = cols.filter(F.col("left_column").like(MONTH_KEY_PATTERN)
                        & ~F.col("left_column").isin(*EXCLUDED_COLUMNS)) \
        .withColumn("right_table", F.lit(MONTH_TARGET))
    date = cols.filter(F.col("left_column").like(DATE_KEY_PATTERN)
                       & ~F.col("left_column").like(MONTH_PATTERN)
                       & ~F.col("left_column").isin(*EXCLUDED_DATE_COLUMNS)) \
        .withColumn("right_table", F.lit(DATE_TARGET))

    edges = reduce(DataFrame.unionByName,
                   [d.select("left_table", "left_column", "right_table")
                    for d in (by_name, month, date)])
    return edges.distinct().withColumn("right_column", F.lit(RIGHT_COLUMN)).select(*EDGE_COLUMNS)


def order_edges(edges: DataFrame) -> DataFrame:
    """O1: the reference's output order (right table, then left table)."""
    return edges.orderBy("right_table", "left_table", "left_column")


def entities(edges: DataFrame, columns: DataFrame | None = None) -> DataFrame:
    """A10 + T10: each distinct left/right table once, with its colour class,
    its first-seen position key and (optionally) its ordered column list.

    First seen = the smallest (right table, left table, side) over the
    edges where it appears, side 0 for left and 1 for right; sorting
    entities by it reproduces the order in which a scan of the ordered
    edge list meets them.  A group-by, not a global window."""
    sep = F.lit("\u0001")
    left = edges.select(F.col("left_table").alias("entity"),
                        F.concat_ws("\u0001", "right_table", "left_table", F.lit("0"))
                        .alias("seen"))
    right = edges.select(F.col("right_table").alias("entity"),
                         F.concat_ws("\u0001", "right_table", "left_table", F.lit("1"))
                         .alias("seen"))
    ents = (left.unionByName(right).groupBy("entity")
            .agg(F.min("seen").alias("seen"))
            .select("entity", entity_class("entity").alias("color"),
                    F.replace(F.col("seen"), sep, F.lit("|")).alias("first_seen_key")))
    if columns is None:
        return ents
    item = F.struct(F.col("ordinal_position").alias("o"),
                    F.concat_ws(" ", "column_name", "data_type").alias("t"))
    folded = (columns.groupBy(F.col("table_name").alias("entity"))
              .agg(F.array_join(F.transform(F.array_sort(F.collect_list(item)),
                                            lambda x: x["t"]), ", ").alias("column_list")))
    return ents.join(folded, "entity", "left")


def _key_text(name: str, kind: T.DataType) -> Column:
    """A key as text; equal numbers of any numeric type give equal text."""
    c = F.col(name)
    if isinstance(kind, T.DecimalType) and kind.scale:
        return F.regexp_replace(c.cast("string"), r"\.?0+$", "")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        whole = (c == F.floor(c)) & (F.abs(c) < F.lit(1e18))
        return F.when(whole, c.cast("decimal(38,0)").cast("string")).otherwise(
            F.when(F.abs(c) < F.lit(1e18), F.regexp_replace(
                c.cast("decimal(38,15)").cast("string"), r"\.?0+$", ""))
            .otherwise(c.cast("string")))
    return c.cast("string")


def _tagged_keys(frames: dict[str, DataFrame], wanted: dict[str, list[tuple[int, str]]],
                 key_type: str) -> DataFrame:
    """(edge, k) rows: each table read once for all the edges listed for it,
    its key columns exploded side by side."""
    parts = []
    for table, cols in wanted.items():
        kinds = {f.name: f.dataType for f in frames[table].schema.fields}
        items = [F.struct(F.lit(e).alias("edge"),
                          (F.col(c).cast("bigint") if key_type == "bigint"
                           else _key_text(c, kinds[c])).alias("k")) for e, c in cols]
        parts.append(frames[table].select(F.explode(F.array(*items)).alias("x"))
                     .select("x.edge", "x.k"))
    return reduce(DataFrame.unionByName, parts)


def check_relationships(frames: dict[str, DataFrame], edges: list[tuple[str, str, str, str]]
                        ) -> DataFrame:
    """Check each inferred or configured edge on the data.

    Per edge (child table, child column -> parent table, parent column):
    child rows, rows with a non-null key, distinct child keys, orphan keys
    and orphan rows (non-null key without a parent).

    Each table is scanned once as a child (all its child edges) and once as
    a parent (all its parent edges): its key columns are exploded into
    ``(edge, key)`` rows.  The child side is reduced
    to ``(edge, key, rows)`` by a partial aggregate, so a hot key costs one
    row per task before the shuffle; the parent side to its distinct keys;
    one left join and one aggregate per edge give all counts.
    """
    integral = ("tinyint", "smallint", "int", "bigint")
    types = {frames[t].schema[c].dataType.simpleString()
             for ch, cc, pt, pc in edges for t, c in ((ch, cc), (pt, pc))}
    key_type = "bigint" if types <= set(integral) else "string"
    child_cols: dict[str, list[tuple[int, str]]] = {}
    parent_cols: dict[str, list[tuple[int, str]]] = {}
    for i, (child, ccol, parent, pcol) in enumerate(edges):
        child_cols.setdefault(child, []).append((i, ccol))
        parent_cols.setdefault(parent, []).append((i, pcol))
    keyed = (_tagged_keys(frames, child_cols, key_type).groupBy("edge", "k")
             .agg(F.count(F.lit(1)).alias("n")))
    parents = (_tagged_keys(frames, parent_cols, key_type).filter(F.col("k").isNotNull())
               .distinct().withColumn("has_parent", F.lit(True)))
    orphan = F.col("k").isNotNull() & F.col("has_parent").isNull()
    stats = keyed.join(parents, ["edge", "k"], "left").groupBy("edge").agg(
        F.sum("n").cast("long").alias("child_rows"),
        F.coalesce(F.sum(F.when(F.col("k").isNotNull(), F.col("n"))), F.lit(0))
         .cast("long").alias("keyed_rows"),
        F.count("k").cast("long").alias("child_keys"),
        F.count_if(orphan).cast("long").alias("orphan_keys"),
        F.coalesce(F.sum(F.when(orphan, F.col("n"))), F.lit(0)).cast("long")
         .alias("orphan_rows"))
    spark = next(iter(frames.values())).sparkSession
    edge_rows = spark.createDataFrame(
        [(i, *e) for i, e in enumerate(edges)],
        "edge int, child_table string, child_column string, parent_table string, "
        "parent_column string")
    zero = F.lit(0).cast("long")
    return edge_rows.join(stats, "edge", "left").select(
        "child_table", "child_column", "parent_table", "parent_column",
        *[F.coalesce(c, zero).alias(c) for c in
          ("child_rows", "keyed_rows", "child_keys", "orphan_keys", "orphan_rows")])
