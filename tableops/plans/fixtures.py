"""Stand-in inputs built from the test tables.

Each builder only renders rows of a test table into the shape a job reads
(text files, landed responses, catalog rows ...).  None of them does any of
the job's work; the jobs must be right on any input of that shape.
Files go to a fresh folder under the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import read_table, work_dir

# Header names given to the `part` columns in the semicolon fixture file.
PART_FILE_HEADERS = ["Part Key", "Part.Name", "Brand/Code", "Type (Text)", "Size",
                     "Retail Price (USD)", "Unused Column"]


def money_text(c) -> F.Column:
    """Amount as text with thousands commas, two decimals."""
    return F.format_number(F.col(c).cast("decimal(18,2)"), 2)


def orders_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`orders` rendered as an all-text stage plus one all-null column."""
    o = read_table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.col("o_custkey").cast("string").alias("o_custkey"),
        F.col("o_orderstatus"),
        money_text("o_totalprice").alias("o_totalprice"),
        F.upper(F.date_format("o_orderdate", "dd-MMM-yy")).alias("o_orderdate"),
        F.col("o_orderpriority"),
        F.lit(None).cast("string").alias("o_comment"),
    )


def orders_before_and_after(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """`orders` with even keys, and an older state of them: without the first
    keys, with other prices in one hundredth of the key range and with rows of
    odd keys, gone by now, in another."""
    o = read_table(spark, sf_dir, "orders")
    top = o.agg(F.max("o_orderkey")).first()[0]
    newer = o.withColumn("o_orderkey", F.col("o_orderkey") * 2)
    share = F.floor(F.col("o_orderkey") * 50 / F.lit(top + 1))
    older = newer.filter(F.col("o_orderkey") > 20).withColumn(
        "o_totalprice", F.when(share == 20, F.col("o_totalprice") + 1)
        .otherwise(F.col("o_totalprice")))
    gone = newer.filter((share == 70) & (F.col("o_orderkey") % 20 == 0)).withColumn(
        "o_orderkey", F.col("o_orderkey") + 1)
    return older.unionByName(gone), newer


# Renderings of one timestamp, one per candidate mask (Spark patterns).
EVENT_TS_RENDERINGS = [
    ("ts_dd_mon_yy", "dd-MMM-yy"),
    ("ts_mon_dd_yyyy", "MMM dd, yyyy hh:mm:ss a"),
    ("ts_dd_mon_yy_ff9", "dd-MMM-yy hh.mm.ss.SSSSSSSSS a"),
    ("ts_yyyy", "yyyy-"),
    ("ts_mm_dd_yyyy", "MM/dd/yyyy hh:mm a"),
    ("ts_iso", "yyyy-MM-dd HH:mm:ss"),
]


def events_ts_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    return e.select(F.col("event_id").cast("string").alias("event_id"),
                    *[F.date_format("ts", fmt).alias(name) for name, fmt in EVENT_TS_RENDERINGS],
                    F.col("event_type"))


def part_semicolon_file(spark: SparkSession, sf_dir: str) -> str:
    """`part` as a ';'-delimited file with odd headers and an empty column."""
    p = read_table(spark, sf_dir, "part")
    out = work_dir(spark, "fixture-part")
    (p.select(F.col("p_partkey").cast("string"), "p_name", "p_brand", "p_type",
              F.col("p_size").cast("string"),
              F.col("p_retailprice").cast("decimal(18,2)").cast("string"),
              F.lit(None).cast("string"))
     .toDF(*PART_FILE_HEADERS)
     .write.option("sep", ";").option("header", True).option("nullValue", "")
     .csv(out))
    return out


def customer_csv_with_rejects(spark: SparkSession, sf_dir: str) -> str:
    """`customer` as CSV; rows with a negative balance carry one extra field."""
    c = read_table(spark, sf_dir, "customer")
    out = work_dir(spark, "fixture-customer")
    last = F.when(F.col("c_acctbal") < 0, F.concat("c_mktsegment", F.lit(",EXTRA"))) \
        .otherwise(F.col("c_mktsegment"))
    (c.select(F.col("c_custkey").cast("string").alias("c_custkey"), "c_name",
              F.col("c_nationkey").cast("string").alias("c_nationkey"),
              F.col("c_acctbal").cast("decimal(18,2)").cast("string").alias("c_acctbal"),
              last.alias("c_mktsegment"))
     .write.option("header", True).option("quote", "\u0000").csv(out))
    return out


CUSTOMER_HEADER = "c_custkey,c_name,c_nationkey,c_acctbal,c_mktsegment"


def customer_csv_with_errors(spark: SparkSession, sf_dir: str) -> str:
    """`customer` as one CSV file per nation, in key order, with a field too many
    (negative balances), records that end after two fields, blank lines, quoted
    line breaks (nations of even keys) and, in the first nation, a last record
    whose quote is not closed.  Folders are named ``folder=<nation>``."""
    c = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_mktsegment", "c_acctbal")
    key = F.col("c_custkey")
    last = c.filter("c_nationkey = 0").agg(F.max("c_custkey")).first()[0]
    name = F.when((key % 13 == 5) & (F.col("c_nationkey") % 2 == 0),
                  F.concat(F.lit('"'), F.col("c_name"), F.lit('\nand ""more"""'))) \
        .otherwise(F.col("c_name"))
    whole = F.concat_ws(",", key, name, "c_nationkey",
                        F.col("c_acctbal").cast("decimal(18,2)"), "c_mktsegment")
    record = (F.when(key == (last or 0), F.concat(key, F.lit(',"'), F.col("c_name"), F.lit(",x")))
              .when(F.col("c_acctbal") < 0, F.concat(whole, F.lit(",EXTRA")))
              .when(key % 11 == 3, F.concat(key, F.lit(","), F.col("c_name")))
              .otherwise(whole))
    rows = c.select(F.col("c_nationkey").alias("folder"), key.alias("at"), F.concat(
        F.when(key % 17 == 1, F.lit(" \n")).otherwise(F.lit("")), record).alias("value"))
    head = rows.select("folder").distinct().select(
        "folder", F.lit(-1).cast("long").alias("at"), F.lit(CUSTOMER_HEADER).alias("value"))
    out = work_dir(spark, "fixture-customer-errors")
    (rows.unionByName(head).repartition(F.xxhash64("folder")).sortWithinPartitions("folder", "at")
     .select("folder", "value").write.partitionBy("folder").text(out))
    return out


# Source column types given to the catalog rows derived from `part`
# (the type list of the reference's source system, binary ones included).
SOURCE_TYPES = ["smallint", "tinyint", "decimal", "float", "int", "money", "numeric",
                "datetime", "datetime2", "smalldatetime", "bigint", "bit", "date",
                "varchar", "nvarchar", "varbinary", "image", "binary"]


def catalog_from_part(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """An information-schema catalog whose tables and columns are named from
    `part` rows: table = a part type or noun with a _DIM/_DFACT/_FACT suffix
    by size; column = a *_KEY, *_MONTH_KEY, *_DATE_KEY, excluded or plain name
    by brand number; type from the size.  (table, column) pairs are unique."""
    p = read_table(spark, sf_dir, "part")
    noun = F.upper(F.split_part("p_name", F.lit(" "), F.lit(2)))
    adj = F.upper(F.split_part("p_name", F.lit(" "), F.lit(1)))
    ptype = F.upper("p_type")
    b = F.split_part("p_brand", F.lit("#"), F.lit(2)).cast("int")
    suffix = (F.when(F.col("p_size") <= 10, F.lit("_DIM"))
              .when(F.col("p_size") <= 20, F.lit("_DFACT")).otherwise(F.lit("_FACT")))
    table = F.concat(F.when(b % 2 == 0, ptype).otherwise(noun), suffix)
    column = (F.when(F.col("p_size") % 7 == 0, F.concat_ws("_", adj, noun, F.lit("NAME")))
              .when(b % 5 == 0, F.concat(ptype, F.lit("_KEY")))
              .when(b % 5 == 1, F.concat(noun, F.lit("_KEY")))
              .when(b % 5 == 2, F.concat(adj, F.lit("_MONTH_KEY")))
              .when(b % 5 == 3, F.concat(adj, F.lit("_DATE_KEY")))
              .otherwise(F.element_at(F.array(*[F.lit(x) for x in (
                  "PKEY", "MD_NATURAL_KEY", "DATE_KEY", "MONTH_DATE_KEY")]),
                  (F.col("p_size") % 4 + 1).cast("int"))))
    dtype = F.element_at(F.array(*[F.lit(t) for t in SOURCE_TYPES]),
                         (F.col("p_size") % len(SOURCE_TYPES) + 1).cast("int"))
    scale = F.when(dtype.isin("decimal", "numeric", "money"), F.col("p_size") % 3) \
        .when((dtype == "float") & (F.col("p_size") % 2 == 0), F.lit(2))
    rows = p.select(table.alias("table_name"), column.alias("column_name"),
                    dtype.alias("data_type"), scale.cast("int").alias("numeric_scale"),
                    "p_partkey")
    cols = (rows.groupBy("table_name", "column_name")
            .agg(F.min_by(F.struct("data_type", "numeric_scale"), "p_partkey").alias("t"),
                 F.min("p_partkey").alias("first_key")))
    from pyspark.sql import Window
    w = Window.partitionBy("table_name").orderBy("first_key")
    columns = cols.select(
        F.lit("PROD_DB").alias("table_catalog"), F.lit("PUBLIC").alias("table_schema"),
        "table_name", "column_name", F.col("t.data_type").alias("data_type"),
        F.col("t.numeric_scale").alias("numeric_scale"),
        F.row_number().over(w).cast("int").alias("ordinal_position"))
    tables = columns.select("table_catalog", "table_schema", "table_name").distinct() \
        .withColumn("table_type", F.when(F.col("table_name").startswith("PROMO"), F.lit("VIEW"))
                    .otherwise(F.lit("BASE TABLE")))
    # land both as catalog tables, read back like an information schema
    base = work_dir(spark, "fixture-catalog")
    columns.write.parquet(f"{base}/columns")
    tables.write.parquet(f"{base}/tables")
    return spark.read.parquet(f"{base}/tables"), spark.read.parquet(f"{base}/columns")


def frames_to_convert(spark: SparkSession, sf_dir: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """Tables with the column types of their source: `orders` as texts, some of
    which are no numbers or dates, `supplier` without one of its columns."""
    from ..operators import metadata
    frames = {n: read_table(spark, sf_dir, n) for n in ("orders", "customer", "lineitem", "supplier")}
    mapped = metadata.type_mapping(*metadata.frame_catalog(frames))
    key = F.col("o_orderkey")
    frames["orders"] = frames["orders"].select(
        key, "o_custkey", "o_orderstatus",
        F.when(key % 50 == 7, F.lit("n/a")).when(key % 50 == 8, F.lit(None))
         .otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string")).alias("o_totalprice"),
        F.when(key % 70 == 7, F.concat(F.date_format("o_orderdate", "yyyy-13-dd")))
         .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).alias("o_orderdate"),
        "o_orderpriority")
    frames["supplier"] = frames["supplier"].drop("s_acctbal")
    return frames, mapped


def write_file_tree(rows: DataFrame, base: str) -> str:
    """Write ``(rel_path, content)`` rows as files under ``base`` (sub-folders
    made as needed), spread over tasks with ``mapInPandas``."""
    import os

    import pandas as pd
    root = base[len("file:"):] if base.startswith("file:") else base

    def _write(batches):
        for pdf in batches:
            for rel, content in zip(pdf["rel_path"], pdf["content"]):
                path = os.path.join(root, rel)
                os.makedirs(os.path.dirname(path), exist_ok=True)
                with open(path, "wb") as fh:
                    fh.write(content)
            yield pd.DataFrame({"n": [len(pdf)]})

    rows.select("rel_path", "content").repartition("rel_path").mapInPandas(_write, "n long") \
        .agg(F.sum("n")).collect()
    return base


def documents_csv(spark: SparkSession, sf_dir: str) -> str:
    """`documents` as a CSV file in the sources' encoding: texts with line breaks
    and quotes, every fifth language empty."""
    out = work_dir(spark, "fixture-documents-csv")
    text = F.concat(F.col("text"), F.when(F.col("doc_id") % 7 == 0, F.lit(' "quoted"\n,"tail"'))
                    .otherwise(F.lit("")))
    (read_table(spark, sf_dir, "documents")
     .select(F.col("doc_id").alias("Doc Id"), text.alias("Text"),
             F.when(F.col("doc_id") % 5 > 0, F.col("lang")).alias("Lang"))
     .write.option("header", True).option("encoding", "ISO-8859-1").option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(out))
    return out


def doc_file_name(id_col: str = "doc_id") -> F.Column:
    return F.concat(F.lit("doc_"), F.col(id_col).cast("string"), F.lit(".txt"))


def document_files(spark: SparkSession, sf_dir: str, missing: str | None = None) -> str:
    """A folder with one text file per document, except those in the language
    ``missing`` (files that a manifest names and the folder lacks)."""
    d = read_table(spark, sf_dir, "documents")
    if missing is not None:
        d = d.filter(F.col("lang") != missing)
    base = work_dir(spark, "fixture-docfiles")
    return write_file_tree(d.select(doc_file_name().alias("rel_path"),
                                    F.encode("text", "UTF-8").alias("content")), base)


def document_folders(spark: SparkSession, sf_dir: str) -> str:
    """Documents filed under one sub-folder per source ('Source srcN'), the
    German ones under 'Compressed'."""
    d = read_table(spark, sf_dir, "documents")
    folder = F.when(F.col("lang") == "de", F.lit("Compressed")) \
        .otherwise(F.concat(F.lit("Source "), F.col("source")))
    base = work_dir(spark, "fixture-docfolders")
    return write_file_tree(d.select(F.concat_ws("/", folder, doc_file_name()).alias("rel_path"),
                                    F.encode("text", "UTF-8").alias("content")), base)


def customer_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Point worklist: one point per customer, degrees from key arithmetic."""
    c = read_table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("record_source"),
        (F.lit(-70.0) + (F.col("c_custkey") * 104729 % 14000) / 100.0).alias("latitude"),
        (F.lit(-180.0) + (F.col("c_custkey") * 7919 % 36000) / 100.0).alias("longitude"))


def _ring(points):
    return F.array(*[F.struct(F.col(x).alias("x"), F.col(y).alias("y")) for x, y in points])


def nation_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polygon layer in Web Mercator metres: per nation a triangle and a
    square with a square hole around (lon, lat) = (-170 + 14k, -60 + 25 (k % 5));
    name = nation, layer = region.  Vertices in degrees are whole numbers."""
    from ..functions.scalars import mercator_x, mercator_y
    n = read_table(spark, sf_dir, "nation").join(
        read_table(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "n_regionkey"),
        "n_regionkey")
    cx = F.lit(-170.0) + F.col("n_nationkey") * 14
    cy = F.lit(-60.0) + (F.col("n_nationkey") % 5) * 25

    def ring(offsets):
        return F.array(*[F.struct(mercator_x(cx + dx).alias("x"), mercator_y(cy + dy).alias("y"))
                         for dx, dy in offsets])

    tri = n.select(F.concat(F.lit("T"), F.col("n_nationkey").cast("string")).alias("poly_id"),
                   F.lit("NWMLS").alias("nwmls"), F.col("n_name").alias("name"),
                   F.col("r_name").alias("layer"),
                   F.concat(F.lit("areas/"), F.col("n_name")).alias("path"),
                   F.array(ring([(-5, -4), (5, -4), (0, 6), (-5, -4)])).alias("rings"))
    sq = n.select(F.concat(F.lit("S"), F.col("n_nationkey").cast("string")).alias("poly_id"),
                  F.lit("NWMLS").alias("nwmls"), F.col("n_name").alias("name"),
                  F.col("r_name").alias("layer"),
                  F.concat(F.lit("areas/"), F.col("n_name")).alias("path"),
                  F.array(ring([(-6, -6), (6, -6), (6, 6), (-6, 6), (-6, -6)]),
                          ring([(-2, -2), (2, -2), (2, 2), (-2, 2), (-2, -2)])).alias("rings"))
    return tri.unionByName(sq)


def nation_gazetteer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed geocoding responses per nation name, except nations of region 4
    (those addresses miss)."""
    n = read_table(spark, sf_dir, "nation").filter(F.col("n_regionkey") != 4)
    loc = F.struct((F.lit(-60.0) + (F.col("n_nationkey") % 5) * 25).alias("lat"),
                   (F.lit(-170.0) + F.col("n_nationkey") * 14).alias("lng"))
    result = F.struct(F.initcap("n_name").alias("formatted_address"),
                      F.struct(loc.alias("location")).alias("geometry"))
    return n.select(F.col("n_name").alias("address"),
                    F.struct(F.array(result).alias("results"), F.lit("OK").alias("status"))
                    .alias("response"))


EVENT_LIST = "EventInformation"
# Status per event type in the landed responses: errors fail, signups hit the quota.
EVENT_STATUS = {"error": (5, "Invalid request parameter"), "signup": (11, "Quota exceeded")}


def event_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One landed API response per event: XML envelope around the JSON text
    ``{"EventInformation": [event], "Status": {...}}``.  Dealt by call, as calls
    land in many files."""
    e = read_table(spark, sf_dir, "events").repartition("event_id")
    code, msg = F.lit(2), F.lit("Success.")
    for et, (c, m) in EVENT_STATUS.items():
        code = F.when(F.col("event_type") == et, F.lit(c)).otherwise(code)
        msg = F.when(F.col("event_type") == et, F.lit(m)).otherwise(msg)
    item = F.struct(F.col("event_id").alias("EventID"), F.col("user_id").alias("UserID"),
                    F.col("event_type").alias("EventType"), F.col("value").alias("Value"),
                    F.col("props").alias("Props"))
    payload = F.to_json(F.struct(F.array(item).alias(EVENT_LIST),
                                 F.struct(code.alias("Code"), msg.alias("Message")).alias("Status")))
    escaped = F.replace(F.replace(F.replace(payload, F.lit("&"), F.lit("&amp;")),
                                  F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    body = F.concat(
        F.lit('<soap:Envelope xmlns:soap="http://www.w3.org/2003/05/soap-envelope">'
              '<soap:Body><GetEventsResponse><GetEventsResult>'),
        escaped,
        F.lit("</GetEventsResult></GetEventsResponse></soap:Body></soap:Envelope>"))
    return e.select(F.col("event_id").alias("call_id"), F.lit(EVENT_LIST).alias("header"),
                    body.alias("body"))


def _long_cells(wide: DataFrame, titles: list[str], display: dict) -> tuple[DataFrame, DataFrame]:
    """Wide rows -> sparse long cells (no cell for a NULL value) + columns."""
    spark = wide.sparkSession
    items = [F.struct(F.lit(i + 1).cast("long").alias("column_id"),
                      F.col(f"`{t}`").alias("value"),
                      F.col(f"`{display[t]}`").alias("display_value") if t in display
                      else F.col(f"`{t}`").alias("display_value"))
             for i, t in enumerate(titles)]
    cells = (wide.select("row_id", F.explode(F.array(*items)).alias("c"))
             .select("row_id", "c.*").filter(F.col("value").isNotNull()))
    columns = spark.createDataFrame([(i + 1, t) for i, t in enumerate(titles)],
                                    "column_id long, title string")
    return cells, columns


def order_sheet(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A form sheet with one row per order; pending orders are new entries."""
    from ..operators import forms
    o = read_table(spark, sf_dir, "orders")
    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation")
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    day = lambda k: F.date_format(F.date_add(F.col("o_orderdate"), k), "yyyy-MM-dd")
    comment = F.when(~F.col("o_orderpriority").startswith("5"),
                     F.concat(F.lit("Priority "), F.col("o_orderpriority")))
    wide = j.select(
        F.col("o_orderkey").alias("row_id"),
        F.when(F.col("o_orderstatus") == "P", F.lit(forms.NEW_ENTRY))
         .otherwise(F.lit(forms.PROCESSED)).alias("Record Source"),
        F.col("c_name").alias("Owner"),
        F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("Project Name"),
        F.col("c_name").alias("Client"), comment.alias("Comments"),
        F.col("n_name").alias("Address"), F.col("c_mktsegment").alias("Market"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("Value"),
        F.concat(F.lit("$"), money_text("o_totalprice")).alias("Value__display"),
        day(0).alias("Precon Start Date"), day(30).alias("Construction Start Date"),
        day(365).alias("Const Completion Date"),
        F.col("c_custkey").cast("string").alias("Client Contact"),
        F.lit(None).cast("string").alias("Designer"))
    return _long_cells(wide, forms.FORM_TITLES, {"Value": "Value__display"})


CONVERSATION_ROLES = ["user", "assistant", "system"]


def conversation_sheet(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A sheet with one row per conversation and one column per role, each
    cell the role's first turn (also its display value)."""
    from ..operators import forms
    c = read_table(spark, sf_dir, "conversations")
    first = c.groupBy("conv_id", "role").agg(F.min_by("text", "turn").alias("text"))
    ids = F.element_at(F.create_map(*[x for i, r in enumerate(CONVERSATION_ROLES)
                                      for x in (F.lit(r), F.lit(i + 1))]), F.col("role"))
    cells = first.select(F.col("conv_id").alias("row_id"), ids.cast("long").alias("column_id"),
                         F.col("text").alias("value"),
                         F.col("text").alias("display_value"))
    columns = spark.createDataFrame([(i + 1, r) for i, r in enumerate(CONVERSATION_ROLES)],
                                    "column_id long, title string")
    base = work_dir(spark, "fixture-sheet")
    cells.write.parquet(f"{base}/cells")
    columns.write.parquet(f"{base}/columns")
    return forms.read_sheet(spark, f"{base}/cells", f"{base}/columns")


def event_notifications(spark: SparkSession, sf_dir: str, base: str) -> str:
    """Sheet-row notifications from `events` in two overlapping batches
    (days 1-19 and 10-30); signups are new entries.  Returns a glob of the
    batch files."""
    from ..operators import forms
    e = read_table(spark, sf_dir, "events")
    rows = e.select(
        F.col("event_id").alias("row_id"), F.lit("Smartsheet webhook callback").alias("header"),
        F.col("ts").cast("timestamp").alias("event_time"),
        F.when(F.col("event_type") == "signup", F.lit(forms.NEW_ENTRY))
         .otherwise(F.lit(forms.PROCESSED)).alias("Record Source"),
        F.concat(F.lit("Event "), F.col("event_id").cast("string")).alias("Project Name"),
        F.col("props").alias("Comments"), F.col("props").alias("Comments__display"),
        F.col("value").cast("string").alias("Value"),
        F.col("value").cast("string").alias("Value__display"))
    rows.filter(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz")) \
        .write.json(f"{base}/batch1")
    rows.filter(F.col("ts") >= F.lit("2024-01-10").cast("timestamp_ntz")) \
        .write.json(f"{base}/batch2")
    return f"{base}/batch*/*.json"


def task_and_project_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed responses of two call types from `events`: a task list per
    click/view/purchase event (task fields from the event) and a project
    list per signup/error event."""
    from ..operators import api
    e = read_table(spark, sf_dir, "events")
    task = F.struct(F.concat(F.lit("T"), F.col("event_id").cast("string")).alias("TaskID"),
                    F.col("user_id").alias("TaskTypeLinkID"),
                    F.col("event_type").alias("TaskType"),
                    F.col("user_id").alias("IssuedToPackageID"),
                    F.col("value").alias("Cost"),
                    (F.col("event_type") == "purchase").alias("Complete"),
                    F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("LastModified"))
    project = F.struct(F.col("event_id").alias("ProjectID"), F.col("event_type").alias("Name"))
    is_task = F.col("event_type").isin("click", "view", "purchase")
    status = F.struct(F.lit(2).alias("Code"), F.lit("Success.").alias("Message"))
    payload = F.when(is_task, F.to_json(F.struct(F.array(task).alias(api.TASKS),
                                                 status.alias("Status")))) \
        .otherwise(F.to_json(F.struct(F.array(project).alias(api.PROJECTS),
                                      status.alias("Status"))))
    body = F.concat(F.lit("<Envelope><Body><R>"),
                    F.replace(F.replace(payload, F.lit("&"), F.lit("&amp;")), F.lit("<"),
                              F.lit("&lt;")),
                    F.lit("</R></Body></Envelope>"))
    return e.select(F.col("event_id").alias("call_id"),
                    F.when(is_task, F.lit(api.TASKS)).otherwise(F.lit(api.PROJECTS))
                    .alias("header"), body.alias("body"))


def entity_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed responses of four lists, one call per row of `region` (business
    units), `nation` (projects, some with a manager), `part` (package trades,
    some with a rate that is no number) and `orders` (forms); calls for large
    orders failed."""
    from ..operators import api
    tables = {n: read_table(spark, sf_dir, n) for n in ("region", "nation", "part", "orders")}

    def landed(df, call, header, items, code=F.lit(2)):
        status = F.to_json(F.struct(code.alias("Code"), F.lit("Said <so> & so.").alias("Message")))
        payload = F.concat(F.lit('{"' + header + '":['), items, F.lit('],"Status":'), status, F.lit("}"))
        escaped = F.replace(F.replace(payload, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
        return df.select(F.col(call).cast("long").alias("call_id"), F.lit(header).alias("header"),
                         F.concat(F.lit("<E><B><R>"), escaped, F.lit("</R></B></E>")).alias("body"))

    def item(*columns):
        return F.to_json(F.struct(*columns))

    unit = item(F.col("r_regionkey").alias("BusinessUnitID"), F.col("r_name").alias("Name"))
    manager = F.when(F.col("n_nationkey") % 3 == 0, F.concat(F.lit("M "), F.col("n_name")))
    project = item(F.col("n_nationkey").alias("ProjectID"), F.col("n_regionkey").alias("BusinessUnitID"),
                   F.col("n_name").alias("Name"), manager.alias("Manager"))
    trade = [F.col("p_partkey").alias("PackageID"), F.col("p_type").alias("Trade")]
    rate = F.when(F.col("p_size") % 10 == 0, item(*trade, F.lit("open").alias("Rate"))) \
        .otherwise(item(*trade, F.col("p_size").alias("Rate")))
    form = [F.col("o_orderkey").alias("FormID"), F.col("o_orderstatus").alias("Status"),
            (F.col("o_orderstatus") == "F").alias("Closed"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("StatusDate")]
    price = F.col("o_totalprice").cast("decimal(18,2)")
    cost = F.when(F.col("o_orderkey") % 2 == 0, item(*form, price.cast("long").alias("Cost"))) \
        .otherwise(item(*form, price.alias("Cost")))
    code = F.when(price > 150_000, F.lit(5)).otherwise(F.lit(2))
    return (landed(tables["region"], "r_regionkey", api.BUSINESS_UNITS, unit)
            .unionByName(landed(tables["nation"], "n_nationkey", api.PROJECTS, project))
            .unionByName(landed(tables["part"], "p_partkey", api.PACKAGE_TRADES, rate))
            .unionByName(landed(tables["orders"], "o_orderkey", api.FORMS, cost, code)))
