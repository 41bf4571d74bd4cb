"""Query registry over the test tables (used by ``__spark_entry__``).

Every query reads whole test tables (or data Spark derives from them) and
runs the library's own job on it.  Each returns a DataFrame whose column
names match the DuckDB SQL in ``oracle.py``.
"""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import normalize_header_col
from ..functions.scalars import backup_name
from ..operators import (api, audit, filesets, forms, geo, metadata, paging, relations,
                         snapshots, softdelete)
from ..sinks import commits
from ..sinks.writers import write_csv, write_json_lines, write_text_lines
from ..streaming import form_events
from ..sources import files, polygons
from ..operators.profiling import profile_columns, profile_frame, typed_projection
from ..session import read_table, work_dir
from ..sources.delimited import (good_rows, land_delimited, number_rejects, read_headerless,
                                 read_strict, reject_rows)
from . import fixtures as fx
from . import delta, geo_jobs, replicate, transfer
from .loader import load_file

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


# -- 1. type inference and typed load --------------------------------------
@register
def profile_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-aggregate profile of `orders` rendered as text."""
    return profile_frame(fx.orders_as_text(spark, sf_dir))


@register
def typed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Infer types of the text rendering and cast back."""
    stage = fx.orders_as_text(spark, sf_dir)
    return typed_projection(stage, profile_columns(stage))


@register
def profile_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First-matching timestamp mask over `events.ts` in six renderings."""
    return profile_frame(fx.events_ts_as_text(spark, sf_dir))


@register
def typed_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5/T6 with every mask: the renderings parsed back to timestamps."""
    stage = fx.events_ts_as_text(spark, sf_dir)
    return typed_projection(stage, profile_columns(stage))


@register
def load_file_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`part` as a ';' file loaded end to end."""
    src = fx.part_semicolon_file(spark, sf_dir)
    res = load_file(spark, src, "PART_LOADED", "CSV_SEMICOLON_DELIMITER")
    return spark.read.parquet(res.table_path)


@register
def load_documents_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`documents` as a CSV file with quoted line breaks, loaded end to end."""
    res = load_file(spark, fx.documents_csv(spark, sf_dir), "DOCUMENTS_LOADED", "CSV")
    out = spark.read.parquet(res.table_path)
    return out.select(F.col("DOC_ID").cast("long").alias("doc_id"), F.col("TEXT").alias("text"),
                      F.col("LANG").alias("lang"))


@register
def normalize_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1 over header-like strings composed from `part` text columns."""
    p = read_table(spark, sf_dir, "part")
    raw = F.concat(F.col("p_type"), F.lit(" ("), F.col("p_brand"), F.lit(")/"),
                   F.col("p_name"), F.lit("."))
    return p.select("p_partkey", raw.alias("raw_header"),
                    normalize_header_col(raw).alias("clean_header"))


@register
def load_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Malformed records of `customer` CSV files captured as rejects, with
    the broken rule, line, character and column; the files of nations with even
    keys hold quoted line breaks, the others do not."""
    src = fx.customer_csv_with_errors(spark, sf_dir)
    out = []
    for digits in ("02468", "13579"):
        path = f"{src}/folder=*[{digits}]"
        raw = land_delimited(spark, path, work_dir(spark, "stage-customer"), "CSV")
        out.append(reject_rows(raw, "CUSTOMER", number_rejects(spark, path, raw)))
    rej = out[0].unionByName(out[1])
    return rej.select(
        F.regexp_extract("file", r"folder=(\d+)", 1).cast("long").alias("c_nationkey"),
        F.col("line").cast("long").alias("line"), F.col("character").cast("long").alias("character"),
        "error", "column_name", "category", "table_name", "rejected_record")


@register
def load_good_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines that load (stage rows) of the same `customer` CSV."""
    src = fx.customer_csv_with_rejects(spark, sf_dir)
    raw = land_delimited(spark, src, work_dir(spark, "stage-customer"), "CSV")
    return good_rows(raw).select(F.col("c_custkey").cast("long").alias("c_custkey"),
                                 "c_name", "c_mktsegment")


# -- 2. count audit and soft delete ------------------------------------------
TEST_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations"]
# Which test tables stand for which registered source in the audit queries.
AUDIT_SOURCES = {
    1: ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"],
    2: ["documents", "labels", "benchmark", "pages"],
    3: ["events", "embeddings", "conversations"],
}


def _audit_inputs(spark, sf_dir, names):
    """Sources are the test tables (`labels` stands for an empty source);
    targets are copies, `orders` only partly replicated, `benchmark` missing."""
    src, tgt = {}, {}
    for n in names:
        df = read_table(spark, sf_dir, n)
        src[n] = df.filter(F.col("doc_id") < 0) if n == "labels" else df
        if n == "benchmark":
            tgt[n] = None
        elif n == "orders":
            tgt[n] = df.filter(F.col("o_orderstatus") != "P")
        else:
            tgt[n] = df
    return src, tgt


def _no_clock(df: DataFrame) -> DataFrame:
    return df.drop("source_date", "target_date")


@register
def count_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source vs target counts for every enabled source."""
    registry = spark.createDataFrame(
        [(k, f"source {k}", audit.AUDITED_SOURCE_TYPE, "Y") for k in AUDIT_SOURCES]
        + [(9, "flat files", "FLAT FILE", "Y"), (8, "retired", audit.AUDITED_SOURCE_TYPE, "N")],
        "source_key long, source_name string, source_type string, audit_enabled_flag string")
    keys = [r.source_key for r in audit.registry_filter(registry)
            .select("source_key").collect()]
    parts = [audit.count_audit(k, *_audit_inputs(spark, sf_dir, AUDIT_SOURCES[k]))
             for k in sorted(keys)]
    return _no_clock(reduce(DataFrame.unionByName, parts))


@register
def retire_and_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results of sources 1..3 committed source by source; a new run of
    source 2 retires its old rows and leaves the other sources' files alone."""
    base = work_dir(spark, "count-results")
    for k in (*sorted(AUDIT_SOURCES), 2):
        audit.commit_results(base, audit.count_audit(
            k, *_audit_inputs(spark, sf_dir, AUDIT_SOURCES[k])), k)
    return _no_clock(audit.read_results(spark, base))


@register
def copy_count_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`lineitem` copied to a new table and both counts compared."""
    src = read_table(spark, sf_dir, "lineitem")
    out = work_dir(spark, "copy-lineitem")
    src.write.parquet(out)
    return audit.copy_count_check("lineitem", src, spark.read.parquet(out))


@register
def soft_delete_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views hiding soft-deleted `events` rows
    (flag TRUE for errors, NULL for signups, FALSE otherwise)."""
    import uuid
    tag = uuid.uuid4().hex[:8]
    src_db, rpt_db = f"replica_{tag}", f"reporting_{tag}"
    base = work_dir(spark, "softdelete")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {src_db} LOCATION '{base}/src'")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {rpt_db} LOCATION '{base}/rpt'")
    ev = read_table(spark, sf_dir, "events")
    flag = (F.when(F.col("event_type") == "error", F.lit(True))
            .when(F.col("event_type") == "signup", F.lit(None).cast("boolean"))
            .otherwise(F.lit(False)))
    ev.withColumn(softdelete.DELETE_FLAG, flag).write.parquet(f"{base}/data/events")
    ev.limit(0).write.parquet(f"{base}/data/audit")
    spark.catalog.createTable(f"{src_db}.events", path=f"{base}/data/events", source="parquet")
    spark.catalog.createTable(f"{src_db}.{softdelete.AUDIT_TABLE}", path=f"{base}/data/audit",
                              source="parquet")
    softdelete.soft_delete_views(spark, src_db, rpt_db)
    out = spark.table(f"{rpt_db}.events")
    # the view is part of the plan by now; its files are not the database's
    for db in (rpt_db, src_db):
        spark.sql(f"DROP DATABASE {db} CASCADE")
    return out


# -- 3. paging and chunked replication ---------------------------------------
@register
def global_rank_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rank of every `orders` row by key, without a single-task sort."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return paging.global_rank(o, ["o_orderkey"])


@register
def row_number_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 + P13: the page of ranks 1001..2000 (the page slice is the feature)."""
    o = read_table(spark, sf_dir, "orders")
    return paging.rank_between(paging.global_rank(o, ["o_orderkey"]), 1001, 2000) \
        .select("o_orderkey", "o_totalprice", "ranking")


@register
def chunk_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of 500 ranks over `orders`."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey")
    chunked = paging.with_chunks(paging.global_rank(o, ["o_orderkey"]), 500)
    return paging.chunk_summary(chunked)


@register
def replicate_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`orders` copied in chunks of 500; chunk 0 already
    present from an earlier, interrupted run and skipped on restart."""
    o = read_table(spark, sf_dir, "orders")
    keys = spark.createDataFrame([("orders", "o_orderkey", 1), ("lineitem", "l_orderkey", 1)],
                                 "table_name string, column_name string, key_ordinal int")
    key_cols = replicate.primary_key_columns(keys, "orders")
    target = work_dir(spark, "replica-orders")
    replicate.replicate_table(spark, o, "orders", target, key_cols, batch=500, max_chunks=1)
    res = replicate.replicate_table(spark, o, "orders", target, key_cols, batch=500)
    if res.skipped_chunks != 1 or res.written_chunks != res.total_chunks - 1:
        raise AssertionError(f"unexpected restart bookkeeping: {res}")
    return replicate.read_copy(spark, target).drop("chunk_id")


@register
def replicate_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R3 run again after the source grew and changed: the new copy replaces
    the older one row for row."""
    o = read_table(spark, sf_dir, "orders")
    older = o.filter(F.col("o_orderstatus") != "F").withColumn("o_totalprice", F.lit(0.0))
    target = work_dir(spark, "replica-refresh")
    replicate.replicate_table(spark, older, "orders", target, ["o_orderkey"], batch=5000)
    replicate.replicate_table(spark, o, "orders", target, ["o_orderkey"], batch=5000)
    return replicate.read_copy(spark, target).drop("chunk_id")


@register
def replicate_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R3 interrupted, then continued on a source that has more rows with low
    keys by then: the unfinished run is not reused."""
    o = read_table(spark, sf_dir, "orders")
    target = work_dir(spark, "replica-restart")
    replicate.replicate_table(spark, o.filter(F.col("o_custkey") % 2 == 0), "orders", target,
                              ["o_orderkey"], batch=5000, max_chunks=1)
    res = replicate.replicate_table(spark, o, "orders", target, ["o_orderkey"], batch=5000)
    if res.skipped_chunks:
        raise AssertionError(f"chunks of another source were reused: {res}")
    return replicate.read_copy(spark, target).drop("chunk_id")


def _refreshed_orders(spark, sf_dir):
    """A replica of the older `orders` refreshed to the newer ones, and the log
    of both calls and of one in between that finds nothing to do."""
    older, newer = fx.orders_before_and_after(spark, sf_dir)
    target = work_dir(spark, "replica-delta")
    log = [delta.refresh_table(x, target, ["o_orderkey"], batch=100)
           for x in (older, older, newer)]
    return target, log


@register
def replicate_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`orders` replicated, then refreshed by key ranges after values
    changed, keys came in before the first one and others went."""
    return delta.read_refreshed(spark, _refreshed_orders(spark, sf_dir)[0])


@register
def replicate_delta_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges and rows that each of the three calls copied."""
    log = _refreshed_orders(spark, sf_dir)[1]
    return spark.createDataFrame(
        [(i, r.ranges, r.copied_ranges, r.copied_rows) for i, r in enumerate(log)],
        "call int, ranges long, copied_ranges long, copied_rows long")


@register
def append_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: `events` appended in four loads, each of them sent twice."""
    e = read_table(spark, sf_dir, "events")
    base = work_dir(spark, "appended-events")
    for i in (0, 1, 2, 3, 0, 1, 2, 3):
        commits.append_table(e.filter(F.col("event_id") % 4 == i), base, f"events {i} of 4")
    return commits.read_appended(spark, base)


@register
def replicate_keyless(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R3 without a key: `nation` copied as one chunk."""
    import warnings
    n = read_table(spark, sf_dir, "nation")
    target = work_dir(spark, "replica-nation")
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        replicate.replicate_table(spark, n, "nation", target, None)
    return replicate.read_copy(spark, target)


# -- 4. catalog metadata and relationships ----------------------------------
@register
def type_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target types of every base-table, non-binary column."""
    tables, columns = fx.catalog_from_part(spark, sf_dir)
    return metadata.type_mapping(tables, columns).select(
        "table_name", "column_name", "ordinal_position", "data_type", "numeric_scale",
        "target_type")


@register
def grouped_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per table, its mapped columns folded in ordinal order."""
    tables, columns = fx.catalog_from_part(spark, sf_dir)
    return metadata.group_columns(metadata.type_mapping(tables, columns)).select(
        "table_name", "n_columns", "column_list")


@register
def convert_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`orders` and `customer` catalogued from their schemas and
    converted to the mapped target types; `orders` returned."""
    frames = {n: read_table(spark, sf_dir, n) for n in ("orders", "customer")}
    tables, columns = metadata.frame_catalog(frames)
    conv = metadata.convert_tables(spark, frames, metadata.type_mapping(tables, columns))
    failed = [r for r in conv.status.collect() if r.status != metadata.CONVERTED]
    if failed:
        raise RuntimeError(f"conversion failed: {failed}")
    return conv.frames["orders"]


def _conversion(spark, sf_dir, keep_good_rows=False):
    frames, mapped = fx.frames_to_convert(spark, sf_dir)
    return metadata.convert_tables(spark, frames, mapped, keys={"orders": ["o_orderkey"]},
                                   keep_good_rows=keep_good_rows)


@register
def convert_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2, T5: the values of `orders` texts that their target types cannot hold."""
    return _conversion(spark, sf_dir).rejects


@register
def convert_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2: `orders` fails by its values, `supplier` by a missing column, the
    other tables are copied."""
    return _conversion(spark, sf_dir).status.drop("error")


@register
def convert_good_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2, T5: `orders` without the rows that hold such values."""
    return _conversion(spark, sf_dir, keep_good_rows=True).frames["orders"]


@register
def relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges inferred by the naming rules."""
    tables, columns = fx.catalog_from_part(spark, sf_dir)
    return relations.order_edges(relations.infer_relationships(tables, columns))


@register
def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct entities of the edges, colour, first-seen key, columns."""
    tables, columns = fx.catalog_from_part(spark, sf_dir)
    edges = relations.infer_relationships(tables, columns)
    return relations.entities(edges, columns)


# Configured edges of the test tables (child, column, parent, column).
TEST_EDGES = [
    ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("orders", "o_custkey", "customer", "c_custkey"),
    ("customer", "c_nationkey", "nation", "n_nationkey"),
    ("nation", "n_regionkey", "region", "r_regionkey"),
    ("labels", "doc_id", "documents", "doc_id"),
    ("events", "user_id", "customer", "c_custkey"),
]


@register
def check_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Child rows, keys and orphans per edge (German documents removed,
    so some labels lose their parent)."""
    names = {t for e in TEST_EDGES for t in (e[0], e[2])}
    frames = {n: read_table(spark, sf_dir, n) for n in names}
    frames["documents"] = frames["documents"].filter(F.col("lang") != "de")
    return relations.check_relationships(frames, TEST_EDGES)


# -- 5. files, manifests and archives ----------------------------------------
@register
def file_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of the files in a folder (one file per
    document) written as text lines and loaded as the system's file list."""
    table = files.file_list_job(spark, fx.document_files(spark, sf_dir), "DOCS",
                                work_dir(spark, "file-list"))
    return spark.read.parquet(table).select(F.col("FILE_NAME").alias("file_name"))


@register
def copy_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K8 + A7: every file copied under a new prefix; the copy's listing
    count must equal the source's."""
    src = fx.document_files(spark, sf_dir)
    target = work_dir(spark, "copied-docfiles")
    copied = files.copy_files(files.read_files(spark, src), target)
    out = work_dir(spark, "copy-report")
    copied.write.parquet(out)
    check = audit.copy_count_check("docfiles", files.list_files(spark, src),
                                   files.list_files(spark, target)).first()
    if not check.matched:
        raise AssertionError(f"copy count mismatch: {check}")
    return spark.read.parquet(out).select("file_name", "bytes")


def _attachments(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents")
    return d.select(F.col("source").alias("invoice_id"), fx.doc_file_name().alias("file_name"))


@register
def manifest_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 + O1: attachment records joined to the folder listing."""
    listing = files.list_files(spark, fx.document_files(spark, sf_dir, missing="es"))
    return filesets.manifest_join(_attachments(spark, sf_dir), listing)


@register
def ordered_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The joined manifest with the position of every row in its order."""
    listing = files.list_files(spark, fx.document_files(spark, sf_dir, missing="es"))
    return paging.with_position(filesets.manifest_join(_attachments(spark, sf_dir), listing),
                                ["invoice_id", "file_name"])


@register
def ordered_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The edges by right, then left table, with their positions."""
    tables, columns = fx.catalog_from_part(spark, sf_dir)
    return paging.with_position(relations.infer_relationships(tables, columns),
                                ["right_table", "left_table", "left_column", "right_column"])


@register
def bundle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each invoice's present files in order, numbered 1..n."""
    listing = files.list_files(spark, fx.document_files(spark, sf_dir, missing="es"))
    pairs = filesets.manifest_join(_attachments(spark, sf_dir), listing)
    return filesets.group_files(pairs).select("invoice_id", "file_seq", "file_name")


@register
def files_vs_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folder listing vs expected records (given as Windows paths);
    records are the non-French documents."""
    listing = files.list_files(spark, fx.document_files(spark, sf_dir, missing="es"))
    d = read_table(spark, sf_dir, "documents").filter(F.col("lang") != "fr")
    records = d.select(F.concat(F.lit("C:\\invoices\\"), F.col("source"), F.lit("\\"),
                                fx.doc_file_name()).alias("file_name"))
    return filesets.files_vs_records(listing, records)


@register
def zip_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One archive per conversation (turns as files), cut into parts of
    about 3 files; every archive opened again and its entries counted;
    totals per conversation."""
    c = read_table(spark, sf_dir, "conversations")
    turns = c.select("conv_id", F.concat(F.lit("turn_"), F.lpad(F.col("turn").cast("string"), 4, "0"),
                                         F.lit("_"), F.col("role"), F.lit(".txt"))
                     .alias("file_name"), F.encode("text", "UTF-8").alias("content"))
    z = filesets.archive_contents(filesets.zip_bundles(turns, "conv_id", files_per_archive=3))
    return z.groupBy(F.col("group_id").cast("long").alias("conv_id")).agg(
        F.sum("n_files").alias("n_files"), F.sum("n_entries").alias("n_entries"),
        F.sum("n_bytes").alias("n_bytes"))


@register
def zip_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One archive per sub-folder except 'Compressed'."""
    tree = fx.document_folders(spark, sf_dir)
    z = filesets.zip_folders(files.read_files(spark, tree, recursive=True), "INVOICES")
    return filesets.archive_contents(z).groupBy("archive_name").agg(
        F.sum("n_entries").alias("n_files"), F.sum("n_bytes").alias("n_bytes"))


# -- 6. geography -------------------------------------------------------------
@register
def web_mercator(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer points in EPSG:3857 metres (rounded to mm)."""
    p = geo.to_web_mercator(fx.customer_points(spark, sf_dir))
    # + 0.0 turns a rounded -0.0 into 0.0 (equal numbers, one text form)
    return p.select("id", (F.round("px", 3) + F.lit(0.0)).alias("x"),
                    (F.round("py", 3) + F.lit(0.0)).alias("y"))


@register
def point_in_polygon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (customer point, containing polygon) pair."""
    pts = geo.to_web_mercator(fx.customer_points(spark, sf_dir))
    return geo.point_in_polygon(pts, fx.nation_polygons(spark, sf_dir)).select("id", "poly_id")


@register
def area_tag_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R15 (S11, T14, J5, T20, K6): customers not yet tagged (automobile
    segment already done) tagged with their areas, written as JSON lines
    and read back."""
    pts = fx.customer_points(spark, sf_dir)
    done = pts.filter(F.col("record_source") == "AUTOMOBILE").select("id")
    out = geo_jobs.area_tag_job(pts, done, fx.nation_polygons(spark, sf_dir),
                                work_dir(spark, "area-json"))
    schema = "ID long, RECORD_SOURCE string, MLS_NAME string, MLS_AREA_NAME string, " \
             "COUNTY string, MLS_AREA_ID string"
    return spark.read.schema(schema).json(out)


@register
def area_tag_geojson(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S12 + J5: the polygon layer written as GeoJSON lines, read back by
    the layer source, and every customer point tagged with it."""
    path = work_dir(spark, "layer-geojson")
    polygons.write_geojson_lines(fx.nation_polygons(spark, sf_dir), path)
    layer = polygons.read_geojson_lines(spark, path)
    pts = geo.to_web_mercator(fx.customer_points(spark, sf_dir))
    return geo.point_in_polygon(pts, layer).select("id", "poly_id", "name", "layer")


@register
def missing_worklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that have no label yet."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    return geo.missing_worklist(d, read_table(spark, sf_dir, "labels"), "doc_id")


@register
def geocode_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R14 (S11, J6, T19, K6): customers' nation names geocoded from landed
    responses (misses kept), JSON lines written and read back."""
    c = read_table(spark, sf_dir, "customer").join(
        read_table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "c_nationkey"),
        "c_nationkey")
    work = c.select(F.col("c_custkey").alias("id"),
                    F.concat(F.lit("  "), F.lower("n_name"), F.lit(" ")).alias("api_address"),
                    F.col("c_mktsegment").alias("record_source"))
    done = work.filter(F.col("record_source") == "MACHINERY").select("id")
    out = geo_jobs.geocode_job(work, done, fx.nation_gazetteer(spark, sf_dir),
                               work_dir(spark, "geocode-json"))
    schema = ("ID long, RECORD_SOURCE string, status string, "
              "results array<struct<formatted_address string, "
              "geometry struct<location struct<lat double, lng double>>>>")
    j = spark.read.schema(schema).json(out)
    first = F.element_at("results", 1)
    return j.select("ID", "RECORD_SOURCE", "status",
                    first["formatted_address"].alias("formatted_address"),
                    first["geometry"]["location"]["lat"].alias("lat"),
                    first["geometry"]["location"]["lng"].alias("lng"))


# -- 7. API responses ---------------------------------------------------------
_EVENT_ELEMENT = T.StructType([
    T.StructField("EventID", T.LongType()), T.StructField("UserID", T.LongType()),
    T.StructField("EventType", T.StringType()), T.StructField("Value", T.DoubleType()),
    T.StructField("Props", T.StringType()),
])


@register
def api_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entity rows of the successful calls."""
    parsed = api.parse_responses(fx.event_responses(spark, sf_dir), fx.EVENT_LIST, _EVENT_ELEMENT)
    data, _, _ = api.extract(parsed, fx.EVENT_LIST)
    return data


@register
def api_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Route and error text of every call."""
    parsed = api.parse_responses(fx.event_responses(spark, sf_dir), fx.EVENT_LIST, _EVENT_ELEMENT)
    return parsed.select("call_id", "route", "error")


@register
def api_retry_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls that hit the quota become a retry list (no recursion)."""
    parsed = api.parse_responses(fx.event_responses(spark, sf_dir), fx.EVENT_LIST, _EVENT_ELEMENT)
    _, retry, _ = api.extract(parsed, fx.EVENT_LIST)
    return retry.select("call_id")


def _hierarchy_tables(spark, sf_dir):
    units = read_table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("BusinessUnitID"), F.col("r_name").alias("Name"))
    projects = read_table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("ProjectID"), F.col("n_regionkey").alias("BusinessUnitID"),
        F.col("n_name").alias("Name"))
    return units, projects


@register
def api_hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tasks (customers) under project (nation) and business unit
    (region), with the trade of the package they were issued to."""
    units, projects = _hierarchy_tables(spark, sf_dir)
    c = read_table(spark, sf_dir, "customer")
    tasks = c.select(F.col("c_custkey").alias("TaskID"), F.col("c_nationkey").alias("ProjectID"),
                     F.col("c_custkey").alias("IssuedToPackageID"))
    trades = c.select(F.col("c_custkey").alias("package_id"),
                      F.col("c_mktsegment").alias("division"))
    out = api.package_trade_lookup(api.hierarchy_expand(units, projects, tasks), trades)
    return out.select("TaskID", "business_unit", "project", "division")


@register
def api_form_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form results (line items) -> forms (orders) -> project (customer
    nation) -> business unit."""
    units, projects = _hierarchy_tables(spark, sf_dir)
    forms = read_table(spark, sf_dir, "orders").join(
        read_table(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("ProjectID")),
        "o_custkey").select(F.col("o_orderkey").alias("FormID"), "ProjectID")
    results = read_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("FormID"), F.col("l_linenumber").alias("line"),
        F.col("l_quantity").alias("quantity"))
    per_form = api.hierarchy_expand(units, projects, forms)
    return results.join(per_form, "FormID").select("FormID", "line", "business_unit", "project",
                                                   "quantity")


@register
def request_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per customer, the first..last order date split into calls of at
    most three months."""
    o = read_table(spark, sf_dir, "orders")
    ranges = o.groupBy("o_custkey").agg(F.to_date(F.min("o_orderdate")).alias("date_from"),
                                        F.to_date(F.max("o_orderdate")).alias("date_to"))
    return api.request_windows(ranges).select("o_custkey", "window_from", "window_to")


@register
def request_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of 1000 rows over the line items shipped per year."""
    li = read_table(spark, sf_dir, "lineitem")
    totals = li.groupBy(F.year("l_shipdate").alias("ship_year")).agg(
        F.count(F.lit(1)).alias("n_rows"))
    return api.request_pages(totals).select("ship_year", "start_row", "page_size")


# -- 8. form sheets and notifications ------------------------------------------
@register
def pivot_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation sheet pivoted to one row per conversation."""
    cells, columns = fx.conversation_sheet(spark, sf_dir)
    wide = forms.pivot_sheet(cells, columns, fx.CONVERSATION_ROLES)
    return wide.select("row_id", "user", "assistant", "system", "user__display")


@register
def form_notifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subject and HTML body for every new form entry."""
    cells, columns = fx.order_sheet(spark, sf_dir)
    wide = forms.pivot_sheet(forms.new_entry_cells(cells, columns), columns, forms.FORM_TITLES)
    return forms.render_notification(forms.new_entries(wide))


@register
def form_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comments to post for new entries that have one."""
    cells, columns = fx.order_sheet(spark, sf_dir)
    wide = forms.pivot_sheet(forms.new_entry_cells(cells, columns), columns, forms.FORM_TITLES)
    return forms.comments(forms.new_entries(wide))


@register
def form_status_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New entries marked processed; the sheet's Record Source after."""
    cells, columns = fx.order_sheet(spark, sf_dir)
    wide = forms.pivot_sheet(forms.new_entry_cells(cells, columns), columns, forms.FORM_TITLES)
    updated = forms.apply_updates(
        cells, forms.status_updates(forms.new_entries(wide), columns), "updated_at")
    after = forms.pivot_sheet(updated, columns, [forms.RECORD_SOURCE])
    return after.select("row_id", F.col(f"`{forms.RECORD_SOURCE}`").alias("record_source"))


@register
def cell_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First turns as cells of one column; every third cell is cleared,
    every third updated twice, and an empty cell of each row filled."""
    c = read_table(spark, sf_dir, "conversations").groupBy(F.col("conv_id").alias("row_id")).agg(
        F.min_by("text", "turn").alias("value"))
    cells = c.select("row_id", F.lit(1).alias("column_id"), "value",
                     F.col("value").alias("display_value"))
    ids = c.select("row_id")

    def update(rows: DataFrame, column: int, value: str | None, at: int) -> DataFrame:
        return rows.select("row_id", F.lit(column).alias("column_id"),
                           F.lit(value).cast("string").alias("new_value"), F.lit(at).alias("at"))

    second = ids.filter("row_id % 3 = 1")
    updates = (update(ids.filter("row_id % 3 = 0"), 1, None, 1)
               .unionByName(update(second, 1, "second", 2))
               .unionByName(update(second, 1, "first", 1))
               .unionByName(update(ids, 99, "added", 1)))
    return forms.apply_updates(cells, updates, "at").select("row_id", "column_id", "value")


@register
def classify_notifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incoming notification headers (one per event) classified."""
    e = read_table(spark, sf_dir, "events")
    header = (F.when(F.col("event_type") == "signup", F.lit("Smartsheet-Hook-Challenge: abc"))
              .when(F.col("event_type") == "click", F.lit("Smartsheet-Change-Agent"))
              .when(F.col("event_type") == "view", F.lit("smartsheet lower case"))
              .otherwise(F.concat(F.lit("X-Forwarded: "), F.col("event_type"))))
    return e.select("event_id", forms.classify_notification(header).alias("kind"))


@register
def stream_new_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping notification batches streamed
    (availableNow, one file per trigger); each new entry notified once."""
    base = work_dir(spark, "form-stream")
    src = fx.event_notifications(spark, sf_dir, f"{base}/in")
    form_events.run_available(spark, src, f"{base}/out", f"{base}/checkpoint",
                              max_files_per_trigger=4)
    return spark.read.parquet(f"{base}/out/{form_events.NOTIFY_DIR}").select("row_id", "subject")


# -- 9. snapshots, transfers and sinks -----------------------------------------
_SNAPSHOT_TODAY = "2001-08-16"


def _snapshot_list(spark, sf_dir):
    """Snapshot names: one per distinct order date of `orders`."""
    o = read_table(spark, sf_dir, "orders")
    days = o.select(F.to_date("o_orderdate").alias("d")).distinct()
    return days.select(backup_name(F.lit("PROD_DB"), "d").alias("name"), "d")


@register
def snapshot_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot name per date (order dates stand for run dates)."""
    s = _snapshot_list(spark, sf_dir)
    return s.select(F.col("d").alias("snapshot_date"), "name",
                    snapshots.snapshot_db("name").alias("db"))


@register
def retention_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which snapshots to drop on a fixed day, exact rule and older-or-equal rule."""
    s = _snapshot_list(spark, sf_dir).select("name")
    today = F.to_date(F.lit(_SNAPSHOT_TODAY))
    plan = snapshots.retention_plan(s, today)
    return plan.withColumn("drop_older", snapshots.drop_flag(
        F.col("snapshot_date"), today, mode=snapshots.MODE_OLDER))


@register
def snapshot_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dated copies of every base table of the catalog, taken
    twice (the second replaces the first); history rows without clock columns."""
    import datetime as dt
    frames = {n: read_table(spark, sf_dir, n) for n in TEST_TABLES}
    catalog, _ = metadata.frame_catalog(frames)
    names = [r.table_name for r in metadata.list_tables(catalog, "default").collect()]
    tables = {n: frames[n] for n in names}
    base = work_dir(spark, "snapshots")
    snapshots.snapshot_tables(spark, tables, base, "PROD_DB", dt.date(2001, 8, 16))
    hist = snapshots.snapshot_tables(spark, tables, base, "PROD_DB", dt.date(2001, 8, 16))
    return hist.select("table_name", "rows_before", "rows_after", "status")


@contextlib.contextmanager
def _dataset(spark: SparkSession, sf_dir: str):
    """A database that holds the test tables where they are, for as long as needed."""
    name = f"dataset_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name}")
    try:
        for t in TEST_TABLES:
            spark.catalog.createTable(f"{name}.{t}", path=f"{sf_dir}/{t}.parquet", source="parquet")
        yield name
    finally:
        spark.sql(f"DROP DATABASE {name} CASCADE")


@register
def catalog_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables and columns of a database as an information schema."""
    with _dataset(spark, sf_dir) as db:
        tables, columns = metadata.session_catalog(spark, db)
    return (columns.join(metadata.list_tables(tables).select("table_name"), "table_name")
            .select("table_name", "column_name", "data_type", "ordinal_position"))


@register
def truncate_and_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R18 (S8, A4, K5, K3, S3, A7): four tables exported to CSV and loaded
    strictly into targets that already hold an older copy."""
    tables = {n: read_table(spark, sf_dir, n) for n in ("region", "nation", "supplier", "part")}
    exp, tgt = work_dir(spark, "export"), work_dir(spark, "target")
    older = tables["nation"].filter(F.col("n_regionkey") == 0)
    transfer.transfer_dataset(spark, {"nation": older}, exp, tgt)
    return transfer.transfer_dataset(spark, tables, exp, tgt)


@register
def transfer_all_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R18, S8 over every table of a database: exported to CSV, loaded strictly, counts and
    values of both sides compared."""
    exp, tgt = work_dir(spark, "export-all"), work_dir(spark, "target-all")
    with _dataset(spark, sf_dir) as db:
        tables = {n: spark.table(f"{db}.{n}") for n in metadata.dataset_tables(spark, db)}
    result = transfer.transfer_dataset(spark, tables, exp, tgt)
    equal = spark.createDataFrame(
        transfer.equal_values(spark, tables, tgt), "name string, equal_values boolean")
    return (result.join(equal, F.col("table_name") == F.col("name"))
            .select("table_name", "rows_after", "matched", "equal_values"))


@register
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4 (all quoted), S4: `orders` written as headerless quoted CSV and
    read back by position into the table's schema."""
    o = read_table(spark, sf_dir, "orders")
    out = work_dir(spark, "csv-orders")
    write_csv(o, out, quote_all=True, header=False)
    return read_headerless(spark, out, o.schema)


@register
def json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6: `customer` as JSON lines with null fields kept (a comment that is
    NULL for negative balances); every line keeps all six keys."""
    c = read_table(spark, sf_dir, "customer").withColumn(
        "c_comment", F.when(F.col("c_acctbal") >= 0, F.lit("ok")))
    out = work_dir(spark, "json-customer")
    write_json_lines(c, out)
    lines = spark.read.text(out)
    return lines.select(
        F.get_json_object("value", "$.c_custkey").cast("long").alias("c_custkey"),
        F.get_json_object("value", "$.c_comment").alias("c_comment"),
        F.json_array_length(F.concat(F.lit("["), F.array_join(
            F.transform(F.json_object_keys("value"), lambda k: F.lit("0")), ","), F.lit("]")))
        .alias("n_keys"))


@register
def text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7: part names written one per line (range-ordered files), read back."""
    out = work_dir(spark, "text-part")
    write_text_lines(read_table(spark, sf_dir, "part"), "p_name", out, ordered=True)
    return spark.read.text(out)


@register
def strict_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: a clean CSV export of `supplier` loaded with abort-on-error."""
    s = read_table(spark, sf_dir, "supplier")
    out = work_dir(spark, "csv-supplier")
    write_csv(s, out, header=True)
    return read_strict(spark, out, s.schema, header=True)


@register
def load_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One history row per load; the same file loaded twice into one
    target (rows before/after, rejects, status; clock columns dropped)."""
    src = fx.part_semicolon_file(spark, sf_dir)
    target = work_dir(spark, "load-history")
    first = load_file(spark, src, "PART_LOADED", "CSV_SEMICOLON_DELIMITER", target).history
    second = load_file(spark, src, "PART_LOADED", "CSV_SEMICOLON_DELIMITER", target).history
    return first.withColumn("run", F.lit(1)).unionByName(second.withColumn("run", F.lit(2))) \
        .select("run", "table_name", "rows_before", "rows_after", "rejects", "status")


@register
def api_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R16 with several lists: task-list and project-list calls landed in
    one table, each parsed with its list's schema; the task rows returned."""
    responses = fx.task_and_project_responses(spark, sf_dir)
    project = T.StructType([T.StructField("ProjectID", T.LongType()),
                            T.StructField("Name", T.StringType())])
    out = api.extract_all(responses, {api.TASKS: api.TASK_ELEMENT, api.PROJECTS: project})
    tasks = out[api.TASKS][0]
    return tasks.select("call_id", "TaskID", "TaskTypeLinkID", "TaskType", "IssuedToPackageID",
                        "Cost", "Complete", "LastModified", "Closed")


def _entities(spark: SparkSession, sf_dir: str, header: str) -> DataFrame:
    return api.extract_entities(fx.entity_responses(spark, sf_dir), [header])[header][0]


@register
def api_business_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed business units, their fields found in the landed responses."""
    return _entities(spark, sf_dir, api.BUSINESS_UNITS)


@register
def api_projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed projects; some responses have a field that others lack."""
    return _entities(spark, sf_dir, api.PROJECTS)


@register
def api_package_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed package trades; a rate is a number here and a text there."""
    return _entities(spark, sf_dir, api.PACKAGE_TRADES)


@register
def api_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed forms, whole numbers and fractions in one field."""
    return _entities(spark, sf_dir, api.FORMS)
