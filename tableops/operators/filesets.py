"""Manifest joins, directory reconciliation and per-group archives
(J2, J9, A8, T9, T25, R10, R11)."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import file_base_name, strip_spaces
from .paging import global_rank

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's behaviour
# ---------------------------------------------------------------------------
SKIP_FOLDER = "Compressed"      # sub-folder never archived
ARCHIVE_EXT = ".zip"

MATCHED, MISSING_FILE, UNEXPECTED_FILE = "matched", "missing_file", "unexpected_file"
# Files per archive part (on average): a larger group is split into parts
# so no task builds an unbounded archive.
DEFAULT_FILES_PER_ARCHIVE = 1000


def manifest_join(attachments: DataFrame, file_list: DataFrame) -> DataFrame:
    """Attachment records that have a file, ``(invoice_id, file_name)``,
    ordered by both.  Duplicate names on either side multiply, as an inner
    equi-join does."""
    return (attachments.select("invoice_id", "file_name")
            .join(file_list.select("file_name"), "file_name", "inner")
            .select("invoice_id", "file_name").orderBy("invoice_id", "file_name"))


def files_vs_records(files: DataFrame, records: DataFrame) -> DataFrame:
    """Reconcile a directory listing with expected records on the file
    name (base name after '\\' -> '/'), both directions."""
    f = files.select(file_base_name("file_name").alias("file_name")).distinct() \
        .withColumn("_in_dir", F.lit(True))
    r = records.select(file_base_name("file_name").alias("file_name")).distinct() \
        .withColumn("_expected", F.lit(True))
    return f.join(r, "file_name", "full_outer").select(
        "file_name",
        F.when(F.col("_in_dir") & F.col("_expected"), F.lit(MATCHED))
         .when(F.col("_expected"), F.lit(MISSING_FILE))
         .otherwise(F.lit(UNEXPECTED_FILE)).alias("status"))


def group_files(rows: DataFrame, group_col: str = "invoice_id",
                file_col: str = "file_name") -> DataFrame:
    """Each group's files in order, as rows with ``file_seq`` 1..n
    (all input columns kept).

    Positions come from one distributed rank over (group, file); a group's
    first rank is a partial-aggregated minimum joined back (AQE broadcasts
    it when small, or splits a skewed group's partition).  A group holding a
    third of all rows is spread over many range partitions, not one task."""
    ranked = global_rank(rows, [group_col, file_col], rank_col="_r")
    first = ranked.groupBy(group_col).agg(F.min("_r").alias("_r0"))
    return (ranked.join(first, group_col)
            .withColumn("file_seq", F.col("_r") - F.col("_r0") + 1)
            .drop("_r", "_r0"))


def archive_name(prefix: str, folder) -> F.Column:
    """``PREFIX_<folder>`` with spaces removed, plus the extension."""
    return F.concat(strip_spaces(F.concat(F.lit(f"{prefix}_"), folder)), F.lit(ARCHIVE_EXT))


_ZIP_SCHEMA = T.StructType([
    T.StructField("group_id", T.StringType()),
    T.StructField("part", T.LongType()),
    T.StructField("n_files", T.LongType()),
    T.StructField("archive", T.BinaryType()),
])


def _zip_group(pdf: pd.DataFrame) -> pd.DataFrame:
    buf = io.BytesIO()
    order = pdf.sort_values("file_name")
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        for name, content in zip(order["file_name"], order["content"]):
            zf.writestr(name.replace("\\", "/").rsplit("/", 1)[-1], bytes(content))
    return pd.DataFrame({"group_id": [str(pdf["group_id"].iloc[0])],
                         "part": [int(pdf["part"].iloc[0])], "n_files": [len(pdf)],
                         "archive": [buf.getvalue()]})


def zip_bundles(files: DataFrame, group_col: str, files_per_archive: int =
                DEFAULT_FILES_PER_ARCHIVE) -> DataFrame:
    """One zip archive per group holding its files under their base
    names; ``(group_id, part, n_files, archive)``.

    ``files`` has ``(group, file_name, content)``.  A group of n files is cut
    into ceil(n / files_per_archive) parts by a hash of the file name, so a
    hot group becomes many archives built in parallel (each about
    ``files_per_archive`` files) instead of one unbounded task.  Group sizes
    are a partial-aggregated count; no sort and no copy of the contents is
    needed.  Building the archive bytes is the only Python step
    (``applyInPandas`` per part; files in name order inside an archive)."""
    keyed = files.select(F.col(group_col).cast("string").alias("group_id"), "file_name",
                         "content")
    sizes = keyed.groupBy("group_id").agg(
        F.ceil(F.count(F.lit(1)) / F.lit(files_per_archive)).alias("_parts"))
    parts = keyed.join(sizes, "group_id").withColumn(
        "part", F.pmod(F.xxhash64("file_name"), F.col("_parts")).cast("long"))
    return (parts.select("group_id", "part", "file_name", "content")
            .groupBy("group_id", "part").applyInPandas(_zip_group, _ZIP_SCHEMA))


def zip_folders(files: DataFrame, prefix: str,
                files_per_archive: int = DEFAULT_FILES_PER_ARCHIVE) -> DataFrame:
    """One archive per sub-folder except ``Compressed``, named
    ``PREFIX_<folder>.zip`` without spaces."""
    kept = files.filter(F.col("folder") != SKIP_FOLDER)
    z = zip_bundles(kept.withColumnRenamed("folder", "grp"), "grp", files_per_archive)
    return z.withColumn("archive_name", archive_name(prefix, F.col("group_id")))


_CONTENT_SCHEMA = T.StructType([
    T.StructField("n_entries", T.LongType()),
    T.StructField("n_bytes", T.LongType()),
])


def archive_contents(archives: DataFrame) -> DataFrame:
    """Open every archive and count its entries and uncompressed bytes
    (a check of ``zip_bundles`` output)."""
    # plain rows: Spark hands a task about a hundred archives at a time, while an
    # Arrow batch takes ten thousand, however large they are
    @F.udf(_CONTENT_SCHEMA, useArrow=False)
    def _open(blob):
        with zipfile.ZipFile(io.BytesIO(bytes(blob))) as zf:
            infos = zf.infolist()
        return len(infos), sum(i.file_size for i in infos)

    return archives.withColumn("_c", _open("archive")).select(
        "*", "_c.n_entries", "_c.n_bytes").drop("_c")
