"""Operator 8, best-fit packing: sum-of-squares packing of token pieces.

Documents become ids; only those longer than a sequence are cut, into whole
sequences and a rest.  Each piece of less than a sequence is placed in the
open bin, or a new one, that makes the sum over the residual gaps g of
(open bins with gap g) squared smallest; ties take the tightest gap, a new
bin last.

Packing runs in groups of ``GROUP_PIECES`` pieces, dealt by a hash, long
pieces first: a task holds one group, however large the input is.  The bins a group leaves with
``MERGE_GAP`` tokens or more unused are packed once more as if each were one
piece, in groups that again hold ``GROUP_PIECES`` of them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import bound_batches, work_dir
from .tokens import crc32, encoder

SEQUENCE = 2048
END_ID = 0
GROUP_PIECES = 32_768
MERGE_GAP = 16


def sum_of_squares(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Place sizes (1 to capacity) in the given order -> (bin, offset) of each."""
    n = len(sizes)
    bins, offsets = np.empty(n, np.int64), np.empty(n, np.int64)
    counts = np.zeros(capacity + 1, np.int64)       # open bins by gap
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    opened = 0
    for i, size in enumerate(sizes.tolist()):
        # a bin goes from gap g to g - size: the sum changes by
        # 2 * (counts[g - size] - counts[g] + 1); closing a bin (gap 0) and
        # opening one (from nowhere) leave out the term of that gap
        now = counts[size:capacity]
        change = 2 * (counts[:capacity - size] - now) + 2
        if len(change):
            change[0] = 1 - 2 * now[0]
        change[now == 0] = np.iinfo(np.int64).max
        fresh = 2 * counts[capacity - size] + 1 if size < capacity else 0
        best = int(change.argmin()) if len(change) else -1
        if best >= 0 and change[best] <= fresh and now[best]:
            gap = best + size
            b = stacks[gap].pop()
            counts[gap] -= 1
        else:
            gap, b = capacity, opened
            opened += 1
        bins[i], offsets[i] = b, capacity - gap
        if gap > size:
            stacks[gap - size].append(b)
            counts[gap - size] += 1
    return bins, offsets


def tokenized_pieces(docs: DataFrame, tokenizer_path: str, style: str = "word",
                     capacity: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every document's pieces.

    Null and empty texts are ``end_id`` alone; repeated rows are documents
    of their own; other columns are ignored.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path, style)
        end = np.array([end_id], "<u4").tobytes()
        for b in batches:
            rows = []
            texts = enc.encode(b.column(1).to_pylist())
            for d, ids in zip(b.column(0).to_pylist(), texts, strict=True):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    rows.append((d, k, at // 4, len(part) // 4, crc32(part)))
            cols = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(),
                                                       pa.int64(), pa.int64()), strict=True)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    bound_batches(docs.sparkSession)
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
            .mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long"))


def _pack(rows: DataFrame, groups: int, key: list[str], size: str, extra: int,
          capacity: int) -> DataFrame:
    """Pack ``rows`` in hash-dealt groups: adds bin (unique number) and at."""
    schema = rows.schema.simpleString()[7:-1].replace(":", " ")

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        group = int(pdf["g_"].iloc[0])
        # long pieces first: the short ones fill what they leave
        pdf = pdf.drop(columns="g_").sort_values([size, *key], ascending=False, kind="stable")
        bins, offsets = sum_of_squares(pdf[size].to_numpy(np.int64), capacity)
        return pdf.assign(bin=(bins * groups + group) * 4 + extra, at=offsets)

    dealt = rows.withColumn("g_", F.pmod(F.xxhash64(*key), F.lit(groups)).cast("int"))
    return dealt.groupBy("g_").applyInPandas(pack, f"{schema}, bin long, at long")


def pack_pieces(pieces: DataFrame, capacity: int = SEQUENCE,
                group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Add sequence_id and offset to pieces with lengths from 1 to ``capacity``.

    ``pieces`` must be stored (it is read several times).  Full pieces are
    sequences of their own and need no packing.  An empty table gives none.
    """
    spark = pieces.sparkSession
    # repeated rows of one document are different pieces
    part = pieces.filter(F.col("length") < capacity).withColumn(
        "row_", F.monotonically_increasing_id())
    groups = max(1, math.ceil(part.count() / group_pieces))
    path = work_dir(spark, "packed")
    _pack(part, groups, ["row_"], "length", 1, capacity).write.parquet(path)
    first = spark.read.parquet(path)
    fill = (first.groupBy(F.col("bin").alias("row_")).agg(F.sum("length").alias("used"))
            .filter(F.col("used") <= capacity - MERGE_GAP))
    path = work_dir(spark, "merged")
    fill.write.parquet(path)
    fill = spark.read.parquet(path)
    groups = max(1, math.ceil(fill.count() / group_pieces))
    merged = _pack(fill, groups, ["row_"], "used", 2, capacity).toDF(
        "bin_", "used", "to_", "shift")
    placed = (first.join(merged, F.col("bin") == F.col("bin_"), "left")
              .withColumn("sequence_id", F.coalesce("to_", "bin"))
              .withColumn("offset", F.col("at") + F.coalesce("shift", F.lit(0)))
              .drop("row_", "bin", "at", "bin_", "used", "to_", "shift"))
    full = (pieces.filter(F.col("length") >= capacity)
            .withColumn("sequence_id", F.monotonically_increasing_id() * 4)
            .withColumn("offset", F.lit(0).cast("long")))
    return placed.unionByName(full)


def pack_documents(docs: DataFrame, tokenizer_path: str, style: str = "word",
                   capacity: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """Tokenize, cut and pack whole documents: doc_id, piece, start, length,
    ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    path = work_dir(spark, "pieces")
    tokenized_pieces(docs, tokenizer_path, style, capacity, end_id).write.parquet(path)
    return pack_pieces(spark.read.parquet(path), capacity)
