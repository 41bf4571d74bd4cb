"""Global row numbering and chunked copies.

``row_number() OVER (ORDER BY pk)`` without a partition runs in a single
task in Spark.  ``global_rank`` gives the same numbers with the work spread
over all tasks:

1. range-partition on the key and sort inside each partition (one shuffle);
2. tag every row with its partition id and its position in the partition
   (``monotonically_increasing_id`` minus the partition's base), and write
   that once as a reliable checkpoint, so the sampled range boundaries
   cannot change between the two reads below (and a lost executor's
   partitions are re-read, not re-sampled);
3. count rows per partition (one row per partition reaches the driver, a
   number bounded by the partition count, not the data);
4. rank = rows in earlier partitions + position + 1, a per-row expression.

The number of range partitions grows with the input size (see
``sized_partitions``), so no task sorts an outsized partition.

The key must be unique for the ranking to be deterministic, as with
``row_number``.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import chunk_count
from ..session import cut_lineage, sized_partitions

RANK_COL = "ranking"
CHUNK_COL = "chunk_id"
# Rows per chunk in the reference's copy loop.
DEFAULT_BATCH = 50_000
# Input bytes per range partition of the distributed sort.
SORT_PARTITION_BYTES = 1 << 30


def _key_cols(keys: list[str | Column]) -> list[Column]:
    return [F.col(k) if isinstance(k, str) else k for k in keys]


def global_rank(df: DataFrame, keys: list[str | Column], num_partitions: int | None = None,
                rank_col: str = RANK_COL) -> DataFrame:
    """1-based rank by ``keys`` (ascending), computed without a single-task sort."""
    return ranked_with_count(df, keys, num_partitions, rank_col)[0]


def ranked_with_count(df: DataFrame, keys: list[str | Column], num_partitions: int | None = None,
                      rank_col: str = RANK_COL) -> tuple[DataFrame, int]:
    """``global_rank`` plus the row count, known from the per-partition
    sizes it collects anyway (no extra pass)."""
    n = num_partitions or sized_partitions(df, SORT_PARTITION_BYTES)
    kc = _key_cols(keys)
    tagged = (df.repartitionByRange(n, *kc).sortWithinPartitions(*kc)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_pos", F.monotonically_increasing_id()
                          - F.shiftleft(F.spark_partition_id().cast("long"), 33)))
    tagged = cut_lineage(tagged)
    sizes = dict(tagged.groupBy("_pid").count().collect())
    n_parts = max(sizes) + 1 if sizes else 1
    offsets = list(itertools.accumulate(
        (sizes.get(p, 0) for p in range(n_parts)), initial=0))[:n_parts]
    # one row per range partition: a proven size bound for the broadcast
    table = df.sparkSession.createDataFrame(list(enumerate(offsets)), "_pid int, _off long")
    ranked = (tagged.join(F.broadcast(table), "_pid")
              .withColumn(rank_col, F.col("_off") + F.col("_pos") + 1)
              .drop("_pid", "_pos", "_off"))
    return ranked, sum(sizes.values())


def with_position(df: DataFrame, keys: list[str | Column]) -> DataFrame:
    """O1: rows in the order of ``keys`` with their 1-based ``position``, so the
    order survives whatever reads the result."""
    return global_rank(df, keys, rank_col="position")


def rank_between(ranked: DataFrame, lo: int, hi: int, rank_col: str = RANK_COL) -> DataFrame:
    """Rows with ``lo <= rank <= hi`` (inclusive)."""
    return ranked.filter(F.col(rank_col).between(lo, hi))


def with_chunks(ranked: DataFrame, batch: int = DEFAULT_BATCH,
                rank_col: str = RANK_COL) -> DataFrame:
    """Chunk number ``(rank - 1) div batch`` (0-based)."""
    return ranked.withColumn(CHUNK_COL, F.floor((F.col(rank_col) - 1) / F.lit(batch))
                             .cast("long"))


def chunk_summary(chunked: DataFrame, rank_col: str = RANK_COL) -> DataFrame:
    """Rows and rank range per chunk (one partial aggregate per task)."""
    return chunked.groupBy(CHUNK_COL).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(rank_col).alias("first_rank"),
        F.max(rank_col).alias("last_rank"))


def total_chunks(df: DataFrame, batch: int = DEFAULT_BATCH) -> int:
    """ceil(count / batch)."""
    return df.agg(chunk_count(F.count(F.lit(1)), batch).alias("n")).first()["n"]
