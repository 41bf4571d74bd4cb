"""Operator 5, token-id output: Simple-8b word-aligned coding.

A 64-bit word holds a 4-bit selector (top bits) and up to 60 bits of data.
The selector names how many ids the word packs and their width.  Ids are
cut into sub-blocks of ``SUB_BLOCK`` ids that start on a word of their own;
the block's header has each sub-block's first word and first escape, so a
reader decodes any sub-block alone and a whole block with array operations.
A value of 60 bits or more is an escape: the word's data is all ones and
the value stands in the block's escape list.

Block (little endian): magic ``S8B2``, int32 version, int64 n_docs, n_ids,
n_words, n_escapes, n_subs; doc ids int64[n_docs]; null flags of the doc ids
uint8[n_docs]; ids per document int64[n_docs]; first word of each sub-block
int64[n_subs]; first escape of each sub-block int64[n_subs]; words
uint64[n_words]; escapes uint64[n_escapes].

``write_blocks`` stores blocks as rows (shard, first_id, n_ids, payload) of
parquet files, through Spark's own writer, in ascending doc_id order; a
shard is one write task's range of documents and ``first_id`` counts the ids
before the block in its shard.  ``read_documents`` reads the files back.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tokens import crc32, encoder

# Fixed values of the coding: ids per word and bits per id, by selector.
COUNTS = (240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
BITS = (0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
ESCAPE = (1 << 60) - 1
SUB_BLOCK = 1024
# A block is closed when it has so many ids (whole documents only).
BLOCK_IDS = 1 << 18
END_ID = 0

_MAGIC = b"S8B2"
_HEAD = struct.Struct("<4si5q")
_LIMITS = np.array([1 << b for b in range(60)], np.uint64)
_WIDTHS = np.searchsorted(_LIMITS, np.arange(1 << 16, dtype=np.uint64),
                          side="right").astype(np.uint8)


def _bit_widths(ids: np.ndarray) -> np.ndarray:
    """Bits each id needs, as uint8 (60 and more bits: 60)."""
    if int(ids.max(initial=0)) < len(_WIDTHS):
        return _WIDTHS[ids]
    return np.searchsorted(_LIMITS, ids, side="right").astype(np.uint8)


def _selectors(width: np.ndarray, room: np.ndarray) -> np.ndarray:
    """For each position the first selector whose ids, starting there, all
    fit and stay inside ``room`` (ids left in the sub-block)."""
    n = len(width)
    most = {1: width}

    def widest(count: int) -> np.ndarray:
        """Largest width among ``count`` ids from each position on."""
        if count not in most:
            base = max(c for c in most if c < count)
            step = min(base, count - base)
            far = np.zeros(n, np.uint8)
            far[:max(0, n - (count - step))] = widest(step)[count - step:]
            most[count] = np.maximum(widest(base), far)
        return most[count]

    out = np.full(n, 15, np.uint8)
    for sel in range(14, -1, -1):
        widest(COUNTS[sel])
    for sel in range(14, -1, -1):
        fits = widest(COUNTS[sel]) <= BITS[sel]
        if fits.any():
            np.copyto(out, np.uint8(sel), where=fits & (room >= COUNTS[sel]))
    return out


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """uint64 ids -> (words, first word and first escape of each sub-block, escapes)."""
    ids = np.ascontiguousarray(ids, np.uint64)
    n = len(ids)
    starts = np.arange(0, n, SUB_BLOCK, dtype=np.int64)
    if not n:
        none = np.zeros(0, np.uint64)
        return none, starts, starts, none
    room = np.resize(np.arange(SUB_BLOCK, 0, -1, dtype=np.uint16), n)
    tail = n - n % SUB_BLOCK
    room[tail:] = np.arange(n - tail, 0, -1)
    sel = _selectors(_bit_widths(ids), room)
    counts = np.array(COUNTS, np.int64)
    jump = counts[sel]
    # all sub-blocks step from word to word together
    pos, end, seen = starts, np.minimum(starts + SUB_BLOCK, n), []
    while len(pos):
        seen.append(pos)
        pos = pos + jump[pos]
        more = pos < end
        pos, end = pos[more], end[more]
    at = np.sort(np.concatenate(seen))
    sel = sel[at].astype(np.uint64)
    words = sel << np.uint64(60)
    for s in range(2, 16):
        rows = np.flatnonzero(sel == s)
        if len(rows):
            data = np.zeros(len(rows), np.uint64)
            for i in range(COUNTS[s]):
                v = ids[at[rows] + i]
                if s == 15:
                    v = np.minimum(v, np.uint64(ESCAPE))
                data |= v << np.uint64(i * BITS[s])
            words[rows] |= data
    is_escape = (sel == 15) & (ids[at] >= np.uint64(ESCAPE))
    escape_at = at[is_escape]
    return (words, np.searchsorted(at, starts), np.searchsorted(escape_at, starts),
            ids[escape_at])


def unpack(words: np.ndarray, escapes: np.ndarray) -> np.ndarray:
    """All ids of consecutive words (with the escapes that belong to them)."""
    sel = (words >> np.uint64(60)).astype(np.int64)
    counts = np.array(COUNTS, np.int64)[sel]
    first = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), np.uint64)
    for s in range(2, 16):
        rows = np.flatnonzero(sel == s)
        if len(rows):
            w, to = words[rows], first[rows]
            mask = np.uint64((1 << BITS[s]) - 1)
            for i in range(COUNTS[s]):
                out[to + i] = (w >> np.uint64(i * BITS[s])) & mask
    if len(escapes):
        singles = first[sel == 15]
        out[singles[out[singles] == np.uint64(ESCAPE)]] = escapes
    return out


def encode_block(doc_ids: list[int | None], ids: list[np.ndarray]) -> bytes:
    """One block of whole documents."""
    lens = np.array([len(x) for x in ids], np.int64)
    flat = np.concatenate([x.astype(np.uint64) for x in ids]) if ids else np.zeros(0, np.uint64)
    words, subs, esc_subs, escapes = pack(flat)
    null = np.array([d is None for d in doc_ids], np.uint8)
    docs = np.array([0 if d is None else d for d in doc_ids], "<i8")
    head = _HEAD.pack(_MAGIC, 2, len(docs), len(flat), len(words), len(escapes), len(subs))
    return b"".join([head, docs.tobytes(), null.tobytes(), lens.astype("<i8").tobytes(),
                     subs.astype("<i8").tobytes(), esc_subs.astype("<i8").tobytes(),
                     words.astype("<u8").tobytes(), escapes.astype("<u8").tobytes()])


class Block:
    """A block that was read: documents, offsets, and ids by sub-block or whole."""

    def __init__(self, payload: bytes):
        magic, version, n_docs, self.n_ids, n_words, n_esc, n_subs = _HEAD.unpack_from(payload)
        if magic != _MAGIC or version != 2:
            raise ValueError("not a Simple-8b block")
        at = _HEAD.size

        def take(dtype: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(payload, dtype, n, at)
            at += out.nbytes
            return out

        docs, null = take("<i8", n_docs), take("u1", n_docs)
        self.doc_ids = [None if x else int(d) for d, x in zip(docs, null, strict=True)]
        self.lens = take("<i8", n_docs)
        self.subs, self.esc_subs = take("<i8", n_subs), take("<i8", n_subs)
        self.words, self.escapes = take("<u8", n_words), take("<u8", n_esc)

    def ids(self) -> np.ndarray:
        return unpack(self.words, self.escapes)

    def sub_block(self, k: int) -> np.ndarray:
        """Ids ``k * SUB_BLOCK`` and following, up to the sub-block's end."""
        last = k + 1 >= len(self.subs)
        w = self.words[self.subs[k]: None if last else self.subs[k + 1]]
        return unpack(w, self.escapes[self.esc_subs[k]: None if last else self.esc_subs[k + 1]])


def write_blocks(docs: DataFrame, path: str, tokenizer_path: str, style: str = "byte",
                 end_id: int = END_ID) -> None:
    """Encode ``docs`` (doc_id, text; more columns are ignored) into block files.

    Every document is its ids and ``end_id``; null or empty text gives
    ``end_id`` alone.  Documents are range-partitioned and sorted by doc_id
    (null first); rows with the same doc_id are ordered by text.  An empty
    table writes no blocks.  Texts cross the network once.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path, style)
        end = np.array([end_id], "<u4").tobytes()
        shard, first, doc_ids, ids, size = TaskContext.get().partitionId(), 0, [], [], 0

        def close() -> pa.RecordBatch:
            payload = encode_block(doc_ids, ids)
            return pa.RecordBatch.from_pydict(
                {"shard": pa.array([shard], pa.int32()), "first_id": pa.array([first], pa.int64()),
                 "n_ids": pa.array([size], pa.int64()),
                 "payload": pa.array([payload], pa.binary())})

        for b in batches:
            texts = enc.encode(b.column(1).to_pylist())
            for d, text in zip(b.column(0).to_pylist(), texts, strict=True):
                got = np.frombuffer(text + end, "<u4")
                doc_ids.append(d)
                ids.append(got)
                size += len(got)
                if size >= BLOCK_IDS:
                    yield close()
                    first, doc_ids, ids, size = first + size, [], [], 0
        if doc_ids:
            yield close()

    (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
     .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
     .mapInArrow(encode, "shard int, first_id long, n_ids long, payload binary")
     .write.option("compression", "uncompressed").parquet(path))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: doc_id, start (ids before it), n_tokens, ids_crc32.

    A block starts after the ids of all earlier shards and the earlier blocks
    of its own; the shards' totals are one row per write task, which bounds
    what is broadcast.
    """
    blocks = spark.read.schema(
        "shard int, first_id long, n_ids long, payload binary").parquet(path)
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = (blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
              .select("shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base, payload in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                block = Block(payload.as_py())
                ids = block.ids().astype("<u4")
                stop = np.cumsum(block.lens)
                start = stop - block.lens
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(block.doc_ids, pa.int64()),
                    "start": pa.array(start + base, pa.int64()),
                    "n_tokens": pa.array(block.lens, pa.int64()),
                    "ids_crc32": pa.array([crc32(ids[i:j].tobytes())
                                           for i, j in zip(start, stop, strict=True)],
                                          pa.int64())})

    return (blocks.join(F.broadcast(shards), "shard")
            .select((F.col("before") + F.col("first_id")).alias("base"), "payload")
            .mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long"))
