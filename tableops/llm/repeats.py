"""Which 64-bit tokens occur in more than one text: a bit table of fixed size.

Tasks send their distinct tokens, sorted and packed by shard (the tokens'
top bits); a shard finds the tokens that two tasks sent, or that one task
saw twice, and returns its slice of the table.  The table has ``2 ** bits``
bits whatever the input, so it may be broadcast; a token whose bit is not
set occurs in one text only, a set bit says that it may occur in two.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ..session import land, passing_folders, work_dir
from .shingles import slices
from .workers import lean

_U = np.uint64
# Tokens that a task holds before it sends them on.
FLUSH_TOKENS = 2_000_000


# Low bits that are not sent: 46 bits tell tokens apart (a set bit only says
# that a token may repeat).
DROPPED_BITS = 18


def packed(tokens: np.ndarray) -> bytes:
    """Sorted tokens without their low bits, as steps of 32 bits where they fit."""
    short = tokens >> _U(DROPPED_BITS)
    steps = np.diff(short, prepend=short[:1])
    if len(short) and int(steps.max()) < 1 << 32:
        return b"S" + short[:1].tobytes() + steps.astype("<u4").tobytes()
    return b"W" + short.tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    """Sorted tokens, low bits zero."""
    if raw[:1] == b"W":
        return np.frombuffer(raw, np.uint64, offset=1) << _U(DROPPED_BITS)
    first = np.frombuffer(raw, np.uint64, 1, 1)
    steps = np.cumsum(np.frombuffer(raw, "<u4", offset=9).astype(np.uint64))
    return (steps + first) << _U(DROPPED_BITS)


class BitTable:
    def __init__(self, bits: int):
        self.bits = bits
        self.data = np.zeros(1 << (bits - 3), np.uint8)

    def may_repeat(self, tokens: np.ndarray) -> np.ndarray:
        at = (tokens >> _U(64 - self.bits)).astype(np.int64)
        return ((self.data[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).astype(bool)


def repeated_bits(frame: DataFrame, kinds: int, bits: int,
                  tokens_of: Callable[[pa.RecordBatch], Iterator[tuple[int, np.ndarray]]],
                  over: Callable[..., DataFrame] | None = None) -> list[BitTable]:
    """One table per kind.  ``tokens_of(batch)`` yields (kind, distinct tokens of a text).
    ``over`` (else ``frame.mapInArrow``) runs a function over the batches."""
    parts = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # shards grow with the configured parallelism
    shard_bits = max(6, min(bits - 6, (parts - 1).bit_length()))

    @lean
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = [[] for _ in range(kinds)]

        def flush() -> pa.RecordBatch:
            rows: dict[str, list] = {"part": [], "seen": [], "again": []}
            for kind in range(kinds):
                if not held[kind]:
                    continue
                tokens, n = np.unique(np.concatenate(held[kind]), return_counts=True)
                shard = (tokens >> _U(64 - shard_bits)).astype(np.int64)
                cut = np.searchsorted(shard, np.arange((1 << shard_bits) + 1))
                for s in range(1 << shard_bits):
                    own, k = tokens[cut[s]:cut[s + 1]], n[cut[s]:cut[s + 1]]
                    if len(own):
                        rows["part"].append(kind << shard_bits | s)
                        rows["seen"].append(packed(own[k == 1]))
                        rows["again"].append(packed(own[k > 1]))
                held[kind] = []
            return pa.RecordBatch.from_pydict({
                "part": pa.array(rows["part"], pa.int32()),
                "seen": pa.array(rows["seen"], pa.binary()),
                "again": pa.array(rows["again"], pa.binary())})

        size = 0
        for b in slices(batches):
            for kind, tokens in tokens_of(b):
                held[kind].append(tokens)
                size += len(tokens)
                if size > FLUSH_TOKENS:
                    yield flush()
                    size = 0
        yield flush()

    def meet(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        again = np.unique(np.concatenate(
            [unpacked(x.as_py()) for x in table.column("again")]))
        seen = np.sort(np.concatenate(
            [again, *(unpacked(x.as_py()) for x in table.column("seen"))]))
        twice = np.concatenate([seen[1:][seen[1:] == seen[:-1]], again])
        own = np.zeros(1 << (bits - shard_bits), bool)
        own[((twice >> _U(64 - bits)) & _U((1 << (bits - shard_bits)) - 1)).astype(np.int64)] = 1
        return pa.table({"part": pa.array([part], pa.int32()),
                         "bits": pa.array([np.packbits(own).tobytes()], pa.binary())})

    out = [BitTable(bits) for _ in range(kinds)]
    width = 1 << (bits - shard_bits - 3)
    # kinds * 2 ** bits bits in all; landed, as the tokens' shuffle would stay behind an iterator
    with passing_folders(frame.sparkSession):
        rows = land((over or frame.mapInArrow)(emit, "part int, seen binary, again binary")
                    .groupBy("part").applyInArrow(meet, "part int, bits binary"),
                    work_dir(frame.sparkSession, "repeated-bits"))
        for row in rows.toLocalIterator():
            kind, shard = row["part"] >> shard_bits, row["part"] & ((1 << shard_bits) - 1)
            out[kind].data[shard * width:(shard + 1) * width] = np.frombuffer(row["bits"], np.uint8)
    return out
