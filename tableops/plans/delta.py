"""Replication by key ranges that copies only what changed.

The target is cut into ranges of key values.  A commit lists its ranges: lower
border, rows, two fingerprints over all values, and the run whose files hold
the range's rows.  ``refresh_table`` fingerprints the source by those borders in
one scan (one partial row per task and range), copies the rows of the ranges
whose fingerprint differs, and commits a list that refers to the new run for
them and to earlier runs for all others.  Borders are key values, so rows that
are inserted or deleted change their own range only.

Borders come from ranking the keys alone (not the rows), every ``batch`` ranks;
a range that has grown beyond twice that is cut again, and one that has lost
all rows joins its neighbour.  At most ``MAX_RANGES`` ranges exist (a larger
table gets longer ranges), so borders may go to every task.  A row finds its
range by binary search over the borders, in the order Spark sorts the keys (whole
numbers and texts a batch at a time in Python, other keys by an expression).

A run's files hold rows of many ranges, ordered by range, so the number of
files follows the bytes copied, and readers prune by range.  Fingerprints in
a commit are those of the rows written: if the source changed meanwhile, the
next refresh sees it.  A refresh that dies after some of its steps has
committed those (``complete`` false, not for readers); the next call goes on
from there, as their ranges agree by then.

A changed schema or key starts anew.  A null key belongs to the first range.
Without a key the table is one range.
"""

from __future__ import annotations

import bisect
import json
import time
import uuid
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.paging import DEFAULT_BATCH, ranked_with_count
from ..session import _parse_bytes, input_bytes
from ..sinks.commits import _hadoop, publish, published, read_published
from ..sinks.writers import TIME_FORMATS

MAX_RANGES = 1 << 16
# Key types that a batch of keys is searched for as a whole.
SEARCHED = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.StringType())
RANGE_COL, RUN_COL = "_copied_range", "_copied_by_run"
COMMITS, RUNS = "commits", "runs"


@dataclass
class Range:
    range_id: int
    lower: str | None      # JSON of the first key, None: from the beginning
    rows: int
    hash: str
    check: int
    run: str


@dataclass
class RefreshResult:
    commit: int | None     # None: the target was up to date
    ranges: int
    copied_ranges: int
    copied_rows: int
    complete: bool


@dataclass
class Commit:
    number: int
    schema: str
    key: list[str]
    complete: bool
    ranges: list[Range]


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _has_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_has_map(f.dataType) for f in kind.fields)
    return isinstance(kind, T.MapType)


def _values(schema: T.StructType) -> list[Column]:
    """Columns that a hash can take (what holds maps as text)."""
    return [F.to_json(F.col(f"`{f.name}`"), TIME_FORMATS) if _has_map(f.dataType)
            else F.col(f"`{f.name}`") for f in schema.fields]


def _stored(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(RANGE_COL, T.IntegerType()),
                         T.StructField(RUN_COL, T.StringType())])


def _fingerprint(schema: T.StructType) -> list[Column]:
    values = _values(schema)
    return [F.count(F.lit(1)).alias("rows"),
            F.sum(F.xxhash64(*values).cast("decimal(38,0)")).cast("string").alias("hash"),
            F.bit_xor(F.xxhash64(F.lit(1), *reversed(values))).alias("check")]


def _key(key: list[str]) -> Column:
    return F.struct(*[F.col(f"`{k}`") for k in key])


def position(key: list[str], schema: T.StructType, borders: list[str]) -> Column:
    """Number of borders (JSON of keys, ascending) that are at or below the row's key."""
    if not borders:
        return F.lit(0)
    if len(key) == 1 and schema[key[0]].dataType in SEARCHED:
        return _single(key[0], borders)(F.col(f"`{key[0]}`"))
    kind = T.ArrayType(T.StructType([schema[k] for k in key]))
    # a constant: parsed once, and read in place by every row
    known = F.from_json(F.lit("[" + ",".join(borders) + "]"), kind, TIME_FORMATS)
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(borders).bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        (at + step <= len(borders)) & (F.get(known, at + step - 1) <= _key(key)),
        at + step).otherwise(at))


def _single(key: str, borders: list[str]):
    """``position`` for a key of one whole number or text: Arrow batches of keys and
    one search per row by numpy or ``bisect`` (higher-order functions are not
    compiled and take some 14 us a row)."""
    known = [json.loads(b)[key] for b in borders]
    if isinstance(known[0], str):
        def place(keys: pa.Array) -> pa.Array:
            return pa.array([0 if k is None else bisect.bisect_right(known, k)
                             for k in keys.to_pylist()], pa.int32())
    else:
        numbers = np.array(known, np.int64)

        def place(keys: pa.Array) -> pa.Array:
            at = np.searchsorted(numbers, keys.cast(pa.int64()).fill_null(0).to_numpy(), "right")
            at[keys.is_null().to_numpy(zero_copy_only=False)] = 0
            return pa.array(at, pa.int32())
    return F.arrow_udf(place, "int")


def _range_id(key: list[str], schema: T.StructType, ranges: list[Range],
              only: set[int] | None = None) -> Column:
    """The id of the row's range; of ranges that are not in ``only``, null."""
    ids = F.from_json(F.lit(json.dumps([
        r.range_id if only is None or r.range_id in only else None for r in ranges])),
        "array<int>")
    return F.get(ids, position(key, schema, [r.lower for r in ranges if r.lower is not None]))


def _borders(frame: DataFrame, key: list[str], batch: int) -> list[str]:
    """JSON of every ``batch``-th key (from 0) of the frame, by a distributed
    ranking of the keys alone; at most ``MAX_RANGES`` reach the driver."""
    ranked, n = ranked_with_count(frame.select(*[F.col(f"`{k}`") for k in key]), key)
    batch = max(batch, -(-n // MAX_RANGES))
    rows = (ranked.filter((F.col("ranking") - 1) % batch == 0).orderBy("ranking")
            .select(F.to_json(_key(key), {**TIME_FORMATS, "ignoreNullFields": "false"}).alias("k")))
    out = [r["k"] for r in rows.collect()]
    # equal keys (a key that is not unique) have one border
    return list(dict.fromkeys(out))


def commits(spark: SparkSession, target: str) -> list[int]:
    return [int(n) for n in published(spark, f"{target}/{COMMITS}")]


def read_commit(spark: SparkSession, target: str, number: int) -> Commit:
    raw = json.loads(read_published(spark, f"{target}/{COMMITS}/{number:012d}"))
    return Commit(number, raw["schema"], raw["key"], raw["complete"],
                  [Range(**r) for r in raw["ranges"]])


def latest(spark: SparkSession, target: str, complete: bool) -> Commit | None:
    """The newest commit (of complete ones only, if asked)."""
    for number in reversed(commits(spark, target)):
        got = read_commit(spark, target, number)
        if got.complete or not complete:
            return got
    return None


def _publish(spark: SparkSession, target: str, c: Commit) -> None:
    text = json.dumps({"schema": c.schema, "key": c.key, "complete": c.complete,
                       "ranges": [asdict(r) for r in c.ranges]})
    if not publish(spark, f"{target}/{COMMITS}/{c.number:012d}", text):
        raise RuntimeError(f"another refresh of {target} committed meanwhile; run this one again")


def _between(key: list[str], schema: T.StructType, ranges: list[Range], changed: set[int]) -> Column:
    """What keys of the changed ranges must fulfil, in a form that scans push
    down: from the first changed range's border to the end of the last one
    (by the first key column)."""
    at = [i for i, r in enumerate(ranges) if r.range_id in changed]
    first, after = ranges[at[0]], at[-1] + 1
    kind = T.StructType([schema[k] for k in key])
    column = F.col(f"`{key[0]}`")

    def border(r: Range) -> Column:
        return F.from_json(F.lit(r.lower), kind, TIME_FORMATS)[key[0]]

    out = F.lit(True)
    if first.lower is not None:
        out = out & (column >= border(first))
    if after < len(ranges):
        out = out & (column <= border(ranges[after]))
        if first.lower is None:
            out = out | column.isNull()
    return out


def refresh_table(source: DataFrame, target: str, key: list[str] | None,
                  batch: int = DEFAULT_BATCH, steps: int = 1,
                  max_steps: int | None = None) -> RefreshResult:
    """Bring the copy at ``target`` up to ``source``.  The changed ranges are
    copied in ``steps`` parts, each committed; ``max_steps`` ends the call after
    so many (the next call goes on)."""
    spark, target, key = source.sparkSession, target.rstrip("/"), list(key or [])
    schema, shape = source.schema, source.schema.json()
    seen = commits(spark, target)
    number = seen[-1] + 1 if seen else 0
    last = latest(spark, target, complete=False)
    if last is None or last.schema != shape or last.key != key:
        lower = [None, *(_borders(source, key, batch)[1:] if key else [])]
        ranges = [Range(i, x, 0, "", 0, "") for i, x in enumerate(lower)]
        changed, done = {r.range_id for r in ranges}, False
    else:
        ranges, done = last.ranges, last.complete
        now = {r["id"]: (r["rows"], r["hash"], r["check"]) for r in source.groupBy(
            _range_id(key, schema, ranges).alias("id")).agg(*_fingerprint(schema)).collect()}
        changed = {r.range_id for r in ranges
                   if now.get(r.range_id, (0, None, None)) != (r.rows, r.hash or None, r.check)
                   and (r.rows or r.range_id in now)}
        ranges, cut = _recut(source, key, schema, ranges, changed, now, batch)
        changed |= cut
        if not changed and done:
            return RefreshResult(None, len(ranges), 0, 0, True)
    order = [r.range_id for r in ranges if r.range_id in changed]
    size = max(1, -(-len(order) // steps))
    parts = [order[i:i + size] for i in range(0, len(order), size)] or [[]]
    copied = rows = 0
    for i, part in enumerate(parts):
        if max_steps is not None and i == max_steps:
            return RefreshResult(number - 1, len(ranges), copied, rows, False)
        if part:
            own = set(part)
            ranges = _copy(source, target, key, schema, ranges, own)
            rows += sum(r.rows for r in ranges if r.range_id in own)
            copied += len(part)
        complete = i == len(parts) - 1
        _publish(spark, target, Commit(number, shape, key, complete,
                                       _without_empty(ranges) if complete else ranges))
        number += 1
    return RefreshResult(number - 1, len(ranges), copied, rows, True)


def _without_empty(ranges: list[Range]) -> list[Range]:
    """Ranges without rows go; their keys belong to the range before then."""
    return [r for i, r in enumerate(ranges) if r.rows or i == 0]


def _recut(source: DataFrame, key: list[str], schema: T.StructType, ranges: list[Range],
           changed: set[int], now: dict, batch: int) -> tuple[list[Range], set[int]]:
    """New borders inside of the changed ranges that are too long by now."""
    batch = max(batch, -(-sum(n for n, _, _ in now.values()) // MAX_RANGES))
    long = {i for i in changed if now.get(i, (0,))[0] > 2 * batch}
    if not long or not key:
        return ranges, set()
    at = _range_id(key, schema, ranges)
    inside = source.filter(_between(key, schema, ranges, long)).filter(
        _range_id(key, schema, ranges, long).isNotNull())
    fresh = _borders(inside, key, batch)[1:]
    # where the new borders lie, by the same search
    kind = T.StructType([schema[k] for k in key])
    text = "_border_text"
    placed = (source.sparkSession.createDataFrame([(x,) for x in fresh], f"{text} string")
              .select(text, F.from_json(text, kind, TIME_FORMATS).alias("v")).select(text, "v.*")
              .select(text, at.alias("id")).collect())
    new: dict[int, list[str]] = {}
    for r in placed:
        new.setdefault(r["id"], []).append(r[text])
    order = {k: i for i, k in enumerate(fresh)}
    free = max(r.range_id for r in ranges) + 1
    out, cut = [], set()
    for r in ranges:
        out.append(r)
        if r.range_id in long:
            for lower in sorted(new.get(r.range_id, []), key=order.get):
                if lower != r.lower:
                    out.append(Range(free, lower, 0, "", 0, ""))
                    cut.add(free)
                    free += 1
    return out, cut


def _copy(source: DataFrame, target: str, key: list[str], schema: T.StructType,
          ranges: list[Range], part: set[int]) -> list[Range]:
    """The ranges after a new run with the rows of those in ``part``."""
    spark = source.sparkSession
    run = f"{int(time.time() * 1e6):018d}-{uuid.uuid4().hex[:8]}"
    path = f"{target}/{RUNS}/{run}"
    rows = source.withColumn(RANGE_COL, _range_id(key, schema, ranges))
    if len(part) < len(ranges):
        rows = source.filter(_between(key, schema, ranges, part)).withColumn(
            RANGE_COL, _range_id(key, schema, ranges, part)).filter(F.col(RANGE_COL).isNotNull())
    share = len(part) / len(ranges)
    advisory = _parse_bytes(spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64MB"))
    files = int(input_bytes(source) * share / advisory) + 1
    rows = rows.withColumn(RUN_COL, F.lit(run))
    if key:
        rows = rows.repartitionByRange(files, RANGE_COL, *[F.col(f"`{k}`") for k in key]) \
            .sortWithinPartitions(RANGE_COL)
    rows.write.parquet(path)
    got = {r[RANGE_COL]: r for r in spark.read.schema(_stored(schema)).parquet(path)
           .groupBy(RANGE_COL).agg(*_fingerprint(schema)).collect()}
    return [r if r.range_id not in part else
            Range(r.range_id, r.lower, got[r.range_id]["rows"], got[r.range_id]["hash"],
                  got[r.range_id]["check"], run) if r.range_id in got else
            Range(r.range_id, r.lower, 0, "", 0, "") for r in ranges]


def read_refreshed(spark: SparkSession, target: str) -> DataFrame:
    """The copy as of the newest complete commit."""
    target = target.rstrip("/")
    c = latest(spark, target, complete=True)
    if c is None:
        raise FileNotFoundError(f"no complete commit under {target}")
    schema = T.StructType.fromJson(json.loads(c.schema))
    held = [(r.run, r.range_id) for r in c.ranges if r.rows]
    if not held:
        return spark.createDataFrame([], schema)
    runs = sorted({run for run, _ in held})
    rows = spark.read.schema(_stored(schema)).parquet(*[f"{target}/{RUNS}/{r}" for r in runs])
    # at most MAX_RANGES rows
    mine = spark.createDataFrame(held, f"{RUN_COL} string, {RANGE_COL} int")
    return rows.join(F.broadcast(mine), [RUN_COL, RANGE_COL], "left_semi").select(*[
        F.col(f"`{n}`") for n in schema.names])


def vacuum(spark: SparkSession, target: str, keep: int = 1) -> list[str]:
    """Delete the runs that none of the last ``keep`` complete commits, nor a
    later one, refers to; returns their names.  Not beside a running refresh."""
    target = target.rstrip("/")
    numbers = commits(spark, target)
    needed: set[str] = set()
    left = keep
    for number in reversed(numbers):
        c = read_commit(spark, target, number)
        needed |= {r.run for r in c.ranges}
        left -= c.complete
        if not left:
            break
    fs, root = _hadoop(spark, f"{target}/{RUNS}")
    if not fs.exists(root):
        return []
    gone = []
    for status in fs.listStatus(root):
        if status.getPath().getName() not in needed:
            fs.delete(status.getPath(), True)
            gone.append(status.getPath().getName())
    return sorted(gone)
