"""Prefix trie of conversations by truncation peeling.

A node is a distinct sequence of first turns (role, text); its members are the
conversations that start with it, the root (depth 0) has them all.

Every conversation becomes a chain of 128-bit keys, one a turn (the key before
it, the digest of role and text), kept in rows of ``SEGMENT`` turns, so that no
row grows with a conversation.  Peeling goes from the greatest depth down.  At
each depth the conversations that end there (equal ones merged before) meet the
nodes that survive from below; what has one key becomes one node, and the sums
of its rows are its members, children, leaves and savings.  Then the last turn
is stripped and the nodes go on to the next depth as rows of their parents.
Each depth is one small aggregate, summed in the tasks before its shuffle and
written to the shared work folder, so hot prefixes cost no more than others and
a lost executor repeats one depth at most.

Where all that passes a segment's border is one and the same whole sequence,
nothing merges below it: such tails are peeled in one step, so the number of
rounds follows the depth to which different conversations agree, not the
longest conversation.

The digest of the conversations that end at a node reads their ids in
ascending order: ranges of ids make pieces of text in parallel, one stream a
node hashes the pieces (bounded memory, the hash itself is sequential).

Odd rows: rows without conv_id belong to no conversation and are left out; a
null role or text counts as empty; turns are ordered by (turn, role, text),
null turns first, so ties and repeated rows have one order and each row is a
turn; very long texts travel as digests; an empty table gives no rows, and no
root; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import work_dir

SEGMENT = 8
# Ids in one piece of text.
PIECE_IDS = 50_000
# An opening shared by rule is shorter than this.
OPENINGS = 9
BLOCK = 5
ROOT_KEY = bytes(16)
NOTHING = hashlib.sha256(b"").hexdigest()
NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
        "n_leaves long, saved_tokens long, ends_sha256 string")


def conversation_ids(turns: DataFrame) -> DataFrame:
    return turns.filter("conv_id is not null").select("conv_id").distinct()


def numbered_turns(turns: DataFrame) -> DataFrame:
    """``conv_id, pos`` (from 0), ``digest`` and ``n_bytes`` of every turn."""
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    return (turns.filter("conv_id is not null")
            .select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"),
                    text.alias("text"))
            .select("conv_id", (F.row_number().over(order) - 1).alias("pos"),
                    # the role's length keeps (role, text) pairs apart
                    F.substring(F.unhex(F.sha2(F.concat(
                        F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)), 1, 16)
                    .alias("digest"),
                    F.octet_length("text").cast("long").alias("n_bytes")))


def opening_length(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string").cast("binary")) % OPENINGS


def share_openings(numbered: DataFrame, ids: DataFrame) -> DataFrame:
    """Turns of the conversations rebuilt with the opening of their block's
    first conversation: ``conv_id, part, pos, digest, n_bytes``."""
    block = F.col("conv_id") - F.col("conv_id") % BLOCK
    own = (numbered.filter(F.col("pos") >= opening_length(F.col("conv_id")))
           .withColumn("part", F.lit(1)))
    near = F.explode(F.sequence(F.lit(1 - BLOCK), F.lit(BLOCK - 1)))
    opening = (numbered.filter((F.col("conv_id") == block) & (F.col("pos") < OPENINGS - 1))
               .withColumn("step", near)
               .withColumn("first", F.col("conv_id"))
               .withColumn("conv_id", F.try_add("conv_id", F.col("step").cast("long")))
               .filter((block == F.col("first")) & (F.col("pos") < opening_length(F.col("conv_id"))))
               .join(ids, "conv_id", "left_semi").withColumn("part", F.lit(0)))
    return own.unionByName(opening.select(*own.columns))


def paths(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """Segments ``conv_id, seg, ends, path, sizes``: ``path`` has the key before
    the segment and those after each of its turns, ``sizes`` the texts' bytes."""
    heads = ids.select("conv_id", F.lit(-1).alias("part"), F.lit(-1).alias("pos"),
                       F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("n_bytes"))
    # by an expression of its own: a union of frames that are dealt by conv_id counts
    # as dealt by it, but its parts may be coalesced each in its own way at run time
    rows = (turns.select(*heads.columns).unionByName(heads).repartition(F.xxhash64("conv_id"))
            .sortWithinPartitions("conv_id", "part", "pos").select("conv_id", "part", "digest", "n_bytes"))

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        conv, seg, path, sizes = None, 0, [ROOT_KEY], []

        def flush() -> pa.RecordBatch:
            cols = list(zip(*out, strict=True)) or [[]] * 5
            out.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (
                    pa.int64(), pa.int32(), pa.bool_(), pa.list_(pa.binary()),
                    pa.list_(pa.int64())), strict=True)], ["conv_id", "seg", "ends", "path", "sizes"])

        for b in batches:
            for c, part, digest, size in zip(*(x.to_pylist() for x in b.columns), strict=True):
                if part < 0:
                    if conv is not None:
                        out.append((conv, seg, True, path, sizes))
                    conv, seg, path, sizes = c, 0, [ROOT_KEY], []
                    continue
                if len(sizes) == SEGMENT:
                    out.append((conv, seg, False, path, sizes))
                    seg, path, sizes = seg + 1, path[-1:], []
                path.append(hashlib.blake2b(path[-1] + digest, digest_size=16).digest())
                sizes.append(size)
            if len(out) > 5000:
                yield flush()
        if conv is not None:
            out.append((conv, seg, True, path, sizes))
        yield flush()

    return rows.mapInArrow(
        chain, "conv_id long, seg int, ends boolean, path array<binary>, sizes array<long>")


def whole_sequences(segments: DataFrame) -> DataFrame:
    """One row per distinct whole conversation: ``depth, key, conv_id`` (the
    smallest), ``n_convs`` and the digest of all their ids."""
    ended = segments.filter("ends").select(
        "conv_id", (F.col("seg") * SEGMENT + F.size("sizes")).cast("long").alias("depth"),
        F.element_at("path", -1).alias("key"))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {n: [] for n in ("depth", "key", "first", "n", "ids")}
        key, depth, own = None, 0, []

        def close():
            if own:
                for n, v in zip(held, (depth, key, own[0], len(own), ",".join(map(str, own))),
                                strict=True):
                    held[n].append(v)

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_pydict({
                "depth": pa.array(held["depth"], pa.int64()), "key": pa.array(held["key"], pa.binary()),
                "first": pa.array(held["first"], pa.int64()), "n": pa.array(held["n"], pa.int64()),
                "ids": pa.array(held["ids"], pa.string())})
            for v in held.values():
                v.clear()
            return batch

        for b in batches:
            for c, d, k in zip(*(x.to_pylist() for x in b.columns), strict=True):
                if k != key or len(own) == PIECE_IDS:
                    close()
                    key, depth, own = k, d, []
                own.append(c)
            yield flush()
        close()
        yield flush()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        key, now, row = None, None, None

        def flush() -> pa.RecordBatch:
            cols = list(zip(*out, strict=True)) or [[]] * 5
            out.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (
                    pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.string()), strict=True)],
                ["depth", "key", "conv_id", "n_convs", "ends_sha256"])

        for b in batches:
            for d, k, first, n, ids in zip(*(x.to_pylist() for x in b.columns), strict=True):
                if k != key:
                    if key is not None:
                        out.append((*row, now.hexdigest()))
                    key, now, row = k, hashlib.sha256(ids.encode()), [d, k, first, n]
                else:
                    now.update(b"," + ids.encode())
                    row[3] += n
            yield flush()
        if key is not None:
            out.append((*row, now.hexdigest()))
        yield flush()

    parts = int(segments.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (ended.repartitionByRange(parts, "key", "conv_id").sortWithinPartitions("key", "conv_id")
            .mapInArrow(pieces, "depth long, key binary, first long, n long, ids string")
            .repartition("key").sortWithinPartitions("key", "first")
            .mapInArrow(digests, "depth long, key binary, conv_id long, n_convs long, "
                                 "ends_sha256 string"))


def _tails(classes: DataFrame, segments: DataFrame) -> DataFrame:
    """Segments of the classes' first members with ``cut``: the depth below
    which the class is alone (null where it never is)."""
    own = (classes.filter(F.col("depth") >= SEGMENT)
           .select("conv_id", "depth", "n_convs", "ends_sha256", F.col("key").alias("whole"))
           .join(segments, "conv_id"))
    # a border is a class's own if one whole sequence passes or ends there
    borders = (own.filter(F.size("sizes") == SEGMENT)
               .groupBy(F.element_at("path", -1).alias("border"))
               .agg(F.min("whole").alias("a"), F.max("whole").alias("b"),
                    F.min("conv_id").alias("conv_id"),
                    F.first("seg").alias("seg")).filter("a = b"))
    cuts = borders.groupBy("conv_id").agg(
        ((F.min("seg") + 1) * SEGMENT).cast("long").alias("cut"))
    return own.join(cuts, "conv_id", "left")


def _chain_nodes(tails: DataFrame) -> DataFrame:
    """The nodes below the cut: each has one child or ends its class."""
    below = tails.filter(F.col("seg") * SEGMENT >= F.col("cut"))
    total = F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)
    deeper = Window.partitionBy("conv_id").orderBy(F.desc("seg")).rowsBetween(
        Window.unboundedPreceding, -1)
    at = F.col("seg") * SEGMENT + F.col("i") + 1
    rest = F.aggregate(F.slice("sizes", F.col("i") + 1, F.lit(SEGMENT)), F.lit(0).cast("long"),
                       lambda a, x: a + x)
    return (below.withColumn("later", F.coalesce(F.sum(total).over(deeper), F.lit(0)))
            .withColumn("i", F.explode(F.sequence(F.lit(0), F.size("sizes") - 1)))
            .select(at.cast("long").alias("depth"),
                    F.get("path", F.col("i") + 1).alias("key"),
                    F.get("path", F.col("i")).alias("parent_key"), "conv_id", "n_convs",
                    F.when(at < F.col("depth"), 1).otherwise(0).cast("long").alias("n_children"),
                    F.lit(1).cast("long").alias("n_leaves"),
                    ((F.col("n_convs") - 1) * (rest + F.col("later"))).alias("saved_tokens"),
                    F.when(at == F.col("depth"), F.col("ends_sha256")).alias("ends_sha256")))


def _entries(classes: DataFrame, tails: DataFrame, segments: DataFrame) -> DataFrame:
    """What enters the peeling, and at which depth: classes where they end, or
    the top of a tail as the only child that is known yet of the node at its cut."""
    cut = F.col("depth") > F.col("cut")
    saved = F.sum(F.when(F.col("seg") * SEGMENT >= F.col("cut"), F.aggregate(
        "sizes", F.lit(0).cast("long"), lambda a, x: a + x)))
    cuts = (tails.filter(cut).groupBy("conv_id")
            .agg(F.first("cut").alias("cut"), saved.alias("tail_bytes")))
    entering = (classes.join(cuts, "conv_id", "left")
                .select(F.coalesce("cut", "depth").alias("depth"), "conv_id", "n_convs",
                        F.when(F.col("cut").isNull(), 0).otherwise(1).cast("long").alias("n_children"),
                        F.when(F.col("cut").isNull(), 0).otherwise(1).cast("long").alias("n_leaves"),
                        F.coalesce((F.col("n_convs") - 1) * F.col("tail_bytes"), F.lit(0))
                        .alias("saved_tokens"),
                        F.when(F.col("cut").isNull(), F.col("ends_sha256")).alias("ends_sha256")))
    # the segment that holds the entry's last turn (for depth 0 the first one)
    seg = F.greatest(F.lit(0), F.floor((F.col("depth") - 1) / SEGMENT)).cast("int")
    return (entering.withColumn("seg", seg)
            .join(segments.select("conv_id", "seg", "path", "sizes"), ["conv_id", "seg"]).drop("seg"))


def _merged(rows: DataFrame, depth: int) -> DataFrame:
    """The nodes of one depth from all rows that end there or come from below."""
    i = (depth - 1) % SEGMENT
    if depth:
        key, parent, size = F.get("path", F.lit(i + 1)), F.get("path", F.lit(i)), F.get("sizes", F.lit(i))
    else:
        key, parent, size = F.lit(ROOT_KEY), F.lit(None).cast("binary"), F.lit(0).cast("long")
    first = F.struct("conv_id", parent.alias("parent_key"), size.alias("size"), "path", "sizes")
    return (rows.withColumn("key", key).groupBy("key")
            .agg(F.min(first).alias("x"),
                 *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
                 F.max("ends_sha256").alias("ends_sha256"))
            .select(F.lit(depth).cast("long").alias("depth"), "key", "x.*", "n_convs", "n_children",
                    F.greatest("n_leaves", F.lit(1)).alias("n_leaves"),
                    (F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("x.size"))
                    .alias("saved_tokens"), "ends_sha256").drop("size"))


def prefix_trie(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """The nodes of all conversations of ``ids`` (turnless ones are members of
    the root); ``turns`` has ``conv_id, part, pos, digest, n_bytes``."""
    spark = turns.sparkSession
    base = work_dir(spark, "prefix-trie")

    def written(frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{base}/{name}")
        return spark.read.parquet(f"{base}/{name}")

    segments = written(paths(turns, ids), "segments")
    classes = written(whole_sequences(segments), "classes")
    tails = written(_tails(classes, segments), "tails")
    entries = written(_entries(classes, tails, segments), "entries")
    top = entries.agg(F.max("depth")).first()[0]
    if top is None:
        return spark.createDataFrame([], NODE)
    levels: list[DataFrame] = []
    for depth in range(top, -1, -1):
        rows = entries.filter(F.col("depth") == depth).drop("depth")
        if levels:
            # survivors of the depth below, without their last turn
            up = levels[-1].select(
                "conv_id", "n_convs", F.lit(1).cast("long").alias("n_children"), "n_leaves",
                "saved_tokens", F.lit(None).cast("string").alias("ends_sha256"), "path", "sizes")
            if depth and depth % SEGMENT == 0:
                above = segments.filter(F.col("seg") == depth // SEGMENT - 1)
                up = up.drop("path", "sizes").join(above.select("conv_id", "path", "sizes"), "conv_id")
            rows = rows.select(*up.columns).unionByName(up)
        levels.append(written(_merged(rows, depth), f"depth-{depth:07d}"))
    peeled = [x.drop("path", "sizes") for x in levels]
    nodes = reduce(DataFrame.unionByName, [*peeled, _chain_nodes(tails)])
    parents = nodes.filter("n_children > 0").select(F.col("key").alias("parent_key"),
                                                    F.col("conv_id").alias("parent_conv_id"))
    return (nodes.join(parents, "parent_key", "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                    "saved_tokens", F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256")))


def openings_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the conversations rebuilt by ``share_openings``."""
    ids = conversation_ids(conversations)
    return prefix_trie(share_openings(numbered_turns(conversations), ids), ids)
