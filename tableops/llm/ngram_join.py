"""Operator 7, n-gram Jaccard join by several global token orders.

If sets x and y have Jaccard similarity >= t, their prefixes (the first
``n - ceil(t * n) + l`` tokens) share l tokens or more under *every* global
order of the tokens, where l is the smaller of both sets' ``shared_size``, a
tenth of the set.  Here tokens have ``ORDERS`` orders: each puts tokens that
were found frequent behind all others, and is otherwise a different
pseudo-random order.

1. Frequent tokens: tasks count their tokens; the ``FREQUENT`` most counted
   make up the orders' rear (any choice gives right results; it only keeps
   long postings out of the prefixes).
2. Repeated tokens: prefix tokens meet by token, and a bit table of fixed
   size (``BITS``) tells which may occur twice.  Documents without such a
   token in some order link with nothing and leave here.
3. Equal sets become one class.  Classes meet, token by token, the class of
   the token's postings that shares most (the leader), are verified with it,
   and verified links unite them, so a large group of near copies needs about
   as many comparisons as it has members.
4. What is left are postings whose classes are still in different
   components.  The first token that x and y share under an order has at most
   ``|x| - o`` tokens of x and ``|y| - o`` of y before it, where o is the least
   intersection of similar sets of these sizes.  So pairs of fitting sizes meet
   by tokens that stand so far in front in both; a pair stays a candidate
   if it meets under every order.  Candidates are verified on their texts.

Verification compares whole shingle sets.  No step collects a posting list,
and pairs inside a component are never made.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import bound_batches, drop_folders, land, passing_folders, shuffles_removed, work_dir
from .components import components
from .repeats import BitTable, repeated_bits
from .shingles import chunked, mix, shingle_sets, slices
from .workers import lean

# Links when PERCENT * union <= 100 * intersection.
PERCENT = 80
ORDERS = 3
FREQUENT = 100_000
# Bits of each order's table of repeated prefix tokens (2 ** BITS).
BITS = 26
# Members that a task compares with one copy of a leader's text.
LEADER_CHUNK = 1000
LEADER_ROUNDS = 2
_U = np.uint64
_SEEDS = (0x2545F4914F6CDD1D, 0x9FB21C651E98DF25, 0xD1342543DE82EF95, 0xAF251AF3B0F025B5)


def shared_size(n: int) -> int:
    """Tokens that prefixes share if the smaller set has ``n``."""
    return 1 + n // 10


def least_partner(n: int) -> int:
    """Size of the smallest set that can be similar to one of ``n``."""
    return (PERCENT * n + 99) // 100


def prefix_size(n: int) -> int:
    return min(n, n - (PERCENT * n + 99) // 100 + shared_size(n))


class Orders:
    """Sort keys of tokens under each order, given the frequent tokens."""

    def __init__(self, tokens: np.ndarray, counts: np.ndarray):
        at = np.argsort(tokens)
        self.tokens = tokens[at]
        # rarer frequent tokens stand before more frequent ones
        self.rank = np.minimum(np.log2(np.maximum(counts[at], 1)), 63).astype(np.uint64)
        self.table = np.zeros(1 << 20, bool)
        self.table[(self.tokens >> _U(44)).astype(np.int64)] = True

    def prefix(self, tokens: np.ndarray, order: int) -> np.ndarray:
        """The prefix of a set of tokens, in the order."""
        key = mix(tokens ^ _U(_SEEDS[order])) >> _U(1)
        maybe = np.flatnonzero(self.table[(tokens >> _U(44)).astype(np.int64)])
        if len(maybe) and len(self.tokens):
            at = np.minimum(np.searchsorted(self.tokens, tokens[maybe]), len(self.tokens) - 1)
            hit = self.tokens[at] == tokens[maybe]
            rows = maybe[hit]
            key[rows] = (_U(1) << _U(63)) | (self.rank[at[hit]] << _U(57)) | (key[rows] >> _U(7))
        size = prefix_size(len(tokens))
        front = np.argpartition(key, size - 1)[:size] if size < len(tokens) else np.arange(size)
        # in their order; equal keys by token, as in every other set
        return tokens[front[np.lexsort((tokens[front], key[front]))]]


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sorted sets of hashes have the similarity."""
    if not len(x) or not len(y) or PERCENT * max(len(x), len(y)) > 100 * min(len(x), len(y)):
        return False
    both = np.concatenate([x, y])
    both.sort()
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= PERCENT * (len(x) + len(y) - shared)


def counted(tokens: np.ndarray, counts: np.ndarray, new: np.ndarray, least: int
            ) -> tuple[np.ndarray, np.ndarray]:
    """Counts of sorted distinct ``tokens`` with those of sorted ``new`` ones added:
    what is counted ``least`` times or more (at least twice).  Most new tokens
    occur once; no array of their counts is made."""
    counts = counts + (np.searchsorted(new, tokens, side="right") - np.searchsorted(new, tokens))
    same = np.zeros(len(new) + 1, bool)  # as the one before
    same[1:-1] = new[1:] == new[:-1]
    first = np.flatnonzero(same[1:] & ~same[:-1])
    ends = np.flatnonzero(same[:-1] & ~same[1:]) + 1
    repeated, n = new[first], ends - first
    at = np.minimum(np.searchsorted(tokens, repeated), max(0, len(tokens) - 1))
    fresh = tokens[at] != repeated if len(tokens) else np.ones(len(repeated), bool)
    tokens, counts = np.concatenate([tokens, repeated[fresh]]), np.concatenate([counts, n[fresh]])
    keep = np.flatnonzero(counts >= least)
    keep = keep[np.argsort(tokens[keep], kind="stable")]
    return tokens[keep], counts[keep]


def _frequent(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """About the most frequent tokens: sums of what tasks found thrice or more."""

    @lean
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        fresh: list[np.ndarray] = []
        size = had = 0

        def settle(least: int):
            nonlocal tokens, counts
            new = np.concatenate([*fresh, np.zeros(0, np.uint64)])
            fresh.clear()
            new.sort()
            tokens, counts = counted(tokens, counts, new, least)

        for b in slices(batches):
            texts = b.column(0).to_pylist()
            for i, j in chunked(texts):
                fresh.extend(shingle_sets(texts[i:j]))
                size += sum(map(len, fresh[had:]))
                had = len(fresh)
                if size > 4_000_000:
                    settle(2)
                    size = had = 0
        settle(3)
        yield pa.RecordBatch.from_pydict({"token": pa.array(tokens.astype(np.int64)),
                                          "n": pa.array(counts)})

    with shuffles_removed(docs.sparkSession):
        rows = (docs.select("text").mapInArrow(count, "token long, n long")
                .groupBy("token").agg(F.sum("n").alias("n"))
                .orderBy(F.desc("n"), "token").limit(FREQUENT).toPandas())
    return (rows["token"].to_numpy(np.int64).astype(np.uint64),
            rows["n"].to_numpy(np.int64))


def _repeated_bits(docs: DataFrame, orders: Orders) -> list[BitTable]:
    """For each order the bit table of prefix tokens that occur in two texts."""
    shared = docs.sparkSession.sparkContext.broadcast(orders)

    def tokens_of(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
        texts = batch.column(0).to_pylist()
        for i, j in chunked(texts):
            for own in shingle_sets(texts[i:j]):
                if len(own):
                    for r in range(ORDERS):
                        yield r, shared.value.prefix(own, r)

    return repeated_bits(docs.select("text"), ORDERS, BITS, tokens_of)


def _profiles(docs: DataFrame, orders: Orders, bits: list[BitTable], path: str) -> DataFrame:
    """Stored per document: id, n_shingles, set_key, by order the prefix tokens
    that may be repeated (t0, ...) and their places from 0 (p0, ...), and the text
    of documents that have enough in each order.  Of the orders after the first,
    only tokens in whose place two similar sets may share their first one."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((orders, bits))

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order_of, tables = shared.value
        for b in slices(batches):
            texts = b.column(1).to_pylist()
            sizes, keys, kept, lists = [], [], [], [[] for _ in range(2 * ORDERS)]
            for i, j in chunked(texts):
                for text, own in zip(texts[i:j], shingle_sets(texts[i:j]), strict=True):
                    found: list[np.ndarray] = []
                    whole = len(own) > 0
                    for r in range(ORDERS if whole else 0):
                        p = order_of.prefix(own, r)
                        at = np.flatnonzero(tables[r].may_repeat(p))
                        whole = len(at) >= shared_size(least_partner(len(own)))
                        if not whole:
                            break
                        if r:
                            at = at[at <= len(own) - least_partner(len(own))]
                        found += [p[at].astype(np.int64), at.astype(np.int32)]
                    sizes.append(len(own))
                    keys.append(xxhash.xxh3_128_digest(own.tobytes()) if len(own) else None)
                    kept.append(text if whole else None)
                    for r in range(2 * ORDERS):
                        lists[r].append(found[r] if whole else None)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()),
                 pa.array(kept, pa.string()),
                 *(pa.array(x, pa.list_(pa.int32() if r % 2 else pa.int64()))
                   for r, x in enumerate(lists))],
                names=["id", "n", "set_key", "text",
                       *(f"{c}{r}" for r in range(ORDERS) for c in "tp")])

    return land(docs.mapInArrow(
        run, "id long, n long, set_key binary, text string, "
        + ", ".join(f"t{r} array<long>, p{r} array<int>" for r in range(ORDERS))), path)


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (a, b) whose texts are similar; each b is a leader of several a.

    A leader's text goes once to each chunk of its members; a task reads
    the leader, then streams the members."""
    spark = pairs.sparkSession
    own = work_dir(spark, "pairs"), work_dir(spark, "leaders")
    pairs = land(pairs, own[0])
    chunks = pairs.groupBy(F.col("b").alias("lead")).agg(
        F.ceil(F.count(F.lit(1)) / LEADER_CHUNK).cast("int").alias("chunks"))
    chunks = land(chunks, own[1])
    salt = F.pmod(F.xxhash64("a"), F.col("chunks")).cast("int")
    members = (pairs.join(chunks, F.col("b") == F.col("lead"))
               .select("a", "b", salt.alias("salt"))
               .join(texts, F.col("a") == F.col("id")).select("b", "salt", "a", "text"))
    leaders = (chunks.join(texts, F.col("lead") == F.col("id"))
               .select(F.col("lead").alias("b"),
                       F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("salt"),
                       F.lit(None).cast("long").alias("a"), "text"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lead: tuple | None = None
        chief = np.zeros(0, np.uint64)
        for batch in slices(batches):
            b, salt, a = (batch.column(i).to_pylist() for i in range(3))
            texts_ = batch.column(3).to_pylist()
            out_a, out_b = [], []
            for i, j in chunked(texts_):
                for k, own in zip(range(i, j), shingle_sets(texts_[i:j]), strict=True):
                    if a[k] is None:
                        lead, chief = (b[k], salt[k]), own
                    elif lead == (b[k], salt[k]) and similar(own, chief):
                        out_a.append(a[k])
                        out_b.append(b[k])
            yield pa.RecordBatch.from_pydict({"a": pa.array(out_a, pa.int64()),
                                              "b": pa.array(out_b, pa.int64())})

    verified = land(leaders.unionByName(members).repartition("b", "salt")
                    .sortWithinPartitions("b", "salt", F.col("a").asc_nulls_first())
                    .mapInArrow(compare, "a long, b long"), work_dir(spark, "verified"))
    drop_folders(spark, *own)
    return verified


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, n_shingles, component_id, one row per row.

    A null or empty text, or one without words, has the empty set and links
    with nothing; a null doc_id gives a null component.  Repeated rows
    link; rows of one doc_id with different texts share their links.  Very
    long texts are compared whole.  Extra columns are ignored.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").alias("text"))
    path = work_dir(spark, "grouped")
    with passing_folders(spark):
        return land(_grouped(docs), path)


def _grouped(docs: DataFrame) -> DataFrame:
    """``near_duplicates`` of (id, text), from work folders."""
    spark = docs.sparkSession
    orders = Orders(*_frequent(docs))
    bits = _repeated_bits(docs, orders)
    profiles = work_dir(spark, "profiles")
    rows = _profiles(docs, orders, bits, profiles)

    lists = [f"{c}{r}" for r in range(ORDERS) for c in "tp"]
    classes = (rows.filter(F.col("text").isNotNull() & F.col("id").isNotNull())
               .groupBy("set_key").agg(F.min(F.struct("id", "n", "text", *lists)).alias("x")))
    classes = land(classes.select("x.*"), work_dir(spark, "classes"))
    rows = land(rows.select("id", "n", "set_key"), work_dir(spark, "sets"))
    drop_folders(spark, profiles)  # its texts stand in the classes now
    texts = classes.select("id", "text")

    def postings(order: int, path: str) -> DataFrame:
        """(token, pos, id, n) of tokens that at least two classes have."""
        p = classes.select(F.explode(F.arrays_zip(
            F.col(f"t{order}").alias("token"), F.col(f"p{order}").alias("pos"))).alias("x"),
            "id", "n").select("x.token", "x.pos", "id", "n")
        twice = (p.groupBy(F.col("token").alias("tk")).agg(F.count(F.lit(1)).alias("df"))
                 .filter("df > 1"))
        return land(p.join(twice, F.col("token") == F.col("tk"))
                    .select("token", "pos", "id", "n"), path)

    posted = [work_dir(spark, "postings") for _ in range(ORDERS)]
    first = postings(0, posted[0])
    score = first.groupBy(F.col("id").alias("sid")).agg(F.count(F.lit(1)).alias("score"))
    must = 1 + F.floor(F.floor((PERCENT * F.col("n") + 99) / 100) / 10)
    scored = land(first.join(score, F.col("id") == F.col("sid")).filter(F.col("score") >= must)
                  .select("token", "pos", "id", "n", "score"), work_dir(spark, "scored"))
    drop_folders(spark, posted[0])

    def fits(a: str, b: str):
        return ((PERCENT * F.col(a) <= 100 * F.col(b)) & (PERCENT * F.col(b) <= 100 * F.col(a)))

    links: list[DataFrame] = []
    groups = None
    for turn in range(LEADER_ROUNDS):
        now = scored
        if groups is not None:
            now = now.join(groups, "id", "left").withColumn("part", F.coalesce("part", "id"))
        else:
            now = now.withColumn("part", F.col("id"))
        # the class that shares most leads first; then a seeded choice
        rank = F.col("score") if not turn else F.xxhash64("id", F.lit(turn))
        lead = now.groupBy(F.col("token").alias("tk")).agg(
            F.max(F.struct(rank.alias("rank"), "id", "n", "part")).alias("l"))
        asked = (now.join(lead, F.col("token") == F.col("tk"))
                 .filter((F.col("part") != F.col("l.part"))).withColumn("ln", F.col("l.n"))
                 .filter(fits("n", "ln"))
                 .groupBy(F.col("id").alias("a"), F.col("l.id").alias("b"))
                 .agg(F.count(F.lit(1)).alias("c"))
                 .withColumn("r", F.row_number().over(
                     Window.partitionBy("a").orderBy(F.desc("c"), "b")))
                 # one question a round; the last step asks for all pairs left
                 .filter("r = 1").select("a", "b"))
        links.append(_verified(asked, texts))
        groups = _labels(links) if turn + 1 < LEADER_ROUNDS else _parts(links)

    def in_front(pos: str, n: str, least: Column) -> Column:
        return F.col(pos) <= F.col(n) - least

    # the least intersection of similar sets: with the smallest partner, and of a pair
    alone = F.floor((PERCENT * F.col("n") + 99) / 100)
    both = F.floor((PERCENT * (F.col("n") + F.col("n2")) + 99 + PERCENT) / (100 + PERCENT))
    survivors = None
    for r in range(ORDERS):
        p = (scored if not r else postings(r, posted[r])).filter(in_front("pos", "n", alone)) \
            .join(groups, "id", "left").withColumn("part", F.coalesce("part", "id"))
        # of each token with several components, the one with most postings
        sizes = p.groupBy("token", "part").agg(F.count(F.lit(1)).alias("k"))
        mixed = (sizes.groupBy(F.col("token").alias("tk"))
                 .agg(F.max(F.struct("k", "part"))["part"].alias("big"),
                      F.count(F.lit(1)).alias("parts")).filter("parts > 1"))
        p = land(p.join(mixed, F.col("token") == F.col("tk"))
                 .select("token", "pos", "id", "n", "part", "big"), work_dir(spark, "mixed"))
        drop_folders(spark, posted[r])
        q = p.toDF("token", "pos2", "id2", "n2", "part2", "big2")
        # postings outside the large component ask all of other components, so
        # a large group of near copies meets the few others, not itself
        met = (p.filter(F.col("part") != F.col("big")).join(q, "token")
               .filter((F.col("part") != F.col("part2")) & fits("n", "n2")
                       & in_front("pos", "n", both) & in_front("pos2", "n2", both)
                       & ((F.col("part2") == F.col("big2")) | (F.col("id") < F.col("id2"))))
               .select(F.least("id", "id2").alias("a"), F.greatest("id", "id2").alias("b"))
               .distinct())
        survivors = met if survivors is None else survivors.join(met, ["a", "b"], "left_semi")
    links.append(_verified(survivors, texts))
    groups = _parts(links)

    reps = rows.filter(F.col("set_key").isNotNull()).groupBy(F.col("set_key").alias("k")).agg(
        F.min("id").alias("rep"))
    reps = (reps.join(groups, F.col("rep") == F.col("id"), "left")
            .select("k", F.coalesce("part", "rep").alias("component")))
    return (rows.select("id", "n", "set_key")
            .join(reps, F.col("set_key") == F.col("k"), "left")
            .select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
                    F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
                    .alias("component_id")))


def _union(links: list[DataFrame]) -> DataFrame:
    out = links[0]
    for more in links[1:]:
        out = out.unionByName(more)
    return out


def _labels(links: list[DataFrame]) -> DataFrame:
    """(id, part): nodes with one part are in one component; a component may
    still have several.  Two steps towards the smallest id, for stars enough."""
    low = F.least("a", "b").alias("part")
    pairs = _union(links)
    one = (pairs.select(F.col("a").alias("id"), low).unionByName(
        pairs.select(F.col("b").alias("id"), low)).groupBy("id").agg(F.min("part").alias("part")))
    one = land(one, work_dir(pairs.sparkSession, "labels"))
    return one.join(one.toDF("i", "next"), F.col("part") == F.col("i")).select(
        "id", F.col("next").alias("part"))


def _parts(links: list[DataFrame]) -> DataFrame:
    """(id, part) by the components of all links so far."""
    out = _union(links)
    got = components(out).select("id", F.col("component").alias("part"))
    return land(got, work_dir(out.sparkSession, "parts"))
