"""Operator 10, mixing sources to target weights by min-cost flow.

Documents are summed up by membership pattern (the set of sources a document
belongs to).  Word capacity flows from patterns to sources: a pattern offers
its words once at no cost, a second time at cost 1, a third time at cost 4,
and so on with the squares (``epochs`` times in all), so repetition is
spread as evenly as the quotas allow.  Each source takes up to its quota.
The flow is solved on the summed patterns, whose number is checked
(``MAX_PATTERNS``); documents never leave the executors.

A pattern that gives f words then takes every document ``f div words`` times
and the rest from documents in a seeded order (hash of seed, id, text and
source) until it is reached.  The order's running sums come from a histogram
of hash ranges, then of the finer ranges in the one where a pattern's rest
ends; only the fine range in which it ends is sorted.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import work_dir

WEIGHTS = (5.0, 2.0, 1.0)
EPOCHS = 3
SEED = 20
MAX_PATTERNS = 100_000
# Hash ranges of the seeded order, and finer ranges in one (2 ** BITS each).
BITS = 8

WORDS = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)).cast("long"), F.lit(0).cast("long"))


def capped_targets(sizes: list[int], weights: list[float], epochs: int = EPOCHS) -> list[float]:
    """Share sum(sizes) by weight; no share above ``epochs`` times its size,
    the excess reshared by weight among the others."""
    total, n = float(sum(sizes)), len(sizes)
    # the share per weight rises until a source is full: fill the sources
    # in the order in which that happens
    order = sorted(range(n), key=lambda i: (epochs * sizes[i] / weights[i], i))
    left, weight, out = total, sum(weights), [0.0] * n
    for i in order:
        share = left * weights[i] / weight if weight > 0 else 0.0
        out[i] = min(share, float(epochs * sizes[i]))
        left -= out[i]
        weight -= weights[i]
    return out


def min_cost_flow(supply: list[int], member: list[list[int]], quota: list[int],
                  epochs: int = EPOCHS) -> list[dict[int, int]]:
    """Words each pattern gives to each of its sources.

    ``supply[p]`` words can be given ``epochs`` times, the k-th time (from 0)
    at cost k * k a word; source s takes at most ``quota[s]``.  Successive
    cheapest paths: as path costs never fall, words are sent at one cost
    level after the other, each level by augmenting paths that may move
    earlier words of a pattern from one source to another.
    """
    flow: list[dict[int, int]] = [dict.fromkeys(m, 0) for m in member]
    users: list[list[int]] = [[] for _ in quota]
    for p, sources in enumerate(member):
        for s in sources:
            users[s].append(p)
    open_quota = list(quota)
    for level in range(epochs):
        for start in range(len(supply)):
            left = supply[start]
            while left > 0:
                # breadth-first: pattern -> source -> pattern that could move
                came: dict[tuple[str, int], tuple[str, int]] = {}
                queue, end = deque([("p", start)]), None
                came["p", start] = ("", -1)
                while queue and end is None:
                    kind, i = queue.popleft()
                    if kind == "p":
                        for s in member[i]:
                            if ("s", s) not in came:
                                came["s", s] = ("p", i)
                                if open_quota[s] > 0:
                                    end = s
                                    break
                                queue.append(("s", s))
                    else:
                        for p in users[i]:
                            if flow[p][i] > 0 and ("p", p) not in came:
                                came["p", p] = ("s", i)
                                queue.append(("p", p))
                if end is None:
                    break
                path, at = [], ("s", end)
                while at[0]:
                    path.append(at)
                    at = came[at]
                path.reverse()
                amount = min(left, open_quota[end])
                for a, b in zip(path, path[1:], strict=False):
                    if a[0] == "s":  # words of b move away from source a
                        amount = min(amount, flow[b[1]][a[1]])
                for a, b in zip(path, path[1:], strict=False):
                    if a[0] == "p":
                        flow[a[1]][b[1]] += amount
                    else:
                        flow[b[1]][a[1]] -= amount
                open_quota[end] -= amount
                left -= amount
    return flow


def mix(docs: DataFrame, sources: Column, size: Column, weights=WEIGHTS, epochs: int = EPOCHS,
        seed: int = SEED, keep: tuple[str, ...] = ()) -> DataFrame:
    """Take words of ``docs`` (doc_id, text, and what ``sources`` reads).

    ``sources``: array<string> of the sources of a document, null entries
    allowed, null is the null source alone; ``size``: its words.  Sources in code-point order, null last,
    have ``weights``, repeating.  Returns one row per input row: doc_id,
    sources, size, target (sum of its sources' targets), source_size (sum of
    its sources' sizes), taken (words, a whole multiple of size up to
    ``epochs`` times) and the columns named in ``keep``.  Null or empty
    texts have size 0 and are taken 0 times.  Rows that are equal in
    doc_id, text and sources are taken alike, the rest of the order breaks
    ties by nothing else.  An empty table gives no rows.
    """
    spark = docs.sparkSession
    sources = F.coalesce(sources, F.array(F.lit(None).cast("string")))
    order = F.xxhash64(F.lit(seed), "doc_id", "text", F.to_json(F.struct(sources.alias("s"))))
    sized = docs.select(
        F.col("doc_id"), *keep, F.array_sort(F.array_distinct(sources)).alias("sources_"),
        size.alias("size_"), order.alias("hash_"))
    path = work_dir(spark, "mix-sizes")
    sized.write.parquet(path)
    sized = spark.read.parquet(path)
    patterns = (sized.groupBy("sources_").agg(F.sum("size_").alias("words"))
                .limit(MAX_PATTERNS + 1).collect())
    if len(patterns) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns")
    patterns.sort(key=lambda r: [(x is None, x or "") for x in r["sources_"]])
    names = sorted({s for r in patterns for s in r["sources_"]}, key=lambda x: (x is None, x or ""))
    at = {s: i for i, s in enumerate(names)}
    member = [[at[s] for s in r["sources_"]] for r in patterns]
    supply = [int(r["words"] or 0) for r in patterns]
    # a shared document's words count in each of its sources
    sizes = [sum(w for w, m in zip(supply, member, strict=True) if i in m)
             for i in range(len(names))]
    targets = capped_targets(sizes, [weights[i % len(weights)] for i in range(len(names))], epochs)
    flow = min_cost_flow(supply, member, [round(t) for t in targets], epochs)

    rows = []
    for r, words, given, m in zip(patterns, supply, flow, member, strict=True):
        whole, rest = divmod(sum(given.values()), words) if words else (0, 0)
        rows.append((r["sources_"], whole, rest, float(sum(targets[i] for i in m)),
                     sum(sizes[i] for i in m)))
    plan = spark.createDataFrame(
        rows, "p_ array<string>, whole long, rest long, target double, source_size long")
    # at most MAX_PATTERNS rows: a checked bound
    doc = sized.join(F.broadcast(plan), F.col("sources_").eqNullSafe(F.col("p_"))).drop("p_")

    # (first, last) documents of the order up to where the rest ends: whole
    # ranges before it, then the finer ranges of the range in which it ends
    inside, taken = F.lit(True), F.lit(False)
    doc = doc.withColumn("last_before", F.lit(0).cast("long"))
    for k in (1, 2, 3):
        span = F.shiftrightunsigned(F.col("hash_"), 64 - k * BITS)
        ranges = (doc.filter(inside).groupBy("sources_", "rest", "last_before", span.alias("span_"))
                  .agg(F.sum("size_").alias("words")))
        before = Window.partitionBy("sources_").orderBy("span_").rowsBetween(
            Window.unboundedPreceding, -1)
        ranges = (ranges.withColumn("before", F.col("last_before")
                                    + F.coalesce(F.sum("words").over(before), F.lit(0)))
                  # the range in which the rest ends: one row per pattern
                  .filter((F.col("before") < F.col("rest"))
                          & (F.col("before") + F.col("words") >= F.col("rest")))
                  .select(F.col("sources_").alias("q_"), F.col("span_").alias(f"span{k}"),
                          F.col("before").alias("b_")))
        doc = (doc.join(F.broadcast(ranges), F.col("sources_").eqNullSafe(F.col("q_")), "left")
               .withColumn("last_before", F.coalesce("b_", "last_before")).drop("q_", "b_"))
        here = F.col(f"span{k}").isNotNull()
        taken = taken | (inside & here & (span < F.col(f"span{k}")))
        inside = inside & here & (span == F.col(f"span{k}"))
    within = Window.partitionBy("sources_").orderBy("hash_").rowsBetween(
        Window.unboundedPreceding, -1)
    edge = (doc.filter(inside)
            .withColumn("sum_", F.col("last_before") + F.coalesce(
                F.sum("size_").over(within), F.lit(0)))
            # whole documents: the last one if that comes nearer to the rest
            .withColumn("more", 2 * (F.col("rest") - F.col("sum_")) > F.col("size_"))
            .drop("sum_"))
    rest = doc.filter(~inside).withColumn("more", taken)
    return (edge.unionByName(rest)
            .select("doc_id", *keep, F.col("sources_").alias("sources"),
                    F.col("size_").alias("size"), "source_size", "target",
                    ((F.col("whole") + F.when((F.col("whole") < epochs) & F.col("more"), 1)
                      .otherwise(0)) * F.col("size_")).alias("taken")))
