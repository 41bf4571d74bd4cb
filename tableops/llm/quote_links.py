"""Operator 2, chat formatting: quotation linking.

A message's lines have a quote level, the number of ``>`` at their start
(blanks between them do not count).  A passage is a run of lines of one
level without an empty line.  Normalised (blanks collapsed, lower case),
passages and their single lines are hashed.  A quoted passage links to the
earlier message of the same conversation that first said the passage in its
own words, or else most of its lines (ties: the earliest message).  A message
replies to the origin of its first linked passage of the lowest level.

Threads are found by pointer doubling over the reply links, and a thread's
messages are in order of turn, so that every message comes after the one it
replies to.  Positions come from a distributed rank.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.paging import global_rank
from ..session import ensure_checkpoint_dir, work_dir

_MARK = re.compile(r"^[ \t]*((?:>[ \t]*)+)")
_BLANKS = re.compile(r"\s+")
# A line that only announces a quotation, such as "On Monday A wrote:".
_ANNOUNCED = re.compile(r"^\s*\S.*\bwrote:\s*$", re.IGNORECASE)
# What a whole passage weighs against single lines.
PASSAGE_WEIGHT = 1 << 20


def levels(text: str) -> list[tuple[int, str]]:
    """(quote level, line without its marks) of each line."""
    out = []
    for line in text.split("\n"):
        mark = _MARK.match(line)
        out.append((mark.group(1).count(">"), line[mark.end():]) if mark else (0, line))
    return out


def normalise(text: str) -> str:
    return _BLANKS.sub(" ", text).strip().lower()


def digest(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def passages(lines: list[tuple[int, str]]) -> list[tuple[int, list[str]]]:
    """(level, normalised lines) of each run of one level."""
    out: list[tuple[int, list[str]]] = []
    open_level = None
    for level, line in lines:
        plain = normalise(line)
        if not plain:
            open_level = None
        elif level == open_level:
            out[-1][1].append(plain)
        else:
            out.append((level, [plain]))
            open_level = level
    return out


def parse(text: str | None) -> tuple[str, list[int], list[dict]]:
    """(body without quotes, hashes of own passages and lines, quoted units)."""
    lines = levels(text or "")
    body = [line for i, (level, line) in enumerate(lines) if not level and not (
        _ANNOUNCED.match(line) and any(x[0] for x in lines[i + 1:i + 2]))]
    own, quotes, k = set(), [], 0
    for level, said in passages(lines):
        whole = digest(" ".join(said))
        if not level:
            own.add(whole)
            own.update(map(digest, said))
            continue
        quotes.append({"level": level, "k": k, "hash": whole, "weight": PASSAGE_WEIGHT})
        quotes.extend({"level": level, "k": k, "hash": digest(x), "weight": 1} for x in said)
        k += 1
    return "\n".join(body).strip("\n"), sorted(own), quotes


_QUOTES = pa.list_(pa.struct([("level", pa.int32()), ("k", pa.int32()), ("hash", pa.int64()),
                              ("weight", pa.int64())]))


def link_quotes(messages: DataFrame) -> DataFrame:
    """Messages (conv_id, turn, role, text) without quotes, in reply order.

    One row per input row: conv_id, turn, role, body, n_quotes (quoted
    passages), n_linked, parent_turn, thread_turn (first message of the
    thread), depth (replies up to there), reply_index (position in the
    thread, from 0; rows with one turn share the smallest).  Null text is an
    empty body.  Rows with a null conv_id or turn link with nothing and are
    threads of their own (thread_turn is their turn).  Rows that repeat a turn
    count as one message with the words of both.  Extra columns are ignored.
    """
    spark = messages.sparkSession
    ensure_checkpoint_dir(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [parse(t.as_py()) for t in b.column(3)]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:3], pa.array([g[0] for g in got], pa.string()),
                 pa.array([g[1] for g in got], pa.list_(pa.int64())),
                 pa.array([g[2] for g in got], _QUOTES)],
                names=["conv_id", "turn", "role", "body", "own", "quotes"])

    path = work_dir(spark, "messages")
    (messages.select(F.col("conv_id").cast("long").alias("conv_id"),
                     F.col("turn").cast("long").alias("turn"),
                     F.col("role").cast("string").alias("role"), F.col("text").alias("text"))
     .mapInArrow(run, "conv_id long, turn long, role string, body string, own array<long>, "
                 "quotes array<struct<level:int,k:int,hash:long,weight:long>>")
     .write.parquet(path))
    parsed = spark.read.parquet(path)

    first = (parsed.select(F.col("conv_id").alias("c"), "turn", F.explode("own").alias("h"))
             .groupBy("c", "h").agg(F.min("turn").alias("origin")))
    quoted = (parsed.select("conv_id", "turn", F.explode("quotes").alias("q"))
              .select("conv_id", "turn", "q.*"))
    # one row per (conversation, hash) on the right: a hot passage is a
    # skewed left side, which adaptive execution splits
    found = (quoted.join(first, (F.col("conv_id") == F.col("c")) & (F.col("hash") == F.col("h")))
             .filter(F.col("origin") < F.col("turn"))
             .groupBy("conv_id", "turn", "level", "k", "origin").agg(F.sum("weight").alias("w"))
             .groupBy("conv_id", "turn", "level", "k")
             .agg(F.max(F.struct("w", (-F.col("origin")).alias("o"))).alias("best"))
             .groupBy(F.col("conv_id").alias("c"), F.col("turn").alias("t"))
             .agg(F.min(F.struct("level", "k", (-F.col("best.o")).alias("origin")))["origin"]
                  .alias("parent_turn"), F.count(F.lit(1)).alias("n_linked")))
    replies = found.select("c", "t", "parent_turn", "n_linked").checkpoint()
    roots = _roots(replies.select("c", "t", F.col("parent_turn").alias("up")))

    n_quotes = F.size(F.array_distinct(F.transform("quotes", lambda q: q["k"])))
    placed = (parsed.select("conv_id", "turn", "role", "body", n_quotes.alias("n_quotes"))
              .join(replies, (F.col("conv_id") == F.col("c")) & (F.col("turn") == F.col("t")),
                    "left").drop("c", "t")
              .join(roots, (F.col("conv_id") == F.col("c")) & (F.col("turn") == F.col("t")),
                    "left").drop("c", "t")
              .withColumn("n_linked", F.coalesce("n_linked", F.lit(0)))
              .withColumn("thread_turn", F.coalesce("root", "turn"))
              .withColumn("depth", F.coalesce("depth", F.lit(0))).drop("root"))
    path = work_dir(spark, "threads")
    placed.write.parquet(path)
    placed = spark.read.parquet(path)
    nodes = (placed.select(F.col("conv_id").alias("c"), F.col("thread_turn").alias("r"),
                           F.col("turn").alias("t")).distinct())
    ranked = global_rank(nodes, ["c", "r", "t"])
    base = ranked.groupBy(F.col("c").alias("bc"), F.col("r").alias("br")).agg(
        F.min("ranking").alias("base"))
    index = (ranked.join(base, F.col("c").eqNullSafe(F.col("bc"))
                         & F.col("r").eqNullSafe(F.col("br")))
             .select("c", "r", "t", (F.col("ranking") - F.col("base")).alias("reply_index")))
    return (placed.join(index, F.col("conv_id").eqNullSafe(F.col("c"))
                        & F.col("thread_turn").eqNullSafe(F.col("r"))
                        & F.col("turn").eqNullSafe(F.col("t")))
            .select("conv_id", "turn", "role", "body", "n_quotes", "n_linked", "parent_turn",
                    "thread_turn", "depth", "reply_index"))


def _roots(links: DataFrame) -> DataFrame:
    """(c, t, up) -> (c, t, root, depth) by pointer doubling.

    Only messages whose pointer does not stand on a thread's first message
    yet take part in a round; the longest reply chain is halved by each.
    """
    known = links.select(F.col("c").alias("nc"), F.col("t").alias("nt"))
    state = (links.select("c", "t", "up", F.lit(1).cast("long").alias("hops"))
             .join(known, (F.col("c") == F.col("nc")) & (F.col("up") == F.col("nt")), "left")
             .withColumn("open", F.col("nt").isNotNull()).drop("nc", "nt").checkpoint())
    while state.filter("open").limit(1).count():
        nxt = state.select(F.col("c").alias("nc"), F.col("t").alias("nt"),
                           F.col("up").alias("nup"), F.col("hops").alias("nhops"),
                           F.col("open").alias("nopen"))
        moved = (state.filter("open")
                 .join(nxt, (F.col("c") == F.col("nc")) & (F.col("up") == F.col("nt")))
                 .select("c", "t", F.col("nup").alias("up"),
                         (F.col("hops") + F.col("nhops")).alias("hops"),
                         F.col("nopen").alias("open")))
        state = state.filter("not open").unionByName(moved).checkpoint()
    return state.select("c", "t", F.col("up").alias("root"), F.col("hops").alias("depth"))


def quoting_messages(conversations: DataFrame) -> DataFrame:
    """`conversations` as a mail program shows them: every turn stands above
    the previous turn's lines as a quotation, and the turn before that as a
    quotation in it.  Gives rows in the operator's schema, nothing else."""
    said = conversations.groupBy("conv_id", "turn").agg(F.min("text").alias("said"))

    def back(n: int, mark: str) -> DataFrame:
        return said.select(
            F.col("conv_id").alias(f"c{n}"), (F.col("turn") + n).alias(f"t{n}"),
            F.concat(F.lit("\n" + mark), F.regexp_replace("said", "\n", "\n" + mark)).alias(f"s{n}"))

    out = conversations
    for n, mark in ((1, "> "), (2, "> > ")):
        out = out.join(back(n, mark), (F.col("conv_id") == F.col(f"c{n}"))
                       & (F.col("turn") == F.col(f"t{n}")), "left")
    return out.select("conv_id", "turn", "role", F.concat(
        F.col("text"), F.coalesce("s1", F.lit("")), F.coalesce("s2", F.lit(""))).alias("text"))
