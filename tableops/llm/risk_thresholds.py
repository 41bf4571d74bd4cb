"""Operator 6, quality rules: risk-controlled thresholds.

Each rule rejects a document whose measure is above a cutoff.  For every
stratum (language) and rule the cutoff is the smallest candidate for which
the labelled holdout proves that the rule rejects at most ``alpha / rules`` of
the stratum's good documents (quality 1): with n good documents of which k
are above the cutoff, P(Binomial(n, alpha / rules) <= k), an exact bound, must
not exceed the chain's level.

A stratum and a rule make a chain: its candidates are tested in a fixed order,
from the loosest to the strictest, and the first that fails ends it, so they
need no correction among themselves.  Over the chains goes Holm's step-down
correction of ``delta``: each of m chains has ``delta / m``, and a chain that
is proven down to its strictest candidate leaves its level to the others.  The
union of the rules then rejects at most ``alpha`` of each stratum's good
documents, in all strata at once, with probability ``1 - delta``.  A rule
without a proven cutoff rejects nothing in that stratum; a stratum without
labels has no rules.  Very long texts are measured whole.

Candidates are fixed numbers, so no data choose them, and every labelled row
is holdout.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import work_dir

ALPHA = 0.05
DELTA = 0.05
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = b"#*$%&|<>"
# Candidate cutoffs of each rule's measure, by rule; the first is the strictest
# that a rule may take, whatever the labels allow.
CUTOFFS = {
    "symbol_share": tuple(i / 100 for i in range(5, 51, 3)),
    "dup_lines_per_100_words": tuple(range(2, 21, 2)),
    "repeat_share": tuple(i / 100 for i in range(20, 51, 3)),
    "word_length": tuple(i / 2 for i in range(14, 33, 2)),
}
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measure(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text."""
    if not text:
        return 0, 0, 0, 0, 0
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes split at \\x20 and \\x09-\\x0D, as the word pattern
    n = len(words)
    word_chars = len(text) - (len(raw) - sum(map(len, words)))
    symbols = sum(raw.count(bytes([c])) for c in SYMBOLS)
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    dup = len(lines) - len(set(lines))
    return n, word_chars, symbols, dup, _repeated(words)


def _repeated(words: list[bytes]) -> int:
    """Words in 3-word windows found twice or more in the text."""
    if len(words) < 4:
        return 0
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    if len(windows) == len(words) - 2:
        return 0
    again = np.fromiter((windows[w] > 1 for w in zip(words, words[1:], words[2:],
                                                     strict=False)), bool, len(words) - 2)
    covered = np.zeros(len(words), bool)
    for i in range(3):
        covered[i:len(words) - 2 + i] |= again
    return int(covered.sum())


def base_measures(docs: DataFrame) -> DataFrame:
    """doc_id, lang and the base measures of every whole text (null: zeros)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = np.array([measure(t.as_py()) for t in b.column(2)],
                            np.int64).reshape(-1, len(BASE))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), *(pa.array(rows[:, i]) for i in range(len(BASE)))],
                names=["doc_id", "lang", *BASE])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.col("lang").cast("string").alias("lang"), F.col("text").alias("text"))
            .mapInArrow(run, "doc_id long, lang string, "
                        + ", ".join(f"{c} long" for c in BASE)))


def base_failed() -> Column:
    return ((F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def rule_measures() -> dict[str, Column]:
    """The rules' measures; 0 for a text without words."""
    def per(num: str, den: str, scale: float = 1.0) -> Column:
        return F.when(F.col(den) > 0, F.lit(scale) * F.col(num) / F.col(den)).otherwise(0.0)
    return {
        "symbol_share": per("n_symbols", "word_chars"),
        "dup_lines_per_100_words": per("n_dup_lines", "n_words", 100.0),
        "repeat_share": per("n_repeat_words", "n_words"),
        "word_length": per("word_chars", "n_words"),
    }


def binomial_cdf(k: int, n: int, p: float) -> float:
    """P(Binomial(n, p) <= k), summed exactly from its largest terms."""
    if k >= n:
        return 1.0
    if p <= 0.0:
        return 1.0
    if p >= 1.0:
        return 0.0
    logs = (math.lgamma(n + 1) + math.log(p) * k + math.log1p(-p) * (n - k)
            - math.lgamma(k + 1) - math.lgamma(n - k + 1))
    # terms below k fall when k < n * p; above, use the other tail
    if k <= n * p:
        term, total, i = 1.0, 1.0, k
        while i > 0 and term > 1e-18 * total:
            term *= i * (1 - p) / ((n - i + 1) * p)
            total += term
            i -= 1
        return min(1.0, math.exp(logs) * total)
    term, total, i = 1.0, 0.0, k
    while i < n:
        term *= (n - i) * p / ((i + 1) * (1 - p))
        total += term
        i += 1
        if term <= 1e-18 * total:
            break
    return max(0.0, 1.0 - math.exp(logs) * total)


def select_cutoffs(measured: DataFrame, labels: DataFrame, alpha: float = ALPHA,
                   delta: float = DELTA) -> DataFrame:
    """One row per stratum: stratum_ and a cutoff (or null) per rule.

    ``measured`` holds doc_id, lang and the base measures; ``labels`` doc_id and
    quality.  Several labels of a document count once; they must all say
    good.  The holdout counts are sums per stratum, rule and candidate.
    """
    spark = measured.sparkSession
    good = (labels.select(F.col("doc_id").cast("long").alias("id_"),
                          F.col("quality").alias("quality"))
            .groupBy("id_").agg(F.min("quality").alias("q")).filter(F.col("q") == 1))
    holdout = (measured.filter(~base_failed())
               .join(good, F.col("doc_id") == F.col("id_"), "left_semi"))
    rules = list(CUTOFFS)
    # the first candidate at or above the measure: one small histogram row
    # per task, stratum, rule and step
    values = rule_measures()
    def above(rule: str) -> Column:
        """How many of the rule's candidates the measure is above."""
        value = values[rule]
        return F.size(F.filter(F.array(*map(F.lit, CUTOFFS[rule])), lambda c: value > c))

    steps = [F.struct(F.lit(i).alias("rule"), above(r).alias("above"))
             for i, r in enumerate(rules)]
    counts = (holdout.select(F.col("lang").alias("stratum_"), F.explode(F.array(*steps)).alias("s"))
              .groupBy("stratum_", "s.rule", "s.above").agg(F.count(F.lit(1)).alias("n")))
    path = work_dir(spark, "holdout")
    counts.groupBy("stratum_").applyInPandas(
        lambda pdf: p_values(pdf, alpha), "stratum_ string, rule int, p array<double>"
    ).write.parquet(path)
    chains = spark.read.parquet(path)
    level = step_down(chains.count(), delta, lambda x: chains.filter(
        F.get("p", F.lit(0)) <= x).count())
    # candidates ascend, and so the strictest that is proven is the first one
    first = F.array_position(F.transform("p", lambda p: p <= level), True).cast("int")
    cut = {r: F.max(F.when((F.col("rule") == i) & (first > 0), F.get(
        F.array(*map(F.lit, map(float, CUTOFFS[r]))), first - 1))).alias(r)
        for i, r in enumerate(rules)}
    return chains.groupBy("stratum_").agg(*cut.values())


def p_values(pdf: pd.DataFrame, alpha: float = ALPHA) -> pd.DataFrame:
    """A stratum's p-values of every rule's candidates, from its histogram."""
    out = []
    for i, r in enumerate(CUTOFFS):
        own = pdf[pdf["rule"] == i]
        total = int(own["n"].sum())
        rejected = [int(own.loc[own["above"] > j, "n"].sum()) for j in range(len(CUTOFFS[r]))]
        out.append((pdf["stratum_"].iloc[0], i, [
            binomial_cdf(k, total, alpha / len(CUTOFFS)) if total else 1.0 for k in rejected]))
    return pd.DataFrame(out, columns=["stratum_", "rule", "p"])


def step_down(chains: int, delta: float, proven: Callable[[float], int]) -> float:
    """The level of the chains that are left when those proven to their end at a
    level (``proven`` counts them) have left theirs to the others."""
    done = 0
    while True:
        level = delta / max(1, chains - done)
        more = proven(level)
        if more <= done:
            return level
        done = more


def judge(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA,
          delta: float = DELTA) -> DataFrame:
    """doc_id, the base measures, base_failed, kept of every row of ``docs``.

    Null text: all measures 0, so base_failed.  A null language is a stratum
    of its own.  Without labels only the base decides.
    """
    spark = docs.sparkSession
    path = work_dir(spark, "measures")
    base_measures(docs).write.parquet(path)
    measured = spark.read.parquet(path)
    path = work_dir(spark, "cutoffs")
    # a written table, so that its size is known when the join is planned
    select_cutoffs(measured, labels, alpha, delta).write.parquet(path)
    cutoffs = spark.read.parquet(path)
    values = rule_measures()
    rejected = F.lit(False)
    for r in CUTOFFS:
        rejected = rejected | F.coalesce(values[r] > F.col(r), F.lit(False))
    failed = base_failed()
    return (measured.join(cutoffs, F.col("lang").eqNullSafe(F.col("stratum_")), "left")
            .select("doc_id", *BASE, failed.alias("base_failed"),
                    (~failed & ~rejected).alias("kept"), F.col("lang").alias("stratum"),
                    *CUTOFFS))
