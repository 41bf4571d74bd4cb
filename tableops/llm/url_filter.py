"""Operator 1, URL filters: gradient-boosted trees on lexical features.

Everything here is DataFrame and SQL functions.  A url is split into host
and path; the longest fitting rule gives the verdict, and urls without a
rule get the verdict of boosted trees that are trained on the urls with
one (the labelled urls).

Features: lengths, depth, digit ratio, entropy of the characters, number of
parameters, and suffix statistics (the smoothed share of blocked urls among
the labelled urls with the same last host label, and with the same last two).

Training: features become bins (quantiles of the training sample); a tree
level is one aggregation of gradient and hessian sums by (node, feature,
bin), from which the driver, which sees nodes x features x bins sums only,
picks the splits.  Trees fit the logistic loss with second-order leaf
values and become CASE expressions.  The trees are fitted on about
``sample_rows`` labelled urls chosen by hash (a documented bound of the
classifier); suffix statistics and verdicts cover all urls.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import work_dir

# Rule string -> verdict.  A rule is host/path-start.
RULES = {"net/": "block", "example.net/en/": "allow",
         "example.com/de/": "block", "org/fr/": "allow"}

SAMPLE_ROWS = 20_000
TREES = 10
DEPTH = 3
BINS = 16
LEARNING_RATE = 0.4
REGULARIZATION = 1.0
MIN_HESSIAN = 1.0
# Pseudo-rows at the overall rate behind every suffix share.
SUFFIX_PRIOR = 20.0

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FEATURES = ("host_len", "path_len", "query_len", "labels", "depth", "digit_ratio",
            "entropy", "params", "hyphens", "tail_len", "suffix1", "suffix2")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; null or no ``://``: empty."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + F.lit(3)))
    return F.coalesce(F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; null or no ``://``: empty."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + F.lit(3)))
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule that fits: its host is the url's or a parent domain,
    and the url's path starts with its path.  Null if none fits."""
    out = F.lit(None).cast("string")
    # shortest first, so that the longest is asked first
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        domain, slash, rest = rule.partition("/")
        fits = (((host == domain) | F.endswith(host, F.lit("." + domain)))
                & F.startswith(path, F.lit(slash + rest)))
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def _entropy(text: Column) -> Column:
    """Shannon entropy in bits of the characters, from runs of the sorted characters."""
    chars = F.array_sort(F.split(text, ""))
    n = F.length(text).cast("double")
    # (last character, its run so far, sum of run * log2(run) of closed runs)
    start = F.struct(F.lit("").alias("c"), F.lit(0.0).alias("run"), F.lit(0.0).alias("s"))

    def closed(acc: Column) -> Column:
        return acc["s"] + F.when(acc["run"] > 0, acc["run"] * F.log2(acc["run"])).otherwise(0.0)

    def step(acc: Column, c: Column) -> Column:
        same = acc["c"] == c
        return F.struct(c.alias("c"), F.when(same, acc["run"] + 1.0).otherwise(1.0).alias("run"),
                        F.when(same, acc["s"]).otherwise(closed(acc)).alias("s"))

    total = F.aggregate(chars, start, step, closed)
    return F.when(n > 0, F.log2(n) - total / n).otherwise(0.0)


def parsed(pages: DataFrame, rules: dict[str, str]) -> DataFrame:
    """page_id, url, host, path, rule, suffix keys and lexical features."""
    url = F.coalesce(F.col("url"), F.lit(""))
    cut = pages.select(F.col("page_id").alias("page_id"), F.col("url").alias("url"),
                       host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    length = F.length(url)

    def found(pattern: str) -> Column:
        return F.regexp_count(url, F.lit(pattern)).cast("double")

    return cut.select(
        "page_id", "url", "host", "path",
        rule_of(F.col("host"), F.col("path"), rules).alias("rule"),
        F.substring_index("host", ".", -1).alias("suffix1_key"),
        F.substring_index("host", ".", -2).alias("suffix2_key"),
        F.length("host").cast("double").alias("host_len"),
        F.length("path").cast("double").alias("path_len"),
        F.length(query).cast("double").alias("query_len"),
        F.regexp_count(F.col("host"), F.lit(r"[^.]+")).cast("double").alias("labels"),
        F.regexp_count(F.col("path"), F.lit(r"/[^/]+")).cast("double").alias("depth"),
        F.when(length > 0, found("[0-9]") / length).otherwise(0.0).alias("digit_ratio"),
        _entropy(url).alias("entropy"),
        F.when(query != "", F.regexp_count(query, F.lit("&")) + 1.0).otherwise(0.0).alias("params"),
        F.regexp_count(F.col("host"), F.lit("-")).cast("double").alias("hyphens"),
        F.length(F.regexp_extract("path", r"([^/]*)/*$", 1)).cast("double").alias("tail_len"))


@dataclass
class Trees:
    """Boosted trees over the features: nested (feature, threshold, low, high)
    tuples, a leaf is its value.  A url goes low if feature <= threshold."""

    base: float = 0.0
    trees: list = field(default_factory=list)

    def margin(self) -> Column:
        def expr(node) -> Column:
            if not isinstance(node, tuple):
                return F.lit(float(node))
            feature, threshold, low, high = node
            return F.when(F.col(feature) <= threshold, expr(low)).otherwise(expr(high))
        return reduce(lambda a, b: a + b, map(expr, self.trees), F.lit(float(self.base)))

    def margin_of(self, row: dict[str, float]) -> float:
        """The margin of one url (for checks)."""
        total = self.base
        for node in self.trees:
            while isinstance(node, tuple):
                feature, threshold, low, high = node
                node = low if row[feature] <= threshold else high
            total += node
        return total


def _node_of(tree: list, depth: int) -> Column:
    """Number of the node at ``depth`` that a row reaches in a growing tree.

    ``tree[d]`` maps a node number at depth d to its split (feature, threshold)."""
    node = F.lit(0)
    for d in range(depth):
        nxt = F.lit(-1)
        for k, split in tree[d].items():
            if split is not None:
                step = F.when(F.col(split[0]) <= split[1], 2 * k).otherwise(2 * k + 1)
                nxt = F.when(node == k, step).otherwise(nxt)
        node = nxt
    return node


def train(sample: DataFrame, trees: int = TREES, depth: int = DEPTH, bins: int = BINS) -> Trees:
    """Fit trees to ``sample`` (the features and ``y``, 1.0 for block).

    ``sample`` must be stored.  No row, or one class only, gives a constant.
    """
    n, positive = sample.agg(F.count(F.lit(1)), F.sum("y")).first()
    if not n or positive in (0.0, float(n)):
        return Trees(0.0 if not n else 10.0 if positive else -10.0)
    cuts_row = sample.agg(*[F.percentile_approx(f, [i / bins for i in range(1, bins)], 1000)
                            .alias(f) for f in FEATURES]).first()
    cuts = {f: sorted(set(cuts_row[f])) for f in FEATURES}
    rate = positive / n
    model = Trees(math.log(rate / (1 - rate)))
    # bin b of a feature: how many of its cuts the value is above
    bin_of = F.array(*[_above(F.col(f), cuts[f]) for f in FEATURES])
    for _ in range(trees):
        p = 1.0 / (1.0 + F.exp(-model.margin()))
        rows = sample.select(*FEATURES, bin_of.alias("bin_"), (p - F.col("y")).alias("g_"),
                             (p * (1.0 - p)).alias("h_"))
        tree: list[dict] = []
        sums: dict[tuple[int, int], tuple[float, float]] = {}
        for d in range(depth):
            got = (rows.select(_node_of(tree, d).alias("node"), "g_", "h_",
                               F.posexplode("bin_").alias("feature", "bin"))
                   .filter(F.col("node") >= 0)
                   .groupBy("node", "feature", "bin")
                   .agg(F.sum("g_").alias("g"), F.sum("h_").alias("h")).collect())
            tree.append({})
            for node in sorted({r["node"] for r in got}):
                own = [r for r in got if r["node"] == node]
                tree[d][node], low, high = _best_split(own, cuts)
                total = [sum(r[x] for r in own if r["feature"] == 0) for x in ("g", "h")]
                sums[d, node] = (total[0], total[1])
                if tree[d][node] is not None:
                    sums[d + 1, 2 * node], sums[d + 1, 2 * node + 1] = low, high

        def build(d: int, k: int):
            split = tree[d].get(k) if d < depth else None
            if split is None:
                g, h = sums.get((d, k), (0.0, 0.0))
                return -LEARNING_RATE * g / (h + REGULARIZATION)
            return (*split, build(d + 1, 2 * k), build(d + 1, 2 * k + 1))

        model.trees.append(build(0, 0))
    return model


def _above(value: Column, cuts: list[float]) -> Column:
    return reduce(lambda a, c: a + F.when(value > c, 1).otherwise(0), cuts, F.lit(0))


def _best_split(own: list, cuts: dict[str, list[float]]):
    """Best (feature, threshold) of a node with the sums of both sides."""
    best, best_gain, sides = None, 1e-9, ((0.0, 0.0), (0.0, 0.0))
    for i, f in enumerate(FEATURES):
        hist = {r["bin"]: (r["g"], r["h"]) for r in own if r["feature"] == i}
        g_all, h_all = (sum(x[k] for x in hist.values()) for k in (0, 1))
        g = h = 0.0
        for b, cut in enumerate(cuts[f]):
            g, h = g + hist.get(b, (0.0, 0.0))[0], h + hist.get(b, (0.0, 0.0))[1]
            if h < MIN_HESSIAN or h_all - h < MIN_HESSIAN:
                continue
            gain = (g * g / (h + REGULARIZATION)
                    + (g_all - g) ** 2 / (h_all - h + REGULARIZATION)
                    - g_all * g_all / (h_all + REGULARIZATION))
            if gain > best_gain:
                best, best_gain = (f, float(cut)), gain
                sides = ((g, h), (g_all - g, h_all - h))
    return best, sides[0], sides[1]


def judge(pages: DataFrame, rules: dict[str, str] = RULES,
          sample_rows: int = SAMPLE_ROWS) -> tuple[DataFrame, Trees]:
    """(page_id, host, path, rule, verdict, score; the model) for ``pages``
    (page_id, url; more columns are ignored).

    A url that is null or has no ``://`` has an empty host and path and no
    rule.  Without a rule the verdict is block where the trees' probability
    is at least one half; without any labelled url it is allow.  Repeated
    rows are judged one by one.
    """
    spark = pages.sparkSession
    cut = parsed(pages, rules)
    label = F.lit(None).cast("double")
    for rule, verdict in rules.items():
        label = F.when(F.col("rule") == rule, 1.0 if verdict == "block" else 0.0).otherwise(label)
    labelled = cut.withColumn("y", label).filter(F.col("y").isNotNull())
    n, rate = labelled.agg(F.count(F.lit(1)), F.avg("y")).first()
    rate = 0.5 if rate is None else rate

    def suffixes(key: str, name: str) -> DataFrame:
        """Smoothed share of blocked urls by suffix, as a written table whose
        size the planner knows: broadcast if small, else joined by key."""
        path = work_dir(spark, "suffix")
        (labelled.groupBy(F.col(key).alias(name + "_"))
         .agg(((F.sum("y") + SUFFIX_PRIOR * rate) / (F.count(F.lit(1)) + SUFFIX_PRIOR))
              .alias(name)).write.parquet(path))
        return spark.read.parquet(path)

    for key in ("suffix1", "suffix2"):
        table = suffixes(key + "_key", key)
        cut = (cut.join(table, F.col(key + "_key") == F.col(key + "_"), "left")
               .withColumn(key, F.coalesce(F.col(key), F.lit(float(rate)))))
    share = min(1.0, sample_rows / max(1, n))
    path = work_dir(spark, "url-sample")
    (cut.withColumn("y", label)
     .filter(F.col("y").isNotNull()
             & (F.pmod(F.xxhash64("url"), F.lit(1 << 30)) < int(share * (1 << 30))))
     .select(*FEATURES, "y").write.parquet(path))
    model = train(spark.read.parquet(path))
    probability = 1.0 / (1.0 + F.exp(-model.margin()))
    verdict = F.when(probability >= 0.5, "block").otherwise("allow")
    if not n:
        verdict = F.lit("allow")
    for rule, own in rules.items():
        verdict = F.when(F.col("rule") == rule, own).otherwise(verdict)
    return cut.select("page_id", "host", "path", "rule", verdict.alias("verdict"),
                      probability.alias("score")), model
