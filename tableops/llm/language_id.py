"""Operator 4, language ID: word-first backoff.

A text's score for a language is the sum over its words of the word's log
frequency in that language.  A word the model does not know falls back to
its character n-grams, longest first: the first length of which the model
knows any n-gram gives the mean of their log frequencies, less a penalty for
each step down.  Words are runs of letters with their combining marks,
lower-cased; digits, numerals and symbols are no letters.

``fit`` learns from a bounded sample of labelled rows: about
``sample_chars`` characters of whole texts per language, chosen by a hash of
the text, so that the model's size does not grow with the corpus.  The model
keeps the ``max_words`` most frequent words of each language and the
``max_ngrams`` most frequent n-grams of each length (model parameters, not a
limit on the texts that are judged; words beyond them back off).  It is sparse: a
key has an entry per language that knows it, so its size is at most languages
times keys of one.  Spark puts the entries of a key together, the driver gets
them as Arrow columns.  ``predict`` judges every whole text, very long ones too.
"""

from __future__ import annotations

import re
from array import array
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import bound_batches, ensure_checkpoint_dir
from .shingles import slices
from .workers import lean

SAMPLE_CHARS = 8_000_000
MAX_WORDS = 40_000
MAX_NGRAMS = 20_000
MAX_LANGUAGES = 400
LENGTHS = (5, 4, 3, 2, 1)
STEP_PENALTY = 0.5
UNKNOWN = "und"
# Numbers that a worker keeps of words seen lately, and of each n-gram table's rows.
CACHE_NUMBERS = 1_000_000
# Keys that are Python objects at once while a table's hashes are taken.
HASHED_KEYS = 10_000

# Texts of Latin letters take the faster of two patterns with one meaning.
_LATIN = re.compile("[a-z\u00aa\u00b5\u00ba\u00df-\u00f6\u00f8-\u024f]+")
_BEYOND = re.compile("[^\u0000-\u024f]")
_WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")


def words_of(text: str) -> list[str]:
    low = text.lower()
    return _WORD.findall(low) if _BEYOND.search(low) else _LATIN.findall(low)


class Table:
    """Log frequencies of keys in every language: ``base`` for a language that
    does not know the key, more by log(2 n + 1) for one that has seen it n times."""

    def __init__(self, base: np.ndarray, keys: pa.Array, ends: np.ndarray, langs: np.ndarray,
                 values: np.ndarray):
        self.base, self.keys, self.ends, self.langs, self.values = base, keys, ends, langs, values
        # keys' numbers, and the rows of keys in use; of words, which a judge asks for
        # once, hashes in order (a dictionary takes some 200 bytes a key in each worker)
        self.often = True
        self.index: dict[str, int] | None = None
        self.hashes: array | None = None
        self.order: np.ndarray | None = None
        self.rows: dict[str, np.ndarray] = {}

    def __getstate__(self):
        return {**self.__dict__, "index": None, "hashes": None, "order": None, "rows": {}}

    def _find(self, key: str) -> int | None:
        """The key's number, None if no language knows it."""
        if self.often:
            if self.index is None:
                self.index = {k: i for i, k in enumerate(self.keys.to_pylist())}
            return self.index.get(key)
        if self.hashes is None:
            found = np.fromiter((hash(k) for i in range(0, len(self.keys), HASHED_KEYS)
                                 for k in self.keys.slice(i, HASHED_KEYS).to_pylist()),
                                np.int64, len(self.keys))
            self.order = np.argsort(found, kind="stable")
            self.hashes = array("q", found[self.order].tobytes())
        wanted = hash(key)
        at = bisect_left(self.hashes, wanted)
        while at < len(self.hashes) and self.hashes[at] == wanted:
            number = int(self.order[at])
            if self.keys[number].as_py() == key:
                return number
            at += 1
        return None

    def get(self, key: str) -> np.ndarray | None:
        """The key's log frequencies, None if no language knows it."""
        row = self.rows.get(key)
        if row is None:
            number = self._find(key)
            if number is None:
                return None
            a, z = self.ends.item(number), self.ends.item(number + 1)
            row = self.base.copy()
            row[self.langs[a:z]] += self.values[a:z]
            if self.often:
                if len(self.rows) * len(row) > CACHE_NUMBERS:
                    self.rows.clear()
                self.rows[key] = row
        return row

    def __getitem__(self, key: str) -> np.ndarray:
        return self.get(key)


@dataclass
class Model:
    """Log frequencies of words and, by length, of n-grams."""

    langs: list[str]
    words: Table
    ngrams: dict[int, Table]

    def word_scores(self, word: str) -> np.ndarray:
        known = self.words.get(word)
        if known is not None:
            return known
        padded = f" {word} "
        for step, n in enumerate(LENGTHS):
            table = self.ngrams[n]
            hits = [row for i in range(len(padded) - n + 1)
                    if (row := table.get(padded[i:i + n])) is not None]
            if hits:
                return sum(hits[1:], hits[0]) / len(hits) - STEP_PENALTY * (step + 1)
        return np.zeros(len(self.langs))


def count_words(text: str) -> Counter:
    return Counter(words_of(text))


def _table(rows: pa.Table, langs: list[str]) -> Table:
    """Table of the rows ``key, entries`` (language number and count)."""
    entries = rows.column("entries").combine_chunks()
    flat = entries.flatten()
    n = np.asarray(flat.field("n")).astype(float)
    lang = np.asarray(flat.field("lang"))
    ends = np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(entries)))])
    total = np.bincount(lang, weights=n, minlength=len(langs)) + 0.5 * max(1, len(rows))
    return Table(np.log(0.5 / total), rows.column("key").combine_chunks(), ends,
                 lang.astype(np.int32), np.log(2 * n + 1))


_ENTRIES = pa.schema([("size", pa.int32()), ("key", pa.string()),
                      ("entries", pa.list_(pa.struct([("lang", pa.int32()), ("n", pa.int64())])))])


def _model(langs: list[str], rows: pa.Table) -> Model:
    """Model of rows ``size`` (0 for words, else the n-gram's length), ``key, entries``."""
    tables = {k: _table(rows.filter(pc.equal(rows.column("size"), k)), langs)
              for k in (0, *LENGTHS)}
    tables[0].often = False
    return Model(langs, tables.pop(0), tables)


def build_model(langs: list[str], word_rows: list[tuple[str, str, int]],
                gram_rows: list[tuple[str, str, int]]) -> Model:
    """Model from (lang, word, n) and (lang, n-gram, n) counts."""
    found: dict[tuple[int, str], list[dict]] = {}
    for size, rows in [(lambda _: 0, word_rows), (len, gram_rows)]:
        for lang, key, n in rows:
            found.setdefault((size(key), key), []).append({"lang": langs.index(lang), "n": n})
    return _model(langs, pa.Table.from_pylist(
        [{"size": k, "key": key, "entries": own} for (k, key), own in found.items()], _ENTRIES))


def fit(docs: DataFrame, sample_chars: int = SAMPLE_CHARS, max_words: int = MAX_WORDS,
        max_ngrams: int = MAX_NGRAMS) -> Model:
    """Learn from ``docs`` (text, lang).  Rows with a null text or lang are
    left out; no labelled row at all gives a model that answers ``und``."""
    ensure_checkpoint_dir(docs.sparkSession)
    bound_batches(docs.sparkSession)
    labelled = docs.select(F.col("text").alias("text"), F.col("lang").alias("lang")).filter(
        F.col("text").isNotNull() & F.col("lang").isNotNull())
    sizes = (labelled.groupBy("lang").agg(F.sum(F.length("text")).alias("chars"))
             .orderBy(F.desc("chars"), "lang").limit(MAX_LANGUAGES + 1).collect())
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages: not language labels")
    langs = sorted(r["lang"] for r in sizes)
    if not langs:
        return build_model([], [], [])
    # a language's share of rows; the hash decides by whole text
    share = F.element_at(F.create_map(*[
        F.lit(v) for r in sizes
        for v in (r["lang"], min(1.0, sample_chars / max(1, r["chars"])))]), F.col("lang"))
    sample = labelled.filter(
        F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < share * F.lit(float(1 << 30)))

    @lean
    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, Counter] = {}
        for b in batches:
            for text, lang in zip(b.column(0), b.column(1).to_pylist(), strict=True):
                found.setdefault(lang, Counter()).update(words_of(text.as_py()))
        for lang, counter in found.items():
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([lang] * len(counter), pa.string()),
                "word": pa.array(list(counter), pa.string()),
                "n": pa.array(list(counter.values()), pa.int64())})

    counts = (sample.mapInArrow(words, "lang string, word string, n long")
              .groupBy("lang", "word").agg(F.sum("n").alias("n")))

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, Counter] = {}
        for b in batches:
            for lang, word, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
                padded, own = f" {word} ", found.setdefault(lang, Counter())
                for k in LENGTHS:
                    for i in range(len(padded) - k + 1):
                        own[padded[i:i + k]] += n
        for lang, counter in found.items():
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([lang] * len(counter), pa.string()),
                "gram": pa.array(list(counter), pa.string()),
                "n": pa.array(list(counter.values()), pa.int64())})

    counts = counts.checkpoint()
    top_words = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    words_kept = (counts.withColumn("r", F.row_number().over(top_words))
                  .filter(F.col("r") <= max_words)
                  .select("lang", F.col("word").alias("key"), "n", F.lit(0).alias("size")))
    by_size = Window.partitionBy("lang", F.length("gram")).orderBy(F.desc("n"), "gram")
    grams_kept = (counts.mapInArrow(grams, "lang string, gram string, n long")
                  .groupBy("lang", "gram").agg(F.sum("n").alias("n"))
                  .withColumn("r", F.row_number().over(by_size))
                  .filter(F.col("r") <= max_ngrams)
                  .select("lang", F.col("gram").alias("key"), "n", F.length("gram").alias("size")))
    number = F.element_at(F.create_map(*[F.lit(v) for i, x in enumerate(langs) for v in (x, i)]),
                          F.col("lang"))
    # an entry per language that has the key
    entry = F.struct(number.cast("int").alias("lang"), F.col("n").cast("long").alias("n"))
    rows = (words_kept.unionByName(grams_kept).groupBy("size", "key")
            .agg(F.array_sort(F.collect_list(entry)).alias("entries")))
    return _model(langs, rows.select("size", "key", "entries").toArrow().cast(_ENTRIES))


class Judge:
    """Scores texts with a model; remembers the scores of words seen lately."""

    def __init__(self, model: Model):
        # a word's row in a table that grows: an array a word would take four times as much
        self.model, self.seen, self.scores = model, {}, np.empty((1024, len(model.langs)))

    def __call__(self, text: str | None) -> tuple[str, float]:
        """(language, share of its posterior); ``und`` and 0.0 without a letter."""
        words = count_words(text) if text else {}
        if not words or not self.model.langs:
            return UNKNOWN, 0.0
        if len(self.seen) * len(self.model.langs) > CACHE_NUMBERS:
            self.seen.clear()
        rows = []
        for w in words:
            at = self.seen.get(w)
            if at is None:
                at = self.seen[w] = len(self.seen)
                if at == len(self.scores):
                    self.scores = np.concatenate([self.scores, np.empty_like(self.scores)])
                self.scores[at] = self.model.word_scores(w)
            rows.append(at)
        total = np.array(list(words.values()), float) @ self.scores[rows]
        best = int(total.argmax())  # ties: the first language by name
        return self.model.langs[best], 1.0 / float(np.exp(np.maximum(
            total - total[best], -700.0)).sum())


def predict(docs: DataFrame, model: Model, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, lang_pred, score of every row of ``docs`` (doc_id, text), and
    the columns of ``docs`` named in ``keep``.

    ``lang_pred`` is a learned language, or ``und`` with score 0 where the
    text is null or has no letter.  Repeated rows are judged one by one.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    # a kept text goes to the worker once
    names = ["doc_id", *dict.fromkeys(("text", *keep))]

    @lean
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decide = Judge(shared.value)
        # few rows at once: a batch of whole texts is not built a second time
        for b in slices(batches):
            got = [decide(t.as_py()) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([x[0] for x in got], pa.string()),
                 pa.array([x[1] for x in got], pa.float64()), *(b.column(c) for c in keep)],
                names=["doc_id", "lang_pred", "score", *keep])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *names[1:])
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    kept = "".join(f", {c} {kinds[c]}" for c in keep)
    return rows.mapInArrow(judge, "doc_id long, lang_pred string, score double" + kept)


def held_out():
    """Documents that are never learned from: crc32(doc_id as text) mod 3 is 1."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1,
                      F.lit(False))

