"""Benchmark decontamination by a distributed positional inverted index.

``write_index`` stores the postings of all training words: a block is the index
of about ``BLOCK_BYTES`` of text (a longer text is a block of its own) and one
row of a Parquet table: the block's distinct words in the order of their
64-bit hashes, for each word the ascending places where it stands, and the
block's documents with the place of their first word.  Places count the words
of the block, with one place left free after each document, so no phrase goes
from one document to the next.  Blocks are built where the texts are read:
nothing is shuffled, and a frequent word is spread over all blocks.

``exact_matches`` looks test phrases up.  Of each phrase, the word that is
rarest in the block gives the possible starts (its places less its offset in
the phrase); then the lists of the next rarest words, adjusted by their
offsets, thin the starts out until all words agree.  Phrases with a word that
the block does not have end at once.  ``proximity_matches`` finds the shortest
spans of at most ``distance`` words that hold all words of a query, in any order.

Words are compared as strings where a phrase's word meets the block's words.
Inside a block two words with one 64-bit hash would be taken for one: below
one in 10^7 blocks.

Test phrases go to the tasks in chunks of at most ``CHUNK_WORDS`` words, so what
is broadcast at once is bounded however large the benchmark is; there is one
pass over the index (not over the texts) per chunk.  Starts are made in groups
of ``GROUP_STARTS``, so memory follows a block (some ten bytes a byte of its text),
not the number of matches.

Odd rows: a null, empty or wordless text has no words and no hits; each row
stays a row, also where doc_ids repeat or are null; a very long text is a block
of its own (four bytes a word); test rows with equal item_id are one item, those
with a null item_id mark words but are not listed as items; empty tables give
no rows or no hits; columns other than those named are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import bound_batches, work_dir
from .shingles import mix, powers, prefix_sums

WINDOW = 10
BLOCK_BYTES = 2 << 20
# Bytes that are hashed at once, and length from which a word is hashed alone.
PIECE_BYTES = 1 << 18
# Bytes of blocks that a writer gathers before they go to the file.
GROUP_BYTES = 16 << 20
LONG_WORD = 1 << 16
CHUNK_WORDS = 1_000_000
GROUP_STARTS = 1 << 20
# Test rows encoded at once.
ITEM_ROWS = 256

_U = np.uint64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
# Words: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z.
_WORD = np.zeros(256, bool)
_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

INDEX = ("block string, doc_ids array<long>, doc_starts binary, doc_words binary, "
         "hashes binary, word_ends binary, words binary, place_ends binary, places binary")
SPANS = "block string, doc int, doc_id long, item string, first long, last long"


def words_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes of the texts, and per word its start, end and text number."""
    raws = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    data = _LOWER[np.frombuffer(b" ".join(raws) + b" ", np.uint8)]
    word = _WORD[data]
    edge = np.diff(word.view(np.int8), prepend=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    doc_ends = np.cumsum([len(r) + 1 for r in raws])
    return data, starts, ends, np.searchsorted(doc_ends, starts, side="right")


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words, made piece by piece."""
    out = np.empty(len(starts), np.uint64)
    long = ends - starts >= LONG_WORD
    if long.any():
        for i in np.flatnonzero(long):
            word = data[starts[i]:ends[i]].tobytes()
            out[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest())
        out[~long] = word_hashes(data, starts[~long], ends[~long])
        return out
    cuts = np.flatnonzero(np.diff(starts // PIECE_BYTES, prepend=-1)).tolist() + [len(starts)]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        base = int(starts[a])
        own = data[base:int(ends[b - 1])]
        first, last = starts[a:b] - base, ends[a:b] - base
        sums = prefix_sums(own.astype(np.uint64) + _U(1))
        _, down = powers(len(own) + 1)
        out[a:b] = mix((sums[last] - sums[first]) * down[first] + (last - first).astype(np.uint64))
    return out


def _gather(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The bytes of the given pieces, one after another."""
    before = np.cumsum(lengths) - lengths
    return data[np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))]


def _block(name: str, ids: list[int | None], texts: list[str | None]) -> dict:
    data, starts, ends, doc = words_of(texts)
    n_words = np.bincount(doc, minlength=len(texts))
    doc_starts = np.cumsum(n_words + 1) - (n_words + 1)
    place = np.arange(len(starts)) + doc
    hashes = word_hashes(data, starts, ends)
    order = np.argsort(hashes, kind="stable")
    sorted_ = hashes[order]
    first = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]])[:len(sorted_)])
    some = order[first]
    lengths = ends[some] - starts[some]
    return {"block": name, "doc_ids": ids,
            "doc_starts": doc_starts.astype("<i8").tobytes(),
            "doc_words": n_words.astype("<i8").tobytes(),
            "hashes": sorted_[first].astype("<u8").tobytes(),
            "word_ends": np.cumsum(lengths).astype("<i8").tobytes(),
            "words": _gather(data, starts[some], lengths).tobytes(),
            "place_ends": np.append(first[1:], len(order)).astype("<i8").tobytes()
            if len(first) else b"",
            "places": place[order].astype("<u4").tobytes()}


_INDEX_ARROW = pa.schema([("block", pa.string()), ("doc_ids", pa.list_(pa.int64())),
                          *[(n, pa.large_binary()) for n in (
                              "doc_starts", "doc_words", "hashes", "word_ends", "words",
                              "place_ends", "places")]])


def write_index(docs: DataFrame, path: str) -> None:
    """The index of all texts of ``docs`` (``doc_id, text``) as a Parquet table."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        ids: list[int | None] = []
        texts: list[str | None] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal number, size
            out = pa.RecordBatch.from_pylist(
                [_block(f"{part:06d}-{number:06d}", ids[:], texts)], schema=_INDEX_ARROW)
            number, size = number + 1, 0
            ids.clear()
            texts.clear()
            return out

        for b in batches:
            for at in range(b.num_rows):
                text = b.column(1)[at].as_py()
                ids.append(b.column(0)[at].as_py())
                texts.append(text)
                size += len(text or "") + 1
                if size >= BLOCK_BYTES:
                    yield flush()
        if ids:
            yield flush()

    bound_batches(docs.sparkSession)
    # a row is some megabytes: sizes are looked at after each row, not after a hundred
    (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
     .mapInArrow(build, INDEX).write.option("parquet.page.size.row.check.min", 1)
     .option("parquet.page.size.row.check.max", 1)
     .option("parquet.block.size", GROUP_BYTES).parquet(path))


def documents(spark: SparkSession, path: str) -> DataFrame:
    """The index's documents: ``block, doc, doc_id, n_words``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                n = len(row["doc_ids"])
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([row["block"]] * n, pa.string()),
                    "doc": pa.array(range(n), pa.int32()),
                    "doc_id": pa.array(row["doc_ids"], pa.int64()),
                    "n_words": pa.array(np.frombuffer(row["doc_words"], "<i8"), pa.int64())})

    return spark.read.parquet(path).select("block", "doc_ids", "doc_words").mapInArrow(
        rows, "block string, doc int, doc_id long, n_words long")


class Block:
    """One row of the index."""

    def __init__(self, row: dict):
        self.name, self.ids = row["block"], row["doc_ids"]
        self.doc_starts = np.frombuffer(row["doc_starts"], "<i8")
        self.hashes = np.frombuffer(row["hashes"], "<u8")
        self.word_ends = np.frombuffer(row["word_ends"], "<i8")
        self.words = row["words"]
        self.place_ends = np.frombuffer(row["place_ends"], "<i8")
        self.places = np.frombuffer(row["places"], "<u4").astype(np.int64)

    def terms(self, words: list[bytes], hashes: np.ndarray) -> np.ndarray:
        """The block's number of each word, -1 where it is not there."""
        if not len(self.hashes):
            return np.full(len(words), -1)
        at = np.searchsorted(self.hashes, hashes)
        at[at == len(self.hashes)] = 0
        out = np.where(self.hashes[at] == hashes, at, -1)
        for i in np.flatnonzero(out >= 0):
            end = int(self.word_ends[out[i]])
            if self.words[end - len(words[i]):end] != words[i] or (
                    end - len(words[i]) != (int(self.word_ends[out[i] - 1]) if out[i] else 0)):
                out[i] = -1
        return out

    def counts(self, terms: np.ndarray) -> np.ndarray:
        """Number of places of each term (0 for -1)."""
        sizes = np.append(np.diff(self.place_ends, prepend=0), 0)
        return sizes[terms]

    def firsts(self, terms: np.ndarray) -> np.ndarray:
        """Where the terms' lists begin in ``places``."""
        return np.concatenate([[0], self.place_ends])[terms]

    def docs_of(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.doc_starts, places, side="right") - 1


def _blocks(batch: pa.RecordBatch) -> Iterator[Block]:
    """The blocks of a batch of index rows, one at a time."""
    for i in range(batch.num_rows):
        yield Block({n: batch.column(n)[i].as_py() for n in batch.schema.names})


def phrase_places(block: Block, phrases: np.ndarray, sizes: np.ndarray
                  ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(phrase numbers, starts) of all exact occurrences.  ``phrases`` has the
    block's terms of each phrase in a row, ``sizes`` their number."""
    width = phrases.shape[1]
    used = np.arange(width) < sizes[:, None]
    counts = np.where(used, block.counts(phrases), np.iinfo(np.int64).max)
    alive = np.flatnonzero((counts.min(axis=1) > 0) & (sizes > 0))
    if not len(alive):
        return
    phrases, sizes, counts = phrases[alive], sizes[alive], counts[alive]
    order = np.argsort(counts, axis=1, kind="stable")  # rarest first
    rarest = counts[np.arange(len(alive)), order[:, 0]]
    # places of all lists as one ascending array: term, then place
    span = _U(1) << _U(34)
    owner = np.repeat(np.arange(len(block.place_ends)), np.diff(block.place_ends, prepend=0))
    lists = owner.astype(np.uint64) * span + block.places.astype(np.uint64)
    group = np.cumsum(rarest) // GROUP_STARTS
    cuts = np.flatnonzero(np.diff(group, prepend=-1)).tolist() + [len(alive)]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        n = rarest[a:b]
        phrase = np.repeat(np.arange(a, b), n)
        term = phrases[phrase, order[phrase, 0]]
        at = block.firsts(term) + np.arange(len(phrase)) - np.repeat(np.cumsum(n) - n, n)
        start = block.places[at] - order[phrase, 0]
        keep = start >= 0
        phrase, start = phrase[keep], start[keep]
        for step in range(1, width):
            here = step < sizes[phrase]
            offset = order[phrase, step]
            wanted = phrases[phrase, offset].astype(np.uint64) * span + (start + offset).astype(np.uint64)
            found = np.searchsorted(lists, wanted)
            found[found == len(lists)] = 0
            keep = ~here | (lists[found] == wanted)
            phrase, start = phrase[keep], start[keep]
            if not len(phrase):
                break
        if len(phrase):
            yield alive[phrase], start


class Chunk:
    """Test phrases for the tasks: the distinct words with their hashes, the
    phrases as rows of word numbers, and the items of each phrase."""

    def __init__(self, phrases: dict[tuple[bytes, ...], set[str | None]], width: int):
        numbers: dict[bytes, int] = {}
        self.table = np.zeros((len(phrases), width), np.int64)
        self.sizes = np.zeros(len(phrases), np.int64)
        self.items: list[list[str | None]] = []
        for i, (phrase, items) in enumerate(phrases.items()):
            self.table[i, :len(phrase)] = [numbers.setdefault(w, len(numbers)) for w in phrase]
            self.sizes[i] = len(phrase)
            self.items.append(sorted(items, key=lambda x: (x is None, x)))
        self.words = list(numbers)
        joined = np.frombuffer(b" ".join(self.words) + b" ", np.uint8)
        ends = np.cumsum([len(w) + 1 for w in self.words]) - 1
        starts = ends - np.array([len(w) for w in self.words])
        self.hashes = word_hashes(joined, starts, ends)

    def in_block(self, block: Block) -> np.ndarray:
        return block.terms(self.words, self.hashes)[self.table]


def item_words(items: DataFrame) -> Iterator[tuple[str | None, list[bytes]]]:
    """(item_id as text, words) of each test row, read in pieces."""
    rows = items.select(F.col("item_id").cast("string").alias("item"), "text").toLocalIterator()
    for row in rows:
        data, starts, ends, _ = words_of([row["text"]])
        raw = data.tobytes()
        yield row["item"], [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]


def window_chunks(items: DataFrame, window: int = WINDOW) -> Iterator[Chunk]:
    """Windows of all items in chunks of a bounded number of words."""
    held: dict[tuple[bytes, ...], set[str | None]] = {}
    size = 0
    for item, words in item_words(items):
        if not words:
            continue
        for i in range(max(1, len(words) - window + 1)):
            held.setdefault(tuple(words[i:i + window]), set()).add(item)
            size += window
            if size >= CHUNK_WORDS:
                yield Chunk(held, window)
                held, size = {}, 0
    if held:
        yield Chunk(held, window)


def _merged_spans(item: np.ndarray, start: np.ndarray, end: np.ndarray
                  ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of one item that touch or overlap, united."""
    order = np.lexsort((start, item))
    item, start, end = item[order], start[order], end[order]
    # ends made ascending within an item by a large step per item
    step = int(end.max()) + 2
    reach = np.maximum.accumulate(end + item * step)
    new = np.concatenate([[True], (start + item * step)[1:] > reach[:-1]])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(new)) - 1
    return item[first], start[first], reach[last] - item[last] * step


def exact_matches(spark: SparkSession, path: str, chunk: Chunk) -> DataFrame:
    """Spans of documents covered by occurrences of the chunk's phrases, united
    per item: ``block, doc, doc_id, item, first, last`` (words of the document
    from 0, ``last`` exclusive)."""
    bound_batches(spark)
    shared = spark.sparkContext.broadcast(chunk)  # at most CHUNK_WORDS words

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test = shared.value
        names = sorted({x for own in test.items for x in own if x is not None})
        number = {None: len(names), **{x: i for i, x in enumerate(names)}}
        owners = np.array([number[x] for own in test.items for x in own])
        n_owners = np.array([len(own) for own in test.items])
        first_owner = np.cumsum(n_owners) - n_owners
        for b in batches:
            for block in _blocks(b):
                for phrase, start in phrase_places(block, test.in_block(block), test.sizes):
                    n = n_owners[phrase]
                    at = np.repeat(first_owner[phrase] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                    item, start, size = owners[at], np.repeat(start, n), np.repeat(test.sizes[phrase], n)
                    item, first, last = _merged_spans(item, start, start + size)
                    doc = block.docs_of(first)
                    base = block.doc_starts[doc]
                    yield pa.RecordBatch.from_pydict({
                        "block": pa.array([block.name] * len(doc), pa.string()),
                        "doc": pa.array(doc, pa.int32()),
                        "doc_id": pa.array([block.ids[d] for d in doc], pa.int64()),
                        "item": pa.array([None if i == len(names) else names[i] for i in item],
                                         pa.string()),
                        "first": pa.array(first - base, pa.int64()),
                        "last": pa.array(last - base, pa.int64())})

    return spark.read.parquet(path).mapInArrow(search, SPANS)


def proximity_matches(spark: SparkSession, path: str, queries: dict[str, list[str]],
                      distance: int) -> DataFrame:
    """The shortest spans of at most ``distance`` words that hold every word of
    a query (a stated set of names and words), in any order, in the columns of
    ``exact_matches``.  A span is shortest if no other one lies inside it."""
    sets = {name: [_LOWER[np.frombuffer(w.encode(), np.uint8)].tobytes()
                   for w in dict.fromkeys(words)] for name, words in queries.items() if words}
    bound_batches(spark)
    shared = spark.sparkContext.broadcast(
        [(name, Chunk({tuple(dict.fromkeys(words)): {name}}, len(set(words))))
         for name, words in sets.items()])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block in _blocks(b):
                for name, test in shared.value:
                    first, last = spans_near(block, test.in_block(block)[0], distance)
                    if len(first):
                        doc = block.docs_of(first)
                        base = block.doc_starts[doc]
                        yield pa.RecordBatch.from_pydict({
                            "block": pa.array([block.name] * len(doc), pa.string()),
                            "doc": pa.array(doc, pa.int32()),
                            "doc_id": pa.array([block.ids[d] for d in doc], pa.int64()),
                            "item": pa.array([name] * len(doc), pa.string()),
                            "first": pa.array(first - base, pa.int64()),
                            "last": pa.array(last - base + 1, pa.int64())})

    return spark.read.parquet(path).mapInArrow(search, SPANS)


def spans_near(block: Block, terms: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last places of the shortest spans that hold all terms."""
    none = np.zeros(0, np.int64)
    if (terms < 0).any():
        return none, none
    counts, at = block.counts(terms), block.firsts(terms)
    lists = [block.places[a:a + n] for a, n in zip(at.tolist(), counts.tolist(), strict=True)]
    lists.sort(key=len)
    # only places near one of the rarest word's matter
    rare = lists[0]
    near = []
    for own in lists:
        left = np.searchsorted(rare, own - distance + 1)
        left[left == len(rare)] = len(rare) - 1
        near.append(own[np.abs(rare[left] - own) < distance])
    if not all(map(len, near)):
        return none, none
    ends = np.unique(np.concatenate(near))
    start = ends
    for own in near:
        i = np.searchsorted(own, ends, side="right") - 1
        start = np.where(i < 0, -1, np.minimum(start, own[np.maximum(i, 0)]))
    # ends behind which the same start comes again are not shortest
    keep = (start >= 0) & (ends - start < distance) & (block.docs_of(ends) == block.docs_of(start))
    start, ends = start[keep], ends[keep]
    new = np.concatenate([[True], start[1:] != start[:-1]])[:len(start)]
    return start[new], ends[new]


def contaminated_words(spans: DataFrame) -> DataFrame:
    """Per document with spans: ``n_hit`` words inside of any, and its ``items``."""
    order = Window.partitionBy("block", "doc").orderBy("first", "last").rowsBetween(
        Window.unboundedPreceding, -1)
    reach = F.coalesce(F.max("last").over(order), F.lit(0))
    return (spans.withColumn("new", F.greatest(F.lit(0).cast("long"),
                                               F.col("last") - F.greatest("first", reach)))
            .groupBy("block", "doc")
            .agg(F.sum("new").alias("n_hit"), F.array_sort(F.collect_set("item")).alias("items")))


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Every row of ``docs`` as ``doc_id, n_words, n_hit, items``."""
    spark = docs.sparkSession
    base = work_dir(spark, "positional-index")
    write_index(docs, f"{base}/index")
    found = 0
    for chunk in window_chunks(items, window):
        exact_matches(spark, f"{base}/index", chunk).write.parquet(f"{base}/spans-{found}")
        found += 1
    rows = documents(spark, f"{base}/index")
    no_items = F.array().cast("array<string>")
    if not found:
        return rows.select("doc_id", "n_words", F.lit(0).cast("long").alias("n_hit"),
                           no_items.alias("items"))
    spans = spark.read.schema(SPANS).parquet(*[f"{base}/spans-{i}" for i in range(found)])
    return (rows.join(contaminated_words(spans), ["block", "doc"], "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
                    F.coalesce("items", no_items).alias("items")))
