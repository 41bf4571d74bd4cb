import random
import re

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
from pyspark.sql import functions as F

from odd_rows import SCHEMA, odd_documents, sentence
from tableops.llm import positional_index
from tableops.session import work_dir

ITEMS = "item_id long, text string, items string, block string, first long"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def slow(docs, items, window=10):
    grams = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            grams.setdefault(tuple(w[i:i + window]), set()).add(item)
    sizes = {len(g) for g in grams}
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                own = grams.get(tuple(w[i:i + n]))
                if own:
                    hit.update(range(i, i + n))
                    found |= own
        out.append((doc_id, len(w), len(hit), sorted(str(x) for x in found if x is not None)))
    return sorted(out, key=str)


def passages():
    rng = random.Random(12)
    docs = [(r[0], r[1]) for r in odd_documents()]
    long = sentence(rng, 40)
    items = [(1, long), (10, sentence(rng, 25)), (2, docs[0][1][:200]), (3, "Three Words Here"),
             (4, None), (5, ""), (6, "the the the the the the the the the the the"), (None, sentence(rng, 12)),
             (3, sentence(rng, 15)), (7, "... !"), (8, "ab " * 30), (1, long), (9, "Ünïcode é文字"), (11, "A " + "w" * 70_000)]
    for i in range(40):
        w = items[rng.choice([0, 1, 2, 7, 8])][1].split()
        a = rng.randint(0, max(0, len(w) - 9))
        docs.append((200 + i, sentence(rng, rng.randint(0, 30)) + " " + " ".join(
            w[a:a + rng.choice([8, 9, 10, 11, 20])]).upper() + "; " + sentence(rng, 5)))
    docs += [(300, "the " * 50), (301, "x three--WORDS__here y"), (302, long + " " + long), (305, "w" * 70_000 + " " + "a " * 300_000 + "w" * 70_000),
             # a phrase must not go on in the next document
             (303, " ".join(long.split()[:5])), (304, " ".join(long.split()[5:]))]
    return docs, items


def run(spark, docs, items):
    d = spark.createDataFrame([(i, t, "n", "s", 0, 1, "n", 2, "p", 3, 4, "r") for i, t in docs], SCHEMA)
    t = spark.createDataFrame([(*x, "i", "b", 1) for x in items], ITEMS)
    got = positional_index.decontaminate(d, t).collect()
    return sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in got), key=str)


def test_hits_match_brute_force(spark):
    docs, items = passages()
    want = slow(docs, items)
    assert sum(w[2] > 0 for w in want) > 20
    assert run(spark, docs, items) == want


def test_small_blocks_chunks_and_groups_change_nothing(spark, monkeypatch):
    docs, items = passages()
    monkeypatch.setattr(positional_index, "CHUNK_WORDS", 60)
    # the tasks get the module by name: sizes are looked up there, so run the parts here
    rows = [positional_index._block(f"b{i}", [d[0] for d in docs[i:i + 3]], [d[1] for d in docs[i:i + 3]])
            for i in range(0, len(docs), 3)]
    monkeypatch.setattr(positional_index, "GROUP_STARTS", 2)
    items_df = spark.createDataFrame([(*x, "i", "b", 1) for x in items], ITEMS)
    chunks = list(positional_index.window_chunks(items_df))
    assert len(chunks) > 5 and all(c.sizes.sum() <= 70 for c in chunks)
    hits = {}
    for row in rows:
        block = positional_index.Block(row)
        for c in chunks:
            for phrase, start in positional_index.phrase_places(block, c.in_block(block), c.sizes):
                for p, s in zip(phrase, start, strict=True):
                    d = int(block.docs_of(np.array([s]))[0])
                    mark, found = hits.setdefault((row["block"], d), (set(), set()))
                    mark.update(range(s, s + c.sizes[p]))
                    found.update(x for x in c.items[p] if x is not None)
    got = []
    for i, (doc_id, text) in enumerate(docs):
        mark, found = hits.get((f"b{i // 3 * 3}", i % 3), ((), ()))
        got.append((doc_id, len(words(text)), len(mark), sorted(found)))
    assert sorted(got, key=str) == slow(docs, items)


def test_empty_tables(spark):
    docs, items = passages()
    assert run(spark, [], items) == []
    assert all(r[2] == 0 and r[3] == [] for r in run(spark, docs, []))
    assert run(spark, docs, [(1, "?"), (2, None)]) == slow(docs, [])


def test_blocks_are_written_and_read_a_few_at_once(spark, monkeypatch):
    monkeypatch.setattr(positional_index, "GROUP_BYTES", 1 << 20)
    # each text is a block of over a million places (4 MB)
    docs = [(i, f"w{i} " + "a " * 1_100_000) for i in range(5)]
    path = work_dir(spark, "test-index")
    positional_index.write_index(
        spark.createDataFrame(docs, "doc_id long, text string").coalesce(1), path)
    local = path.removeprefix("file://").removeprefix("file:")
    groups = [g.num_rows for f in ds.dataset(local).get_fragments() for g in f.row_groups]
    assert groups == [1] * 5
    got = (spark.read.parquet(path).coalesce(1).mapInArrow(
        lambda batches: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in batches), "n long")
        .collect())
    assert [r.n for r in got] == [1] * 5


def slow_spans(w, query, distance):
    spans = []
    for a in range(len(w)):
        for b in range(a, min(len(w), a + distance)):
            if set(query) <= set(w[a:b + 1]):
                spans.append((a, b + 1))
                break
    return sorted(s for s in spans if not any(
        o != s and o[0] >= s[0] and o[1] <= s[1] for o in spans))


def test_proximity_matches_brute_force(spark):
    rng = random.Random(3)
    docs = [(i, " ".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 60)))) for i in range(40)]
    queries = {"ab": ["a", "B"], "abc": ["a", "b", "c", "a"], "far": ["a", "h", "g", "zz"], "h": ["h"], "none": []}
    path = work_dir(spark, "test-index")
    positional_index.write_index(spark.createDataFrame(docs, "doc_id long, text string").coalesce(2), path)
    for distance in (1, 3, 7):
        got = positional_index.proximity_matches(spark, path, queries, distance).collect()
        want = {(i, n, *s) for i, t in docs for n, q in queries.items() if q
                for s in slow_spans(t.split(), [x.lower() for x in q], distance)}
        assert {(r.doc_id, r["item"], r["first"], r["last"]) for r in got} == want
        assert len(got) == len(want)
    assert positional_index.documents(spark, path).agg(F.sum("n_words")).first()[0] == sum(
        len(t.split()) for _, t in docs)
