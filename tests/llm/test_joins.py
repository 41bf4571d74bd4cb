import hashlib
import random
import re
import tracemalloc

import numpy as np

from odd_rows import SCHEMA, odd_documents, sentence
from tableops import session
from tableops.llm import bwt_dedup, embedding_join, ngram_join, shingles, workers
from tableops.llm.components import components


def find(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


def joined(ids, links):
    parent = {i: i for i in ids}
    for a, b in links:
        a, b = find(parent, a), find(parent, b)
        parent[max(a, b)] = min(a, b)
    return {i: find(parent, i) for i in ids}


def test_components(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(100, 160)] + [(rng.randint(0, 60), rng.randint(0, 60))
                                                     for _ in range(35)] + [(5, 5), (None, 3)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.id: r.component for r in components(df).collect()}
    real = [x for x in links if None not in x and x[0] != x[1]]
    want = joined({i for x in real for i in x}, real)
    assert got == want
    assert components(df.limit(0)).count() == 0


def slow_set(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def test_shingle_sets_match_word_tuples():
    texts = [r[1] for r in odd_documents()]
    got = shingles.shingle_sets(texts)
    seen = {}
    for text, own in zip(texts, got, strict=True):
        want = slow_set(text)
        assert len(own) == len(want)
        assert seen.setdefault(own.tobytes(), want) == want


def test_prefixes_of_similar_sets_meet_in_every_order():
    rng = np.random.default_rng(4)
    for n in range(1, 60):
        x = rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2)
        orders = ngram_join.Orders(x[::3].copy(), np.arange(1, len(x[::3]) + 1))
        for drop in range(n // 5 + 1):
            y = np.concatenate([x[drop:], rng.integers(0, 99, n // 20, dtype=np.uint64)])
            if ngram_join.similar(np.unique(x), np.unique(y)):
                y = np.unique(y)
                least = ngram_join.shared_size(min(len(x), len(y)))
                assert least >= ngram_join.shared_size(ngram_join.least_partner(n))
                for r in range(ngram_join.ORDERS):
                    both = set(orders.prefix(x, r)) & set(orders.prefix(y, r))
                    assert len(both) >= least


def check_near_duplicates(rows, got):
    sets = [(r[0], frozenset(slow_set(r[1]))) for r in rows]
    links = [(a, b) for i, (a, x) in enumerate(sets) for b, y in sets[:i]
             if a is not None and b is not None and x and y
             and 100 * len(x & y) >= 80 * len(x | y)]
    want = joined({r[0] for r in rows if r[0] is not None}, links)
    assert len(got) == len(rows)
    for r in got:  # a row without words stays alone, whatever its doc_id's other rows do
        assert r.component_id == (want[r.doc_id] if r.doc_id is not None and r.n_shingles
                                  else r.doc_id)
    key = lambda v: [(x is not None, x or 0) for x in v]
    assert sorted(((r.doc_id, r.n_shingles) for r in got), key=key) == sorted(
        ((a, len(s)) for a, s in sets), key=key)


def test_ngram_join(spark):
    rng = random.Random(7)
    base = [sentence(rng, 80) for _ in range(4)]
    rows = [(1000 + i, " ".join(rng.choice([w] * 40 + ["new"]) for w in base[i % 4].split())
             + " " + sentence(rng, rng.randint(0, 8))) for i in range(90)]
    extra = [(r[0], r[1]) for r in odd_documents()]
    df = spark.createDataFrame(odd_documents(), SCHEMA).select("doc_id", "text", "id", "part", "n")
    more = spark.createDataFrame([(*r, 0, "p", "n") for r in rows], df.schema)
    got = ngram_join.near_duplicates(df.unionByName(more).repartition(5)).collect()
    check_near_duplicates(extra + rows, got)
    assert ngram_join.near_duplicates(df.limit(0)).count() == 0


def test_embedding_join(spark, monkeypatch):
    monkeypatch.setattr(embedding_join, "HOME_CHUNK", 16)
    monkeypatch.setattr(embedding_join, "BASE_CHUNK", 40)
    rng = np.random.default_rng(1)
    base = rng.standard_normal((6, 16))
    x = np.concatenate([base[rng.integers(0, 6, 120)] + 0.13 * rng.standard_normal((120, 16)),
                        rng.standard_normal((60, 16)), np.repeat(base[:1], 9, 0), 7 * base[:1]])
    rows = [(i, v.tolist(), "l", 0) for i, v in enumerate(x)]
    n = len(rows)
    bad = [None, [], [0.0] * 16, [None] * 16, [float("nan")] + [1.0] * 15,
           [float("inf")] + [1.0] * 15, [1.0, 2.0]]
    rows += [(n + i, v, "l", 0) for i, v in enumerate(bad)] + [(None, base[0].tolist(), "l", 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, key string, id long")
    got = {r.vec_id: r for r in embedding_join.near_duplicates(df.repartition(4)).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    close = u @ u.T >= 0.9
    np.fill_diagonal(close, False)
    want = joined(range(n), [(int(a), int(b)) for a, b in zip(*np.nonzero(close), strict=True)])
    assert close.sum() > 1000
    for i in range(n):
        assert tuple(got[i]) == (i, int(close[i].sum()), want[i], want[i] == i)
    for i in range(n, n + len(bad)):
        assert tuple(got[i]) == (i, 0, i, True)
    assert got[None].n_links == 0 and got[None].component_id is None
    assert embedding_join.near_duplicates(df.limit(0)).count() == 0


def random_bytes(rng, n, letters="abcd"):
    return "".join(rng.choice(letters) for _ in range(n)).encode()


def test_matching_statistics():
    rng = random.Random(1)
    base = random_bytes(rng, 300)
    parts = [base[i:i + rng.randint(10, 90)] for i in (rng.randint(0, 250) for _ in range(30))]
    parts += [random_bytes(rng, 40, "ab") for _ in range(10)]
    index = bwt_dedup.RunLengthIndex(parts, length=20)
    queries = [base[10:90] + b"zz" + base[:20], b"zzz", b"", random_bytes(rng, 70, "ab"), parts[3]]
    size, where, offset = index.matching_statistics(queries)
    text = index.text.tobytes()
    for o, q in zip(offset.tolist(), queries, strict=True):
        for i in range(len(q)):
            best = max(n for n in range(len(q) - i + 1) if q[i:i + n] in text)
            assert min(best, 40) == min(size[o + i], 40)
            assert text[where[o + i]:where[o + i] + min(best, 40)] == q[i:i + min(best, 40)]


def test_older_docs():
    rng = random.Random(3)
    base = random_bytes(rng, 400)
    parts = [base[i:i + rng.randint(50, 80)] for i in (rng.randint(0, 300) for _ in range(60))]
    docs = np.array([rng.randint(0, 9) for _ in parts])
    first = {}
    for p, d in zip(parts, docs.tolist(), strict=True):
        for i in range(len(p) - 49):
            first[p[i:i + 50]] = min(first.get(p[i:i + 50], 99), d)
    for p, low in zip(parts, bwt_dedup.older_docs(parts, docs), strict=True):
        assert low.tolist() == [first[p[i:i + 50]] for i in range(len(p) - 49)]


def test_an_index_takes_few_sorts(monkeypatch):
    """op9: each doubling from eight bytes on was a sort of all suffixes."""
    rng, sorts = random.Random(4), []
    real = bwt_dedup._ranks
    monkeypatch.setattr(bwt_dedup, "_ranks", lambda keys: sorts.append(len(keys)) or real(keys))
    for letters in ("ab", "".join(map(chr, range(32, 127))), "".join(map(chr, range(32, 700)))):
        sorts.clear()
        parts = ["".join(rng.choice(letters) for _ in range(rng.randint(50, 80))).encode()[:80]
                 for _ in range(40)]
        parts += [parts[3], parts[5][:60], parts[7][10:]]
        index = bwt_dedup.RunLengthIndex(parts)
        assert len(sorts) <= 3
        text = index.text.tobytes()
        ends = np.append(index.starts[1:], index.n)
        suffixes = [text[i:ends[np.searchsorted(index.starts, i, side="right") - 1]]
                    for i in range(index.n)]
        heads = [suffixes[i][:50] for i in range(index.n)]
        order = {x: i for i, x in enumerate(sorted(set(heads)))}
        assert index.agree.tolist() == [order[x] for x in heads]
        sa = sorted(range(index.n), key=lambda i: (suffixes[i], i))
        assert (index.head_sa == np.array(sa)[index.run_start]).all()
        assert (index.run_of[index.run_end] == np.arange(len(index.run_end))).all()


def test_ranges_and_changes_of_many_documents_at_once():
    """op9: ranges were merged and answers cut document by document in Python."""
    rng = random.Random(6)
    doc, a, z = np.array([(d, x, x + rng.randint(1, 9)) for d in (0, 2, 3) for x in
                          rng.sample(range(60), 12)], np.int64).T
    mix = np.random.default_rng(1).permutation(len(doc))
    want = []
    for d in (0, 2, 3):
        gone = np.zeros(80, bool)
        for x, y in zip(a[doc == d], z[doc == d], strict=True):
            gone[x:y] = True
        want += [(d, x, y + 1) for x, y in zip(*bwt_dedup.runs(gone), strict=True)]
    got = bwt_dedup.merged(doc[mix], a[mix], z[mix])
    assert list(zip(*(x.tolist() for x in got), strict=True)) == want
    none = np.zeros(0, np.int64)
    assert all(len(x) == 0 for x in bwt_dedup.merged(none, none, none))
    older = [np.array([rng.randint(3, 5) for _ in range(rng.randint(1, 9))]) for _ in range(40)]
    last = np.array([rng.randint(2, 6) for _ in older])
    hit, turn, oldest, ends = bwt_dedup.changes(older, last)
    assert hit.tolist() == [i for i, x in enumerate(older) if x.min() < last[i]]
    for k, i in enumerate(hit.tolist()):
        x = older[i]
        at = [0, *(j for j in range(1, len(x)) if x[j] != x[j - 1])]
        assert turn[ends[k] + k:ends[k + 1] + k + 1].tolist() == [*at, len(x)]
        assert oldest[ends[k]:ends[k + 1]].tolist() == x[at].tolist()
    assert len(bwt_dedup.changes(older, np.full(40, 2))[0]) == 0


def check_dedup(rows, got):
    first = {}
    for doc, text in rows:
        raw = (text or "").encode()
        for i in range(len(raw) - 49 if doc is not None else 0):
            s = raw[i:i + 50]
            first[s] = min(first.get(s, doc), doc)
    want = []
    for doc, text in rows:
        raw = (text or "").encode()
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - 49 if doc is not None else 0):
            if first[raw[i:i + 50]] < doc:
                gone[i:i + 50] = True
        spans = len(re.findall("1+", "".join("01"[int(g)] for g in gone)))
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        want.append((doc, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    key = lambda v: [(x is not None, x or 0) for x in v[:4]]
    assert sorted((tuple(r)[:5] for r in got), key=key) == sorted(want, key=key)


def test_suffix_dedup(spark, monkeypatch):
    monkeypatch.setattr(bwt_dedup, "SHARD_CONTEXTS", 50)
    rows = [(r[0], r[1]) for r in odd_documents()]
    df = spark.createDataFrame(odd_documents(), SCHEMA)
    got = bwt_dedup.deduplicate(df.repartition(4), keep=("lang", "source")).collect()
    check_dedup(rows, got)
    assert bwt_dedup.deduplicate(df.limit(0)).count() == 0


def test_anchors_that_agree_in_the_bits_sent(spark, monkeypatch):
    """``settle`` sees 10 bits of an anchor here, so it takes different ones for one."""
    few = np.uint64(54)

    def packed(tokens):
        return (tokens >> few).tobytes()

    def unpacked(raw):
        return np.frombuffer(raw, np.uint64) << few

    monkeypatch.setattr(bwt_dedup, "ANCHOR_BITS", 10)
    monkeypatch.setattr(bwt_dedup, "packed", lambda tokens: packed(tokens))
    monkeypatch.setattr(bwt_dedup, "unpacked", lambda raw: unpacked(raw))
    rng = random.Random(17)
    shared = [sentence(rng, 40) for _ in range(25)]
    rows = [(i, f"{sentence(rng, 9)} {shared[i % 25]} {sentence(rng, 9)}") for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    check_dedup(rows, bwt_dedup.deduplicate(df.repartition(4)).collect())


def test_hot_anchors_stay_out_of_the_index(spark, monkeypatch):
    real = bwt_dedup.older_docs

    def checked(parts, docs):
        assert len(parts) <= 60, "a hot anchor's contexts met in one shard"
        return real(parts, docs)

    monkeypatch.setattr(bwt_dedup, "older_docs", lambda parts, docs: checked(parts, docs))
    monkeypatch.setattr(bwt_dedup, "HOT_CONTEXTS", 25, raising=False)
    monkeypatch.setattr(bwt_dedup, "NAMED_CONTEXTS", 4, raising=False)
    monkeypatch.setattr(bwt_dedup, "SHARD_CONTEXTS", 20)
    rng = random.Random(23)
    rule, line = "-" * 24, sentence(rng, 14)
    # a short piece and a passage between differing texts, some of which come again
    sides = [sentence(rng, 12) for _ in range(150)]
    rows = [(i, f"{sides[i]}{rule}{sides[-1 - i]} {line} {rng.choice(sides)}{rule}"
             f"{rng.choice(sides)}" + "=" * (i % 9 * 20)) for i in range(150)]
    rows += [(7, "other " + rows[3][1][40:]), (None, rows[5][1]), (200, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    check_dedup(rows, bwt_dedup.deduplicate(df.repartition(4)).collect())


def test_cut_characters_leave_whole_ones():
    raw = "aé文b".encode()
    gone = np.array([0, 0, 1, 0, 0, 0, 0], bool)
    assert bwt_dedup.whole_characters(raw, gone) == "a文b"
    assert bwt_dedup.whole_characters(b"", np.zeros(0, bool)) == ""


def test_vectors_of_any_scale_link(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal(16)
    other = base + 0.1 * rng.standard_normal(16)
    far = rng.standard_normal(16)
    rows = [(i, [float(e) for e in v * s]) for i, (v, s) in enumerate(
        [(base, 1e200), (other, 1e-200), (base, 1.0), (far, 1e200), (other, 1e-300)])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_join.near_duplicates(df).collect()}
    assert got == {0: (3, 0), 1: (3, 0), 2: (3, 0), 3: (0, 3), 4: (3, 0)}


def test_settling_counts_takes_less_memory_than_the_tokens():
    rng = np.random.default_rng(4)

    def slow_counts(rounds):
        found = {}
        for new, least in rounds:
            for x in new.tolist():
                found[x] = found.get(x, 0) + 1
            found = {k: n for k, n in found.items() if n >= least}
        return sorted(found.items())

    for size in (0, 1, 200):
        for top in (2, 30, 5000):
            rounds = [(np.sort(rng.integers(0, top, size).astype(np.uint64)), least)
                      for least in (2, 2, 3)]
            got = np.zeros(0, np.uint64), np.zeros(0, np.int64)
            for new, least in rounds:
                got = ngram_join.counted(*got, new, least)
            assert list(zip(got[0].tolist(), got[1].tolist(), strict=True)) == slow_counts(rounds)
    new = np.sort(rng.integers(0, 1 << 62, 1_000_000).astype(np.uint64))
    tracemalloc.start()
    ngram_join.counted(np.zeros(0, np.uint64), np.zeros(0, np.int64), new, 2)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < new.nbytes


def test_a_task_of_the_dedup_needs_one_worker(spark, monkeypatch):
    frame = type(spark.range(1))
    plain, plans = frame.mapInArrow, []

    def watched(self, *args, **kw):
        plans.append(self._jdf.queryExecution().analyzed().toString())
        return plain(self, *args, **kw)

    monkeypatch.setattr(frame, "mapInArrow", watched)
    rows = [(1, "a" * 60), (2, "a" * 60), (3, "b" * 70)]
    got = bwt_dedup.deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_removed) for r in got) == [(1, 0), (2, 60), (3, 0)]
    # a step in Python on what another one gives, with no join between them
    assert plans and not [p for p in plans if "MapInArrow" in p and "Join" not in p]


def test_lean_tasks_leave_nothing():
    workers.kept("left by another", list)
    seen = []

    def run(batches):
        seen.append(dict(workers._KEPT))
        workers.kept("own", list)
        yield from batches

    assert list(workers.lean(run)(iter([1, 2]))) == [1, 2]
    assert seen == [{}] and not workers._KEPT


def test_batches_are_bounded_where_no_size_is_set(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(key)
    session.bound_batches(spark)
    assert spark.conf.get(key) == str(session.BATCH_BYTES)
    spark.conf.set(key, "7m")
    session.bound_batches(spark)
    assert spark.conf.get(key) == "7m"
    spark.conf.unset(key)
