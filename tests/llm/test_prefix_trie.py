import hashlib
import random
import zlib

from tableops.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, key string, path string, depth int"


def key_of_row(r):
    return (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")


def rebuilt(rows):
    own = {}
    for r in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], key_of_row(r))):
        own.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        # remainders have the sign of the id, as in SQL
        out[c] = own.get(c - int(c % 5 if c >= 0 else -(-c % 5)), [])[:h] + turns[h:]
    return out


def slow_trie(convs):
    members, ends = {}, {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    sums = {}
    for p in sorted(members, key=len, reverse=True):
        own = (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
        below = [sums[x] for x in children.get(p, [])]
        sums[p] = (sum(b[0] for b in below) or 1, own + sum(b[1] for b in below))
    return sorted(
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children.get(p, [])), *sums[p],
         hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest())
        for p, m in members.items())


def check(spark, rows):
    df = spark.createDataFrame([(*r, "k", "p", 1) for r in rows], SCHEMA).repartition(3)
    got = sorted(map(tuple, prefix_trie.openings_trie(df).collect()))
    assert got == slow_trie(rebuilt(rows))
    return got


def test_trie_matches_brute_force(spark):
    rng = random.Random(11)
    rows = []
    for c in range(-12, 90):
        for t in range(rng.choice([1, 2, 3, 5, 8, 9, 11])):
            rows.append((c, t, rng.choice(["user", "assistant", None]), rng.choice(["a", "b", "é文", "", None])))
    # long conversations: a copy, a shorter one, one that parts late, and one alone
    long = [("user", f"turn {i}") for i in range(38)]
    for c, turns in ((1000, long), (1001, long), (1003, long[:26]), (1004, long[:20] + [("user", "x")] * 30),
                     (2001, [("a", str(i)) for i in range(25)])):
        rows += [(c, t, *x) for t, x in enumerate(turns)]
    rows += [(3000, None, "user", "first"), (3000, 1, "user", "tie b"), (3000, 1, "user", "tie a"),
             (3000, 1, "user", "tie a"), (None, 1, "user", "no conversation"), (3004, 0, None, None),
             (3007, 0, "user", "y" * 300_000)]
    got = check(spark, rows)
    assert max(r[1] for r in got) >= 50
    assert any(r[1] == 0 and r[2] is None for r in got)


def test_many_equal_conversations_and_turnless_ones(spark):
    # hot node: every id of a class is in its digest, over many pieces
    rows = [(c, t, "user", f"same {t}") for c in range(3000) for t in range(2)]
    old, prefix_trie.PIECE_IDS = prefix_trie.PIECE_IDS, 7
    try:
        got = check(spark, rows)
    finally:
        prefix_trie.PIECE_IDS = old
    assert got[0][3] == 3000
    # a conversation whose own turns all fall to an absent block opening is empty
    alone = next(c for c in range(1, 500) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 2)
    got = check(spark, [(alone, 0, "user", "x"), (alone, 1, "user", "y")])
    assert [r[:5] for r in got] == [(alone, 0, None, 1, 0)]


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert prefix_trie.openings_trie(empty).collect() == []


def test_partitions_of_uneven_sizes(spark):
    # sizes at which the parts of a union are coalesced differently
    rng = random.Random(4)
    rows = [(c, t, "user", rng.choice(["a", "b", rng.randbytes(200).hex()]))
            for c in range(4000) for t in range(rng.randint(1, 9))]
    names = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "300k", "spark.sql.autoBroadcastJoinThreshold": "1k",
             "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}
    old = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        check(spark, rows)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
