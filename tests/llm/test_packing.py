import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from odd_rows import SCHEMA, odd_documents
from tableops.llm import packing


def slow_sum_of_squares(sizes, capacity):
    gaps, out = [], []
    for size in sizes:
        def cost(g):
            counts = np.bincount([x for x in g if 0 < x < capacity], minlength=capacity)
            return int((counts ** 2).sum())
        options = []
        for b, gap in sorted(enumerate(gaps), key=lambda x: x[1]):
            if gap >= size:
                options.append((cost(gaps[:b] + [gap - size] + gaps[b + 1:]), gap, b))
        options.append((cost(gaps + [capacity - size]), capacity, len(gaps)))
        best, gap, b = min(options, key=lambda x: (x[0], x[1]))
        if b == len(gaps):
            gaps.append(capacity)
        out.append((gaps[b], best))
        gaps[b] -= size
    return out, len(gaps)


def test_sum_of_squares_rule():
    rng = np.random.default_rng(2)
    for capacity in (10, 17):
        sizes = rng.integers(1, capacity + 1, 60)
        bins, offsets = packing.sum_of_squares(sizes, capacity)
        want, n = slow_sum_of_squares(sizes.tolist(), capacity)
        assert bins.max() + 1 == n
        assert [capacity - o for o in offsets] == [gap for gap, _ in want]


def test_perfect_sizes_leave_little_waste():
    sizes = np.random.default_rng(1).integers(1, 40, 20_000)
    bins, _ = packing.sum_of_squares(sizes, 100)
    assert bins.max() + 1 <= 1.01 * sizes.sum() / 100 + 10


def check(got, rows, capacity):
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for r in rows:
        ids = np.array(tok.encode(r[1] or "", add_special_tokens=False).ids + [0], "<u4")
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at:at + capacity]
            want.append((r[0], k, at, len(part), zlib.crc32(part.tobytes())))
    key = lambda x: tuple((v is not None, v or 0) for v in x)
    assert sorted((tuple(r)[:5] for r in got), key=key) == sorted(want, key=key)
    places = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places), sum(w[3] for w in want)


def test_pack_documents(spark):
    rows = odd_documents()
    df = spark.createDataFrame(rows, SCHEMA)
    path = public_tokenizers.path("word_bpe_49k.json")
    n, total = check(packing.pack_documents(df, path).collect(), rows, 2048)
    assert n <= total / 2048 + 2
    assert packing.pack_documents(df.limit(0), path).count() == 0


def test_groups_are_merged(spark):
    pieces = [(i, 0, 0, 1 + (i * 37 % 99) ** 2 // 150, i) for i in range(3000)] + [(9, 0, 0, 100, 1)]
    df = spark.createDataFrame(
        pieces, "doc_id long, piece int, start long, length long, ids_crc32 long")
    got = packing.pack_pieces(df.checkpoint(), capacity=100, group_pieces=256).collect()
    assert len(got) == len(pieces)
    used = {}
    for r in got:
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in used.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 100
    assert len(used) <= 1.05 * sum(p[3] for p in pieces) / 100 + 5
