"""op3 moves its vectors in waves: the same links whatever a wave holds."""
import numpy as np
import pytest
from test_disk_r04 import folders, left
from test_joins import joined

from tableops.llm import embedding_join
from tableops.session import land


@pytest.mark.parametrize("kind", ["float", "double"])
def test_waves_find_what_one_wave_finds(spark, monkeypatch, kind):
    rng = np.random.default_rng(6)
    base = rng.standard_normal((5, 16))
    x = np.concatenate([base[rng.integers(0, 5, 150)] + 0.13 * rng.standard_normal((150, 16)),
                        rng.standard_normal((40, 16)), np.repeat(base[:1], 5, 0)])
    x = x.astype(np.float32).astype(float)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(500, [1.0, 2.0]), (501, [2.0, 4.0])]
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
    moved = []

    def counted(df, path, **how):
        if how.get("mode") == "append":
            moved.append(path)
        return land(df, path, **how)

    monkeypatch.setattr(embedding_join, "land", counted)
    monkeypatch.setattr(embedding_join, "HOME_CHUNK", 30)
    monkeypatch.setattr(embedding_join, "BASE_CHUNK", 30)
    # small waves and, from time to time, links that are summed up
    monkeypatch.setattr(embedding_join, "WAVE_BYTES", 1000)
    monkeypatch.setattr(embedding_join, "input_bytes", lambda df: 30_000)
    before = folders(spark)
    got = {r.vec_id: tuple(r)[1:] for r in embedding_join.near_duplicates(df).collect()}
    assert left(spark, before) == ["linked-vectors"]
    assert len(moved) > 10 and len(set(moved)) < len(moved)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    close = u @ u.T >= 0.9
    np.fill_diagonal(close, False)
    pairs = [(int(a), int(b)) for a, b in zip(*np.nonzero(close), strict=True)]
    want = joined(range(len(x)), pairs)
    assert got == {**{i: (int(close[i].sum()), want[i], want[i] == i) for i in range(len(x))},
                   500: (1, 500, True), 501: (1, 500, False)}


def test_links_are_summed_up_between_waves(spark, monkeypatch):
    rng = np.random.default_rng(7)
    x = rng.standard_normal((1, 8)) + 0.01 * rng.standard_normal((120, 8))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)],
                               "vec_id long, embedding array<double>")
    monkeypatch.setattr(embedding_join, "HOME_CHUNK", 20)
    monkeypatch.setattr(embedding_join, "BASE_CHUNK", 20)
    monkeypatch.setattr(embedding_join, "WAVE_BYTES", 1000)
    sizes = iter([60_000] + [10 ** 9] * 3 + [0] * 10_000)
    monkeypatch.setattr(embedding_join, "input_bytes", lambda df: next(sizes))
    got = [tuple(r) for r in embedding_join.near_duplicates(df).orderBy("vec_id").collect()]
    assert got == [(i, 119, 0, i == 0) for i in range(120)]
