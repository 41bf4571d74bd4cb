import math

import numpy as np
import pytest

from tableops.llm import feast_whitening

SCHEMA = "vec_id long, embedding array<float>, label int, x string, n int, i int"


def slow(rows, wanted=16):
    fine = [(i, v) for i, v in rows if v and all(e is not None and math.isfinite(e) for e in v)]
    x = [(i, tuple(math.floor(64 * float(np.float32(e))) + 1_000_000 for e in v)) for i, v in fine]
    fit = sorted({v for _, v in x})
    n = len(fit)
    if not n:
        return []
    s = [sum(c) for c in zip(*fit, strict=True)]
    y = np.array([[(n * e - t) / n for e, t in zip(v, s, strict=True)] for v in fit])
    cov = y.T @ y / n
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(values)[::-1][:wanted]
    order = [k for k in order if values[k] > 1e-9 * values.max()] if values.max() > 0 else []
    out = []
    for i, v in x:
        d = [n * e - t for e, t in zip(v, s, strict=True)]
        for c, k in enumerate(order):
            out.append((i, c + 1, n, sum(e * e for e in d),
                        float(np.array(d) / n @ vectors[:, k] / np.sqrt(values[k])),
                        float(values[k] / np.trace(cov))))
    return out


def compare(spark, rows):
    df = spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], SCHEMA).repartition(3)
    got = feast_whitening.whitened_embeddings(df).collect()
    want = slow(rows)
    assert sorted(r[:4] for r in got) == sorted(w[:4] for w in want)
    mine, own = {}, {}
    for r in got:
        mine.setdefault(r.component, {})[r.vec_id] = r
    for w in want:
        own.setdefault(w[1], {})[w[0]] = w
    for c, ws in own.items():
        a = np.array([mine[c][i].whitened for i in ws])
        b = np.array([w[4] for w in ws.values()])
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-8
        assert all(abs(mine[c][i].explained / w[5] - 1) < 1e-9 for i, w in ws.items())
    assert all(r.identity_error < 1e-8 for r in got)
    return got


def random_rows(n, d, seed=1):
    rng = np.random.default_rng(seed)
    m = rng.standard_normal((n, d)) @ rng.standard_normal((d, d)) / 4
    return [(i, [float(e) for e in v]) for i, v in enumerate(m)]


def test_whitening_matches_dense_eigenvectors(spark):
    rows = random_rows(300, 24)
    rows += [(1000 + i, rows[7][1]) for i in range(500)]      # a hot copy
    rows += [(2000, None), (2001, []), (2002, [1.0] * 23 + [None]), (2003, [float("nan")] * 24),
             (2004, [float("inf")] + [0.0] * 23), (2005, [0.0] * 24), (7, rows[7][1])]
    compare(spark, [r for r in rows if r[0] != 2005] + [rows[-2]])


def test_few_dimensions_few_rows_and_no_variance(spark):
    compare(spark, random_rows(40, 5))
    compare(spark, random_rows(6, 24, 3))      # rank 5
    assert compare(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])]) == []
    assert compare(spark, [(1, None)]) == []
    assert compare(spark, []) == []


def test_large_entries_keep_exact_deviations(spark):
    rows = [(i, [float(e) * 2 ** 20 for e in v]) for i, v in random_rows(50, 3, 5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = feast_whitening.whitened_embeddings(df).collect()
    want = {w[0]: w[3] for w in slow(rows)}
    assert all(r.deviation == (want[r.vec_id] if want[r.vec_id] < 1 << 63 else None) for r in got)
    other = spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0, 4.0]), (3, [1.0, 2.0, 3.0]), (4, [1e30, 0.0])],
                                  "vec_id long, embedding array<double>")
    assert {r.vec_id for r in feast_whitening.whitened_embeddings(other).collect()} == {1, 2}


@pytest.mark.parametrize("spectrum", [
    list(range(1, 41)), [5.0] * 3 + [1.0] * 37, [1e6, 1e3, 1.0] + [1e-3] * 37, [2.0] * 40, [1.0] + [0.0] * 39])
def test_feast_finds_every_eigenvalue(spectrum):
    rng = np.random.default_rng(9)
    q, _ = np.linalg.qr(rng.standard_normal((40, 40)))
    v = (q * np.array(spectrum)) @ q.T
    v = (v + v.T) / 2
    norm = float(np.abs(v).sum(axis=1).max())
    want = np.sort(np.linalg.eigvalsh(v))
    for shift in rng.uniform(-1, norm, 20):
        assert feast_whitening.eigenvalues_below(v, shift) == (want < shift).sum()
    floor = 16 * 40 * np.finfo(float).eps * norm
    bound = feast_whitening.bound_above(v, 16, floor, norm * 1.001, 1e-10 * norm)
    got = []
    for low, high, count in feast_whitening.slices(v, bound, norm * 1.001, 1e-10 * norm):
        values, vectors = feast_whitening.feast(v, low, high, count, norm)
        assert len(values) == count
        assert np.abs(v @ vectors - vectors * values).max() < 1e-11 * norm
        got += list(values)
    expected = want[want > floor][::-1][:max(16, len(got))]
    assert len(got) >= min(16, (want > floor).sum())
    assert np.allclose(sorted(got, reverse=True), expected[:len(got)], atol=1e-9 * norm)
