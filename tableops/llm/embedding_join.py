"""Operator 3, embedding near-dedup: subspace pigeonhole join.

Unit vectors with cosine >= t are at a squared distance of at most 2 - 2t.
After a fixed random rotation the coordinates are split into blocks; at least
one block then has a squared distance within its proportional share of that
budget.  Each block is range-joined under its share: its leading two
coordinates form a grid whose cells are as wide as the block's radius, a
vector meets the vectors of its own and the eight cells around, and pairs
within the block's share are candidates.  The candidates' cosine is computed
exactly, in double precision; a pair counts in the first block that finds it.

Equal vectors are one class with a number of copies, so a large group of
copies is one vector here.  A cell with many vectors is cut into chunks by
hash, and each task joins one chunk of a cell's own vectors with one chunk
of the vectors around: no task holds more than about ``HOME_CHUNK`` +
``BASE_CHUNK`` vectors.  Tasks return link counts and a spanning forest of
their links, never the pairs.

A vector goes to every chunk that its own chunk meets, so the vectors that
move grow with the square of a cell.  The pairs of chunks are therefore dealt
to waves of about as many bytes as the vectors themselves have (``WAVE_BYTES``
at least), one after the other: every pair of chunks meets in one wave, and no
more than a wave lies on disk at once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import drop_folders, input_bytes, land, passing_folders, work_dir
from .components import components

THRESHOLD = 0.9
BLOCKS = 4
SEED = 3
# Equal chunks move the fewest vectors for the pairs that a task compares.
HOME_CHUNK = 16_384
BASE_CHUNK = 16_384
# Bytes of vectors (and of links found) that are moved at once, or as many as all
# vectors have; bytes of a moved row besides its vector.
WAVE_BYTES = 128 << 20
ROW_BYTES = 60
# Added to the distance budget, far above rounding of the block sums; and to a
# block's share where sums in single precision choose what is looked at.
SLACK = 1e-9
SINGLE_SLACK = 1e-4
# A cell's own vectors and those of half of the cells around: every pair of
# neighbouring cells meets in one place.
_HALF = ((0, 0), (0, 1), (1, -1), (1, 0), (1, 1))


@lru_cache(maxsize=8)
def rotation(dim: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def block_slices(dim: int) -> list[slice]:
    n = min(BLOCKS, dim)
    edges = [round(i * dim / n) for i in range(n + 1)]
    return [slice(a, b) for a, b in zip(edges, edges[1:], strict=False)]


def budgets(dim: int, threshold: float) -> np.ndarray:
    total = 2.0 - 2.0 * threshold + SLACK
    return np.array([total * (s.stop - s.start) / dim for s in block_slices(dim)])


def unit_vector(values: list | None) -> np.ndarray | None:
    """The vector in double precision, or None where it links with nothing."""
    if not values or any(v is None for v in values):
        return None
    x = np.asarray(values, np.float64)
    if not np.isfinite(x).all():
        return None
    scale = np.abs(x).max()
    if scale == 0:
        return None
    return x / scale


def cells_of(unit: np.ndarray, threshold: float) -> list[dict]:
    """Grid cell of a unit vector in each block."""
    y = unit @ rotation(len(unit))
    out = []
    for j, (s, b) in enumerate(zip(block_slices(len(unit)), budgets(len(unit), threshold),
                                   strict=True)):
        width = np.sqrt(b) * (1 + 1e-9)
        lead = np.floor(y[s][:2] / width).astype(int)
        out.append({"block": j, "cx": int(lead[0]), "cy": int(lead[1]) if len(lead) > 1 else 0})
    return out


def _near_one(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two each, so that products neither overflow nor
    vanish; cosines stay the same to the last bit."""
    _, exponent = np.frexp(np.abs(x).max(axis=1, initial=0.0))
    return np.ldexp(x, -exponent[:, None])


def _links(home: np.ndarray, base: np.ndarray, block: int, threshold: float,
           skip) -> tuple[np.ndarray, np.ndarray]:
    """Linked (home row, base row) pairs that ``block`` is the first to find.

    ``skip(i, j)`` masks pairs that another place or order stands for."""
    dim = home.shape[1]
    home, base = _near_one(home), _near_one(base)
    share, parts = budgets(dim, threshold), block_slices(dim)
    norm = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    h, b = norm(home), norm(base)
    hr, br = h @ rotation(dim), b @ rotation(dim)
    s = parts[block]
    hb, bb = hr[:, s], br[:, s]
    # squared distances of the block as one product of rows with two more columns
    one = lambda x: np.ones((len(x), 1))
    square = lambda x: (x * x).sum(1, keepdims=True)
    left_of = np.hstack([-2.0 * hb, square(hb), one(hb)]).astype(np.float32)
    right_of = np.hstack([bb, one(bb), square(bb)]).astype(np.float32).T.copy()
    most = np.float32(share[block] + SINGLE_SLACK)
    left, right = [], []
    rows = max(1, 1_000_000 // max(1, len(base)))
    for at in range(0, len(home), rows):
        near = left_of[at:at + rows] @ right_of <= most
        i, j = np.divmod(np.flatnonzero(near), max(1, len(base)))
        i += at
        keep = ~skip(i, j)
        i, j = i[keep], j[keep]
        for k in range(0, len(i), 50_000):
            a, c = i[k:k + 50_000], j[k:k + 50_000]
            # the same sums wherever a pair meets, so one block owns it
            square = (hr[a] - br[c]) ** 2
            within = np.stack([square[:, p].sum(1) for p in parts], 1) <= share
            mine = within[:, block] & ~within[:, :block].any(1)
            a, c = a[mine], c[mine]
            x, y = home[a], base[c]
            cosine = (x * y).sum(1) / np.sqrt((x * x).sum(1) * (y * y).sum(1))
            ok = cosine >= threshold
            left.append(a[ok])
            right.append(c[ok])
    none = np.zeros(0, np.int64)
    return (np.concatenate(left) if left else none), (np.concatenate(right) if right else none)


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (id, smallest id of its part) that connect what the links a-b do."""
    ids, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = flat[:len(a)], flat[len(a):]
    label = np.arange(len(ids))
    while True:
        new = label.copy()
        np.minimum.at(new, i, label[j])
        np.minimum.at(new, j, label[i])
        new = new[new]
        if (new == label).all():
            break
        label = new
    other = label != np.arange(len(ids))
    return ids[other], ids[label[other]]


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``vectors`` (vec_id, embedding) -> vec_id, n_links, component_id, kept.

    One row per input row.  Vectors that are null, empty, zero or hold null or
    non-finite values link with nothing, and neither do vectors of different
    lengths or rows with a null vec_id (whose component is null).  Rows that
    repeat a vector are copies that link with each other.
    """
    spark = vectors.sparkSession
    path = work_dir(spark, "linked-vectors")
    with passing_folders(spark):
        return land(_linked(vectors, threshold), path)


def _linked(vectors: DataFrame, threshold: float) -> DataFrame:
    """``near_duplicates`` from work folders."""
    spark = vectors.sparkSession
    # a vector is stored in as many bytes as it came in
    kind = vectors.schema["embedding"].dataType
    single = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    stored = "<f4" if single else "<f8"

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, vecs = [], []
            for v in batch.column(1).to_pylist():
                x = unit_vector(v)
                raw = None if x is None else np.asarray(v, "<f8").tobytes()
                vecs.append(raw and np.asarray(v, stored).tobytes())
                keys.append(None if raw is None else xxhash.xxh3_128_digest(raw))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(keys, pa.binary()), pa.array(vecs, pa.binary())],
                names=["vec_id", "key", "vec"])

    path = work_dir(spark, "vectors")
    rows = land(vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                               F.col("embedding").cast("array<double>").alias("embedding"))
                .mapInArrow(prepare, "vec_id long, key binary, vec binary"), path)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("block", pa.int32()), ("cx", pa.int32()), ("cy", pa.int32())]))
        for batch in batches:
            cells, dims = [], []
            for raw in batch.column(3).to_pylist():
                x = np.frombuffer(raw, stored).astype(np.float64)
                x = x / np.abs(x).max()
                cells.append(cells_of(x / np.linalg.norm(x), threshold))
                dims.append(len(x))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(dims, pa.int32()), pa.array(cells, kind)],
                names=["key", "id", "copies", "vec", "dim", "cells"])

    classes = land(
        rows.filter(F.col("key").isNotNull() & F.col("vec_id").isNotNull())
        .groupBy("key").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies"),
                            F.first("vec").alias("vec"))
        .mapInArrow(place, "key binary, id long, copies long, vec binary, dim int, "
                    "cells array<struct<block:int,cx:int,cy:int>>"), work_dir(spark, "classes"))
    rows = land(rows.select("vec_id", "key"), work_dir(spark, "vector-keys"))
    drop_folders(spark, path)  # the vectors stand in the classes now

    cell = ["dim", "block", "cx", "cy"]
    half = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx, dy in _HALF])
    there = (classes.withColumn("c", F.explode("cells")).withColumn("o", F.explode(half))
             .select("id", "copies", "vec", "dim", F.col("c.block").alias("block"),
                     (F.col("c.cx") - F.col("o.dx")).alias("cx"),
                     (F.col("c.cy") - F.col("o.dy")).alias("cy"),
                     ((F.col("o.dx") == 0) & (F.col("o.dy") == 0)).alias("own")))
    # a few cells for each block and length of vectors; a cell's pairs of chunks have
    # numbers from 0 (home chunk by home chunk), and bytes up to the cell's first one
    sizes = land(
        there.groupBy(cell).agg(F.count_if("own").alias("homes"), F.count(F.lit(1)).alias("bases"))
        .filter("homes > 0")
        .withColumn("n_home", F.ceil(F.col("homes") / HOME_CHUNK))
        .withColumn("n_base", F.ceil(F.col("bases") / BASE_CHUNK))
        .withColumn("moved", (F.col("homes") * F.col("n_base") + F.col("bases") * F.col("n_home"))
                    * (F.col("dim") * np.dtype(stored).itemsize + ROW_BYTES))
        .withColumn("before", F.sum("moved").over(Window.orderBy(*cell)) - F.col("moved"))
        .select(*[F.col(c).alias(c + "_") for c in cell], "n_home", "n_base", "moved", "before"),
        work_dir(spark, "cells"))
    wave_bytes = max(WAVE_BYTES, input_bytes(classes))
    waves = math.ceil((sizes.agg(F.sum("moved")).first()[0] or 0) / wave_bytes)

    def first_pair(wave: int) -> Column:
        """The cell's first pair of chunks that is not of an earlier wave."""
        pairs = F.col("n_home") * F.col("n_base")
        if wave == waves:
            return pairs
        share = F.ceil((F.lit(float(wave * wave_bytes)) - F.col("before")) * pairs / F.col("moved"))
        return F.greatest(F.lit(0), F.least(pairs, share)).cast("long")

    def dealt(wave: int, own: bool) -> DataFrame:
        """A chunk of the cell's own vectors meets every chunk of all, and back: what
        of that is the wave's."""
        now = (sizes.withColumn("lo", first_pair(wave)).withColumn("hi", first_pair(wave + 1))
               .filter("lo < hi"))
        met = (there.filter("own") if own else there).join(
            now, [F.col(c) == F.col(c + "_") for c in cell])
        mine = "n_home" if own else "n_base"
        met = met.withColumn("salt", F.pmod(F.xxhash64("id", F.lit(own)), F.col(mine)))
        if own:  # of a home chunk's pairs, those from lo up to hi
            start = F.col("salt") * F.col("n_base")
            met = (met.withColumn("from", F.greatest(F.lit(0), F.col("lo") - start))
                   .withColumn("to", F.least(F.col("n_base"), F.col("hi") - start)))
        else:  # home chunks whose pair with this base chunk is one of them
            after = lambda x: F.ceil((F.col(x) - F.col("salt")) / F.col("n_base"))
            met = met.withColumn("from", after("lo")).withColumn("to", after("hi"))
        others = F.explode(F.sequence(F.col("from"), F.col("to") - 1))
        return met.filter(F.col("from") < F.col("to")).select(
            *cell, "id", "copies", "vec", "own", F.lit(own).alias("home"),
            F.col("salt").alias("hc" if own else "bc"), others.alias("bc" if own else "hc"))

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        home, base = pdf[pdf["home"]], pdf[~pdf["home"]]
        block = int(pdf["block"].iloc[0])

        def matrix(x: pd.DataFrame) -> np.ndarray:
            return np.frombuffer(b"".join(x["vec"]), stored).reshape(len(x), -1).astype(np.float64)

        out = pd.DataFrame({"id": pd.Series(dtype="int64"), "n": pd.Series(dtype="int64"),
                            "to": pd.Series(dtype="int64")})
        if home.empty or base.empty:
            return out
        hid, bid = home["id"].to_numpy(), base["id"].to_numpy()
        b_own = base["own"].to_numpy()

        def skip(i: np.ndarray, j: np.ndarray) -> np.ndarray:
            return (hid[i] == bid[j]) | (b_own[j] & (hid[i] > bid[j]))

        i, j = _links(matrix(home), matrix(base), block, threshold, skip)
        if not len(i):
            return out
        n_home = np.bincount(i, base["copies"].to_numpy()[j], len(hid)).astype(np.int64)
        n_base = np.bincount(j, home["copies"].to_numpy()[i], len(bid)).astype(np.int64)
        a, to = _forest(hid[i], bid[j])
        return pd.concat([
            pd.DataFrame({"id": hid[n_home > 0], "n": n_home[n_home > 0]}),
            pd.DataFrame({"id": bid[n_base > 0], "n": n_base[n_base > 0]}),
            pd.DataFrame({"id": a, "n": 0, "to": to})]).astype({"to": "Int64"})

    def summed(found: DataFrame, path: str) -> DataFrame:
        """No more than two rows of a vector: its links, and a link to its component."""
        with passing_folders(spark):
            stars = components(found.filter("to is not null").select(F.col("id").alias("a"),
                                                                     F.col("to").alias("b")))
            return land(found.groupBy("id").agg(F.sum("n").alias("n"))
                        .withColumn("to", F.lit(None).cast("long"))
                        .unionByName(stars.select("id", F.lit(0).cast("long").alias("n"),
                                                  F.col("component").alias("to"))), path)

    kind = "id long, n long, to long"
    found, path, bound = spark.createDataFrame([], kind), work_dir(spark, "links"), wave_bytes
    for wave in range(waves):
        found = land(dealt(wave, True).unionByName(dealt(wave, False)).groupBy(*cell, "hc", "bc")
                     .applyInPandas(join, kind), path, mode="append")
        if input_bytes(found) > bound:
            old, path = path, work_dir(spark, "links")
            found = summed(found, path)
            drop_folders(spark, old)
            # what cannot be summed up further does not count again
            bound = input_bytes(found) + wave_bytes
    counts = found.groupBy(F.col("id").alias("cid")).agg(F.sum("n").alias("n"))
    groups = components(found.filter("to is not null").select(F.col("id").alias("a"),
                                                              F.col("to").alias("b")))
    of_class = (classes.select(F.col("key").alias("k"), F.col("id").alias("rep"), "copies")
                .join(counts, F.col("rep") == F.col("cid"), "left")
                .join(groups, F.col("rep") == F.col("id"), "left")
                .select("k", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("links"),
                        F.coalesce("component", "rep").alias("group")))
    known = F.col("vec_id").isNotNull()
    component = F.when(known, F.coalesce("group", "vec_id"))
    return (rows.select("vec_id", "key").join(of_class, F.col("key") == F.col("k"), "left")
            .select("vec_id", F.when(known, F.coalesce("links", F.lit(0))).otherwise(0)
                    .cast("long").alias("n_links"),
                    component.alias("component_id"),
                    F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept")))
