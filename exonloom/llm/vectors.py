"""Operator 9: embedding near-duplicates by int8 tile products with error bounds.

Equal vectors are folded first. The others are scaled to length 1 and rounded to int8 with a
scale and the exact length of the rounding error of each; what rounding left is rounded to a second
int8 vector, whose error is about 254 times smaller. Only these two meet tile by tile. The product
of the first integer matrices plus the error bounds tells which pairs may reach the threshold:

    u.v = u'.v' + u'.(v - v') + (u - u').v,  so  |u.v - u'.v'| <= (1 + eu) ev + eu

For those the second vectors settle all but the few pairs within some 0.0001 of the threshold, which
leave as pairs of ids and are computed in double precision from the full vectors, joined by id.
Of what is settled a pair of tiles returns one row per linked vector, its number of links and one
link of a spanning forest, so a large group of copies does not come out as pairs. A tile holds as
many vectors as fit 1 MB of int8 components.

A vector that is null or zero, or has null, NaN or infinite components, links with nothing;
vectors of different lengths do not link; equal rows link with each other; an empty table gives no
rows; other columns are ignored. The whole comparison is quadratic in distinct vectors, as the
method is; tiles keep the memory of a task fixed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from exonloom.scale import materialize

from .components import components

EXACT = 1024  # products of this many int8 pairs add up exactly in single precision
BLOCK = 128
TILE_BYTES = 1 << 20


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(int8 rows, scale, length of the error) of unit rows."""
    scale = np.maximum(np.abs(x).max(1), 1e-300) / 127
    q = np.rint(x / scale[:, None])
    error = np.sqrt(((x - q * scale[:, None]) ** 2).sum(1))
    return q.astype(np.int8), scale, error * (1 + 1e-9) + 1e-12


def unit(x: np.ndarray) -> np.ndarray:
    """``x`` scaled to length 1, whatever the size of its components."""
    x = x / np.abs(x).max()
    return x / np.sqrt((x * x).sum())


def prepare(distinct: DataFrame, tiles: int) -> DataFrame:
    """``id, weight, dim, tile`` and the two int8 vectors as ``q``, with scales and errors in ``info``."""

    def run(batches):
        for batch in batches:
            qs, infos = [], []
            for v in batch.column("embedding"):
                x = unit(np.array(v.as_py(), np.float64))[None, :]
                q, scale, error = quantise(x)
                r, fine, left = quantise(x - q * scale[:, None])
                qs.append(q.tobytes() + r.tobytes())
                infos.append(np.concatenate([scale, error, fine, left]).tobytes())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", "weight", "dim", "tile")), pa.array(qs, pa.binary()), pa.array(infos, pa.binary())],
                                             names=["id", "weight", "dim", "tile", "q", "info"])

    tiled = distinct.select("id", "weight", F.size("embedding").alias("dim"), F.pmod(F.xxhash64("id"), F.lit(tiles)).cast("int").alias("tile"), "embedding")
    return tiled.mapInArrow(run, "id long, weight long, dim int, tile int, q binary, info binary")


class Side:
    def __init__(self, rows: pa.Table, dim: int):
        self.id, self.weight = rows.column("id").to_numpy(), rows.column("weight").to_numpy()
        q = np.frombuffer(b"".join(rows.column("q").to_pylist()), np.int8).reshape(-1, 2, dim)
        self.q, self.both = np.ascontiguousarray(q[:, 0]).astype(np.float32), q
        self.scale, self.error, self.fine, self.left = np.ascontiguousarray(np.frombuffer(b"".join(rows.column("info").to_pylist()), np.float64).reshape(-1, 4).T)

    def finer(self, i: np.ndarray) -> np.ndarray:
        """Both int8 vectors of rows ``i``, added up."""
        return self.both[i, 0] * self.scale[i, None] + self.both[i, 1] * self.fine[i, None]


def products(a: Side, b: Side, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Products of pairs from both int8 vectors and the bound of their errors."""
    bound = a.left[i] + b.left[j] * (1 + a.left[i]) + 1e-12
    if len(i) > 4096:
        ui, pi = np.unique(i, return_inverse=True)
        uj, pj = np.unique(j, return_inverse=True)
        if len(ui) * len(uj) <= 8 * len(i):
            return (a.finer(ui) @ b.finer(uj).T)[pi, pj], bound
    step = max(1, (1 << 22) // a.q.shape[1])
    parts = [(a.finer(i[k:k + step]) * b.finer(j[k:k + step])).sum(1) for k in range(0, len(i), step)]
    return (np.concatenate(parts) if parts else np.empty(0)), bound


def possible(a: Side, b: Side, rows: slice, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a block of ``a`` with ``b`` that may reach the threshold."""
    dim = a.q.shape[1]
    if dim <= EXACT:
        product = a.q[rows] @ b.q.T
    else:
        product = sum((a.q[rows, k:k + EXACT] @ b.q[:, k:k + EXACT].T).astype(np.float64) for k in range(0, dim, EXACT))
    ea, sa = a.error[rows], a.scale[rows]
    worst = (threshold - ea - b.error.max() * (1 + ea)) / (sa * b.scale.max())
    i, j = np.nonzero(product >= np.minimum(worst, 3e38)[:, None] * (1 - 1e-6)) if worst.min() > 0 else np.nonzero(np.ones(product.shape, bool))
    upper = product[i, j].astype(np.float64) * sa[i] * b.scale[j] + ea[i] + b.error[j] * (1 + ea[i])
    sure = upper >= threshold
    return i[sure] + rows.start, j[sure]


class Forest:
    def __init__(self, n: int):
        self.root = np.arange(n)

    def find(self, x: np.ndarray) -> np.ndarray:
        while True:
            up = self.root[x]
            if (up == x).all():
                return x
            x = up

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        ri, rj = self.find(i), self.find(j)
        apart = ri != rj
        for x, y in np.unique(np.stack([ri[apart], rj[apart]], 1), axis=0):
            x, y = self.find(np.array([x]))[0], self.find(np.array([y]))[0]
            self.root[max(x, y)] = min(x, y)


def compare(rows: pa.Table, dim: int, one: bool, threshold: float):
    """Settled: (id, links, other), the weighted links of each linked vector and one link of a forest.
    Open: (id, other) of the pairs too close to the threshold for the bounds."""
    tile = rows.column("tile").to_numpy()
    low = tile == tile.min()
    a = Side(rows.filter(pa.array(low)), dim)
    b = a if one else Side(rows.filter(pa.array(~low)), dim)
    na, nb = len(a.id), 0 if one else len(b.id)
    links, forest, left = np.zeros(na + nb, np.int64), Forest(na + nb), []
    for k in range(0, na, BLOCK) if one or nb else ():
        i, j = possible(a, b, slice(k, min(k + BLOCK, na)), threshold)
        if one:
            i, j = i[i != j], j[i != j]
        value, bound = products(a, b, i, j)
        hit = value - bound >= threshold
        rest = ~hit & (value + bound >= threshold)
        if one:
            rest &= i < j
        left.append((a.id[i[rest]], b.id[j[rest]]))
        i, j = i[hit], j[hit]
        np.add.at(links, i, b.weight[j])
        if not one:
            np.add.at(links, na + j, a.weight[i])
        forest.link(i, j + (0 if one else na))
    ids = np.concatenate([a.id, b.id]) if nb else a.id
    at = np.flatnonzero(links)
    none = np.empty(0, np.int64)
    return (ids[at], links[at], ids[forest.find(at)]), tuple(np.concatenate([none, *(x[k] for x in left)]) for k in (0, 1))


def settle(pairs: DataFrame, distinct: DataFrame, threshold: float) -> DataFrame:
    """``id, links, other`` of both directions of the pairs whose cosine in double precision reaches the threshold."""
    full = distinct.select(F.col("id").alias("_i"), "weight", "embedding")
    met = pairs.join(full.toDF("_i", "wu", "u"), F.col("id") == F.col("_i")).drop("_i").join(full.toDF("_i", "wv", "v"), F.col("other") == F.col("_i")).drop("_i")

    def run(batches):
        for batch in batches:
            u, v = (batch.column(c).to_pylist() for c in ("u", "v"))
            hit = [bool((unit(np.array(x)) * unit(np.array(y))).sum() >= threshold) for x, y in zip(u, v)]
            yield batch.select(["id", "other", "wu", "wv"]).filter(pa.array(hit, pa.bool_()))

    linked = met.mapInArrow(run, "id long, other long, wu long, wv long")
    return linked.select(F.explode(F.array(F.struct("id", F.col("wv").alias("links"), "other"), F.struct(F.col("other").alias("id"), F.col("wu").alias("links"), F.col("id").alias("other")))).alias("l")).select("l.*")


def near_vectors(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = 0.9, tile: int | None = None) -> DataFrame:
    """``key, n_links, component_id, kept``, one row per vector. ``tile``: vectors of a tile, 1 MB of them if None."""
    x = F.col("embedding")
    good = F.coalesce(x.isNotNull() & (F.size(x) > 0) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(x, lambda v: v != 0), F.lit(False))
    every = vectors.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("embedding"))
    valid = every.where(good)
    distinct = materialize(valid.groupBy("embedding").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("weight")), "vectors")
    rows, widest = distinct.agg(F.count(F.lit(1)), F.max(F.size("embedding"))).first()
    tiles = max(1, -(-rows // (tile or max(256, TILE_BYTES // (widest or 1)))))
    ready = prepare(distinct, tiles)
    other = F.explode(F.sequence(F.lit(0), F.lit(tiles - 1)))
    met = ready.withColumn("other", other).withColumns({"a": F.least("tile", "other"), "b": F.greatest("tile", "other")}).drop("other")

    def run(keys, rows):
        _, a, b = (k.as_py() for k in keys)
        (ids, links, to), (i, j) = compare(rows, keys[0].as_py(), a == b, threshold)
        return pa.table({"id": pa.array(np.concatenate([ids, i]), pa.int64()), "links": pa.array(np.concatenate([links, np.zeros(len(i), np.int64)]), pa.int64()),
                         "other": pa.array(np.concatenate([to, j]), pa.int64())})

    tried = materialize(met.groupBy("dim", "a", "b").applyInArrow(run, "id long, links long, other long"), "tried")
    # a settled row has at least one link, so rows without any are the open pairs
    found = materialize(tried.where("links > 0").unionByName(settle(tried.where("links = 0").select("id", "other"), distinct, threshold)), "links")
    part = components(found.select(F.col("id").alias("u"), F.col("other").alias("v")))
    degree = found.groupBy("id").agg(F.sum("links").alias("links"))
    known = distinct.join(degree, "id", "left").join(part, F.col("id") == F.col("node"), "left")
    known = known.select(F.col("embedding").alias("_e"), (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    joined = valid.join(known, F.col("embedding") == F.col("_e")).select("id", "n_links", "component_id")
    alone = every.where(~good).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return joined.unionByName(alone).withColumn("kept", F.col("id") == F.col("component_id")).withColumnRenamed("id", key)
