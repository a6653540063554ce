"""Operator 2: best-fit packing by a grouping genetic algorithm on islands.

Texts are encoded, closed by an end id and, where longer than a sequence, cut into pieces. The
pieces are dealt by hash into regions of a few thousand; a region is solved by several islands.
Each island keeps a population of packings: crossover injects whole well-filled bins of one
parent into the other, removes the other's bins that hold the same pieces, and puts the pieces
that lost their bin back by best fit. Between epochs every island passes its best packing to the
next one. A region ends with the best packing of its islands. A piece as long as a sequence
needs no search. All rows of a region fit a task by construction, whatever the lengths are.

Null and empty texts are the end id alone; equal rows are packed each; an empty table gives no
rows; other columns are carried along.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import seal
from .tokens import END_ID, Encoder


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, key: str = "doc_id", text: str = "text",
           describe: tuple[str, str, Callable[[np.ndarray], int]] | None = None) -> DataFrame:
    """``key, piece, start, length, ids`` of every text, the first piece of a long one being the shorter.

    ``describe`` (column, "long", function of the ids) gives a number in place of ``ids``.
    """
    name, kind, value = describe or ("ids", "array<int>", lambda ids: ids)
    key_type = docs.schema[key].dataType.simpleString()

    def run(batches):
        encoder = Encoder(tokenizer)
        for batch in batches:
            rows = ([], [], [], [], [])

            def put(*row):
                for column, x in zip(rows, row):
                    column.append(x)

            for k, t in zip(batch.column(0), batch.column(1)):
                ids = np.array([*encoder.ids(t.as_py()), END_ID], "<u4")
                at, end = 0, len(ids) % capacity or capacity
                for piece in range(-(-len(ids) // capacity)):
                    put(k.as_py(), piece, at, end - at, value(ids[at:end]))
                    at, end = end, end + capacity
                if len(rows[0]) >= 2000:
                    yield record(rows, batch.column(0).type)
                    rows = ([], [], [], [], [])
            yield record(rows, batch.column(0).type)

    def record(rows, key_arrow):
        kinds = (key_arrow, pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int32()) if describe is None else pa.int64())
        arrays = [pa.array(x if i != 4 or describe else [y.astype(np.int32) for y in x], t) for i, (x, t) in enumerate(zip(rows, kinds))]
        return pa.RecordBatch.from_arrays(arrays, names=["key", "piece", "start", "length", name])

    out = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"key {key_type}, piece int, start long, length long, {name} {kind}")
    return out.withColumnRenamed("key", key)


class Packing:
    """Bins of one region as an array: bin of each piece."""

    def __init__(self, bins: np.ndarray, lengths: np.ndarray, capacity: int):
        self.bins = bins
        self.loads = np.bincount(bins, lengths).astype(np.int64) if len(bins) else np.zeros(0, np.int64)
        self.cost = (len(self.loads), -float(((self.loads / capacity) ** 2).sum()))


def best_fit(bins: np.ndarray, lengths: np.ndarray, items: np.ndarray, capacity: int) -> np.ndarray:
    """Puts ``items`` (in this order) into the fullest bin that takes them; -1 marks pieces without a bin."""
    bins = bins.copy()
    used = int(bins.max(initial=-1)) + 1
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0
    held = bins >= 0
    for b, load in enumerate(np.bincount(bins[held], lengths[held], used).astype(np.int64).tolist()):
        rooms[capacity - load].append(b)
        mask |= 1 << (capacity - load)
    for i, size in zip(items.tolist(), lengths[items].tolist()):
        fits = mask >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            b = rooms[room].pop()
            if not rooms[room]:
                mask ^= 1 << room
        else:
            room, b = capacity, used
            used += 1
        bins[i] = b
        rooms[room - size].append(b)
        mask |= 1 << (room - size)
    return bins


def cross(into: Packing, giver: Packing, lengths: np.ndarray, capacity: int, rng) -> Packing:
    """Child of two packings: injected bins, bins without duplicates, displaced pieces by best fit."""
    n = len(giver.loads)
    well = np.argsort(-(giver.loads + rng.random(n) * 0.02 * capacity))[:max(1, int(n * rng.uniform(0.2, 0.7)))]
    injected = np.zeros(n, bool)
    injected[well] = True
    moved = injected[giver.bins]
    broken = np.zeros(len(into.loads), bool)
    broken[into.bins[moved]] = True
    broken[np.argsort(into.loads)[:1 + len(into.loads) // 50]] = True  # the emptiest bins are dissolved too
    stay = ~moved & ~broken[into.bins]
    child = np.full(len(lengths), -1, np.int64)
    child[moved] = giver.bins[moved]
    child[stay] = into.bins[stay] + n
    held = child >= 0
    child[held] = np.unique(child[held], return_inverse=True)[1]
    loose = np.flatnonzero(~held)
    loose = loose[np.argsort(-(lengths[loose] * (1 + 0.05 * rng.random(len(loose)))))]
    return Packing(best_fit(child, lengths, loose, capacity), lengths, capacity)


def evolve(lengths: np.ndarray, seeds: list[np.ndarray], capacity: int, population: int, generations: int, rng) -> Packing:
    """Best packing of an island after some generations; ends as soon as no bin can be saved."""
    least = -(-int(lengths.sum()) // capacity)
    pool = [Packing(s, lengths, capacity) for s in seeds]
    none = np.full(len(lengths), -1, np.int64)
    while len(pool) < population and (not pool or min(p.cost for p in pool)[0] > least):
        noise = 0.0 if not pool else 0.3 * rng.random(len(lengths))
        pool.append(Packing(best_fit(none, lengths, np.argsort(-(lengths * (1 + noise)), kind="stable"), capacity), lengths, capacity))
    for _ in range(generations):
        pool.sort(key=lambda p: p.cost)
        if pool[0].cost[0] <= least or len(pool) < 2:
            break
        a, b = rng.choice(len(pool), 2, replace=False)
        child = cross(pool[a], pool[b], lengths, capacity, rng)
        if child.cost < pool[-1].cost:
            pool[-1] = child
    return min(pool, key=lambda p: p.cost)


STATE = "region long, island int, row long, length long, bin long"


def pack(items: DataFrame, capacity: int = 2048, row: str = "row", length: str = "length", islands: int = 3, epochs: int = 2, population: int = 4,
         generations: int = 8, region: int = 2000, seed: int = 11) -> DataFrame:
    """``items`` with ``sequence_id`` and ``offset``; ``row`` must tell the rows apart and ``items`` be a written table."""
    items, restore = seal(items, row, length)
    short = items.where(F.col(length) < capacity).select(F.col(row).alias("row"), F.col(length).cast("long").alias("length"))
    regions = max(1, -(-short.count() // region))

    def island_step(epoch: int):
        def run(key, rows):
            rows = rows.sort_values(["origin", "row"])
            first = rows[rows["origin"] == rows["origin"].iloc[0]]
            lengths = first["length"].to_numpy()
            seeds = [g["bin"].to_numpy() for _, g in rows.groupby("origin")] if epoch else []
            rng = np.random.default_rng([seed, int(key[0]), int(key[1]), epoch])
            best = evolve(lengths, seeds, capacity, population, generations, rng)
            return pd.DataFrame({"region": key[0], "island": key[1], "row": first["row"].to_numpy(), "length": lengths, "bin": best.bins})

        return run

    def choose(key, rows):
        best = min((Packing(g["bin"].to_numpy(), g["length"].to_numpy(), capacity).cost, island) for island, g in rows.groupby("island"))[1]
        rows = rows[rows["island"] == best].sort_values(["bin", "row"])
        ends = rows.groupby("bin")["length"].cumsum()
        return pd.DataFrame({"row": rows["row"], "sequence_id": (int(key[0]) << 24) + rows["bin"], "offset": ends - rows["length"]})

    state = short.select(F.pmod(F.xxhash64("row"), F.lit(regions)).alias("region"), F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"),
                         F.lit(0).alias("origin"), "row", "length", F.lit(-1).cast("long").alias("bin"))
    for epoch in range(epochs):
        state = state.groupBy("region", "island").applyInPandas(island_step(epoch), STATE)
        if epoch + 1 < epochs:
            onward = F.array(F.col("island"), F.pmod(F.col("island") + 1, F.lit(islands)))
            state = state.select("region", F.explode(F.array_distinct(onward)).alias("island"), F.col("island").alias("origin"), "row", "length", "bin")
    chosen = state.groupBy("region").applyInPandas(choose, "row long, sequence_id long, offset long")
    whole = items.where(F.col(length) >= capacity).select(F.col(row).alias("row"), (-1 - F.col(row)).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    placed = chosen.unionByName(whole).withColumnRenamed("row", "_row")
    return restore(items.join(placed, F.col(row) == F.col("_row")), "sequence_id", "offset")
