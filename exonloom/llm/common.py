"""What the corpus operators share: word rule, slabs of a total order, scratch tables."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from exonloom.scale import materialize

#: A word is a run of characters other than space and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers ``fn(spark, folder)`` and, where there is one, its SQL twin."""

    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def seal(df: DataFrame, *kept: str):
    """``df`` with all columns but ``kept`` under private names, and a function that gives a result
    its own names back, followed by added columns (which replace columns of the same name)."""
    hidden = {c: f"_x{i}" for i, c in enumerate(df.columns) if c not in kept}

    def restore(result: DataFrame, *added: str) -> DataFrame:
        return result.select(*[F.col(hidden.get(c, c)).alias(c) for c in df.columns if c not in added], *added)

    return df.toDF(*[hidden.get(c, c) for c in df.columns]), restore


def count_words(text: Column) -> Column:
    """Number of words of a text; null counts none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def splits(df: DataFrame) -> int:
    """Partitions of a scan: follows the input's bytes."""
    return max(1, df.rdd.getNumPartitions())


def ordered_slabs(df: DataFrame, order: list[str]) -> DataFrame:
    """Writes ``df`` range-partitioned by ``order`` with its slab number ``_slab``.

    ``order`` must end in a column that tells equal rows apart, so that no run of
    equal keys has to stay in one slab.
    """
    n = max(splits(df), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return materialize(df.repartitionByRange(n, *order).withColumn("_slab", F.spark_partition_id()), "slabs")


def running_sums(slabs: DataFrame, order: list[str], keys: list[str], values: dict[str, Column]) -> DataFrame:
    """Adds for each name the sum of its value over the rows of the same keys up to this one.

    Every slab is summed on its own; the sums of earlier slabs come from a table with
    one row for each key and slab, in which a key that spans many slabs has as many rows.
    """
    here = W.partitionBy("_slab", *keys).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    before = W.partitionBy(*(keys or [F.lit(0)])).orderBy("_slab").rowsBetween(W.unboundedPreceding, -1)
    totals = slabs.groupBy("_slab", *keys).agg(*[F.sum(v).alias(f"_t_{n}") for n, v in values.items()])
    carry = totals.select(F.col("_slab").alias("_cs"), *[F.col(k).alias(f"_ck_{k}") for k in keys],
                          *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_b_{n}") for n in values])
    on = F.col("_slab") == F.col("_cs")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_ck_{k}"))
    joined = slabs.withColumns({n: F.sum(v).over(here) for n, v in values.items()}).join(carry, on, "left")
    return joined.withColumns({n: F.col(n) + F.coalesce(f"_b_{n}", F.lit(0)) for n in values}).drop("_cs", *[f"_ck_{k}" for k in keys], *[f"_b_{n}" for n in values])


SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BYTE = np.random.default_rng(20240229).integers(1, 2**63, 256, np.uint64) | np.uint64(1)
_P = 0x9E3779B97F4A7C15
_SPAN = 1 << 18


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


_POW, _INV = _powers(_P, _SPAN), _powers(pow(_P, -1, 2**64), _SPAN)


class Texts:
    """UTF-8 bytes of consecutive texts with the places and 64-bit hashes of their words.

    ``data``: bytes on end; ``bounds``: first byte of each text (n + 1); ``starts``, ``ends``:
    bytes of each word; ``first``: first word of each text (n + 1); ``hashes``: by content only.
    """

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        self.data, self.bounds = data, bounds
        word = ~SPACE[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[bounds] = True
        opens, closes = word.copy(), word.copy()
        opens[1:] &= ~word[:-1] | edge[1:-1]
        closes[:-1] &= ~word[1:] | edge[1:-1]
        self.starts, self.ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        self.first = np.searchsorted(self.starts, bounds)
        self.hashes = self._hash()

    def _hash(self) -> np.ndarray:
        out = np.empty(len(self.starts), np.uint64)
        i = 0
        with np.errstate(over="ignore"):
            while i < len(out):
                at = self.starts[i]
                j = max(i + 1, int(np.searchsorted(self.ends, at + _SPAN, "right")))
                part = _BYTE[self.data[at:self.ends[j - 1]]]
                pow_, inv = (_POW, _INV) if len(part) <= _SPAN else (_powers(_P, len(part)), _INV)
                sums = np.zeros(len(part) + 1, np.uint64)
                np.cumsum(part * pow_[:len(part)], out=sums[1:])
                s = self.starts[i:j] - at
                out[i:j] = (sums[self.ends[i:j] - at] - sums[s]) * inv[s]
                i = j
        return mix(out)

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def words_per_text(self) -> np.ndarray:
        return np.diff(self.first)

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all windows of ``width`` words inside one text, and the word each starts at."""
        if len(self.hashes) < width:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        inside = np.ones(len(self.hashes) + 1, bool)
        for k in range(1, width):  # the last width - 1 words of each text start none
            inside[np.maximum(self.first[1:] - k, 0)] = False
        at = np.flatnonzero(inside[:len(self.hashes) - width + 1])
        short = np.flatnonzero(np.diff(self.first) < width)
        if len(short):
            owner = np.searchsorted(self.first, at, "right") - 1
            at = at[at + width <= self.first[owner + 1]]
        return windows(self.hashes, width)[at], at

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i]:self.ends[i]].tobytes()


def texts_of(column, most: int = 4 << 20, lower: bool = False, rows: int = 1 << 20):
    """(first row, Texts) for runs of rows of an Arrow string column; null counts as empty.

    A run ends before it would exceed ``most`` bytes or ``rows`` texts; a longer text is a run of its own.
    """
    if len(column) == 0:
        return
    column = pc.fill_null(column, "")
    offsets = np.frombuffer(column.buffers()[1], np.int64 if pa.types.is_large_string(column.type) else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        j = min(j, len(column), i + rows)
        part = data[offsets[i]:offsets[j]]
        yield i, Texts(LOWER[part] if lower else part, offsets[i:j + 1] - offsets[i])
        i = j


def row_spans(column, most: int):
    """(first row, end) of runs of rows of an Arrow string column of up to ``most`` bytes; a longer
    text is a run of its own."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)) if len(column) else []
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + most, "right")))
        yield i, j
        i = j


def windows(hashes: np.ndarray, width: int, salt: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """Hash of the ``width`` words from each place on; shorter by ``width - 1``."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    mult = np.uint64(salt | 1)
    h = hashes[:n].copy()
    with np.errstate(over="ignore"):
        for i in range(1, width):
            h *= mult
            h ^= h >> np.uint64(29)
            h += hashes[i:n + i]
        return mix(h)


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over the 64 output bits."""
    with np.errstate(over="ignore"):
        h = h ^ (h >> np.uint64(33))
        h *= np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(33)
        h *= np.uint64(0xC4CEB9FE1A85EC53)
        h ^= h >> np.uint64(33)
    return h
