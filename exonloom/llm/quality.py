"""Operator 5: quality rules by gradient-boosted trees over document statistics.

Statistics of whole texts are counted from their bytes, many texts at a time. Trees are
boosted (logistic loss, histogram splits) on a bounded sample of labelled documents;
chosen statistics may only lower the score. The forest is flattened into node arrays and scored
by stepping all documents of a batch down one level at a time.

Null text has no words, as an empty one; a document's verdict hangs on its text alone, so equal
rows get equal verdicts; without labelled rows of both classes the base rule decides alone;
other columns are carried along.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE, Texts, seal, texts_of

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Statistics the trees see, and those in which more must not mean better.
STATISTICS = ("log_words", "word_length", "symbol_share", "dup_line_share", "repeat_share", "upper_share", "digit_share", "mark_share", "bar_share", "shout_share",
              "distinct_share", "top_share", "same_next_share", "line_words", "end_share")
FALLING = frozenset({"symbol_share", "dup_line_share", "repeat_share", "bar_share", "shout_share", "top_share", "same_next_share"})

#: The characters counted as symbols.
SYMBOLS = b"#*$%&|<>"
CLASSES = {"symbol": SYMBOLS, "upper": bytes(range(65, 91)), "lower": bytes(range(97, 123)), "digit": b"0123456789", "bar": b"|", "shout": b"!",
           "mark": bytes(b for b in range(33, 127) if not chr(b).isalnum()), "end": b".?!"}


def _flag(chars: bytes) -> np.ndarray:
    out = np.zeros(256, np.uint8)
    out[list(chars)] = 1
    return out


_FLAGS = {name: _flag(chars) for name, chars in CLASSES.items()}
_POINT = ((np.arange(256) & 0xC0) != 0x80) & ~SPACE


def per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of byte flags over each text."""
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def repeated(t: Texts, width: int = 5) -> np.ndarray:
    """Words of each text that a window of ``width`` words covers which the text holds twice or more."""
    h, at = t.windows(width)
    owner = np.searchsorted(t.first, at, "right") - 1
    order = np.lexsort((h, owner))
    same = (h[order][1:] == h[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    twice = np.zeros(len(h) + 1, bool)
    twice[:-1][1:] = same
    twice[:-2] |= same
    steps = np.zeros(len(t.hashes) + 1, np.int32)
    hit = at[order[twice[:-1]]]
    np.add.at(steps, hit, 1)
    np.add.at(steps, hit + width, -1)
    return per_text(np.cumsum(steps[:-1]) > 0, t.first)


def measure(t: Texts) -> tuple[np.ndarray, np.ndarray]:
    """(base counts, statistics) of a batch of texts, one row each."""
    n, words = len(t), t.words_per_text()
    counts = {name: per_text(flag[t.data], t.bounds) for name, flag in _FLAGS.items()}
    chars = per_text(_POINT[t.data], t.bounds)
    repeat = repeated(t)
    dup_lines, lines = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i in range(n):
        own = [x for x in t.data[t.bounds[i]:t.bounds[i + 1]].tobytes().split(b"\n") if x.strip(b" \t\n\r\x0b\x0c")]
        lines[i], dup_lines[i] = len(own), len(own) - len(set(own))
    owner = np.repeat(np.arange(n), words)
    order = np.lexsort((t.hashes, owner))
    h, o = t.hashes[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    runs = np.diff(np.append(np.flatnonzero(new), len(h)))
    top = np.zeros(n, np.int64)
    np.maximum.at(top, o[new], runs)
    distinct = np.bincount(o[new], minlength=n)
    same_next = np.zeros(len(owner), bool)
    same_next[1:] = (t.hashes[1:] == t.hashes[:-1]) & (owner[1:] == owner[:-1])
    ends = per_text(_FLAGS["end"][t.data[np.maximum(t.ends - 1, 0)]] if len(t.ends) else np.zeros(0, np.uint8), t.first)
    w, c, ln = np.maximum(words, 1), np.maximum(chars, 1), np.maximum(lines, 1)
    base = np.stack([words, chars, counts["symbol"], dup_lines, repeat], 1)
    stats = np.stack([np.log1p(words), chars / w, counts["symbol"] / c, dup_lines / ln, repeat / w, counts["upper"] / c, counts["digit"] / c, counts["mark"] / c, counts["bar"] / c,
                      counts["shout"] / c, distinct / w, top / w, per_text(same_next, t.first) / w, words / ln, ends / w], 1)
    return base, stats


@dataclass
class Forest:
    """Trees of one depth as arrays [tree, node]; a leaf's children are itself."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    start: float
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log odds of good quality."""
        trees, rows = np.arange(len(self.feature))[None, :], np.arange(len(x))[:, None]
        node = np.zeros((len(x), len(self.feature)), np.int64)
        for _ in range(self.depth):
            low = x[rows, self.feature[trees, node]] <= self.threshold[trees, node]
            node = np.where(low, self.left[trees, node], self.right[trees, node])
        return self.start + self.value[trees, node].sum(1)


def boost(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 3, rate: float = 0.2, bins: int = 32, least: int = 10, ridge: float = 1.0, falling=FALLING) -> Forest:
    """Fits the forest. A split on a falling statistic must put the lower value on the higher
    side, and the subtrees keep to the two sides of the value halfway between."""
    falls = np.array([s in falling for s in STATISTICS])
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    code = np.stack([np.searchsorted(c, x[:, f]) for f, c in enumerate(cuts)], 1)
    start = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    at, out = np.full(len(y), start), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-at))
        g, h = y - p, p * (1 - p)
        nodes: list[list] = []  # feature, threshold, left, right, value

        def grow(rows: np.ndarray, level: int, low: float, high: float) -> int:
            own, me = float(np.clip(g[rows].sum() / (h[rows].sum() + ridge), low, high)), len(nodes)
            nodes.append([0, np.inf, me, me, own])
            best = (1e-6, None)
            for f in range(x.shape[1] if level < depth else 0):
                k = len(cuts[f]) + 1
                gs, hs = np.bincount(code[rows, f], g[rows], k).cumsum(), np.bincount(code[rows, f], h[rows], k).cumsum()
                ns = np.bincount(code[rows, f], minlength=k).cumsum()
                for b in range(k - 1):
                    if min(ns[b], ns[-1] - ns[b]) < least:
                        continue
                    wl, wr = gs[b] / (hs[b] + ridge), (gs[-1] - gs[b]) / (hs[-1] - hs[b] + ridge)
                    if falls[f] and wl < wr:
                        continue
                    gain = gs[b] * wl + (gs[-1] - gs[b]) * wr - gs[-1] ** 2 / (hs[-1] + ridge)
                    if gain > best[0]:
                        best = (gain, (f, b, np.clip(wl, low, high), np.clip(wr, low, high)))
            if best[1]:
                f, b, wl, wr = best[1]
                middle = (wl + wr) / 2
                bounds = ((middle, high), (low, middle)) if falls[f] else ((low, high), (low, high))
                side = code[rows, f] <= b
                nodes[me][:2] = [f, float(cuts[f][b])]
                nodes[me][2] = grow(rows[side], level + 1, *bounds[0])
                nodes[me][3] = grow(rows[~side], level + 1, *bounds[1])
            return me

        grow(np.arange(len(y)), 0, -np.inf, np.inf)
        out.append(nodes)
        one = flatten([nodes], 0.0, depth, rate)
        at = at + one.score(x)
    return flatten(out, start, depth, rate)


def flatten(trees: list[list], start: float, depth: int, rate: float) -> Forest:
    most = max(len(t) for t in trees)
    grid = np.zeros((len(trees), most, 5))
    for i, t in enumerate(trees):
        grid[i, :len(t)] = t
    return Forest(grid[..., 0].astype(np.int64), grid[..., 1], grid[..., 2].astype(np.int64), grid[..., 3].astype(np.int64), grid[..., 4] * rate, start, depth)


def statistics(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and the statistics as an array."""

    def run(batches):
        for batch in batches:
            for i, t in texts_of(batch.column(1)):
                stats = measure(t)[1]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, len(t)), pa.array(list(stats), pa.list_(pa.float64()))], names=["key", "statistics"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"key {kind}, statistics array<double>").withColumnRenamed("key", key)


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", most: int = 6000) -> Forest | None:
    """Forest from at most ``most`` labelled documents (``most`` is the documented bound), taken by
    the order of a hash of their key; None where a class is missing."""
    known = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).groupBy(key).agg(F.min(label).alias("_label"))
    sample = known.orderBy(F.xxhash64(F.lit(1), key), key).limit(most)
    rows = statistics(docs.select(key, "text").join(F.broadcast(sample.select(key)), key, "left_semi"), key).join(F.broadcast(sample), key).orderBy(F.xxhash64(key)).limit(2 * most).collect()
    y = np.array([r["_label"] for r in rows], np.float64)
    if len(y) == 0 or y.min() == y.max():
        return None
    return boost(np.array([r["statistics"] for r in rows]), y)


def judge(docs: DataFrame, forest: Forest | None, text: str = "text", bar: float = 0.0) -> DataFrame:
    """``docs`` with the base counts, ``base_failed``, ``score`` (log odds) and ``kept``."""
    docs, restore = seal(docs, text)
    names = [f"c{i}" for i in range(len(docs.columns))]
    at = docs.columns.index(text)
    kept_schema = docs.toDF(*names).schema
    for f in ("long",) * 5:
        kept_schema = kept_schema.add(f"b{len(kept_schema)}", f)
    kept_schema = kept_schema.add("base_failed", "boolean").add("score", "double").add("kept", "boolean")

    def run(batches):
        for batch in batches:
            for i, t in texts_of(batch.column(at)):
                base, stats = measure(t)
                failed = (base[:, 0] < 10) | (100 * base[:, 4] > 20 * base[:, 0])
                score = forest.score(stats) if forest else np.where(failed, -1.0, 1.0)
                found = [*map(pa.array, base.T), pa.array(failed), pa.array(score), pa.array(~failed & (score > bar))]
                yield pa.RecordBatch.from_arrays([*(c.slice(i, len(t)) for c in batch.columns), *found], names=kept_schema.names)

    added = (*BASE, "base_failed", "score", "kept")
    return restore(docs.toDF(*names).mapInArrow(run, kept_schema).toDF(*docs.columns, *added), *added)
