"""Operator 3: MinHash near-duplicates by improved consistent weighted sampling.

Shingles of five words weigh term frequency times inverse document frequency. Document
frequencies are counted over all documents in a fixed number of hashed features, so the
weight table has one size at any scale. Consistent weighted sampling draws ``BANDS * ROWS`` samples of a
document; documents that share a band are candidates, and a pair is linked if its weighted
Jaccard similarity reaches the threshold. The plain similarity (all weights equal) counts too:
in a large group of near copies the common shingles weigh little and each copy's few own ones
much, and TF-IDF alone would let such a group fall apart. It has as many samples and bands of its
own, as such a pair may agree in few of the weighted ones. Classes are the connected components.

Equal texts are folded first. In a band bucket of any size every member meets the least one
first; only buckets whose members then lie in several classes are opened, and there pairs of
different classes that share a band are compared in blocks, all of them in full.

Null text counts as empty. Texts of fewer than five words are one shingle; texts without words
link only with equal texts. Ties and repeated rows: the class id is the least key, and of
equal rows one is kept. An empty table gives no rows; other columns do not matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from exonloom.scale import materialize

from .common import Texts, mix, seal, splits, texts_of, windows
from .components import components

WIDTH, BANDS, ROWS, FEATURES = 5, 16, 3, 1 << 18
HASH_BITS = 44
_POOL = 1 << 16
_rng = np.random.default_rng(77)
_R = _rng.gamma(2.0, 1.0, _POOL).astype(np.float32) + np.float32(1e-6)
_LOG_C = np.log(_rng.gamma(2.0, 1.0, _POOL) + 1e-12).astype(np.float32)
_BETA = _rng.random(_POOL).astype(np.float32)
_XOR, _ODD = _rng.integers(0, 2**64, (2, BANDS * ROWS), np.uint64) | np.uint64(1)
BLOCK = 512


def shingles(t: Texts, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text, times) of the distinct shingles of each text, texts in order."""
    h, at = t.windows(width)
    owner = np.searchsorted(t.first, at, "right") - 1
    words = np.diff(t.first)
    for i in np.flatnonzero((words > 0) & (words < width)):
        n = words[i]
        h = np.append(h, windows(t.hashes[t.first[i]:t.first[i] + n], int(n)) ^ np.uint64(n))
        owner = np.append(owner, i)
    # text and 44 bits of the hash in one number, so one plain sort groups them
    both = np.sort((owner.astype(np.uint64) << np.uint64(HASH_BITS)) | (h >> np.uint64(64 - HASH_BITS)))
    at = np.flatnonzero(np.append(True, both[1:] != both[:-1])) if len(both) else np.zeros(0, np.int64)
    times = np.diff(np.append(at, len(both)))
    both = both[at]
    return both & np.uint64((1 << HASH_BITS) - 1), (both >> np.uint64(HASH_BITS)).astype(np.int64), times


def feature(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(HASH_BITS - FEATURES.bit_length() + 1)).astype(np.int64)


def document_frequencies(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Inverse document frequency of each feature; what reaches the driver has ``FEATURES`` numbers."""

    def run(batches):
        counts = np.zeros(FEATURES + 1, np.int64)
        for batch in batches:
            for _, t in texts_of(batch.column(0)):
                h, owner, _ = shingles(t)
                f = feature(h)  # ascends within each text
                new = np.append(True, (f[1:] != f[:-1]) | (owner[1:] != owner[:-1])) if len(f) else np.zeros(0, bool)
                counts[:FEATURES] += np.bincount(f[new], minlength=FEATURES)
                counts[FEATURES] += len(t)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["feature", "docs"])

    found = docs.select(text).mapInArrow(run, "feature long, docs long").groupBy("feature").agg(F.sum("docs").alias("docs")).toArrow()
    counts = np.zeros(FEATURES + 1)
    counts[found.column("feature").to_numpy()] = found.column("docs").to_numpy()
    return (1 + np.log((counts[FEATURES] + 1) / (counts[:FEATURES] + 1))).astype(np.float32)


def sample(h: np.ndarray, weight: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Consistent weighted samples of each run of shingles: [run, BANDS * ROWS] of 32-bit codes.

    The draws of a (shingle, sample) pair come from a pool by double hashing. The least ln(a)
    and the code of its (shingle, level) share one 64-bit number, so one minimum finds both.
    """
    mixed = mix(h)
    low, step, code = mixed.astype(np.uint32), (mixed >> np.uint64(32)).astype(np.uint32) | np.uint32(1), (mix(~h) >> np.uint64(32)).astype(np.uint32)
    log_w = np.log(weight).astype(np.float32)
    out = np.empty((len(starts), BANDS * ROWS), np.uint32)
    with np.errstate(over="ignore"):
        for k in range(BANDS * ROWS):
            low = low + step
            at = low >> np.uint32(16)
            r, beta = _R[at], _BETA[at]
            level = np.floor(log_w / r + beta)
            value = _LOG_C[at] - r * (level - beta + 1) + np.float32(128)  # positive, so bits sort as numbers
            key = np.maximum(value, np.float32(1e-6)).view(np.uint32).astype(np.uint64) << np.uint64(32)
            key |= code ^ (level.astype(np.int32).view(np.uint32) * np.uint32(0x9E3779B1))
            out[:, k] = np.minimum.reduceat(key, starts).astype(np.uint32)
    return out


def plain_sample(h: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Samples of each run of shingles with all weights equal: [run, BANDS * ROWS] of 32-bit codes."""
    mixed = mix(h)
    out = np.empty((len(starts), BANDS * ROWS), np.uint32)
    with np.errstate(over="ignore"):
        for k in range(BANDS * ROWS):
            out[:, k] = np.minimum.reduceat((mixed ^ _XOR[k]) * _ODD[k], starts).astype(np.uint32)
    return out


def signatures(docs: DataFrame, idf, key: str, text: str) -> DataFrame:
    """``key, k1, k2, bands, samples``: two digests of the text, band keys (weighted, then plain), raw samples."""
    salt = np.arange(1, 2 * BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)

    def run(batches):
        table = idf.value
        for batch in batches:
            for i, t in texts_of(batch.column(3), 1 << 18):
                h, owner, times = shingles(t)
                starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])) if len(h) else np.zeros(0, np.int64)
                bands, samples = [None] * len(t), [None] * len(t)
                if len(h):
                    drawn = np.concatenate([sample(h, times * table[feature(h)], starts), plain_sample(h, starts)], 1)
                    parts = drawn.astype(np.uint64).reshape(len(starts), 2 * BANDS, ROWS)
                    keys = np.broadcast_to(salt, parts.shape[:2])
                    for r in range(ROWS):
                        keys = mix(keys ^ parts[:, :, r])
                    for o, b, s in zip(owner[starts], keys.view(np.int64), drawn):
                        bands[o], samples[o] = b, s.tobytes()
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(i, len(t)) for c in range(3)), pa.array(bands, pa.list_(pa.int64())), pa.array(samples, pa.binary())],
                                                 names=["key", "k1", "k2", "bands", "samples"])

    lean = keyed(docs, key, text).select("key", "k1", "k2", "text")
    return lean.mapInArrow(run, "key long, k1 long, k2 long, bands array<long>, samples binary")


NO_KEY = -(2**63)


def whole(key: str):
    """Key without null, so that rows without one are documents like others."""
    return F.coalesce(F.col(key).cast("long"), F.lit(NO_KEY))


def keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``key, text`` and two digests that tell texts apart."""
    words = F.coalesce(F.col(text), F.lit(""))
    return docs.select(whole(key).alias("key"), words.alias("text"), F.xxhash64(words).alias("k1"), F.xxhash64(F.lit("2"), words).alias("k2"))


def similarities(a: Texts, b: Texts, idf: np.ndarray) -> np.ndarray:
    """Weighted Jaccard similarity of text i of ``a`` and text i of ``b``: the greater of that with
    TF-IDF weights and that with equal weights."""
    (ha, oa, ta), (hb, ob, tb) = shingles(a), shingles(b)
    h, o = np.concatenate([ha, hb]), np.concatenate([oa, ob])
    order = np.lexsort((h, o))
    h, o = h[order], o[order]
    both = np.flatnonzero((h[1:] == h[:-1]) & (o[1:] == o[:-1]))

    def jaccard(w: np.ndarray) -> np.ndarray:
        total = np.bincount(o, w, len(a))
        shared = np.bincount(o[both], np.minimum(w[both], w[both + 1]), len(a))
        return np.divide(shared, total - shared, out=np.zeros(len(a)), where=total > shared)

    return np.maximum(jaccard((np.concatenate([ta, tb])[order]) * idf[feature(h)].astype(np.float64)), jaccard(np.ones(len(h))))


def verify(pairs: DataFrame, texts: DataFrame, idf, threshold: float) -> DataFrame:
    """The pairs ``a, b`` whose similarity reaches the threshold. ``texts``: ``node, text``."""

    def run(batches):
        for batch in batches:
            one, two = batch.column(2), batch.column(3)
            for k in range(0, len(batch), 64):
                (_, a), = texts_of(one.slice(k, 64), 1 << 40)
                (_, b), = texts_of(two.slice(k, 64), 1 << 40)
                good = pa.array(similarities(a, b, idf.value) >= threshold)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(k, 64).filter(good), batch.column(1).slice(k, 64).filter(good)], names=["u", "v"])

    left = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a")
    both = left.join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b")
    return both.select("a", "b", "ta", "tb").mapInArrow(run, "u long, v long")


def open_links(members: DataFrame, idf, threshold: float) -> DataFrame:
    """Links ``u, v`` between members of different classes in one bucket.

    ``members``: ``bucket, band, size, node, part, samples, text``. A bucket is dealt into blocks of
    a few hundred and the blocks meet pairwise, so no task gets a whole bucket; small ones share a
    group. A pair is looked at in the first band it shares and verified on the spot: only links
    leave the task. Classes that a link has joined count as one for the rest of the block.
    """
    n = members.withColumn("blocks", F.ceil(F.col("size") / BLOCK)).withColumn("own", F.pmod(F.xxhash64("node"), "blocks"))
    met = n.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    groups = max(64, 4 * splits(members))
    met = met.withColumn("group", F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("bucket"), F.lit(groups))).otherwise(F.col("bucket")))
    met = met.select("group", "bucket", "band", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "part", "samples", "text")

    def run(keys, rows):
        got = []
        one = keys[1].as_py() == keys[2].as_py()
        bucket = rows.column("bucket").to_numpy()
        order = np.argsort(bucket, kind="stable")
        for own_rows in np.split(order, np.flatnonzero(bucket[order][1:] != bucket[order][:-1]) + 1):
            part = rows.take(own_rows)
            low = part.column("own").to_numpy() == keys[1].as_py()
            got += links_in(part, low, low if one else ~low, one, idf.value, threshold)
        got = np.array(got, np.int64).reshape(-1, 2)
        return pa.table({"u": pa.array(got[:, 0]), "v": pa.array(got[:, 1])})

    return met.groupBy("group", "i", "j").applyInArrow(run, "u long, v long").distinct()


def links_in(rows: pa.Table, low: np.ndarray, high: np.ndarray, one: bool, idf: np.ndarray, threshold: float) -> list[tuple[int, int]]:
    """Verified links between the rows ``low`` and ``high`` of one bucket."""
    node, part = rows.column("node").to_numpy(), rows.column("part").to_numpy().copy()
    if part.min() == part.max():
        return []
    drawn = np.frombuffer(b"".join(rows.column("samples").to_pylist()), np.uint32).reshape(len(node), -1, ROWS)
    band = rows.column("band")[0].as_py()
    (_, t), = texts_of(rows.column("text").combine_chunks(), 1 << 62)
    h, owner, times = shingles(t)
    ids = np.unique(h, return_inverse=True)[1]
    first = np.searchsorted(owner, np.arange(len(node) + 1))
    heavy = times * idf[feature(h)].astype(np.float64)
    size, weight = np.diff(first), np.bincount(owner, heavy, len(node))
    mine, own = np.zeros(ids.max() + 1), np.zeros(ids.max() + 1)
    out = []
    others = np.flatnonzero(high)
    for x in np.flatnonzero(low):
        y = others[(part[others] != part[x]) & ((node[others] > node[x]) if one else True)]
        shared = (drawn[y] == drawn[x]).all(2)
        y = y[(shared.argmax(1) == band) & shared.any(1)]
        # no similarity exceeds the ratio of the sizes
        y = y[np.maximum(np.minimum(size[y], size[x]) / np.maximum(size[y], size[x]), np.minimum(weight[y], weight[x]) / np.maximum(weight[y], weight[x])) >= threshold]
        if not len(y):
            continue
        s = slice(first[x], first[x + 1])
        mine[ids[s]], own[ids[s]] = heavy[s], 1.0
        starts = np.cumsum(size[y]) - size[y]
        at = np.repeat(first[y] - starts, size[y]) + np.arange(size[y].sum())
        common = np.add.reduceat(own[ids[at]], starts)
        heavy_common = np.add.reduceat(np.minimum(mine[ids[at]], heavy[at]), starts)
        mine[ids[s]], own[ids[s]] = 0.0, 0.0
        alike = np.maximum(common / (size[y] + size[x] - common), heavy_common / (weight[y] + weight[x] - heavy_common)) >= threshold
        for k in y[alike]:
            if part[k] != part[x]:
                part[part == part[k]] = part[x]
                out.append((int(node[x]), int(node[k])))
    return out


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = 0.8) -> DataFrame:
    """``key, k1, k2, class_id, kept, copies``, one row per document; ``copies`` counts rows equal in key and text."""
    spark = docs.sparkSession
    idf = spark.sparkContext.broadcast(document_frequencies(docs, text))
    drawn = materialize(signatures(docs, idf, key, text).withColumn("row", F.monotonically_increasing_id()), "samples")
    groups = drawn.groupBy("k1", "k2").agg(F.min("row").alias("node"), F.min("key").alias("least"))
    nodes = drawn.join(groups.select("node"), F.col("row") == F.col("node"), "left_semi").select(F.col("row").alias("node"), "key", "k1", "k2", "bands", "samples")
    nodes = materialize(nodes.where("bands is not null"), "nodes")

    banded = nodes.select("node", F.posexplode("bands").alias("band", "bucket"))
    full = banded.groupBy("bucket").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("size")).where("size > 1")
    full = materialize(full, "buckets")
    members = banded.join(full, "bucket")
    stars = materialize(members.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct(), "stars")
    wanted = stars.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(nodes.select("node", "key", "k1", "k2"), "node")
    texts = wanted.join(keyed(docs, key, text), ["key", "k1", "k2"]).select("node", "text")
    texts = materialize(texts, "texts")
    links = materialize(verify(stars, texts, idf, threshold), "links")
    parts = components(links)

    placed = members.where("size > 2").join(parts, "node", "left").select("bucket", "band", "size", "node", F.coalesce("component", "node").alias("part"))
    several = placed.groupBy("bucket").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo <> hi").select("bucket")
    opened = placed.join(several, "bucket").join(nodes.select("node", "samples"), "node").join(texts, "node")
    late = materialize(open_links(opened, idf, threshold), "late")
    parts = components(links.unionByName(late))

    known = groups.join(parts, "node", "left").select("k1", "k2", "least", F.coalesce("component", "node").alias("part"))
    named = known.groupBy("part").agg(F.min("least").alias("class_id")).join(known, "part").select("k1", "k2", "part", "class_id")
    rows = drawn.groupBy("key", "k1", "k2").agg(F.count(F.lit(1)).alias("copies"))
    named = rows.join(named, ["k1", "k2"])
    first = named.where("key = class_id").groupBy("part").agg(F.min(F.struct("k1", "k2")).alias("first"))
    out = named.join(first, "part", "left").withColumn("kept", F.coalesce((F.col("key") == F.col("class_id")) & (F.struct("k1", "k2") == F.col("first")), F.lit(False)))
    given = lambda c: F.nullif(F.col(c), F.lit(NO_KEY)).alias(key if c == "key" else c)
    return out.select(given("key"), "k1", "k2", given("class_id"), "kept", "copies")


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = 0.8) -> DataFrame:
    """``docs`` with one document of each class, columns unchanged."""
    kept = materialize(classes(docs, key, text, threshold), "classes").where("kept").select(F.col(key).alias("_key"), "k1", "k2", "copies")
    docs, restore = seal(docs, key, text)
    words = F.coalesce(F.col(text), F.lit(""))
    marked = docs.withColumns({"_k1": F.xxhash64(words), "_k2": F.xxhash64(F.lit("2"), words)})
    chosen = marked.join(kept, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_k1") == F.col("k1")) & (F.col("_k2") == F.col("k2")))
    once = restore(chosen.where("copies = 1"))
    again = restore(chosen.where("copies > 1").dropDuplicates(["_key", "k1", "k2"]))
    return once.unionByName(again)
