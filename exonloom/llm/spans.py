"""Operator 10: substring deduplication by fixed-block anchors.

Every text is indexed by its non-overlapping blocks of 7 words. Any window of 13 words holds a
whole block, so a window that two documents share shows up where a rolling 7-word probe of one
meets a block of the other. Such hits are extended: all 13-word windows around them are looked
up by their hash, and consecutive windows found again form the maximal exact repeats. A word is
removed where a window covers it that also starts in a document with a smaller key.

Probes and windows travel as packed arrays, one row per batch of texts and hash bucket. Within a
batch a hash is sent once: what batch-mates share is settled on the spot, so a passage that is in
a third of all documents arrives at most once per batch. Buckets follow the size of the input.
Batches are cut from scans and from joins sorted by key, so a task that runs again cuts the same.

Null text has no words; a null key counts as the least; rows equal in key and text are handled
alike and never make each other repeats; an empty table gives no rows; other columns stay.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import seal, splits, texts_of
from .near import whole

BLOCK, WINDOW = 7, 13
BATCH = 6 << 20
#: A row holds the entries of one batch and bucket (``hash, at, lone, key``), or, once for each batch,
#: its documents (``docs, text_keys, starts``) with the places ``at`` that need no answer.
PACKED = "bucket int, batch long, hash binary, at binary, lone binary, key binary, docs binary, text_keys binary, starts binary"
ANSWERS = "batch long, at binary, docs binary, text_keys binary, starts binary"


def planes(x: np.ndarray) -> bytes:
    """Steps of an integer array by byte plane, so that planes of zeros compress away."""
    steps = np.diff(x, prepend=x.dtype.type(0))
    return steps.view(np.uint8).reshape(-1, x.itemsize).T.tobytes()


def from_planes(data: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.cumsum(np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel(), dtype=kind)


def _batches(batches, columns):
    """(number, keys, text keys, Texts, record batch, first row) of consecutive texts."""
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 24
    for batch in batches:
        key, text_key = (batch.column(c).to_numpy(zero_copy_only=False) for c in columns[:2])
        for i, t in texts_of(batch.column(columns[2]), BATCH):
            number += 1
            s = slice(i, i + len(t))
            yield number, key[s], text_key[s], t, batch, i


def _runs(values: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal sorted values."""
    return np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.zeros(0, np.int64)


def _packed(number, buckets, hashes, at, lone, keys, kind, t, docs, text_keys, settled):
    """Record batch of one batch of texts: its entries by bucket (``at`` ascends) and its documents."""
    bucket = ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    rows = [(number % buckets, number, b"", planes(settled.astype(np.uint32)), b"", b"", docs.tobytes(), text_keys.tobytes(), t.first[:-1].astype(np.uint32).tobytes())]
    for part in np.split(order, _runs(bucket[order])[1:]) if len(order) else ():
        rows.append((int(bucket[part[0]]), number, hashes[part].astype(kind).tobytes(), planes(at[part].astype(np.uint32)), lone[part].tobytes() if len(lone) else b"", b"" if keys is None else planes(keys[part]), None, None, None))
    kinds = (pa.int32(), pa.int64(), *[pa.binary()] * 7)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=[c.split()[0] for c in PACKED.split(", ")])


def probes(docs: DataFrame, columns: tuple[str, str, str], buckets: int) -> DataFrame:
    """Rolling block hashes of all texts, packed. ``lone`` bit 0: hash of one document of the batch
    only, to be answered; bit 1: some place of it is a reference block."""

    def run(batches):
        for number, keys, text_keys, t, _, _ in _batches(batches, columns):
            h, at = t.windows(BLOCK)
            if not len(h):
                continue
            owner = np.searchsorted(t.first, at, "right") - 1
            block = (at - t.first[owner]) % BLOCK == 0
            order = np.argsort(h, kind="stable")
            edges = _runs(h[order])
            size = np.diff(np.append(edges, len(order)))
            own = owner[order]
            several = np.repeat(own[edges] != own[edges + size - 1], size)  # equal hashes stand in order of texts
            indexed = np.repeat(np.maximum.reduceat(block[order], edges), size)
            first = np.zeros(len(order), bool)
            first[edges] = True
            send = first | ~several
            sent = order[send]
            lone = (~several[send]).astype(np.uint8) | (np.where(several[send], indexed[send], block[sent]).astype(np.uint8) << 1)
            back = np.argsort(sent)
            # what batch-mates share needs no answer
            yield _packed(number, buckets, h[sent][back], at[sent][back], lone[back], None, np.uint32, t, keys, text_keys, np.sort(at[order[several]]))

    return docs.mapInArrow(run, PACKED)


def _answer(packed: DataFrame, kind, hits) -> DataFrame:
    """Looks at all entries of a bucket at once; ``hits(hash, batch, lone, key)`` gives the entries to report."""

    def run(keys, rows):
        out, parts, batches = [], [], rows.column("batch").to_pylist()
        columns = [rows.column(c).to_pylist() for c in ("hash", "at", "lone", "key", "docs", "text_keys", "starts")]
        for number, h, at, lone, key, docs, text_keys, starts in zip(batches, *columns):
            if docs is not None:
                out.append((number, at, docs, text_keys, starts))
            else:
                h = np.frombuffer(h, kind)
                parts.append((h, np.full(len(h), number), np.frombuffer(lone, np.uint8), from_planes(key, np.int64) if key else np.zeros(len(h), np.int64), from_planes(at, np.uint32)))
        if parts:
            h, batch, lone, key, at = (np.concatenate(x) for x in zip(*parts))
            good = np.sort(hits(h, batch, lone, key))
            for part in np.split(good, _runs(batch[good])[1:]) if len(good) else ():
                out.append((int(batch[part[0]]), planes(at[part]), None, None, None))
        fields = [pa.array(c, k) for c, k in zip(zip(*out), (pa.int64(), *[pa.binary()] * 4))] if out else [pa.array([], k) for k in (pa.int64(), *[pa.binary()] * 4)]
        return pa.Table.from_arrays(fields, names=[c.split()[0] for c in ANSWERS.split(", ")])

    def resolve(keys, rows):
        columns = [rows.column(c).to_pylist() for c in ("at", "docs", "text_keys", "starts")]
        places, table = [], None
        for at, docs, text_keys, starts in zip(*columns):
            places.append(from_planes(at, np.uint32))
            if docs is not None:
                table = np.frombuffer(docs, np.int64), np.frombuffer(text_keys, np.int64), np.frombuffer(starts, np.uint32).astype(np.int64)
        at = np.sort(np.concatenate(places)).astype(np.int64)
        doc = np.searchsorted(table[2], at, "right") - 1
        edges = _runs(doc)
        lists = pa.ListArray.from_arrays(pa.array(np.append(edges, len(at)), pa.int32()), pa.array(at - table[2][doc], pa.int32()))
        return pa.table({"key": pa.array(table[0][doc[edges]]), "text_key": pa.array(table[1][doc[edges]]), "at": lists})

    answers = packed.groupBy("bucket").applyInArrow(run, ANSWERS)
    return answers.groupBy("batch").applyInArrow(resolve, "key long, text_key long, at array<int>")


def anchors(packed: DataFrame) -> DataFrame:
    """``key, text_key, at``: places where a probe meets a block of another document."""

    def hits(h, batch, lone, key):
        order = np.argsort(h, kind="stable")
        edges = _runs(h[order])
        size, b = np.diff(np.append(edges, len(order))), batch[order]
        hit = (np.minimum.reduceat(b, edges) != np.maximum.reduceat(b, edges)) & (np.maximum.reduceat(lone[order] & 2, edges) > 0)
        good = order[np.repeat(hit, size)]
        return good[(lone[good] & 1) > 0]

    return _answer(packed, np.uint32, hits)


def candidates(found: DataFrame, columns: tuple[str, str, str], buckets: int) -> DataFrame:
    """Hashes of the windows around the anchors, packed. ``found``: ``columns`` and ``hits``.

    In a batch, documents above the least key of a window are settled; that one asks the others.
    """

    def run(batches):
        for number, keys, text_keys, t, batch, i in _batches(batches, columns):
            near = np.zeros(len(t.hashes) + 1, np.int32)
            for k, hits in enumerate(batch.column("hits").slice(i, len(t))):
                if hits.is_valid:
                    p = hits.values.to_numpy() + t.first[k]
                    np.add.at(near, np.maximum(p - (WINDOW - BLOCK), t.first[k]), 1)
                    np.add.at(near, p + 1, -1)
            near = np.cumsum(near[:-1]) > 0
            h, at = t.windows(WINDOW)
            h, at = h[near[at]], at[near[at]]
            if not len(h):
                continue
            own = keys[np.searchsorted(t.first, at, "right") - 1]
            order = np.argsort(h, kind="stable")
            edges = _runs(h[order])
            least = np.repeat(np.minimum.reduceat(own[order], edges), np.diff(np.append(edges, len(order))))
            later = own[order] > least
            ask = np.sort(order[~later])
            yield _packed(number, buckets, h[ask], at[ask], np.empty(0, np.uint8), own[ask], np.uint64, t, keys, text_keys, np.sort(at[order[later]]))

    return found.mapInArrow(run, PACKED)


def repeats(packed: DataFrame) -> DataFrame:
    """``key, text_key, at``: starts of windows that also start in a document with a smaller key."""

    def hits(h, batch, lone, key):
        order = np.argsort(h, kind="stable")
        edges = _runs(h[order])
        least = np.repeat(np.minimum.reduceat(key[order], edges), np.diff(np.append(edges, len(order))))
        return order[key[order] > least]

    return _answer(packed, np.uint64, hits)


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", tidy: bool = True) -> DataFrame:
    """``docs`` with ``text`` less the repeated words, ``n_words`` and ``n_removed``.

    ``tidy`` joins the kept words by one space; else what stands between them stays, and a removed
    word goes with the white space after it.
    """
    spark = docs.sparkSession
    docs, restore = seal(docs, key, text)
    buckets = max(64, 4 * splits(docs), 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    names = [f"c{i}" for i in range(len(docs.columns))]
    body = names[docs.columns.index(text)]
    own = docs.toDF(*names)
    own = own.withColumns({"_key": whole(names[docs.columns.index(key)]), "_text_key": F.xxhash64(F.coalesce(F.col(body), F.lit("")))})
    columns = ("_key", "_text_key", body)

    def joined(places: DataFrame) -> DataFrame:
        # rows equal in key and text may have got different places; all of them hold for each
        each = places.groupBy("key", "text_key").agg(F.array_distinct(F.flatten(F.collect_set("at"))).alias("hits"))
        return own.join(each, (F.col("_key") == F.col("key")) & (F.col("_text_key") == F.col("text_key")), "left").drop("key", "text_key")

    # both joins read the same columns of the documents, so one shuffle of the texts serves them
    # batches are numbered by the order of rows, so a task that runs again must see the same one whatever
    # join was chosen; a merge join has this order already and is not sorted again
    found = joined(anchors(probes(own.select(*columns), columns, buckets))).sortWithinPartitions("_key", "_text_key")
    marked = joined(repeats(candidates(found, columns, buckets)))
    schema = own.select(*names).schema.add("n_words", "long").add("n_removed", "long")

    def run(batches):
        for batch in batches:
            at_text = names.index(body)
            for i, t in texts_of(batch.column(at_text), BATCH):
                gone = np.zeros(len(t.hashes) + 1, np.int32)
                hits = batch.column("hits").slice(i, len(t))
                for k, starts in enumerate(hits):
                    if starts.is_valid:
                        p = starts.values.to_numpy() + t.first[k]
                        np.add.at(gone, p, 1)
                        np.add.at(gone, p + WINDOW, -1)
                keep = np.cumsum(gone[:-1]) == 0
                texts = batch.column(at_text).slice(i, len(t)).to_pylist()
                removed = np.zeros(len(t), np.int64)
                for k in range(len(t)):
                    a, b = t.first[k], t.first[k + 1]
                    removed[k] = b - a - keep[a:b].sum()
                    if tidy:
                        raw = t.data[t.bounds[k]:t.bounds[k + 1]].tobytes().split()
                        texts[k] = b" ".join([w for w, g in zip(raw, keep[a:b].tolist()) if g] if removed[k] else raw).decode()
                    elif removed[k]:
                        raw, ends = t.data[t.bounds[k]:t.bounds[k + 1]].tobytes(), np.append(t.starts[a + 1:b], t.bounds[k + 1]) - t.bounds[k]
                        begins = t.starts[a:b] - t.bounds[k]
                        texts[k] = (raw[:begins[0]] + b"".join(raw[x:y] for x, y, g in zip(begins, ends, keep[a:b]) if g)).decode()
                columns = [batch.column(n).slice(i, len(t)) for n in names]
                columns[at_text] = pa.array(texts, pa.string())
                yield pa.RecordBatch.from_arrays([*columns, pa.array(t.words_per_text().astype(np.int64)), pa.array(removed)], names=schema.names)

    cut = marked.mapInArrow(run, schema).toDF(*docs.columns, "n_words", "n_removed")
    return restore(cut, "n_words", "n_removed")
