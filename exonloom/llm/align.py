"""Operator 13: alignment of two tokenizers by whitespace-token anchors.

Every whole text is tokenised by both: a byte-level BPE (A, over a space and the text) and a
piece model (B, which adds that space itself). Where a token of A and one of B end at the same
byte and a space follows, both next tokens are space-marked: such verified ends are anchors that
part a document into windows of token ids, mostly one word each. A window's alignment depends on
its two id tuples alone, so it is worked out once and remembered: its groups (token stretches
between shared ends) and its links (pairs of tokens that share bytes).

In how many documents a pair of ids is linked is counted over the whole corpus. Texts are
tokenised once; a batch of them is written with its distinct pairs, asks for their counts by
buckets of A ids, and is joined with the answers. No row holds more than one batch of texts.

A null or empty text, and one whose tokens do not spell it byte by byte, has no tokens: zeros and
empty groups. Special tokens' strings are plain text. Equal rows count as documents each; an empty
table gives no rows; columns other than the key are left out.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from exonloom.scale import materialize

from .common import row_spans
from .spans import from_planes, planes
from .tokens import Encoder

#: Buckets of A ids, batches that ask together, bytes of text in a batch, bytes of remembered windows in a task.
BUCKETS, TOGETHER, BATCH, REMEMBERED = 64, 4096, 2 << 20, 64 << 20
_OF_B = 1 << 31


class Tokenizers:
    """Both tokenizers of a task, the bytes of their ids, and the alignments of known windows."""

    def __init__(self, a: str, b: str):
        import sentencepiece

        self.encoder = Encoder(a)
        spelled = self.encoder.id_bytes()
        self.a_bytes = [spelled.get(i, b"") for i in range(max(spelled) + 1)]
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=b)
        piece = [self.pieces.id_to_piece(i) for i in range(self.pieces.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:-1], 16)]) if self.pieces.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(piece)]
        self.shown = [f"{i}{mark}" for size, marks in ((len(self.a_bytes), ",|"), (len(piece), ",;")) for i in range(size) for mark in marks]
        self.a_size, self.b_size = (np.array([len(x) for x in t]) for t in (self.a_bytes, self.b_bytes))
        self.forget()

    def forget(self) -> None:
        self.number: dict[bytes, int] = {}
        self.groups: list[str] = []
        self.links, self.first_link = np.zeros(0, np.int64), np.zeros(1, np.int64)
        self.held = 0

    def ids(self, texts: list[str | None]) -> list[tuple[list[int], list[int]]]:
        """Ids by A and by B of each text; none where they do not spell the text."""
        out = []
        for t, b in zip(texts, self.pieces.encode([t or "" for t in texts], num_threads=1)):
            a = self.encoder.plain_ids(" " + t) if t else []
            whole = (" " + t).encode() if t else b""
            fits = b"".join(map(self.a_bytes.__getitem__, a)) == whole == b"".join(map(self.b_bytes.__getitem__, b))
            out.append((a, b) if fits and t else ([], []))
        return out

    def windows(self, a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> np.ndarray:
        """Number of each window ``a[cut_a[k]:cut_a[k + 1]]``, ``b[cut_b[k]:cut_b[k + 1]]``.

        A window's key is its tuple of ids, those of B marked by their highest bit.
        """
        if self.held > REMEMBERED:
            self.forget()
        in_a, in_b = (np.repeat(np.arange(len(cut) - 1), np.diff(cut)) for cut in (cut_a, cut_b))
        ids = np.empty(len(a) + len(b), "<u4")
        ids[np.arange(len(a)) + cut_b[in_a]] = a
        ids[np.arange(len(b)) + cut_a[in_b + 1]] = b | _OF_B
        packed, cut = ids.tobytes(), (4 * (cut_a + cut_b)).tolist()
        keys = [packed[s:e] for s, e in zip(cut, cut[1:])]
        known = self.number
        numbers = [known.setdefault(k, len(known)) for k in keys]
        out = np.array(numbers, np.int64)
        if len(known) > len(self.groups):
            fresh = np.flatnonzero(out >= len(self.groups))
            _, one = np.unique(out[fresh], return_index=True)
            self.learn(fresh[one], a, b, cut_a, cut_b)
        return out

    def learn(self, at: np.ndarray, a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> None:
        """Aligns the windows ``at``, all at once: every stretch between two ends of any side is a link,
        and every end of both sides closes a group."""
        a, of_a = _stretches(a, cut_a, at)
        b, of_b = _stretches(b, cut_b, at)
        stop_a, stop_b = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        end_a, end_b = ends_of(self.a_size[a], stop_a[-1]), ends_of(self.b_size[b], stop_a[-1])
        stops, shared = np.flatnonzero(end_a | end_b), np.flatnonzero(end_a & end_b)
        i, j = np.searchsorted(stop_a, stops), np.searchsorted(stop_b, stops)
        size = np.bincount(of_a[i], minlength=len(at))
        self.links = np.concatenate([self.links, a[i] << 32 | b[j]])
        self.first_link = np.concatenate([self.first_link, self.first_link[-1] + np.cumsum(size)])
        last_a, last_b = end_b[stop_a], end_a[stop_b]
        turn = np.concatenate([2 * np.searchsorted(shared, stop_a), 2 * np.searchsorted(shared, stop_b) + 1])
        word = np.concatenate([2 * a + last_a, 2 * (len(self.a_bytes) + b) + last_b])[np.argsort(turn, kind="stable")]
        shown = list(map(self.shown.__getitem__, word.tolist()))
        cut = np.concatenate([[0], np.cumsum(np.bincount(of_a, minlength=len(at)) + np.bincount(of_b, minlength=len(at)))]).tolist()
        self.groups += ["".join(shown[s:e]) for s, e in zip(cut, cut[1:])]
        self.held += 250 * len(at) + 20 * len(word) + 8 * len(i)


def _stretches(ids: np.ndarray, cut: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the windows ``at`` on end, and whose each one is."""
    size = cut[at + 1] - cut[at]
    own = np.repeat(np.arange(len(at)), size)
    return ids[np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + cut[at][own]], own


def ends_of(sizes: np.ndarray, total: int) -> np.ndarray:
    """Flags of the bytes (0 to ``total``) at which a token ends."""
    flags = np.zeros(total + 1, bool)
    flags[np.cumsum(sizes)] = True
    return flags


def align_texts(known: Tokenizers, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(A tokens, B tokens, first window of each text (n + 1), window numbers)."""
    ids = known.ids(texts)
    n_a, n_b = (np.array([len(x[side]) for x in ids]) for side in (0, 1))
    a, b = (np.fromiter(chain.from_iterable(x[side] for x in ids), np.int64, n.sum()) for side, n in ((0, n_a), (1, n_b)))
    data = np.frombuffer(b"".join(b" " + t.encode() for t, x in zip(texts, ids) if x[0]), np.uint8)
    end_a, end_b = ends_of(known.a_size[a], len(data)), ends_of(known.b_size[b], len(data))
    begins = np.zeros(len(data) + 1, bool)
    begins[np.cumsum([0] + [1 + len(t.encode()) for t, x in zip(texts, ids) if x[0]])] = True
    anchor = begins.copy()
    anchor[:-1] |= end_a[:-1] & end_b[:-1] & (data == 0x20)
    at = np.flatnonzero(anchor)
    cut_a, cut_b = (np.cumsum(end)[at] for end in (end_a, end_b))
    numbers = known.windows(a, b, cut_a, cut_b) if len(data) else np.zeros(0, np.int64)
    first = np.searchsorted(cut_a, np.concatenate([[0], np.cumsum(n_a)])) if len(data) else np.zeros(len(texts) + 1, np.int64)
    return n_a, n_b, first, numbers


def bucket_of(a):
    """Bucket of an A id, for arrays and for columns."""
    return a % BUCKETS


def linked(known: Tokenizers, first: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(distinct pairs by bucket and pair, and of each text and pair in it: text, place among the pairs, links)."""
    used, mine = np.unique(numbers, return_inverse=True)
    links, _ = _stretches(known.links, known.first_link, used)
    size = np.diff(known.first_link)[used]
    pairs, place = np.unique(links, return_inverse=True)
    order = np.lexsort((pairs, bucket_of(pairs >> 32)))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    place, begin = rank[place], np.cumsum(size) - size
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    once, times = np.unique(text * len(used) + mine, return_counts=True) if len(used) else (np.zeros(0, np.int64),) * 2
    text, window = np.divmod(once, max(len(used), 1))
    many = size[window]
    inside = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    at = place[np.repeat(begin[window], many) + inside]
    both, back = np.unique(np.repeat(text, many) * max(len(pairs), 1) + at, return_inverse=True)
    total = np.bincount(back, np.repeat(times, many), len(both)).astype(np.int64)
    text, at = np.divmod(both, max(len(pairs), 1))
    return pairs[order], text, at, total


def tokenise(docs: DataFrame, a: str, b: str, key: str, text: str, describe: tuple) -> DataFrame:
    """One row per document with its counts and packed links, and one per batch with its pairs."""
    name, kind, digest = describe
    key_type = docs.schema[key].dataType.simpleString()
    schema = f"batch long, key {key_type}, n_a long, n_b long, n_groups long, n_links long, {name} {kind}, at binary, times binary, pairs binary, docs binary"

    def run(batches):
        from pyspark import TaskContext

        known, number = Tokenizers(a, b), TaskContext.get().partitionId() << 32
        for batch in batches:
            for i, j in row_spans(batch.column(1), BATCH):
                n_a, n_b, first, numbers = align_texts(known, batch.column(1).slice(i, j - i).to_pylist())
                pairs, doc, at, times = linked(known, first, numbers)
                cut = np.searchsorted(doc, np.arange(j - i + 1))
                shown, begin = list(map(known.groups.__getitem__, numbers.tolist())), first.tolist()
                spelled = [digest("".join(shown[s:e])[:-1]) for s, e in zip(begin, begin[1:])]
                per_doc = [range(s, e) for s, e in zip(cut, cut[1:])]
                links = np.array([times[r.start:r.stop].sum() for r in per_doc])
                none = pa.nulls(j - i, pa.binary())
                columns = [pa.array(np.full(j - i, number)), batch.column(0).slice(i, j - i), pa.array(n_a), pa.array(n_b), pa.array(n_a + n_b - links), pa.array(links), pa.array(spelled),
                           pa.array([planes(at[r.start:r.stop].astype(np.int32)) for r in per_doc], pa.binary()), pa.array([planes(times[r.start:r.stop].astype(np.int32)) for r in per_doc], pa.binary()), none, none]
                names = ["batch", "key", "n_a", "n_b", "n_groups", "n_links", name, "at", "times", "pairs", "docs"]
                made = pa.RecordBatch.from_arrays(columns, names=names)
                yield made
                if len(pairs):
                    held = np.bincount(at, minlength=len(pairs))
                    own = {"batch": [number], "pairs": [planes(pairs)], "docs": [planes(held.astype(np.int32))]}
                    yield pa.RecordBatch.from_arrays([pa.array(own[f.name], f.type) if f.name in own else pa.nulls(1, f.type) for f in made.schema], schema=made.schema)
                number += 1

    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, schema)


def pair_counts(batches: DataFrame) -> DataFrame:
    """``pair`` (A id << 32 | B id) and in how many documents it is linked; summed up in every task first."""

    def run(rows):
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def summed():
            pair, back = np.unique(np.concatenate([p for p, _ in held]), return_inverse=True)
            return pair, np.bincount(back, np.concatenate([n for _, n in held])).astype(np.int64)

        for batch in rows:
            for p, n in zip(batch.column(0), batch.column(1)):
                held.append((from_planes(p.as_py(), np.int64), from_planes(n.as_py(), np.int32)))
                if sum(len(x) for x, _ in held) > 1 << 21:
                    held = [summed()]
                    if len(held[0][0]) > 1 << 20:
                        yield pa.RecordBatch.from_arrays([*map(pa.array, held.pop())], names=["pair", "docs"])
        if held:
            yield pa.RecordBatch.from_arrays([*map(pa.array, summed())], names=["pair", "docs"])

    return batches.select("pairs", "docs").mapInArrow(run, "pair long, docs long").groupBy("pair").agg(F.sum("docs").alias("docs"))


def answers(batches: DataFrame, counts: DataFrame) -> DataFrame:
    """``batch``, ``bucket``, the corpus-wide ``counts`` of its pairs there, and which are the highest of their A id.

    All pairs of an A id lie in one bucket; about ``TOGETHER`` batches ask a bucket at a time, so
    that a frequent id never brings all batches into one task.
    """
    turns = -(-max(batches.count(), 1) // TOGETHER)

    def ask(rows):
        for batch in rows:
            for number, turn, packed in zip(*(batch.column(c).to_pylist() for c in range(3))):
                pairs = from_planes(packed, np.int64)
                bucket = bucket_of(pairs >> 32)
                parts = np.split(np.arange(len(pairs)), np.flatnonzero(np.diff(bucket)) + 1)
                yield pa.RecordBatch.from_pydict({"bucket": pa.array(bucket[[p[0] for p in parts]]), "turn": pa.array([turn] * len(parts), pa.int64()),
                                                  "batch": pa.array([number] * len(parts), pa.int64()), "pairs": pa.array([planes(pairs[p]) for p in parts], pa.binary())})

    def answer(asked, found):
        pair, n = found.column("pair").to_numpy(), found.column("docs").to_numpy()
        order = np.argsort(pair)
        pair, n = pair[order], n[order]
        opens = np.flatnonzero(np.append(True, np.diff(pair >> 32) != 0)) if len(pair) else np.zeros(0, np.int64)
        best = n == np.repeat(np.maximum.reduceat(n, opens), np.diff(np.append(opens, len(pair)))) if len(pair) else np.zeros(0, bool)
        at = [np.searchsorted(pair, from_planes(p, np.int64)) for p in asked.column("pairs").to_pylist()]
        return pa.table({"batch": asked.column("batch"), "bucket": asked.column("bucket"), "counts": pa.array([planes(n[x]) for x in at], pa.binary()),
                         "best": pa.array([best[x].tobytes() for x in at], pa.binary())})

    turn = F.pmod(F.xxhash64("batch"), F.lit(turns)).alias("turn")
    asked = batches.select("batch", turn, "pairs").mapInArrow(ask, "bucket long, turn long, batch long, pairs binary")
    dealt = counts.select(bucket_of(F.shiftright("pair", 32)).alias("bucket"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(turns - 1).cast("long"))).alias("turn"), "pair", "docs")
    return asked.groupBy("bucket", "turn").cogroup(dealt.groupBy("bucket", "turn")).applyInArrow(answer, "batch long, bucket long, counts binary, best binary")


def align(docs: DataFrame, a: str, b: str, key: str = "doc_id", text: str = "text", describe: tuple = ("groups", "string", str)) -> DataFrame:
    """One row per document: ``key``, tokens ``n_a`` and ``n_b``, ``n_groups``, ``groups`` (A ids and B ids
    as ``1,2|3;4|5,6``), ``n_links``, and of its links ``n_best`` (those whose id pair is linked in most
    documents among the pairs of its A id) and ``count_sum`` (documents that hold its pair, over all links).

    ``a``: file of a byte-level BPE; ``b``: piece model. ``describe``: column, type and function that
    stand in for ``groups``, so that a digest need not carry the whole string.
    """
    name, kind, _ = describe
    parts = materialize(tokenise(docs, a, b, key, text, describe), "aligned")
    batches = parts.where("pairs is not null")
    replies = answers(batches, pair_counts(batches))
    key_type = parts.schema["key"].dataType.simpleString()
    shown = ["key", "n_a", "n_b", "n_groups", "n_links", name]

    def settle(rows, found):
        order = np.argsort(found.column("bucket").to_numpy())
        counts, best = ([found.column(c)[int(i)].as_py() for i in order] for c in ("counts", "best"))
        counts = np.concatenate([from_planes(x, np.int64) for x in counts]) if counts else np.zeros(0, np.int64)
        best = np.frombuffer(b"".join(best), bool)
        n_best, total = [], []
        for at, times in zip(*(rows.column(c).to_pylist() for c in ("at", "times"))):
            at, times = from_planes(at, np.int32), from_planes(times, np.int32).astype(np.int64)
            n_best.append(int(times[best[at]].sum()))
            total.append(int((times * counts[at]).sum()))
        return rows.select(shown).append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(total, pa.int64()))

    rows = parts.where("pairs is null").select("batch", *shown, "at", "times")
    out = rows.groupBy("batch").cogroup(replies.groupBy("batch")).applyInArrow(
        settle, f"key {key_type}, n_a long, n_b long, n_groups long, n_links long, {name} {kind}, n_best long, count_sum long")
    return out.withColumnRenamed("key", key)
