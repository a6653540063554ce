"""Operator 4: document probability by a subword lattice.

The units are the pieces of an existing vocabulary file. A word is spelled by a first piece,
further pieces and a stop; all ways to cut it count, and a forward recursion in log space sums
them. The file's own scores start the unit probabilities, which expected counts over the
distinct training words (forward and backward, all segmentations) then refine. A word seen in
training may also come whole, with its relative frequency; the share of spelled words is the
share of training tokens seen once. Words do not overlap, so the recursion over a text is the
sum over its words and its end. It starts in one of a few states, the languages of the training
documents, each with its own frequencies of whole words; the text's probability is the sum over
the states, so its own language label is not used.

Word counts stay a table: texts are dealt into batches, a batch asks for its distinct words, and
the answers meet it again. Only unit probabilities, as many as the file has pieces, are sent to all.

Null text is empty (its end alone); a null key counts as the empty string for the split; equal rows
score alike; an empty table gives no rows; other columns have no part in it.
"""

from __future__ import annotations

import math
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from exonloom.scale import materialize

from .common import _BYTE, _INV, _POW, Texts, splits, texts_of

SHORT, PLAIN = 64, 24
TOP_BITS, CODE_BITS = 20, 18
SPREAD = np.uint64(0xD6E8FEB86659FD93)
MARK = "▁".encode()


class Units:
    """Pieces of a vocabulary file as bytes: those that open a word, those that go on, and the stop."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=path)
        self.pieces: list[tuple[bool, bytes]] = []
        rank = []
        for i in range(sp.get_piece_size()):
            if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                continue
            text = sp.id_to_piece(i)
            piece = bytes([int(text[3:5], 16)]) if sp.is_byte(i) else text.encode()
            if piece != piece.lower() or MARK in piece[1:]:
                continue
            opens = piece.startswith(MARK) and not sp.is_byte(i)
            self.pieces.append((opens, piece[len(MARK):] if opens else piece))
            rank.append(-sp.get_score(i))
        self.start = 1 / (2.7 + np.array(rank))
        self.opens = np.array([o for o, _ in self.pieces])
        self.index: tuple[dict[bytes, list[int]], dict[bytes, list[int]]] = ({}, {})
        for k, (o, p) in enumerate(self.pieces):
            self.index[not o].setdefault(p, []).append(k)
        self.tables = [self._table(ix) for ix in self.index]
        self.reach = [self._reach(t[4]) for t in self.tables]

    @staticmethod
    def _reach(strings: list[bytes]) -> np.ndarray:
        """Length of the longest string that starts with three bytes of each code (0: none does)."""
        out = np.zeros(1 << CODE_BITS, np.uint8)
        for s in strings:
            if len(s) > 2:
                k = prefix_code(*(np.array([x], np.uint32) for x in s[:3]))[0]
                out[k] = max(out[k], min(len(s), 255))
        return out

    @staticmethod
    def _table(index: dict[bytes, list[int]]):
        """Distinct strings by hash: sorted hashes, their strings' numbers, first and number of hashes
        for each value of the top bits, the lengths that occur, the strings."""
        strings = [s for s in index if s]
        h = np.array([string_hash(s) for s in strings], np.uint64)
        order = np.argsort(h)
        h, top = h[order], (h[order] >> np.uint64(64 - TOP_BITS)).astype(np.int64)
        count = np.bincount(top, minlength=1 << TOP_BITS).astype(np.int8)
        first = np.full(1 << TOP_BITS, -1, np.int32)
        first[top[::-1]] = np.arange(len(h))[::-1]
        return h, order, (first, count), sorted({len(s) for s in strings}), strings

    def weights(self, p: np.ndarray) -> "Weights":
        return Weights(self, p)


def prefix_code(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Code of three bytes, ``CODE_BITS`` wide."""
    return ((a << 16 | b << 8 | c) * np.uint32(0x9E3779B1)) >> np.uint32(32 - CODE_BITS)


def string_hash(s: bytes) -> int:
    part = _BYTE[np.frombuffer(s, np.uint8)]
    with np.errstate(over="ignore"):
        return int(((part * _POW[:len(part)]).sum() * SPREAD))


def _add(x: float, y: float) -> float:
    """log(exp(x) + exp(y))."""
    hi, lo = max(x, y), min(x, y)
    return hi + (math.log1p(math.exp(lo - hi)) if lo > -math.inf else 0.0)


class Weights:
    """Log probabilities of all strings that units spell. ``p``: one number per unit, then the stop.

    Opening units share one distribution; the others and the stop share another.
    """

    def __init__(self, units: Units, p: np.ndarray):
        o = units.opens
        p = p.copy()
        first, rest = p[:-1][o].sum(), p[:-1][~o].sum() + p[-1]
        p[:-1][o] /= first
        p[:-1][~o] /= rest
        p[-1] /= rest
        self.units, self.p, self.stop = units, p, math.log(p[-1])
        self.bare = math.log(sum(p[k] for k in units.index[0].get(b"", [])) or 1e-300)
        self.logs = [np.array([math.log(sum(p[k] for k in ix[s])) for s in t[4]] or [0.0]) for ix, t in zip(units.index, units.tables)]
        self.by_string = [dict(zip(t[4], lg)) for t, lg in zip(units.tables, self.logs)]

    def _lookup(self, kind: int, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows, string numbers) of the hashes that are known."""
        known, string, (first, count), _, _ = self.units.tables[kind]
        top = (h >> np.uint64(64 - TOP_BITS)).astype(np.int64)
        rows = np.flatnonzero(count[top])
        top, h = top[rows], h[rows]
        at, more, found = first[top], count[top], np.full(len(rows), -1, np.int64)
        for k in range(int(more.max(initial=0))):
            same = (more > k) & (known[np.minimum(at + k, len(known) - 1)] == h)
            found[same] = string[at[same] + k]
        hit = found >= 0
        return rows[hit], found[hit]

    def _arcs(self, words: np.ndarray):
        """(kind, from, to, rows, string numbers) of all substrings of equally long words that are units."""
        n, size = words.shape
        sums = np.zeros((size + 1, n), np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(_BYTE[words.T] * _POW[:size, None], axis=0, out=sums[1:])
            wide = words.T.astype(np.uint32)
            for kind in (0, 1):
                for i in range(1 if kind == 0 else size):
                    reach = self.units.reach[kind][prefix_code(*wide[i:i + 3])] if i + 3 <= size else None
                    for length in self.units.tables[kind][3]:
                        if i + length > size:
                            break
                        if length < 3:
                            rows, found = self._lookup(kind, (sums[i + length] - sums[i]) * (_INV[i] * SPREAD))
                        else:
                            some = np.flatnonzero(reach >= min(length, 255))
                            rows, found = self._lookup(kind, (sums[i + length][some] - sums[i][some]) * (_INV[i] * SPREAD))
                            rows = some[rows]
                        if len(rows):
                            yield kind, i, i + length, rows, found

    def forward(self, words: np.ndarray, counts: np.ndarray | None = None, into: list[np.ndarray] | None = None) -> np.ndarray:
        """Log probability of each of the equally long words (rows of bytes).

        With ``counts`` adds the expected uses of each string to ``into`` (opening, other, [bare, stop]).
        """
        n, size = words.shape
        if counts is not None and size <= PLAIN:
            return self._expected(words, counts, into)
        a = np.full((size + 1, n), -np.inf)
        a[0] = self.bare
        arcs = []
        for kind, i, j, rows, found in self._arcs(words):  # opening ones first, the others from left to right
            score = self.logs[kind][found]
            a[j, rows] = np.logaddexp(a[j, rows], score if kind == 0 else a[i, rows] + score)
            if counts is not None:
                arcs.append((kind, i, j, rows, found, score))
        total = a[size] + self.stop
        if counts is not None:
            b = np.full((size + 1, n), -np.inf)
            b[size] = self.stop
            for kind, i, j, rows, found, score in reversed(arcs):
                onward = score + b[j, rows]
                here = onward + (0 if kind == 0 else a[i, rows]) - total[rows]
                into[kind] += np.bincount(found, np.exp(here) * counts[rows], len(into[kind]))
                if kind:
                    b[i, rows] = np.logaddexp(b[i, rows], onward)
            into[2] += ((np.exp(self.bare + b[0] - total) * counts).sum(), counts.sum())
        return total

    def _expected(self, words: np.ndarray, counts: np.ndarray, into: list[np.ndarray]) -> np.ndarray:
        """``forward`` with counts for words so short that products of probabilities stay far from
        underflow: the same sums without logarithms at every arc."""
        n, size = words.shape
        bare, stop, plain = math.exp(self.bare), math.exp(self.stop), self.plain
        a, b, arcs = np.zeros((size + 1, n)), np.zeros((size + 1, n)), []
        a[0], b[size] = bare, stop
        for arc in self._arcs(words):
            kind, i, j, rows, found = arc
            score = plain[kind][found]
            a[j, rows] += score if kind == 0 else a[i, rows] * score
            arcs.append((*arc, score))
        total = a[size] * stop
        share = np.divide(counts, total, out=np.zeros(n), where=total > 0)
        for kind, i, j, rows, found, score in reversed(arcs):
            onward = score * b[j, rows]
            into[kind] += np.bincount(found, (onward * a[i, rows] if kind else onward) * share[rows], len(into[kind]))
            if kind:
                b[i, rows] += onward
        into[2] += ((bare * b[0] * share).sum(), counts.sum())
        with np.errstate(divide="ignore"):
            return np.log(total)

    @cached_property
    def plain(self) -> list[np.ndarray]:
        return [np.exp(x) for x in self.logs]

    @cached_property
    def numbers(self) -> list[dict[bytes, int]]:
        return [{s: k for k, s in enumerate(t[4])} for t in self.units.tables]

    def long_word(self, word: bytes, count: float | None = None, into: list[np.ndarray] | None = None) -> float:
        """Same for one word of any length, without tables of all its substrings."""
        first, rest = self.by_string
        lengths = [t[3] for t in self.units.tables]
        a = [-math.inf] * (len(word) + 1)
        a[0] = self.bare
        for n in lengths[0]:
            s = first.get(word[:n]) if n <= len(word) else None
            if s is not None:
                a[n] = _add(a[n], s)
        for i in range(len(word)):
            if a[i] > -math.inf:
                for n in lengths[1]:
                    s = rest.get(word[i:i + n]) if i + n <= len(word) else None
                    if s is not None:
                        a[i + n] = _add(a[i + n], a[i] + s)
        total = a[-1] + self.stop
        if count is None or total == -math.inf:
            return total
        b = [-math.inf] * len(word) + [self.stop]
        for i in range(len(word) - 1, -1, -1):
            if a[i] > -math.inf:
                for n in lengths[1]:
                    s = rest.get(word[i:i + n]) if i + n <= len(word) else None
                    if s is not None and b[i + n] > -math.inf:
                        b[i] = _add(b[i], s + b[i + n])
                        into[1][self.numbers[1][word[i:i + n]]] += count * math.exp(a[i] + s + b[i + n] - total)
        for n in lengths[0]:
            s = first.get(word[:n]) if n <= len(word) else None
            if s is not None:
                into[0][self.numbers[0][word[:n]]] += count * math.exp(s + b[n] - total)
        into[2] += (math.exp(self.bare + b[0] - total) * count, count)
        return total

    def words(self, t: Texts, counts: np.ndarray | None = None, into: list[np.ndarray] | None = None) -> np.ndarray:
        """Log probability of every word of the batch."""
        out, sizes = np.empty(len(t.starts)), t.ends - t.starts
        for size in np.unique(sizes):
            rows = np.flatnonzero(sizes == size)
            if size > SHORT:
                out[rows] = [self.long_word(t.word(r), None if counts is None else counts[r], into) for r in rows]
                continue
            for k in range(0, len(rows), 20000):
                r = rows[k:k + 20000]
                out[r] = self.forward(t.data[t.starts[r][:, None] + np.arange(size)], None if counts is None else counts[r], into)
        return out


def distinct_words(t: Texts) -> tuple[np.ndarray, np.ndarray]:
    """(a place of each distinct word, group of each word)."""
    _, at, group = np.unique(t.hashes, return_index=True, return_inverse=True)
    return at, group


def count_words(docs: DataFrame, states: int) -> DataFrame:
    """``word, c0, c1, ...``: how often training documents of each state hold it (0: only others do).

    ``docs``: ``text, held_out, state``.
    """
    names = [f"c{z}" for z in range(states)]

    def run(batches):
        for batch in batches:
            held, state = (batch.column(c).to_numpy(zero_copy_only=False) for c in (1, 2))
            for i, t in texts_of(batch.column(0), lower=True):
                at, group = distinct_words(t)
                train = np.repeat(~held[i:i + len(t)], t.words_per_text())
                own = np.repeat(state[i:i + len(t)], t.words_per_text()).astype(np.int64)
                counts = np.bincount(group * states + own, train, len(at) * states).astype(np.int64).reshape(-1, states)
                yield pa.RecordBatch.from_arrays([pa.array([t.word(k) for k in at], pa.binary()), *[pa.array(counts[:, z]) for z in range(states)]], names=["word", *names])

    found = docs.select("text", "held_out", "state").mapInArrow(run, "word binary, " + ", ".join(f"{c} long" for c in names))
    return found.groupBy("word").agg(*[F.sum(c).alias(c) for c in names])


def as_texts(words) -> Texts:
    """One word per text."""
    (_, t), = texts_of(words.cast(pa.large_binary()).view(pa.large_string()), 1 << 62, rows=1 << 62)
    return t


def gathered(batches, rows: int = 300_000):
    """Record batches of about ``rows`` rows: words of one length are worked on together, so few make much ado."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += len(batch)
        if n >= rows:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def refine(types: DataFrame, units: Units, p: np.ndarray) -> np.ndarray:
    """One round of expected counts over the training words; a little of the old scores stays."""
    spark = types.sparkSession
    shared = spark.sparkContext.broadcast(units.weights(p))

    def run(batches):
        weights = shared.value
        into = [np.zeros(len(lg)) for lg in weights.logs] + [np.zeros(2)]
        for part in gathered(batches):
            weights.words(as_texts(part.column(0)), np.ones(len(part)), into)
        for kind, x in enumerate(into):
            at = np.flatnonzero(x)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), kind)), pa.array(at), pa.array(x[at])], names=["kind", "at", "n"])

    found = types.where("c > 0").select("word").mapInArrow(run, "kind long, at long, n double").groupBy("kind", "at").agg(F.sum("n").alias("n")).collect()
    old = shared.value.p
    new = old * 0.01
    strings = [t[4] for t in units.tables]
    for kind, at, n in found:
        if kind == 2:
            where = units.index[0].get(b"", []) if at == 0 else [len(old) - 1]
        else:
            where = units.index[kind][strings[kind][at]]
        whole = sum(old[k] for k in where) or 1.0
        for k in where:
            new[k] += n * old[k] / whole
    return new


def score(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", state: str | None = "lang", states: int = 8, rounds: int = 3, shared: float = 0.1) -> DataFrame:
    """``key, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every text.

    ``states``: the most frequent values of ``state`` get a state each, all others share the last.
    ``shared``: weight of the frequencies over all documents within each state.
    """
    spark = docs.sparkSession
    held = F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 10 == 0
    own = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"), held.alias("held_out"), (F.col(state) if state else F.lit("")).alias("label"))
    labels = [r[0] for r in own.where("not held_out and label is not null").groupBy("label").count().orderBy(F.desc("count"), "label").limit(states - 1).collect()]
    number = F.lit(len(labels))
    for z, label in enumerate(labels):
        number = F.when(F.col("label") == label, z).otherwise(number)
    per_split = -(-_bytes(spark.conf.get("spark.sql.files.maxPartitionBytes")) // (8 << 20))
    batches = max(64, per_split * splits(docs))
    own = own.withColumns({"state": number.cast("int"), "batch": F.pmod(F.xxhash64("key", "text"), F.lit(batches))})

    k = len(labels) + 1
    every = sum((F.col(f"c{z}") for z in range(1, k)), F.col("c0"))
    types = materialize(count_words(own, k).withColumn("c", every), "words")
    docs_in = np.zeros(k)
    for z, count in own.where("not held_out").groupBy("state").count().collect():
        docs_in[z] = count
    train_docs = int(docs_in.sum())
    n, v, once, *tokens_in = types.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.when(F.col("c") > 0, 1)), F.count(F.when(F.col("c") == 1, 1)),
                                       *[F.coalesce(F.sum(f"c{z}"), F.lit(0)) for z in range(k)]).first()
    n, v, tokens_in = n + train_docs, v + (train_docs > 0), np.array(tokens_in) + docs_in
    units = Units(vocabulary)
    p = np.append(units.start, units.start[~units.opens].sum())
    for _ in range(rounds if n else 0):
        p = refine(types, units, p)
    spelled = min(1.0, max(once, 1) / n) if n else 1.0
    weights = spark.sparkContext.broadcast(units.weights(p))
    log10 = math.log(10)

    def whole_words(c: np.ndarray) -> np.ndarray:
        """Frequency of words, or of the end, in each state; ``c``: [words, states] counts."""
        own_share = c / np.maximum(tokens_in, 1) * (1 - shared)
        return (1 - spelled) * (own_share + shared * c.sum(1, keepdims=True) / max(n, 1))

    def look_up(parts):
        for rows in gathered(parts):
            c = np.stack([rows.column(f"c{z}").to_numpy() for z in range(k)], 1)
            lattice = weights.value.words(as_texts(rows.column("word"))) + math.log(spelled)
            with np.errstate(divide="ignore"):
                lp = (np.logaddexp(lattice[:, None], np.log(whole_words(c))) / log10).astype(np.float32)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * k), pa.array(lp.ravel()))
            made = pa.RecordBatch.from_arrays([rows.column("word"), rows.column("c"), lists], names=["word", "c", "lp"])
            yield from (made.slice(i, 50_000) for i in range(0, len(made), 50_000))

    known = types.mapInArrow(look_up, "word binary, c long, lp array<float>")

    def ask(rows):
        for _, t in texts_of(rows.column("text").combine_chunks(), 1 << 62, lower=True, rows=1 << 62):
            at, _ = distinct_words(t)
            return pa.table({"batch": pa.array(np.full(len(at), rows.column("batch")[0].as_py())), "word": pa.array([t.word(i) for i in at], pa.binary())})

    asked = own.groupBy("batch").applyInArrow(ask, "batch long, word binary")
    answers = asked.join(known, "word").select("batch", "word", "c", "lp")
    floor = math.log10(n + 0.1 * (v + 1))
    ends = whole_words(docs_in[None, :])[0] if n else np.full(k, 0.5)
    start = np.log10(np.maximum(docs_in, 1e-3) / max(docs_in.sum(), 1)) + np.log10(np.maximum(ends, 1e-30))

    def sum_up(rows, words):
        if not len(rows):
            return pa.table({f.name: pa.array([], f.type) for f in out_type})
        table = as_texts(words.column("word").combine_chunks()) if len(words) else None
        order = np.argsort(table.hashes) if table else None
        c = words.column("c").to_numpy()[order] if table else np.zeros(0)
        lp = words.column("lp").combine_chunks().values.to_numpy().reshape(-1, k)[order] if table else np.zeros((0, k))
        out = []
        for i, t in texts_of(rows.column("text").combine_chunks(), 4 << 20, lower=True):
            at = np.searchsorted(table.hashes[order], t.hashes) if len(t.hashes) else np.zeros(0, np.int64)
            full = np.diff(t.first) > 0
            sums = lambda x: np.add.reduceat(np.append(x, 0.0), t.first[:-1]) * full
            known = np.concatenate([[0], np.cumsum(c[at] > 0)])
            by_state = np.stack([sums(lp[at, z].astype(np.float64)) + start[z] for z in range(k)], 1)
            out.append((t.words_per_text() + 1, known[t.first[1:]] - known[t.first[:-1]] + (train_docs > 0), sums(np.log10(c[at] + 0.1) - floor) + math.log10(train_docs + 0.1) - floor,
                        np.logaddexp.reduce(by_state * log10, axis=1) / log10))
        tokens, hits, base, model = (np.concatenate(x) for x in zip(*out))
        return pa.table({"key": rows.column("key"), "held_out": rows.column("held_out"), "n_tokens": pa.array(tokens, pa.int64()), "n_known": pa.array(hits, pa.int64()),
                         "train_tokens": pa.array(np.full(len(rows), n), pa.int64()), "base_score": pa.array(base, pa.float64()), "score": pa.array(model, pa.float64())})

    kind = docs.schema[key].dataType.simpleString()
    out_type = pa.schema([("key", pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else pa.string()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                          ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
    found = own.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(
        sum_up, f"key {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return found.withColumnRenamed("key", key)


def _bytes(size: str) -> int:
    digits = size.lower().rstrip("bkmg")
    return int(digits) << {"k": 10, "m": 20, "g": 30}.get(size.lower()[len(digits):][:1], 0)
