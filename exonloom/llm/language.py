"""Operator 12: language identification by error-correcting output codes.

Every language has a codeword of +1 and -1. One binary classifier for each bit weighs hashed
byte n-grams (2 to 4 bytes of lower-cased letters, runs of other ASCII characters as one space)
by the log odds of the languages on its two sides; counts cover all training texts. The mean
weight of a text is put on a logistic scale fitted on a bounded sample. Decoding sums the
logistic losses of the bits, weighted by how often each bit is right, and takes the codeword
with the least sum; a text is ambiguous where the runner-up is close.

A null text, and one without a letter, is ``und`` with score 0; so is every text if nothing was
learned. Training rows without language or text are left out. Equal texts get equal answers;
an empty table gives no rows; other columns stay.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import row_spans, seal

ORDERS, FEATURES = (2, 3, 4), 1 << 16
UNKNOWN = "und"
_ONES = np.ones(1 << 14, np.float32)
_KEPT = np.full(256, 0x20, np.uint8)
for _b in [*range(65, 91), *range(97, 123), *range(128, 256)]:
    _KEPT[_b] = _b


def codewords(languages: int, seed: int = 1, tries: int = 200) -> np.ndarray:
    """One row of +1 and -1 for each language: all ways to part up to five languages in two, else
    the best of ``tries`` random codes of 10 log2 n bits by least distance of rows."""
    if languages <= 5:
        sides = np.arange(1, 1 << max(languages - 1, 0))
        return np.where((sides[None, :] >> np.arange(languages)[:, None]) & 1, 1, -1).astype(np.int8)
    rng, bits = np.random.default_rng(seed), int(np.ceil(10 * np.log2(languages)))
    best = (-1, None)
    for _ in range(tries):
        code = rng.choice(np.array([-1, 1], np.int8), (languages, bits))
        code = code[:, np.abs(code.sum(0)) < languages]
        agree = code.astype(int) @ code.T.astype(int)
        np.fill_diagonal(agree, -bits)
        apart = code.shape[1] - agree.max()
        if apart > best[0]:
            best = (apart, code)
    return best[1]


def letters(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of lower-cased texts on end, other ASCII as single spaces, one space around every
    text, and the first byte of each (n + 1)."""
    parts = [b" " + (t or "").lower().encode() + b" " for t in texts]
    data = _KEPT[np.frombuffer(b"".join(parts), np.uint8)]
    bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    keep = np.ones(len(data), bool)
    keep[1:] = (data[1:] != 0x20) | (data[:-1] != 0x20)
    keep[bounds[:-1]] = True
    sums = np.concatenate([[0], np.cumsum(keep)])
    return data[keep], sums[bounds]


def grams(data: np.ndarray, n: int) -> np.ndarray:
    """Feature of the ``n`` bytes from each place on."""
    h = np.full(max(len(data) - n + 1, 0), n, np.uint32)
    with np.errstate(over="ignore"):
        for k in range(n):
            h = (h ^ data[k:k + len(h)]) * np.uint32(0x01000193)
        h ^= h >> np.uint32(15)
        return (h * np.uint32(0x2C1B3C6D)) >> np.uint32(16)


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    slope: np.ndarray
    shift: np.ndarray
    trust: np.ndarray

    def margins(self, texts: list[str | None]) -> np.ndarray:
        """Mean weight of the n-grams of each text, one column for each bit."""
        data, bounds = letters(texts)
        total, many = np.zeros((len(texts), self.weights.shape[1])), np.zeros(len(texts))
        for n in ORDERS:
            gram = grams(data, n)
            begin = np.minimum(bounds[:-1], len(gram))
            size = np.maximum(np.minimum(bounds[1:] - n + 1, len(gram)) - begin, 0)
            for i, (s, k) in enumerate(zip(begin.tolist(), size.tolist())):
                for p in range(s, s + k, len(_ONES)):
                    part = self.weights[gram[p:min(p + len(_ONES), s + k)]]
                    total[i] += _ONES[:len(part)] @ part
            many += size
        return total / np.maximum(many, 1)[:, None]

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(nearest codeword, its share among all, how much worse the second one is)."""
        z = margins * self.slope + self.shift
        loss = np.zeros((len(margins), len(self.languages)))
        for b in range(z.shape[1]):
            loss += self.trust[b] * np.logaddexp(0, -z[:, b, None] * self.code[None, :, b])
        rank = np.sort(loss, 1)
        gap = rank[:, 1] - rank[:, 0] if rank.shape[1] > 1 else np.full(len(loss), np.inf)
        share = 1 / np.exp(rank[:, :1] - rank).sum(1)
        return loss.argmin(1), share, gap


def gram_counts(docs: DataFrame, lang: str, text: str) -> DataFrame:
    """``lang``, ``feature``, ``n`` over all rows, summed up in every task first."""

    def run(batches):
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for i, j in row_spans(batch.column(1), 4 << 20):
                texts, own = batch.column(1).slice(i, j - i).to_pylist(), np.array(batch.column(0).slice(i, j - i).to_pylist(), object)
                for one in set(own.tolist()):
                    data, bounds = letters([t for t, x in zip(texts, own) if x == one])
                    into = counts.setdefault(one, np.zeros(FEATURES, np.int64))
                    for n in ORDERS:
                        inside = np.ones(len(data), bool)
                        for k in range(1, n):
                            inside[bounds[1:] - k] = False
                        gram = grams(data, n)
                        into += np.bincount(gram[inside[:len(gram)]], minlength=FEATURES)
        for one, into in counts.items():
            at = np.flatnonzero(into)
            yield pa.RecordBatch.from_pydict({"lang": pa.array([one] * len(at), pa.string()), "feature": pa.array(at.astype(np.int32)), "n": pa.array(into[at])})

    rows = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text")).where("lang is not null and text is not null")
    return rows.mapInArrow(run, "lang string, feature int, n long").groupBy("lang", "feature").agg(F.sum("n").alias("n"))


def logistic(x: np.ndarray, y: np.ndarray, rounds: int = 30) -> tuple[float, float]:
    """Slope and shift of P(y = 1) = 1 / (1 + exp(-(slope x + shift))), by damped Newton steps.
    Classes weigh the same, and a slight pull to slope 0 keeps the slope finite where x parts them."""
    scale = max(float(np.abs(x).mean()), 1e-9)
    v, w = np.stack([x / scale, np.ones(len(x))], 1), np.where(y, 0.5 / max(y.sum(), 1), 0.5 / max((~y).sum(), 1))
    beta, ridge = np.zeros(2), np.array([1e-3, 1e-3])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(v @ beta, -30, 30)))
        grad = v.T @ (w * (y - p)) - ridge * beta
        step = np.linalg.solve((v * (w * p * (1 - p))[:, None]).T @ v + np.diag(ridge), grad)
        beta = beta + step * min(1.0, 2.0 / max(float(np.abs(step).max()), 1e-9))
    return float(beta[0] / scale), float(beta[1])


def train(docs: DataFrame, lang: str = "lang", text: str = "text", key: str = "doc_id", smooth: float = 0.5, most: int = 4000) -> Model | None:
    """Model of the languages of ``docs``; None where no row has both text and language.

    The n-gram counts cover all rows and come to the driver as languages x 65 536 numbers. Only
    the logistic scale of each bit is fitted on a sample: at most ``most`` rows (the documented
    bound), taken by the order of a hash of their key.
    """
    rows = docs.select(F.col(key).alias("k"), F.col(lang).alias("lang"), F.col(text).alias("text")).where("lang is not null and text is not null")
    got = gram_counts(rows, "lang", "text").toArrow()
    if got.num_rows == 0:
        return None
    names = sorted(set(got.column("lang").to_pylist()), key=lambda s: s.encode())
    number = {x: i for i, x in enumerate(names)}
    counts = np.full((len(names), FEATURES), smooth)
    counts[[number[x] for x in got.column("lang").to_pylist()], got.column("feature").to_numpy()] += got.column("n").to_numpy()
    share = counts / counts.sum(1, keepdims=True)
    code = codewords(len(names))
    sides = [np.stack([share[code[:, b] == s].mean(0) for b in range(code.shape[1])], 1) if code.shape[1] else np.zeros((FEATURES, 0)) for s in (1, -1)]
    weights = (np.log(sides[0]) - np.log(sides[1])).astype(np.float32)
    bits = code.shape[1]
    model = Model(names, code, weights, np.ones(bits), np.zeros(bits), np.ones(bits))
    if bits:
        picked = rows.where("k is not null").select("k").distinct().orderBy(F.xxhash64(F.lit(12), "k"), "k").limit(most)
        sample = margins(rows.join(F.broadcast(picked), "k", "left_semi"), model).orderBy(F.xxhash64("k"), "m").limit(most).collect()
        if sample:
            m, side = np.array([r["m"] for r in sample]), code[[number[r["lang"]] for r in sample]] > 0
            for b in range(bits):
                if side[:, b].any() and not side[:, b].all():
                    model.slope[b], model.shift[b] = logistic(m[:, b], side[:, b])
            right = ((m * model.slope + model.shift > 0) == side).mean(0)
            model.trust = np.clip(2 * right - 1, 0.05, 1)
    return model


def margins(rows: DataFrame, model: Model) -> DataFrame:
    """``k``, ``lang`` and the margins ``m`` of each row."""

    def run(batches):
        for batch in batches:
            for i, j in row_spans(batch.column(2), 4 << 20):
                found = model.margins(batch.column(2).slice(i, j - i).to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), pa.array(list(found), pa.list_(pa.float64()))], names=["k", "lang", "m"])

    return rows.select("k", "lang", "text").mapInArrow(run, f"k {rows.schema['k'].dataType.simpleString()}, lang string, m array<double>")


def identify(docs: DataFrame, model: Model | None, text: str = "text", close: float = 0.5) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (share of the chosen codeword, 0 to 1) and
    ``ambiguous`` (the runner-up's loss is within ``close``; true for ``und``)."""
    docs, restore = seal(docs, text)
    names = [f"c{i}" for i in range(len(docs.columns))]
    at = docs.columns.index(text)
    schema = docs.toDF(*names).schema.add("spoken", "boolean").add("p", "string").add("s", "double").add("a", "boolean")
    spoken = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))

    def run(batches):
        for batch in batches:
            for i, j in row_spans(batch.column(at), 4 << 20):
                known = np.array(batch.column(len(names)).slice(i, j - i).to_pylist(), bool)
                pred, score, unsure = np.full(j - i, UNKNOWN, object), np.zeros(j - i), np.ones(j - i, bool)
                if model and known.any():
                    texts = batch.column(at).slice(i, j - i).to_pylist()
                    best, share, gap = model.decode(model.margins([t for t, ok in zip(texts, known) if ok]))
                    pred[known], score[known], unsure[known] = np.array(model.languages, object)[best], share, gap < close
                yield pa.RecordBatch.from_arrays([*(c.slice(i, j - i) for c in batch.columns), pa.array(pred.tolist(), pa.string()), pa.array(score), pa.array(unsure)], names=schema.names)

    found = docs.withColumn("_spoken", spoken).toDF(*names, "spoken").mapInArrow(run, schema).toDF(*docs.columns, "_spoken", "lang_pred", "score", "ambiguous")
    return restore(found.drop("_spoken"), "lang_pred", "score", "ambiguous")
