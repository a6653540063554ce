"""Operator 1: token counts from an exact length histogram; the tokenizer of operators 1 and 2.

The documents are encoded once and only (encoded length, documents) pairs leave a task.
Suffix sums over that histogram answer, for every context limit, how many documents and
tokens exceed it, how many tokens remain when documents are cut there, and the quantiles.

Null text counts as empty (length 0 before the end token); equal rows count each time; an
empty table gives an empty histogram; other columns are ignored.
"""

from __future__ import annotations

import json
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from exonloom.scale import materialize

END_ID = 0


def shown_bytes() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(printable)))}


class Encoder:
    """Ids of a tokenizer file for whole texts.

    A byte-level BPE whose merges stand in the order of their ids is run by rank, which
    gives the same ids faster; any other file is run by its own library.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer, self.plain = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.plain.encode_special_tokens = True
        self.ranked = self._by_rank(path)
        with open(path, encoding="utf-8") as f:
            self.spec = json.load(f)
        self.added = [t["content"] for t in self.spec.get("added_tokens", [])]

    @staticmethod
    def _by_rank(path: str):
        import tiktoken
        from public_tokenizers import PATTERN

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, before = spec["model"], spec.get("pre_tokenizer") or {}
        if model["type"] != "BPE" or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or spec.get("normalizer"):
            return None
        vocab = model["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        if any(vocab.get(a + b) != 256 + i for i, (a, b) in enumerate(merges)):
            return None
        shown = shown_bytes()
        special = {t["content"] for t in spec.get("added_tokens", [])}
        ranks = {bytes(shown[c] for c in piece): i for piece, i in vocab.items() if piece not in special}
        return tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str | None) -> list[int]:
        """All ids of a text, none for null; a text that holds an added token's string goes to the library."""
        if not text:
            return []
        if self.ranked and not any(t in text for t in self.added):
            return self.ranked.encode_ordinary(text)
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def plain_ids(self, text: str) -> list[int]:
        """Ids where the strings of special tokens are ordinary text."""
        return self.ranked.encode_ordinary(text) if self.ranked else self.plain.encode(text, add_special_tokens=False).ids

    def id_bytes(self) -> dict[int, bytes]:
        """Bytes of each id of a byte-level vocabulary."""
        if (self.spec.get("pre_tokenizer") or {}).get("type") != "ByteLevel":
            raise ValueError("the tokens of this file do not stand for bytes")
        shown = shown_bytes()
        return {i: bytes(map(shown.__getitem__, piece)) for piece, i in self.spec["model"]["vocab"].items() if piece not in self.added}


def encoded_lengths(docs: DataFrame, tokenizer: str, text: str = "text", end: int = 1) -> DataFrame:
    """One row per length and task: ``length`` (with ``end`` closing ids) and ``docs``."""

    def run(batches):
        encoder, counts = Encoder(tokenizer), Counter()
        for batch in batches:
            for t in batch.column(0):
                counts[len(encoder.ids(t.as_py())) + end] += 1
        if counts:
            yield pa.RecordBatch.from_pydict({"length": pa.array(list(counts), pa.int64()), "docs": pa.array(list(counts.values()), pa.int64())})

    return docs.select(F.col(text).alias("text")).mapInArrow(run, "length long, docs long")


def length_histogram(docs: DataFrame, tokenizer: str, text: str = "text", end: int = 1) -> DataFrame:
    """Exact histogram: ``length``, ``docs``; written once, as its readers use it more than once."""
    return materialize(encoded_lengths(docs, tokenizer, text, end).groupBy("length").agg(F.sum("docs").alias("docs")), "lengths")


def suffix_totals(histogram: DataFrame, width: int = 64) -> DataFrame:
    """For each length taken as context limit, what the histogram says about it.

    ``tokens``: ids in documents of this length; ``docs_from``, ``tokens_from``: documents at
    least as long; ``docs_upto``, ``quantile``: count and share of documents at most as long;
    ``truncated_tokens``: ids left when every document is cut at this limit. The sums run
    within blocks of ``width`` lengths and then over the blocks.
    """
    own = histogram.withColumn("block", F.floor(F.col("length") / width)).withColumn("tokens", F.col("length") * F.col("docs"))
    after = W.partitionBy("block").orderBy(F.desc("length")).rowsBetween(W.unboundedPreceding, W.currentRow)
    later = W.orderBy(F.desc("block")).rowsBetween(W.unboundedPreceding, -1)
    whole = W.orderBy("block").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    blocks = own.groupBy("block").agg(F.sum("docs").alias("d"), F.sum("tokens").alias("t"))
    blocks = blocks.select("block", F.coalesce(F.sum("d").over(later), F.lit(0)).alias("d_later"), F.coalesce(F.sum("t").over(later), F.lit(0)).alias("t_later"),
                           F.sum("d").over(whole).alias("d_all"), F.sum("t").over(whole).alias("t_all"))
    out = own.join(blocks, "block").withColumns({"docs_from": F.sum("docs").over(after) + F.col("d_later"), "tokens_from": F.sum("tokens").over(after) + F.col("t_later")})
    upto = F.col("d_all") - F.col("docs_from") + F.col("docs")
    return out.select("length", "docs", "tokens", "docs_from", "tokens_from", upto.alias("docs_upto"), (upto / F.col("d_all")).alias("quantile"),
                      (F.col("t_all") - F.col("tokens_from") + F.col("length") * F.col("docs_from")).alias("truncated_tokens"))


def at_limits(totals: DataFrame, limits: list[int]) -> DataFrame:
    """Answers for any limits, also those that no document has: ``limit``, ``docs_over``, ``tokens_kept``.

    The least length above a limit has the greatest suffix sums of those above it; beyond all
    lengths nothing is cut. One aggregate answers all limits.
    """
    above = lambda c, m: F.coalesce(F.max(F.when(F.col("length") > m, F.col(c))), F.lit(0))
    every = F.coalesce(F.sum("tokens"), F.lit(0))
    rows = [F.struct(F.lit(int(m)).cast("long").alias("limit"), above("docs_from", m).alias("docs_over"),
                     (every - above("tokens_from", m) + int(m) * above("docs_from", m)).alias("tokens_kept")) for m in limits]
    return totals.agg(F.array(*rows).alias("rows")).select(F.explode("rows").alias("r")).select("r.*")


def quantiles(totals: DataFrame, shares: list[float]) -> DataFrame:
    """Least length that at least this share of the documents does not exceed: ``share``, ``length``."""
    rows = [F.struct(F.lit(float(x)).alias("share"), F.min(F.when(F.col("quantile") >= x, F.col("length"))).alias("length")) for x in shares]
    return totals.agg(F.array(*rows).alias("rows")).select(F.explode("rows").alias("r")).select("r.*")
