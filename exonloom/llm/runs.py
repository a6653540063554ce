"""Operator 11: periodic runs of words by a dictionary of basic factors.

Basic factors are the stretches of 1, 2, 4, 8, ... words. A factor of twice the length is named
by the pair of names of its halves, so that equal names mean equal words in the same text; a
factor that its text holds once is dropped, since no longer one around it can come again. Two
occurrences within twice a factor's length are part of one arithmetic progression, whose
difference is the distance of a place to its successor: neighbouring places with the same
distance propose one run with that period. Proposals are extended word by word and deduplicated.

Null text has no words, as an empty one; a text with fewer words than a run needs has no runs;
equal rows are handled alike; an empty table gives no rows; other columns stay. A text is
worked on as a whole, so memory follows the longest text.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import compress, count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import row_spans, seal

RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])


def find_runs(words: np.ndarray, first: np.ndarray, least: int = 6, times: int = 4) -> np.ndarray:
    """Rows (text, start, length, period) of all runs, ordered, of texts given as word numbers.

    ``first``: first word of each text (n + 1). A run has ``least`` words and ``times`` (3 or
    more) periods at least, and starts are counted from the first word of its text.
    """
    if times < 3:
        raise ValueError("runs of fewer than three periods may have no basic factor of their length")
    sizes = np.diff(first)
    owner, stop = np.repeat(np.arange(len(sizes)), sizes), np.repeat(first[1:], sizes)
    at = np.arange(len(words))
    name = owner * (int(words.max(initial=0)) + 1) + words
    dense = np.full(len(words), -1, np.int64)
    found, width = [], 1
    while len(at):
        order = np.argsort(name, kind="stable")
        ranked, here = name[order], at[order]
        same = ranked[1:] == ranked[:-1]
        step = np.zeros(len(at), np.int64)
        step[order[:-1][same]] = (here[1:] - here[:-1])[same]
        found.append(progressions(at, step, width, times))
        again = np.zeros(len(at), bool)
        again[order[1:][same]] = again[order[:-1][same]] = True
        rank = np.empty(len(at), np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(~same)])
        at, rank = at[again], rank[again]
        dense[:] = -1
        dense[at] = rank
        at, rank = at[(fits := at + 2 * width <= stop[at])], rank[fits]
        later = dense[at + width]
        at, name = at[later >= 0], (rank * (len(words) + 1) + later)[later >= 0]
        width *= 2
    start, end, period = np.concatenate(found).T if found else np.empty((3, 0), np.int64)
    start, end = extend(words, start, end, period, np.append(owner, -1))
    rows = np.stack([owner[start], start, end - start, period], 1)
    rows = np.unique(rows[rows[:, 2] >= np.maximum(least, times * period)], axis=0)
    rows = rows[np.lexsort((rows[:, 3], rows[:, 1]))]
    rows[:, 1] -= first[rows[:, 0]]
    return rows


def progressions(at: np.ndarray, step: np.ndarray, width: int, times: int) -> np.ndarray:
    """(start, end, period) of neighbouring places whose factor of ``width`` words comes again after
    the same ``step``; steps up to half of ``width`` have been proposed by shorter factors."""
    near = (step > width // 2) & (step <= width)
    at, step = at[near], step[near]
    opens = np.ones(len(at), bool)
    opens[1:] = (at[1:] != at[:-1] + 1) | (step[1:] != step[:-1])
    begin = np.flatnonzero(opens)
    ends = np.append(begin[1:], len(at)) if len(begin) else begin
    place, period = at[begin], step[begin]
    end = at[ends - 1] + width + period if len(begin) else place
    long_enough = end - place >= times * period
    return np.stack([place, end, period], 1)[long_enough]


def extend(words: np.ndarray, start: np.ndarray, end: np.ndarray, period: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Moves both ends out as long as the words one period apart agree within the text."""
    start, end, mine = start.copy(), end.copy(), owner[start]
    for place, way, other in ((start, -1, 1), (end, 1, -1)):
        open_ = np.arange(len(place))
        while len(open_):
            spot = place[open_] + (way if way < 0 else 0)
            more = (spot >= 0) & (owner[spot] == mine[open_])
            more[more] = words[spot[more]] == words[spot[more] + other * period[open_][more]]
            open_ = open_[more]
            place[open_] += way
    return start, end


def split_words(texts: list[str | None]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Words of all texts, their numbers, and the first word of each text (n + 1)."""
    words: list[bytes] = []
    first = [0]
    for t in texts:
        words += (t or "").encode().split()  # bytes.split parts at space and U+0009 to U+000D alone
        first.append(len(words))
    numbers = defaultdict(count().__next__)
    return words, np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)), np.array(first)


def repeated_words(runs: np.ndarray, first: np.ndarray) -> np.ndarray:
    """True for each word that some run holds after its first period."""
    steps = np.zeros(first[-1] + 1, np.int64)
    at = first[runs[:, 0]] + runs[:, 1]
    np.add.at(steps, at + runs[:, 3], 1)
    np.add.at(steps, at + runs[:, 2], -1)
    return np.cumsum(steps[:-1]) > 0


def collapse(docs: DataFrame, text: str = "text", least: int = 6, times: int = 4, most: int = 4 << 20) -> DataFrame:
    """``docs`` with the repeated periods of runs cut out of ``text`` (words joined by one space),
    followed by ``n_words`` (before) and ``runs`` (start, length and period, by start, then period)."""
    docs, restore = seal(docs, text)
    names = [f"c{i}" for i in range(len(docs.columns))]
    at = docs.columns.index(text)
    schema = docs.toDF(*names).schema.add("n", "long").add("r", T.ArrayType(RUN))

    def run(batches):
        kind = pa.list_(pa.struct([(f.name, pa.int64()) for f in RUN]))
        for batch in batches:
            for i, j in row_spans(batch.column(at), most):
                words, numbers, first = split_words(batch.column(at).slice(i, j - i).to_pylist())
                runs = find_runs(numbers, first, least, times)
                gone, holds = repeated_words(runs, first), np.bincount(runs[:, 0], minlength=j - i)
                left = []
                for k in range(j - i):
                    own = words[first[k]:first[k + 1]]
                    left.append(b" ".join(compress(own, (~gone[first[k]:first[k + 1]]).tolist()) if holds[k] else own).decode())
                offsets = np.concatenate([[0], np.cumsum(holds)]).astype(np.int32)
                items = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(runs[:, c])) for c in (1, 2, 3)], fields=list(kind.value_type))
                columns = [c.slice(i, j - i) for c in batch.columns]
                columns[at] = pa.array(left, batch.column(at).type)
                yield pa.RecordBatch.from_arrays([*columns, pa.array(np.diff(first)), pa.ListArray.from_arrays(pa.array(offsets), items)], names=schema.names)

    return restore(docs.toDF(*names).mapInArrow(run, schema).toDF(*docs.columns, "n_words", "runs"), "n_words", "runs")


def strongest(runs: Column) -> Column:
    """The run with most periods; among equal ones the first. Null without runs."""
    better = lambda best, r: best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    return F.aggregate(runs, F.lit(None).cast(RUN), lambda best, r: F.when(better(best, r), r).otherwise(best))
