"""Periodic runs of words: an online, sparse dynamic program over the diagonals of equal words.

A diagonal is a lag; its length is the number of consecutive words that equal the word one lag earlier. Words are read
from left to right in blocks. Each word looks up its earlier occurrences; each of them lengthens the diagonal of its lag,
and a diagonal that gets no match from a word ends there: if it is long enough its run is emitted, else it is forgotten.
What is kept between two blocks is the active diagonals alone.

Two rules keep the matches sparse without losing a run. A run of period q has at least max(q, 12 - q) matching words on
its diagonal, so an occurrence counts only with the words before it: at level 0 (lags below 12) with five of them, at
level k (lags from 12 * 2^(k-1) to twice that) with as many as the smallest lag less one. And inside a stretch that
already repeats with a period of at most half that context, matches at multiples of the period are passed over: their
diagonal covers exactly the shorter run, so its smallest period is not their lag.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from . import textarrays as ta

#: Runs have this many words or more, and two periods or more.
MIN_WORDS = 12
#: Matches handled at once in a task; a bound on memory, not on the matches.
BLOCK_MATCHES = 1 << 20
_HALF = MIN_WORDS // 2

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


class Diagonals:
    """Active lags, each with the first and the last position of its matches; positions come in rising order."""

    def __init__(self):
        self.lag = self.first = self.last = np.zeros(0, np.int64)

    def extend(self, position: np.ndarray, lag: np.ndarray, upto: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Take the matches of all positions below ``upto`` that were not read yet; return the ended diagonals."""
        order = np.lexsort((position, lag))
        lag, position = lag[order], position[order]
        new = np.ones(len(lag), bool)
        new[1:] = (lag[1:] != lag[:-1]) | (position[1:] != position[:-1] + 1)
        at = np.flatnonzero(new)
        ends = np.append(at[1:], len(lag)) - 1 if len(at) else at
        lag = np.concatenate([self.lag, lag[at]])
        first = np.concatenate([self.first, position[at]])
        last = np.concatenate([self.last, position[ends]])
        order = np.lexsort((first, lag))
        lag, first, last = lag[order], first[order], last[order]
        goes_on = np.zeros(len(lag), bool)
        goes_on[1:] = (lag[1:] == lag[:-1]) & (first[1:] == last[:-1] + 1)
        heads = np.flatnonzero(~goes_on)
        tails = np.append(heads[1:], len(lag)) - 1 if len(heads) else heads
        lag, first, last = lag[heads], first[heads], last[tails]
        active = last == upto - 1
        self.lag, self.first, self.last = lag[active], first[active], last[active]
        return lag[~active], first[~active], last[~active]


def _matches(key: np.ndarray, position: np.ndarray, low: int, high: int, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(position, lag) of equal keys at a lag from ``low`` to below ``high``, in blocks of rising positions.

    Occurrences at most ``low / 2`` apart belong to one shorter run and are not matched with each other. A block holds
    ``most`` matches, or those of a single position.
    """
    order = np.lexsort((position, key))
    key, position = key[order], position[order]
    head = np.ones(len(key), bool)
    head[1:] = key[1:] != key[:-1]
    group = np.cumsum(head) - 1
    span = int(position.max()) + 2 * high + 2
    place = group * span + position + high
    link = head.copy()
    link[1:] |= position[1:] - position[:-1] > low // 2
    if low < MIN_WORDS:  # the first level has no shorter runs
        link[:] = True
        own = np.arange(len(key))
    else:
        own = np.maximum.accumulate(np.where(link, np.arange(len(key)), 0))
    begin = np.searchsorted(place, place - high, "right")
    end = np.minimum(np.searchsorted(place, place - low, "right"), own)
    count = np.maximum(end - begin, 0)
    rising = np.argsort(position, kind="stable")
    rising = rising[count[rising] > 0]
    total = np.cumsum(count[rising])
    at = 0
    while at < len(rising):
        before = total[at - 1] if at else 0
        upto = max(int(np.searchsorted(total, before + most, "right")), at + 1)
        rows = rising[at:upto]
        size = count[rows]
        which = np.repeat(np.arange(len(rows)), size)
        earlier = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + np.repeat(begin[rows], size)
        own_position = position[rows][which]
        yield own_position, own_position - position[earlier], int(position[rows[-1]]) + 1
        at = upto


def runs_of(words: ta.Spans, hashes: np.ndarray, most: int = BLOCK_MATCHES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, smallest period) of all runs in a chunk's words, in order of start, then period."""
    count = len(hashes)
    first_word = words.bounds[:-1][words.text]
    at = np.arange(count)
    # Words of another text never match: the text is part of the context.
    context = ta.mix(hashes + words.text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), 5)
    for i in range(1, _HALF):
        earlier = np.zeros(count, np.uint64)
        earlier[i:] = hashes[:max(count - i, 0)]
        context = ta.mix(context, i) + earlier
    size, low = _HALF, 1
    candidates = at[at - first_word >= size - 1]
    found = []
    while True:
        key, which, often = np.unique(context[candidates], return_inverse=True, return_counts=True)
        candidates = candidates[often[which] > 1]
        if not len(candidates):
            break
        high = 2 * low if low >= MIN_WORDS else MIN_WORDS
        diagonals = Diagonals()
        for position, lag, upto in _matches(context[candidates], candidates, low, high, most):
            found.append((size, *diagonals.extend(position, lag, upto)))
        found.append((size, diagonals.lag, diagonals.first, diagonals.last))
        # The context doubles: the half that ends here and the half before it.
        longer = context.copy()
        longer[size:] = ta.mix(context[size:], 7) + context[:max(count - size, 0)]
        context, size, low = longer, 2 * size, high
        candidates = candidates[candidates - first_word[candidates] >= size - 1]
    if not found:
        return at[:0], at[:0], at[:0]
    lag, first, last = (np.concatenate([f[i] for f in found]) for i in (1, 2, 3))
    context_words = np.repeat([f[0] for f in found], [len(f[1]) for f in found])
    start, end = first - context_words + 1 - lag, last + 1
    enough = (end - start >= MIN_WORDS) & (end - start >= 2 * lag)
    start, end, lag = start[enough], end[enough], lag[enough]
    order = np.lexsort((lag, end, start))
    start, end, lag = start[order], end[order], lag[order]
    smallest = np.ones(len(start), bool)  # one stretch may stand on the diagonals of several multiples of its period
    smallest[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, lag = start[smallest], end[smallest], lag[smallest]
    order = np.lexsort((lag, start))
    return start[order], end[order], lag[order]


def _batch(text: pa.Array) -> pa.Array:
    counts, bounds, starts, lengths, periods, collapsed = [], [0], [], [], [], []
    for chunk in ta.chunks(text):
        words = ta.split(chunk, ta.WHITE)
        start, end, period = runs_of(words, ta.hash_spans(chunk.data, words.start, words.end))
        first = words.bounds[:-1]
        owner = words.text[start] if len(start) else start
        starts.append(start - first[owner])
        lengths.append(end - start)
        periods.append(period)
        per_text = np.bincount(owner, minlength=chunk.texts)
        bounds += (bounds[-1] + np.cumsum(per_text)).tolist()
        cover = np.zeros(len(words.start) + 1, np.int64)
        np.add.at(cover, start + period, 1)
        np.add.at(cover, end, -1)
        kept = np.cumsum(cover[:-1]) == 0
        counts.append(words.counts)
        data = chunk.data.tobytes()
        edges = words.bounds.tolist()
        for i, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
            spans = zip(words.start[a:b][kept[a:b]].tolist(), words.end[a:b][kept[a:b]].tolist())
            collapsed.append(b" ".join([data[s:e] for s, e in spans]).decode())
    join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
    run = pa.StructArray.from_arrays([pa.array(join(x), pa.int64()) for x in (starts, lengths, periods)], ["start", "length", "period"])
    return pa.StructArray.from_arrays(
        [pa.array(join(counts), pa.int64()), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), run), pa.array(collapsed, pa.string())],
        ["n_words", "runs", "collapsed"])


def _batches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for text in batches:
        yield _batch(text)


def runs_in(text: Column) -> Column:
    """n_words, runs and the collapsed text of a text column, as a struct."""
    return arrow_udf(_batches, f"struct<n_words:bigint,runs:{RUNS},collapsed:string>")(text)


def periodic_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns of ``docs`` in a struct ``document``, and a struct ``periodic`` with n_words, runs and collapsed.

    Words are runs of characters other than ASCII white space. ``runs`` has start, length (in words) and smallest period
    of each run of 12 words and two periods or more that cannot be extended, by start, then period. ``collapsed`` are the
    words left when each run keeps its first period only, joined by one space. A null or empty text has no words, no
    runs and an empty collapsed text. Rows are judged one by one: repeated rows, null ids and extra columns pass as they
    are; a table without rows gives none.
    """
    found = docs.select(F.struct("*").alias("document"))
    return found.withColumn("periodic", runs_in(F.col(f"document.{text}")))


def planted(doc_id: Column, text: Column) -> Column:
    """The text whose runs ``op13_periodic_runs`` reports: every tenth document by crc32 of its id is made to repeat."""
    code = F.crc32(doc_id.cast("string").cast("binary"))
    words = F.regexp_extract_all(text, F.lit("[^\\x20\\x09-\\x0D]+"), F.lit(0))
    n, g = F.greatest(F.size(words), F.lit(1)), F.floor(code / 10)
    a = (g % n).cast("int")
    p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
    turns = F.ceil((n - a) / p).cast("int")
    spun = F.slice(F.flatten(F.array_repeat(F.slice(words, a + 1, p), turns)), F.lit(1), n - a)
    return F.when((code % 10 == 0) & (F.size(words) > 0), F.array_join(F.concat(F.slice(words, F.lit(1), a), spun), " ")).otherwise(text)
