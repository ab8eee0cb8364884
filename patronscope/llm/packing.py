"""Packing token sequences: linear grouping of large pieces, best fit of small ones.

All pieces are ranked by falling length. What the driver sees is only the count of pieces by length (at most CAPACITY
numbers); the plan it makes from them speaks of ranks, and every piece finds its place by its own rank.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.functions import arrow_udf

from ..operators.numbering import number_rows
from . import textarrays as ta
from .staging import staged

CAPACITY = 4096
END_ID = 1
#: Pieces up to this length are small: they fill what the configurations of large pieces leave.
SMALL = 512
#: Groups of equal cardinality that large pieces are rounded up in; a configuration problem of so many sizes is solved.
GROUPS = 128
TOKENIZER = "word_bpe_49k.json"
#: Words remembered with their ids in a task, before the memory is cleared.
REMEMBERED_WORDS = 400_000
#: A text with any other character, an apostrophe (contractions) or a special token's opening is encoded as a whole.
PLAIN = "[^\t\n\r -&(-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]|<\\|"
_SPACE, _LETTER, _DIGIT, _OTHER = range(4)


class Encoder:
    """Token ids of whole texts, each distinct word encoded once.

    The tokenizer lowers texts, cuts them into runs of letters, single digits and runs of other marks, and merges
    within these only. For texts of printable ASCII and Latin letters that cut is plain on bytes, so a text's ids are
    those of its words; every other text goes to the tokenizer as a whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = np.full(256, _OTHER, np.uint8)
        self.kind[[9, 10, 13, 32]] = _SPACE
        self.kind[48:58] = _DIGIT
        self.kind[97:123] = self.kind[128:] = _LETTER
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)  # ids that end a word
        self.closes[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.clear()

    def clear(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.slot = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int64)
        self.start = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _words(self, chunk: ta.Chunk) -> tuple[np.ndarray, np.ndarray]:
        kind = self.kind[chunk.data]
        edge = np.ones(len(kind) + 1, bool)
        edge[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
        edge[chunk.offsets] = True
        at = np.flatnonzero(edge)
        word = kind[at[:-1]] != _SPACE
        return at[:-1][word], at[1:][word]

    def _learn(self, hashes: np.ndarray, words: list[bytes]) -> None:
        texts = [b" ".join(words[i:i + 64]).decode() for i in range(0, len(words), 64)]
        ids = np.fromiter((i for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False) for i in e.ids), np.uint32)
        ends = np.flatnonzero(self.closes[ids]) + 1
        if len(ends) != len(words):
            raise ValueError("a word was encoded as several")
        length = np.diff(ends, prepend=0)
        slots = len(self.length) + np.arange(len(words))
        self.start = np.concatenate([self.start, len(self.ids) + ends - length])
        self.length = np.concatenate([self.length, length])
        self.ids = np.concatenate([self.ids, ids])
        place = np.searchsorted(self.known, hashes)
        self.known, self.slot = np.insert(self.known, place, hashes), np.insert(self.slot, place, slots)

    def _plain(self, chunk: ta.Chunk) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a chunk end to end, and their bounds."""
        start, end = self._words(chunk)
        unique, first, which = np.unique(ta.hash_spans(chunk.data, start, end), return_index=True, return_inverse=True)
        if len(self.known) > REMEMBERED_WORDS:
            self.clear()
        place = np.minimum(np.searchsorted(self.known, unique), max(len(self.known) - 1, 0))
        fresh = self.known[place] != unique if len(self.known) else np.ones(len(unique), bool)
        if fresh.any():
            data = chunk.data.tobytes()
            self._learn(unique[fresh], [data[start[i]:end[i]] for i in first[fresh].tolist()])
        slot = self.slot[np.searchsorted(self.known, unique)][which] if len(unique) else np.zeros(0, np.int64)
        length = self.length[slot]
        before = np.cumsum(length) - length
        ids = self.ids[np.repeat(self.start[slot] - before, length) + np.arange(int(length.sum()))]
        return ids, np.append(before, len(ids))[np.searchsorted(start, chunk.offsets)]

    def encode(self, column: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text, null as empty."""
        column = column.cast(pa.large_string()).fill_null("")
        odd = pc.match_substring_regex(column, PLAIN)
        lowered = pc.utf8_lower(pc.if_else(odd, "", column))
        odd = odd.to_numpy(zero_copy_only=False)
        for chunk in ta.chunks(lowered):
            ids, bounds = self._plain(chunk)
            for i in range(chunk.texts):
                if odd[chunk.first + i]:
                    whole = self.tokenizer.encode(column[chunk.first + i].as_py(), add_special_tokens=False).ids
                    yield np.array(whole, np.uint32)
                else:
                    yield ids[bounds[i]:bounds[i + 1]]


def _encode_batches(path: str, with_ids: bool):
    kind = [("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]

    def encoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = Encoder(path)
        for column in batches:
            ends, rows, kept = [0], [], []
            for ids in encoder.encode(column):
                ids = np.append(ids, np.uint32(END_ID)).astype("<u4")
                for i, start in enumerate(range(0, len(ids), CAPACITY)):
                    own = ids[start:start + CAPACITY]
                    rows.append((i, start, len(own), zlib.crc32(own)))
                    if with_ids:
                        kept.append(own.astype(np.int32))
                ends.append(len(rows))
            table = np.array(rows, np.int64).reshape(-1, 4)
            fields = [pa.array(table[:, i].astype(np.int32) if i == 0 else table[:, i]) for i in range(4)]
            if with_ids:
                fields.append(pa.array(kept, pa.list_(pa.int32())))
            items = pa.StructArray.from_arrays(fields, names=[n for n, _ in kind] + ["ids"] * with_ids)
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), items)
    return encoded


def pieces_of(text: Column, tokenizer: str | None = None, with_ids: bool = False) -> Column:
    """The text's tokens and an end token, cut into pieces of CAPACITY: array of (piece, start, length, ids_crc32[, ids])."""
    path = tokenizer or public_tokenizers.path(TOKENIZER)
    ids = ", ids: array<int>" if with_ids else ""
    return arrow_udf(_encode_batches(path, with_ids),
                     f"array<struct<piece: int, start: bigint, length: bigint, ids_crc32: bigint{ids}>>")(text)


def best_pattern(sizes: np.ndarray, worth: np.ndarray, capacity: int) -> tuple[np.ndarray, float]:
    """The multiset of sizes within the capacity that is worth most (unbounded knapsack)."""
    best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for g in np.flatnonzero(worth > 0):
        size = int(sizes[g])
        for block in range(size, capacity + 1, size):
            with_it = best[block - size:min(block, capacity + 1 - size)] + worth[g]
            old = best[block:block + size]
            better = with_it[:len(old)] > old + 1e-12
            old[better] = with_it[:len(old)][better]
            last[block:block + size][better] = g
    pattern, room = np.zeros(len(sizes)), capacity
    value = best[capacity]
    while room > 0 and last[room] >= 0:
        pattern[last[room]] += 1
        room -= int(sizes[last[room]])
    return pattern, float(value)


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = 1500) -> list[tuple[np.ndarray, int]]:
    """Patterns and whole multiplicities that use no more of a size than is there: column generation for the fewest
    sequences that hold all (fractional), rounded down. What rounding leaves is at most a few pieces of each size."""
    k = len(sizes)
    basis = np.diag((capacity // sizes).astype(float))
    ones = np.ones(k)
    for _ in range(rounds):
        price = np.linalg.solve(basis.T, ones)
        pattern, value = best_pattern(sizes, price, capacity)
        if value <= 1 + 1e-7:
            break
        amount = np.linalg.solve(basis, demand)
        step = np.linalg.solve(basis, pattern)
        ratio = np.where(step > 1e-9, np.maximum(amount, 0) / np.where(step > 1e-9, step, 1), np.inf)
        leaving = int(np.argmin(ratio))
        if not np.isfinite(ratio[leaving]):
            break
        basis[:, leaving] = pattern
    amount = np.linalg.solve(basis, demand)
    left, chosen = demand.copy(), []
    for c in np.argsort(-amount, kind="stable"):
        pattern = basis[:, c].astype(np.int64)
        used = pattern > 0
        times = int(min(np.floor(amount[c] + 1e-6), (left[used] // pattern[used]).min()))
        if times > 0:
            chosen.append((pattern, times))
            left = left - pattern * times
    return chosen


class Plan:
    """Where each rank goes. ``full`` first ranks fill a sequence each, ranks up to ``large`` are large.

    ``slots`` has rows (first rank, count, first bin, pieces of a bin): rank r of a row goes to bin
    first + (r - first rank) // pieces of a bin. ``rest`` has the ranges (first rank, count) that best fit places.
    """

    def __init__(self, lengths: np.ndarray, counts: np.ndarray):
        order = np.argsort(-lengths)
        self.lengths, self.counts = lengths[order].astype(np.int64), counts[order].astype(np.int64)
        self.ends = np.cumsum(self.counts)
        self.full = int(self.counts[self.lengths == CAPACITY].sum())
        self.large = int(self.counts[self.lengths > SMALL].sum())
        self.pieces = int(self.counts.sum())
        self.slots: list[tuple[int, int, int, int]] = []
        self.rest: list[tuple[int, int]] = []
        self.bins = 0
        self._group()

    def length_of(self, rank: int) -> int:
        return int(self.lengths[np.searchsorted(self.ends, rank, "right")])

    def _group(self) -> None:
        """Linear grouping: equal numbers of ranks, each group's size its largest length; groups of one size merge."""
        count = self.large - self.full
        groups: list[list[int]] = []  # size, first rank, count
        for g in range(min(GROUPS, count)):
            first, last = self.full + g * count // GROUPS, self.full + (g + 1) * count // GROUPS
            if count < GROUPS:
                first, last = self.full + g, self.full + g + 1
            size = self.length_of(first)
            if groups and groups[-1][0] == size:
                groups[-1][2] += last - first
            else:
                groups.append([size, first, last - first])
        if groups:
            sizes, firsts, counts = (np.array(x, np.int64) for x in zip(*groups))
            used = np.zeros(len(groups), np.int64)
            for pattern, times in configurations(sizes, counts.astype(float), CAPACITY):
                for g in np.flatnonzero(pattern):
                    self.slots.append((int(firsts[g] + used[g]), int(pattern[g] * times), self.bins, int(pattern[g])))
                    used[g] += pattern[g] * times
                self.bins += times
            self.rest = [(int(f + u), int(c - u)) for f, u, c in zip(firsts, used, counts) if c > u]
        self.slots.sort()
        if self.pieces > self.large:
            self.rest.append((self.large, self.pieces - self.large))

    def best_fit(self, gaps: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, int]:
        """Rows (first rank, count, first place) for the rest, and the number of places used.

        Places are the bins in the order of their gaps, then new ones. Pieces of one length are placed together, always
        into the smallest gap that holds them; a range of places with one gap moves as a whole.
        """
        room: dict[int, list[tuple[int, int]]] = {}
        place = 0
        for gap, count in sorted(zip(gaps.tolist(), counts.tolist())):
            room.setdefault(gap, []).append((place, count))
            place += count
        open_gaps = sorted(room)
        out = []

        def put(gap: int, part: tuple[int, int]) -> None:
            if gap not in room:
                room[gap] = []
                open_gaps.insert(bisect_left(open_gaps, gap), gap)
            room[gap].append(part)

        for first, count in self.rest:
            rank, stop = first, first + count
            while rank < stop:
                size = self.length_of(rank)
                end = min(stop, int(self.ends[np.searchsorted(self.ends, rank, "right")]))
                while rank < end:
                    at = bisect_left(open_gaps, size)
                    if at == len(open_gaps):
                        new = -(-(end - rank) // (CAPACITY // size))
                        put(CAPACITY, (place, new))
                        place += new
                        continue
                    gap = open_gaps[at]
                    start, many = room[gap].pop()
                    if not room[gap]:
                        del room[gap]
                        open_gaps.pop(at)
                    each = gap // size
                    take = min(many, -(-(end - rank) // each))
                    if many > take:
                        put(gap, (start + take, many - take))
                    now = take
                    for turn in range(each):
                        got = min(now, end - rank)
                        if got < now:  # the last places of the range get one piece less
                            put(gap - turn * size, (start + got, now - got))
                        if got == 0:
                            break
                        out.append((rank, got, start))
                        rank += got
                        now = got
                    else:
                        put(gap - each * size, (start, now))
        return np.array(sorted(out), np.int64).reshape(-1, 3), place


def _place(rows: np.ndarray, columns: int):
    """A column function rank -> row of ``rows`` (by first rank): start + (rank - first) // share."""
    first = rows[:, 0]
    target, share = rows[:, 2], (rows[:, 3] if columns == 4 else np.ones(len(rows), np.int64))

    def placed(rank: pa.Array) -> pa.Array:
        r = rank.to_numpy(zero_copy_only=False).astype(np.int64)
        if not len(first):
            return pa.array(np.full(len(r), -1))
        i = np.maximum(np.searchsorted(first, r, "right") - 1, 0)
        return pa.array(np.where((r >= first[i]) & (r < first[i] + rows[i, 1]), target[i] + (r - first[i]) // share[i], -1))

    return arrow_udf(placed, "bigint")


def pack(docs: DataFrame, tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids], sequence_id, offset): every token of every document, once.

    A null or empty text is its end token alone. Texts of more than CAPACITY tokens are cut, no others. Repeated rows
    and null ids are documents like others; an empty table packs into nothing.
    """
    pieces = staged(docs.select("doc_id", F.explode(pieces_of(F.col("text"), tokenizer, with_ids)).alias("p")).select("doc_id", "p.*"), "pieces")
    counts = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()  # at most CAPACITY rows
    plan = Plan(np.array([r["length"] for r in counts], np.int64), np.array([r["n"] for r in counts], np.int64))
    narrow = pieces if with_ids else pieces.select("doc_id", "piece", "start", "length", "ids_crc32")
    order = [F.col("length").desc(), F.col("doc_id"), F.col("piece"), F.col("ids_crc32"), F.col("tie")]
    ranked = number_rows(narrow.withColumn("tie", F.monotonically_increasing_id()), order).drop("tie").withColumn("rank", F.col("rn") - 1).drop("rn")

    slots = np.array(plan.slots, np.int64).reshape(-1, 4)
    first = ranked.withColumn("bin", F.when((F.col("rank") >= plan.full) & (F.col("rank") < plan.large), _place(slots, 4)(F.col("rank")))
                              .otherwise(F.lit(-1)))
    filled = first.where("bin >= 0").groupBy("bin").agg((F.lit(CAPACITY) - F.sum("length")).alias("gap"))
    bins = number_rows(filled, [F.col("gap"), F.col("bin")]).select("bin", "gap", (F.col("rn") - 1).alias("place"))
    gaps = bins.groupBy("gap").agg(F.count(F.lit(1)).alias("n")).collect()  # at most CAPACITY rows
    rows, _ = plan.best_fit(np.array([r["gap"] for r in gaps], np.int64), np.array([r["n"] for r in gaps], np.int64))

    configured = first.where("bin >= 0").join(bins.select("bin", "place"), "bin").withColumn("sequence_id", F.col("place") + plan.full)
    others = first.where("bin < 0").withColumn("sequence_id", F.when(F.col("rank") < plan.full, F.col("rank")).otherwise(
        _place(rows, 3)(F.col("rank")) + plan.full))
    columns = [c for c in ranked.columns if c != "rank"]
    # A sequence has at most CAPACITY pieces, as each has a token at least.
    inside = Window.partitionBy("sequence_id").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    return configured.drop("bin", "place").unionByName(others.drop("bin")).withColumn(
        "offset", F.coalesce(F.sum("length").over(inside), F.lit(0))).select(*columns, "sequence_id", "offset")
