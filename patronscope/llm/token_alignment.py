"""Alignment of two tokenizers over a corpus, with pair counts by external sorting.

Tokens of A and B that overlap in a text's bytes are linked. How often a pair of ids is linked in the whole corpus is
counted as an external sort does it: every task gathers pair-document records, and each time its memory is full it sorts
them, cuts them by a radix of the B id and spills one zstd run for each radix to the shared folder. A task of the second
step merges the runs of a radix with a heap and counts each pair. The counts, in order of B id and then A id, give the
maxima of each B id as they stream by. The third step streams the same runs again, next to the counts of their radix, and
sends each document its contributions.

A radix is dealt out over several salts, so a B id that stands in every document is counted in many tasks; what meets in
one place afterwards is one number for each pair of ids, and the vocabularies bound these.
"""

from __future__ import annotations

import hashlib
import heapq
import os
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby
from operator import itemgetter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .staging import staged

TOKENIZER_A, TOKENIZER_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Pair-document records that a task holds before it spills them.
SPILL_RECORDS = 1 << 21
#: Radixes of the B id; a spill is one run for each.
RADIXES = 32
#: Runs merged by one heap.
FAN_IN = 64
#: Pairs in one row of the table of counts.
COUNT_PAIRS = 1 << 16
#: Distinct pieces of text (and their characters) remembered with their tokens in a task, before the memory is cleared.
REMEMBERED, REMEMBERED_CHARACTERS = 400_000, 1 << 23
#: Characters of text encoded at a time.
CHUNK_CHARACTERS = 1 << 20

_SPACE = "▁"


def byte_level_alphabet() -> dict[str, int]:
    """The characters that byte-level vocabularies use for bytes: printable ones stand for themselves, the others follow
    from 256 on in order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def of_text(ends: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of values that stand end to end, ``ends`` telling where each text's values end."""
    total = np.concatenate([[0], np.cumsum(values)])
    return np.diff(total[ends], prepend=0)


def spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of each of several stretches, end to end."""
    return np.arange(int(size.sum())) + np.repeat(start - (np.cumsum(size) - size), size)


class Aligner:
    """Tokens and links of texts, each distinct piece encoded once.

    A piece is a run of white space and what follows up to the next one. A never joins other characters with white
    space after them; nor does B where no entry of its vocabulary has a space after another character, or a line feed.
    Then neither tokenizer sees over the bounds of a piece, and a text's groups are those of its pieces. With any
    other B a text is one piece.
    """

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        alphabet = byte_level_alphabet()
        vocabulary = self.a.get_vocab()
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for t, i in vocabulary.items():
            self.bytes_a[i] = bytes(alphabet[c] for c in t) if all(c in alphabet for c in t) else t.encode()
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(t[3:5], 16)]) if self.b.is_byte(i) else t.replace(_SPACE, " ").encode() for i, t in enumerate(names)]
        if len(names) > 1 << 15 or len(self.bytes_a) > 1 << 16:
            raise ValueError("ids of A need 16 bits and ids of B 15")
        self.size_a, self.size_b = (np.array(list(map(len, x))) for x in (self.bytes_a, self.bytes_b))
        # Every id as text with what may follow it: another token of its side, the other side, the next group.
        self.written = [np.array([f"{i}{mark}".encode() for i in range(1 << 16)], object) for mark in ",|;"]
        separable = not any("\n" in t or re.search(f"[^{_SPACE}]{_SPACE}", t) for t in names)
        self.cut = re.compile(r"[ \n]\s*\S*(?:[^\S \n]\s*\S*)*" if separable else r"(?s:.+)").findall
        self.space = self.b.piece_to_id(_SPACE)
        self.clear()

    def clear(self) -> None:
        self.number, self.groups, self.characters = {}, [], 0
        #: By piece: spelt, n_a, n_b, n_groups, n_links; where its pairs end.
        self.counts, self.ends = np.zeros((0, 5), np.int64), np.zeros(0, np.int64)
        self.pairs, self.links = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _tokens(self, pieces: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """B adds a space to what it encodes: a piece with one in front gives it up, the others lose it afterwards."""
        a = [e.ids for e in self.a.encode_batch_fast(pieces, add_special_tokens=False)]
        b = self.b.encode([p[1:] if p[0] == " " else p for p in pieces], num_threads=1)
        return a, [[self.space] if p == " " else ids if p[0] == " " else ids[1:] for p, ids in zip(pieces, b)]

    def learn(self, pieces: list[str]) -> None:
        a, b = self._tokens(pieces)
        data = [p.encode() for p in pieces]
        counted = lambda x: (np.array(list(map(len, x)), np.int64), np.fromiter((i for ids in x for i in ids), np.int64))
        (n_a, ids_a), (n_b, ids_b), size = counted(a), counted(b), np.array(list(map(len, data)))
        whole = b"".join(data)
        spelt = (of_text(np.cumsum(n_a), self.size_a[ids_a]) == size) & (of_text(np.cumsum(n_b), self.size_b[ids_b]) == size)
        if not (spelt.all() and whole == b"".join([self.bytes_a[i] for i in ids_a]) == b"".join([self.bytes_b[i] for i in ids_b])):
            spelt = np.array([b"".join([self.bytes_a[i] for i in x]) == d == b"".join([self.bytes_b[i] for i in y]) for d, x, y in zip(data, a, b)])
            for k in np.flatnonzero(~spelt).tolist():
                a[k] = b[k] = []
            (n_a, ids_a), (n_b, ids_b) = counted(a), counted(b)
        # All pieces stand end to end. A stretch between two neighbouring token ends belongs to one token of each side,
        # and every overlap of two tokens is one such stretch.
        end_a, end_b = np.cumsum(self.size_a[ids_a]), np.cumsum(self.size_b[ids_b])
        stretch = np.union1d(end_a, end_b)
        at_a, at_b = np.searchsorted(end_a, stretch), np.searchsorted(end_b, stretch)
        both = np.isin(end_a, end_b, assume_unique=True)  # A tokens that close a group
        group_a = np.cumsum(both) - both
        shut = end_a[both]
        group_b = np.searchsorted(shut, end_b)
        last_a, last_b = np.diff(group_a, append=-1) != 0, np.diff(group_b, append=-1) != 0
        stop_a, stop_b = np.cumsum(n_a), np.cumsum(n_b)
        n_groups = of_text(stop_a, both)
        owner = np.searchsorted(stop_a, at_a, "right")
        # Text of the groups: tokens in order of group, side and place.
        order = np.lexsort((np.concatenate([np.zeros(len(ids_a), np.int8), np.ones(len(ids_b), np.int8)]), np.concatenate([group_a, group_b])))
        words = np.concatenate([np.where(last_a, self.written[1][ids_a], self.written[0][ids_a]),
                                np.where(last_b, self.written[2][ids_b], self.written[0][ids_b])])[order].tolist() if len(order) else []
        text = b"".join(words)
        length = np.cumsum([0, *map(len, words)])
        stops = length[stop_a + stop_b].tolist()
        # Pairs of a piece, each once with its links.
        key = owner << 32 | ids_b[at_b] << 16 | ids_a[at_a]
        distinct, links = np.unique(key, return_counts=True)
        self.number.update(zip(pieces, range(len(self.groups), len(self.groups) + len(pieces))))
        self.groups += [text[s:e] for s, e in zip([0, *stops], stops)]
        self.characters += sum(map(len, pieces))
        n_links = np.bincount(owner, minlength=len(pieces))
        self.counts = np.concatenate([self.counts, np.stack([spelt.astype(np.int64), n_a, n_b, n_groups, n_links], axis=1)])
        self.ends = np.concatenate([self.ends, len(self.pairs) + np.searchsorted(distinct, np.arange(1, len(pieces) + 1) << 32)])
        self.pairs, self.links = np.concatenate([self.pairs, distinct & 0xFFFFFFFF]), np.concatenate([self.links, links])

    def align(self, texts: list[str | None]) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray, np.ndarray]:
        """For each text n_a, n_b, n_groups, n_links and its groups; for all, records (text, pair, links) in any order."""
        if len(self.groups) > REMEMBERED or self.characters > REMEMBERED_CHARACTERS:
            self.clear()
        cut = [self.cut(" " + t) if t else [] for t in texts]
        flat = [p for own in cut for p in own]
        missing = [p for p in dict.fromkeys(flat) if p not in self.number]
        if missing:
            self.learn(missing)
        numbers = list(map(self.number.__getitem__, flat))
        each = np.array(numbers, np.int64)
        size = np.array(list(map(len, cut)), np.int64)
        ends = np.cumsum(size)
        spelt = (size > 0) & (of_text(ends, self.counts[each, 0]) == size)
        sums = np.stack([of_text(ends, self.counts[each, i]) for i in range(1, 5)], axis=1) * spelt[:, None]
        groups = [b"".join(map(self.groups.__getitem__, numbers[e - n:e]))[:-1] if good else b""
                  for e, n, good in zip(ends.tolist(), size.tolist(), spelt.tolist())]
        key, times = np.unique((np.repeat(np.arange(len(texts)), size) << 32 | each)[np.repeat(spelt, size)], return_counts=True)
        doc, piece = key >> 32, key & 0xFFFFFFFF
        start = np.where(piece > 0, self.ends[piece - 1], 0) if len(piece) else piece
        many = self.ends[piece] - start
        place = spread(start, many)
        return sums, groups, np.repeat(doc, many), self.pairs[place], self.links[place] * np.repeat(times, many)


def pack_arrays(*arrays: np.ndarray) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(struct.pack(f"<{len(arrays)}I", *map(len, arrays)) + b"".join(x.tobytes() for x in arrays))


def unpack_arrays(data: bytes, *kinds: type) -> list[np.ndarray]:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(data)
    sizes, at, found = struct.unpack_from(f"<{len(kinds)}I", raw), 4 * len(kinds), []
    for kind, size in zip(kinds, sizes):
        found.append(np.frombuffer(raw, kind, size, at))
        at += size * np.dtype(kind).itemsize
    return found


def totals(key: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sum of their values."""
    order = np.argsort(key, kind="stable")
    key, value = key[order], value[order]
    head = np.ones(len(key), bool)
    head[1:] = key[1:] != key[:-1]
    at = np.flatnonzero(head)
    return key[at], np.add.reduceat(value, at) if len(at) else value


def spilled(doc: np.ndarray, pair: np.ndarray, links: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """One sorted run for each radix: distinct pairs (steps), documents of each, documents, links."""
    key, links = totals(pair << 32 | doc, links)
    pair, doc = key >> 32, key & 0xFFFFFFFF
    radix = (pair >> 16) % RADIXES
    for r in np.unique(radix).tolist():
        own = radix == r
        distinct, often = np.unique(pair[own], return_counts=True)
        yield r, pack_arrays(np.diff(distinct, prepend=0).astype(np.uint32), often.astype(np.uint32), doc[own].astype(np.uint32), links[own])


def opened(run: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs, documents of each, documents and links of a run."""
    steps, often, doc, links = unpack_arrays(run, np.uint32, np.uint32, np.uint32, np.int64)
    return np.cumsum(steps, dtype=np.int64), often.astype(np.int64), doc.astype(np.int64), links


def counted(run: bytes) -> list[tuple[int, int]]:
    """(pair, links) of a run, in order."""
    pair, often, _, links = opened(run)
    return list(zip(pair.tolist(), np.add.reduceat(links, np.cumsum(often) - often).tolist()))


def merge(runs: list[list[tuple[int, int]]]) -> list[tuple[int, int]]:
    """A heap takes the smallest pair of all runs in turn; equal pairs meet and are summed."""
    return [(pair, sum(n for _, n in same)) for pair, same in groupby(heapq.merge(*runs), itemgetter(0))]


def _encode(path_a: str, path_b: str, with_groups: bool, spill_records: int):
    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(path_a, path_b)
        new_spill = lambda: int.from_bytes(os.urandom(8), "little") >> 1
        spill, ordinal, held, size = new_spill(), 0, [], 0

        def rows(document: pa.Array, sums: np.ndarray, groups: list[bytes]) -> pa.RecordBatch:
            n = len(groups)
            hashes = [hashlib.sha256(g).hexdigest() if g else "" for g in groups]
            kept = pa.array([g.decode() for g in groups] if with_groups else [None] * n, pa.string())
            return pa.RecordBatch.from_arrays(
                [document, pa.array([spill] * n, pa.int64()), pa.array(range(ordinal, ordinal + n), pa.int32()), *map(pa.array, sums.T), pa.array(hashes, pa.string()),
                 kept, pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names)

        def runs(kind: pa.DataType) -> pa.RecordBatch:
            found = list(spilled(*map(np.concatenate, zip(*held)))) if held else []
            n = len(found)
            return pa.RecordBatch.from_arrays(
                [pa.nulls(n, kind), pa.array([spill] * n, pa.int64()), pa.nulls(n, pa.int32()), *[pa.nulls(n, pa.int64())] * 4, *[pa.nulls(n, pa.string())] * 2,
                 pa.array([r for r, _ in found], pa.int32()), pa.array([x for _, x in found], pa.binary())], names)

        names = ["document", "spill", "ordinal", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "groups", "radix", "run"]
        kind = None
        for batch in batches:
            document, texts = batch.column("document"), batch.column("text")
            kind, at = document.type, 0
            lengths = np.cumsum(pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False))
            while at < len(texts):
                before = lengths[at - 1] if at else 0
                upto = max(int(np.searchsorted(lengths, before + CHUNK_CHARACTERS, "right")), at + 1)
                sums, groups, doc, pair, links = aligner.align(texts.slice(at, upto - at).to_pylist())
                yield rows(document.slice(at, upto - at), sums, groups)
                if len(doc):
                    key, links = totals(pair << 32 | doc, links)  # a document's own pieces meet at once
                    held.append(((key & 0xFFFFFFFF) + ordinal, key >> 32, links))
                    size += len(key)
                ordinal, at = ordinal + upto - at, upto
                if size >= spill_records:
                    yield runs(kind)
                    spill, ordinal, held, size = new_spill(), 0, [], 0
        if kind is not None and held:
            yield runs(kind)

    return encoded


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge the runs of each radix and salt, which come one after the other."""
    last, waiting = None, []
    emit = lambda: pa.RecordBatch.from_arrays(
        [pa.array(list(c), pa.int64()) for c in zip(*merge(waiting))], ["pair", "n"])
    for batch in batches:
        for radix, salt, run in zip(*(batch.column(n) for n in ("radix", "salt", "run"))):
            own = (radix.as_py(), salt.as_py())
            if waiting and own != last:
                yield emit()
                waiting = []
            last = own
            waiting.append(counted(run.as_py()))
            if len(waiting) >= FAN_IN:
                waiting = [merge(waiting)]
    if waiting:
        yield emit()


def _maxima(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts stream by in order of radix, B id and A id; when a B id ends its largest count is known."""
    radix, held, size = None, [], 0  # held: (pairs, counts, best) of whole B ids
    rest_pair, rest_n = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def close(pair: np.ndarray, n: np.ndarray) -> None:
        nonlocal size
        if len(pair):
            head = np.flatnonzero(np.diff(pair >> 16, prepend=-1))
            top = np.repeat(np.maximum.reduceat(n, head), np.diff(np.append(head, len(n))))
            held.append((pair, n, n == top))
            size += len(pair)

    def emit() -> pa.RecordBatch:
        nonlocal held, size
        pair, n, best = map(np.concatenate, zip(*held))
        held, size = [], 0
        return pa.RecordBatch.from_arrays([pa.array([radix], pa.int32()), pa.array([int(pair[0])], pa.int64()), pa.array([int(pair[-1])], pa.int64()),
                                           pa.array([pack_arrays(pair, n, best.astype(np.uint8))], pa.binary())], ["radix", "low", "high", "counts"])

    for batch in batches:
        radixes, pairs, numbers = (batch.column(c).to_numpy() for c in ("radix", "pair", "n"))
        edges = [0, *(np.flatnonzero(np.diff(radixes)) + 1).tolist(), len(radixes)] if len(radixes) else [0]
        for a, b in zip(edges[:-1], edges[1:]):
            if radix is not None and radixes[a] != radix:
                close(rest_pair, rest_n)
                rest_pair = rest_n = rest_pair[:0]
                if held:
                    yield emit()
            radix = int(radixes[a])
            pair, n = np.concatenate([rest_pair, pairs[a:b]]), np.concatenate([rest_n, numbers[a:b]])
            whole = int(np.searchsorted(pair >> 16, pair[-1] >> 16))  # the last B id may go on
            close(pair[:whole], n[:whole])
            rest_pair, rest_n = pair[whole:], n[whole:]
            if size >= COUNT_PAIRS:
                yield emit()
    close(rest_pair, rest_n)
    if held:
        yield emit()


def _contributions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each run adds to its documents: links of best pairs, and counts summed over links."""
    last, table = None, None
    for batch in batches:
        spills, found = [], []
        for radix, low, spill, run, counts in zip(*(batch.column(n) for n in ("radix", "low", "spill", "run", "counts"))):
            if (own := (radix.as_py(), low.as_py())) != last:
                last, table = own, unpack_arrays(counts.as_py(), np.int64, np.int64, np.uint8)
            keys, n, best = table
            pair, often, doc, links = opened(run.as_py())
            at = np.minimum(np.searchsorted(keys, pair), len(keys) - 1)
            there = keys[at] == pair
            weight, top = np.where(there, n[at], 0), np.where(there, best[at], 0)
            documents, sums = totals(doc, links * np.repeat(weight, often))
            _, tops = totals(doc, links * np.repeat(top, often))
            some = sums > 0
            spills.append(spill)
            found.append(pack_arrays(documents[some].astype(np.uint32), tops[some], sums[some]))
        yield pa.RecordBatch.from_arrays([pa.array([s.as_py() for s in spills], pa.int64()), pa.array(found, pa.binary())], ["spill", "sums"])


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The contributions of a spill's runs, which come one after the other, summed by document."""
    last, held = None, []

    def emit() -> pa.RecordBatch:
        doc, best, sums = map(np.concatenate, zip(*held))
        documents, tops = totals(doc, best)
        return pa.RecordBatch.from_arrays([pa.array([last] * len(documents), pa.int64()), pa.array(documents.astype(np.int32)), pa.array(tops),
                                           pa.array(totals(doc, sums)[1])], ["spill", "ordinal", "n_best", "count_sum"])

    for batch in batches:
        for spill, sums in zip(batch.column("spill").to_pylist(), batch.column("sums")):
            if held and spill != last:
                yield emit()
                held = []
            last = spill
            held.append(unpack_arrays(sums.as_py(), np.uint32, np.int64, np.int64))
    if held:
        yield emit()


@dataclass
class Alignment:
    """``documents``: a struct ``document`` and a struct ``alignment`` for each row. ``pairs``: b, a, links of the corpus and
    whether that is the largest count of the B id."""
    documents: DataFrame
    pairs: DataFrame


def align(docs: DataFrame, text: str = "text", path_a: str | None = None, path_b: str | None = None, with_groups: bool = False,
          spill_records: int = SPILL_RECORDS) -> Alignment:
    """Align the tokens of two tokenizers over all texts of ``docs``.

    A (a byte-level vocabulary) encodes a space and the text, B (a sentence-piece model that adds that space) the text,
    both without special tokens; their strings inside a text are plain text. ``documents`` has all columns but the text
    in ``document``, and in ``alignment``: n_a, n_b (tokens), n_groups (stretches between places where tokens of
    both end), n_links (pairs of tokens whose bytes overlap), n_best (links whose pair of ids is the most frequent of
    its B id in the corpus, ties included), count_sum (the corpus count of each link's pair, summed), groups_sha256 and,
    with ``with_groups``, the groups themselves as ``a1,a2|b1;a3|b2``. A text that is null, empty or not spelt by its
    tokens has no tokens: zeros and an empty text. Rows are counted one by one: repeated rows, null ids and
    extra columns do not matter. A table without rows gives none.
    """
    path_a, path_b = path_a or public_tokenizers.path(TOKENIZER_A), path_b or public_tokenizers.path(TOKENIZER_B)
    own = docs.select(F.struct(F.lit(0).alias("_"), *[F.col(c) for c in docs.columns if c != text]).alias("document"), F.col(text).cast("string").alias("text"))
    kind = own.schema["document"].dataType.simpleString()
    encoded = staged(own.mapInArrow(
        _encode(path_a, path_b, with_groups, spill_records),
        f"document {kind}, spill bigint, ordinal int, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, groups string, "
        "radix int, run binary"), "encoded")
    salts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) // RADIXES)
    runs = encoded.where("run IS NOT NULL").select("radix", F.pmod(F.xxhash64("spill"), F.lit(salts)).cast("int").alias("salt"), "spill", "run")
    partial = runs.repartition("radix", "salt").sortWithinPartitions("radix", "salt").select("radix", "salt", "run").mapInArrow(_count, "pair bigint, n bigint")
    total = partial.groupBy("pair").agg(F.sum("n").alias("n")).select((F.shiftright("pair", 16) % RADIXES).cast("int").alias("radix"), "pair", "n")
    counts = staged(total.repartition("radix").sortWithinPartitions("radix", "pair").mapInArrow(
        _maxima, "radix int, low bigint, high bigint, counts binary"), "counts")
    dealt = counts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    sums = runs.join(dealt, ["radix", "salt"]).mapInArrow(_contributions, "spill bigint, sums binary")
    found = sums.repartition("spill").sortWithinPartitions("spill").mapInArrow(
        _gather, "spill bigint, ordinal int, n_best bigint, count_sum bigint")
    rows = encoded.where("run IS NULL").join(found, ["spill", "ordinal"], "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    documents = rows.select(F.col("document").dropFields("_").alias("document") if len(docs.columns) > 1 else F.struct().alias("document"), F.struct(
        "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256", *(["groups"] if with_groups else [])).alias("alignment"))
    return Alignment(documents, counts.mapInArrow(_listed, "b int, a int, links bigint, best boolean"))


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for packed in batch.column("counts"):
            pair, n, best = unpack_arrays(packed.as_py(), np.int64, np.int64, np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array((pair >> 16).astype(np.int32)), pa.array((pair & 0xFFFF).astype(np.int32)), pa.array(n),
                                              pa.array(best.astype(bool))], ["b", "a", "links", "best"])
