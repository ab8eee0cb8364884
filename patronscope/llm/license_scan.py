"""Licence scans: an exact set-similarity join of text blocks with licence templates.

A template is the set of words of a licence notice. A block is a window of as many words as the template has, at every position
of a text and over line ends, so a notice is found however it is wrapped, and words far apart never make one. A block matches a
template if it contains at least MIN_CONTAINMENT of the template's words, among them all words that tell it from other licences,
and none that tells another. Words are ordered by their frequency over all lines of the corpus, rarest first, and filters leave
few blocks to count: a match has one of the template's first words (prefix), starts with a template word and has enough of
them at all (length), and so many after its rarest one (position).
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from . import textarrays as ta

MIN_CONTAINMENT = Fraction(4, 5)
Words = tuple[str, ...]
#: Phrases of the base rule and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Licence notices as their texts state them, one block each, with the label of a match.
TEMPLATES = {
    "apache_notice": ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    "apache_terms": ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    "apache_warranty": ("apache-2.0", "distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    "gpl_notice": ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    "gpl_terms": ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    "mit_notice": ("mit", "Released under the MIT License."),
    "mit_grant": ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    "bsd_terms": ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    "cc_by_nc_notice": ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    "cc_by_notice": ("cc-by-4.0", "Licensed under Creative Commons Attribution 4.0 International."),
    "cc_by_sa_notice": ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    "mpl_notice": ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License"),
}
#: Words that a block of a template must have, and words that it must not have.
TELLING = {
    "apache_notice": (("apache", "version", "2", "0"), ()),
    "apache_terms": (("compliance", "license"), ()),
    "apache_warranty": (("license", "warranties"), ()),
    "gpl_notice": (("gnu", "general", "public", "version", "3"), ("lesser", "affero")),
    "gpl_terms": (("gnu", "general", "public"), ("lesser", "affero")),
    "mit_notice": (("mit",), ()),
    "mit_grant": (("permission", "granted"), ()),
    "bsd_terms": (("redistribution", "binary"), ()),
    "cc_by_nc_notice": (("cc", "by", "nc", "4", "0"), ("sa", "nd")),
    "cc_by_notice": (("creative", "commons", "attribution", "4", "0"), ("noncommercial", "sharealike", "noderivatives", "noderivs")),
    "cc_by_sa_notice": (("cc", "by", "sa", "4", "0"), ("nc", "nd")),
    "mpl_notice": (("mozilla",), ()),
}


def words_of(text: str) -> list[bytes]:
    """Words of one text, as the scan sees them."""
    chunk = next(ta.chunks(pa.array([text]))).lowered()
    spans = ta.split(chunk, ta.NOT_ALPHANUMERIC)
    return [chunk.data[a:b].tobytes() for a, b in zip(spans.start, spans.end)]


def _hash(word: bytes) -> int:
    data = np.frombuffer(word, np.uint8)
    return int(ta.hash_spans(data, np.array([0]), np.array([len(data)]))[0])


class Scanner:
    """Finds the words of a small dictionary in the texts of a batch."""

    def __init__(self, templates: dict[str, tuple[str, str]], phrases: dict[str, str], telling: dict[str, tuple[Words, Words]] = TELLING):
        self.templates, self.phrases = templates, phrases
        self.telling = {name: tuple([w.encode() for w in part] for part in telling.get(name, ((), ()))) for name in templates}
        words = sorted({w for _, text in templates.values() for w in words_of(text)} | {w for p in phrases for w in words_of(p)}
                       | {w for parts in self.telling.values() for part in parts for w in part})
        self.words = words
        hashes = np.array([_hash(w) for w in words], np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.number = hashes[order], order
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[self.hashes >> np.uint64(48)] = True
        self.index = {w: i for i, w in enumerate(words)}

    def found(self, chunk: ta.Chunk) -> tuple[ta.Spans, np.ndarray]:
        """Words of the (lowered) chunk, and the dictionary number of each, -1 for others."""
        spans = ta.split(chunk, ta.NOT_ALPHANUMERIC)
        hashes = ta.hash_spans(chunk.data, spans.start, spans.end)
        numbers = np.full(len(hashes), -1)
        at = np.flatnonzero(self.maybe[hashes >> np.uint64(48)])
        place = np.minimum(np.searchsorted(self.hashes, hashes[at]), len(self.hashes) - 1)
        same = self.hashes[place] == hashes[at]
        numbers[at[same]] = self.number[place[same]]
        return spans, numbers

    def blocks(self, chunk: ta.Chunk, spans: ta.Spans, numbers: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, ta.Spans]:
        """Distinct (block, word rank) of dictionary words, sorted by both, and the blocks."""
        every = ta.lines(chunk)
        at = np.flatnonzero(numbers >= 0)
        block = np.searchsorted(every.start, spans.start[at], "right") - 1
        key = np.unique(block * len(self.words) + rank[numbers[at]])
        return key // len(self.words), key % len(self.words), every


def frequencies(docs: DataFrame, scanner: Scanner) -> np.ndarray:
    """For each dictionary word the number of blocks of the whole corpus that have it. What is collected is as long as the dictionary."""
    same = np.arange(len(scanner.words))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(same), np.int64)
        for batch in batches:
            for chunk in ta.chunks(batch.column(0)):
                chunk = chunk.lowered()
                _, words, _ = scanner.blocks(chunk, *scanner.found(chunk), same)
                total += np.bincount(words, minlength=len(same))
        yield pa.record_batch([pa.array(same), pa.array(total)], names=["word", "n"])

    rows = docs.select("text").mapInArrow(counted, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(len(same), np.int64)
    for r in rows:
        out[r["word"]] = r["n"]
    return out


class Matcher:
    """The join of the blocks of a batch with all templates."""

    def __init__(self, scanner: Scanner, frequency: np.ndarray, containment: Fraction):
        self.scanner = scanner
        self.rank = np.empty(len(frequency), np.int64)
        self.rank[np.lexsort((np.arange(len(frequency)), frequency))] = np.arange(len(frequency))
        self.templates = []
        for name, (label, text) in scanner.templates.items():
            own = np.unique([self.rank[scanner.index[w]] for w in words_of(text)])  # rarest first
            needed, barred = ([scanner.index[w] for w in part] for part in scanner.telling[name])
            self.templates.append((name, label, own, ceil(containment * len(own)), len(words_of(text)), needed, barred))
        self.phrases = [(np.array([scanner.index[w] for w in words_of(p)]), label) for p, label in scanner.phrases.items()]

    def places(self, spans: ta.Spans, numbers: np.ndarray) -> Iterator[tuple[np.ndarray, str]]:
        """First words of all places of each phrase, and its label."""
        for phrase, label in self.phrases:
            size = len(phrase)
            at = np.flatnonzero(numbers[:max(len(numbers) - size + 1, 0)] == phrase[0])
            for i in range(1, size):
                at = at[(numbers[at + i] == phrase[i]) & (spans.text[at + i] == spans.text[at])]
            yield at, label

    def blocks(self, spans: ta.Spans, numbers: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, str, str, int, int]]:
        """For each template: first words of matching windows, the number of its words in each, its name, label, size and
        width. A window starts with a template word: any other holds no more than one that does."""
        known = np.flatnonzero(numbers >= 0)
        ranks = self.rank[numbers[known]]
        for name, label, own, least, width, needed, barred in self.templates:
            place = np.minimum(np.searchsorted(own, ranks), len(own) - 1)
            common = own[place] == ranks
            at, place = known[common], place[common]
            stop = np.minimum(at + width, spans.bounds[spans.text[at] + 1])
            end = np.searchsorted(at, stop)
            rare = np.concatenate([[0], np.cumsum(place <= len(own) - least)])
            here = np.arange(len(at))
            first = here[(end - here >= least) & (rare[end] > rare[:-1])]
            for words, wanted in ((needed, True), (barred, False)):
                for word in words:
                    places = np.flatnonzero(numbers == word)
                    first = first[(np.searchsorted(places, at[first]) < np.searchsorted(places, stop[first])) == wanted]
            order = np.argsort(place, kind="stable")
            same = np.flatnonzero(place[order[1:]] == place[order[:-1]])
            before = np.full(len(at), -1)  # the hit before with the same word
            before[order[same + 1]] = order[same]
            counted = np.zeros(len(first), np.int64)
            for i in range(width):
                other = np.minimum(first + i, len(at) - 1)
                counted += (first + i < end[first]) & (before[other] < first)
            first, counted = first[counted >= least], counted[counted >= least]
            yield at[first], counted, name, label, len(own), width

    def scan(self, text: pa.Array) -> pa.Array:
        rows = []
        for chunk in ta.chunks(text):
            chunk = chunk.lowered()
            spans, numbers = self.scanner.found(chunk)
            found = [{"n_words": int(n), "n_base": 0, "first_word": None, "last_word": None, "base": set(), "labels": set(), "score": 0.0, "blocks": []}
                     for n in spans.counts]
            for at, label in self.places(spans, numbers):
                for t, start in zip(spans.text[at].tolist(), (at - spans.bounds[spans.text[at]]).tolist()):
                    row = found[t]
                    row["n_base"] += 1
                    row["first_word"] = start if row["first_word"] is None else min(row["first_word"], start)
                    row["last_word"] = start if row["last_word"] is None else max(row["last_word"], start)
                    row["base"].add(label)
                    row["labels"].add(label)
            every = ta.lines(chunk)
            for start, counted, name, label, size, width in self.blocks(spans, numbers):
                if not len(start):
                    continue
                # Windows that overlap are one place; its first best window is reported.
                new = np.append(True, (start[1:] >= start[:-1] + width) | (spans.text[start[1:]] != spans.text[start[:-1]]))
                place = np.cumsum(new) - 1
                best = np.lexsort((start, -counted, place))
                best = best[np.append(True, place[best[1:]] != place[best[:-1]])]
                line = np.searchsorted(every.start, spans.start[start[best]], "right") - 1
                for t, b, n in zip(spans.text[start[best]].tolist(), line.tolist(), counted[best].tolist()):
                    found[t]["labels"].add(label)
                    found[t]["score"] = max(found[t]["score"], n / size)
                    found[t]["blocks"].append({"line": b - int(every.bounds[t]), "template": name, "containment": n / size})
            for row in found:
                row["base_labels"] = ",".join(sorted(row.pop("base")))
                row["labels"] = ",".join(sorted(row["labels"]))
                row["blocks"].sort(key=lambda x: (x["line"], x["template"]))
            rows += found
        return pa.array(rows, pa.struct([
            ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()),
            ("labels", pa.string()), ("score", pa.float64()),
            ("blocks", pa.list_(pa.struct([("line", pa.int64()), ("template", pa.string()), ("containment", pa.float64())])))]))


def license_scan(docs: DataFrame, templates: dict[str, tuple[str, str]] = TEMPLATES, phrases: dict[str, str] = PHRASES,
                 containment: Fraction = MIN_CONTAINMENT, telling: dict[str, tuple[Words, Words]] = TELLING) -> DataFrame:
    """All columns of ``docs`` in a struct ``document``, and a struct ``license``.

    n_words; places of the phrases (n_base, first_word, last_word, base_labels); the matching ``blocks`` (line, from 0,
    that the window starts in; template, containment; of overlapping windows the first best one); ``labels`` of both, sorted; ``score``, the highest containment of a matching block, 0 without
    one. A null text counts as empty. Repeated rows are scanned each for itself. Templates are part of the code that tasks get, so
    they should stay a few thousand; the corpus may have any size.
    """
    scanner = Scanner(templates, phrases, telling)
    matcher = Matcher(scanner, frequencies(docs, scanner), containment)
    kind = ("struct<n_words: bigint, n_base: bigint, first_word: bigint, last_word: bigint, base_labels: string, labels: string, score: double, "
            "blocks: array<struct<line: bigint, template: string, containment: double>>>")
    scanned = arrow_udf(lambda text: matcher.scan(text), kind)
    return docs.select(F.struct("*").alias("document")).withColumn("license", scanned(F.col("document.text")))


def oracle_sql() -> str:
    """Base places by leading words, containment by counting distinct words of each window."""
    words = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
    lowered = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    places = []
    for phrase, label in PHRASES.items():
        parts = phrase.split()
        test = " AND ".join(f"{'word' if i == 0 else f'next{i}'} = '{w}'" for i, w in enumerate(parts))
        places.append(f"SELECT doc_id, pos, '{label}' AS label FROM w WHERE {test}")
    template_rows = ", ".join(f"('{name}', '{label}', '{w.decode()}')" for name, (label, text) in TEMPLATES.items() for w in sorted(set(words_of(text))))
    widths = ", ".join(f"('{name}', {len(words_of(text))})" for name, (_, text) in TEMPLATES.items())
    telling = ", ".join(f"('{name}', '{w}', {wanted})" for name, parts in TELLING.items() for part, wanted in zip(parts, ("true", "false")) for w in part)
    return f"""
WITH d AS MATERIALIZED (SELECT doc_id, {lowered.format('text')} AS text FROM documents),
s AS (SELECT doc_id, unnest(regexp_extract_all(text, {words})) AS word, generate_subscripts(regexp_extract_all(text, {words}), 1) - 1 AS pos FROM d),
w AS MATERIALIZED (SELECT doc_id, pos, word, lead(word, 1) OVER x AS next1, lead(word, 2) OVER x AS next2, lead(word, 3) OVER x AS next3
      FROM s WINDOW x AS (PARTITION BY doc_id ORDER BY pos)),
p AS MATERIALIZED ({' UNION ALL '.join(places)}),
b AS (SELECT doc_id, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word FROM p GROUP BY doc_id),
t(template, label, word) AS (VALUES {template_rows}),
v(template, width) AS (VALUES {widths}),
q(template, word, wanted) AS (VALUES {telling}),
n AS (SELECT template, label, count(*) AS size FROM t GROUP BY template, label),
h AS MATERIALIZED (SELECT s.doc_id, t.template, v.width, s.pos, s.word FROM s JOIN t USING (word) JOIN v USING (template)),
k AS MATERIALIZED (SELECT doc_id, template, width, pos, count(DISTINCT word) OVER (PARTITION BY doc_id, template ORDER BY pos RANGE BETWEEN CURRENT ROW AND width - 1 FOLLOWING) AS common FROM h),
e AS MATERIALIZED (SELECT k.doc_id, k.template, k.pos, k.width, n.label, k.common / n.size::DOUBLE AS containment FROM k JOIN n USING (template)
      WHERE {MIN_CONTAINMENT.denominator} * k.common >= {MIN_CONTAINMENT.numerator} * n.size),
x AS (SELECT e.doc_id, e.template, e.pos, count(DISTINCT CASE WHEN q.wanted THEN q.word END) AS has, count(CASE WHEN NOT q.wanted THEN 1 END) AS bars
      FROM e JOIN s ON s.doc_id = e.doc_id AND s.pos >= e.pos AND s.pos < e.pos + e.width JOIN q ON q.template = e.template AND q.word = s.word GROUP BY ALL),
m AS MATERIALIZED (SELECT e.doc_id, e.label, e.containment FROM e JOIN x USING (doc_id, template, pos)
      WHERE bars = 0 AND has = (SELECT count(*) FROM q WHERE q.template = e.template AND q.wanted)),
g AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT doc_id, label FROM p UNION ALL SELECT doc_id, label FROM m) GROUP BY doc_id),
bl AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM p GROUP BY doc_id),
c AS (SELECT doc_id, count(*) AS n_words FROM s GROUP BY doc_id),
z AS (SELECT doc_id, max(containment) AS score FROM m GROUP BY doc_id)
SELECT d.doc_id, coalesce(c.n_words, 0) AS n_words, coalesce(b.n_base, 0) AS n_base, b.first_word::BIGINT AS first_word, b.last_word::BIGINT AS last_word,
       coalesce(bl.base_labels, '') AS base_labels, coalesce(g.labels, '') AS labels, coalesce(z.score, 0)::DOUBLE AS score
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN b USING (doc_id) LEFT JOIN bl USING (doc_id) LEFT JOIN g USING (doc_id) LEFT JOIN z USING (doc_id)
"""
