"""License scan by diagonal voting.

Templates are license phrases, notices and the bodies of licenses. Every
rolling hash of k words of a text meets the template positions with the same
hash in a Spark join; a hit votes for the diagonal (place in the text minus
place in the template). Neighbouring diagonals of a template, as words more or
less in between make them, are merged into spans, and spans with enough votes
are verified word by word.

* A base phrase counts where its words stand consecutively.
* A notice or body is found where the edit distance to a stretch of the text
  leaves a similarity (1 - distance / its words) of ``least`` or more.

Nothing is lost before verification: k is the longest length of ``GRAMS`` of
which some gram must survive all edits that ``least`` allows (4 for whole
notices, 2 for short phrases), the votes asked for are the grams that must
survive, and diagonals are merged over gaps wider than the edits allow.
Verification is an alignment of one array row per template word, so its memory
follows the stretch.

The template table is a constant of this module (or a parameter checked to be
small), so it goes to every executor; texts are shuffled once, by document,
to meet their spans.

Defined cases: words are runs of ASCII letters and digits and of non-ASCII
characters, A-Z lower-cased; null and empty texts have no words and no label
(empty string, score 0, no first or last word); rows equal in id and text get
the same result each; null ids are kept; very long texts are scanned whole, a
task holds one of them at a time; an empty table gives an empty result; extra
columns, whatever their names, are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import slices, texts, utf8
from .wordhash import ALNUM, LOWER, mix, span_hashes, words

#: Phrases counted exactly, and their labels.
BASE = [("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")]

#: Phrases of the method's own labels, as the licenses' notices
#: have them, then the notices and bodies themselves.
NOTICES = [
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("creative commons attribution share alike", "cc-by-sa"),
    ("cc0 1 0 universal", "cc0"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("mozilla public license version 2 0", "mpl-2.0"),
    ("free and unencumbered software released into the public domain", "unlicense"),
    ("confidential and proprietary", "proprietary"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
     "associated documentation files (the Software), to deal in the Software without restriction, including "
     "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
     "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
     "following conditions: The above copyright notice and this permission notice shall be included in all "
     "copies or substantial portions of the Software.", "mit"),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted provided "
     "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
     "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
     "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
     "documentation and/or other materials provided with the distribution.", "bsd"),
    ("Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
     "compliance with the License. You may obtain a copy of the License at "
     "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
     "software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS "
     "OF ANY KIND, either express or implied.", "apache-2.0"),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
     "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
     "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
     "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.", "gpl"),
    ("This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
     "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
     "(at your option) any later version.", "lgpl"),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
     "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
     "(at your option) any later version.", "agpl"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
     "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.", "mpl-2.0"),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
     "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
     "isc"),
    ("This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
     "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
     "binary, for any purpose, commercial or non-commercial, and by any means.", "unlicense"),
    ("This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License.",
     "cc-by-sa"),
]
GRAMS = (4, 2)
_STEP = np.uint64(0x9FB21C651E98DF25)
_ONE = np.int64(1 << 32)  # an edit; below it, words from the start of a match to the end of the stretch
#: A word of the text before lower-casing.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    words: tuple[str, ...]
    label: str
    edits: int   # most edits of a match
    gram: int    # words of its grams
    votes: int   # grams of it that every match has


def template(phrase: str, label: str, least: float) -> Template:
    """The phrase with the longest grams of which some survive all edits."""
    found = tuple(w.lower() for w in re.findall(WORD, phrase))
    edits = int(len(found) * (1 - least) + 1e-9)
    for k in GRAMS:
        votes = len(found) - k + 1 - k * edits
        if votes >= 1:
            return Template(found, label, edits, k, votes)
    raise ValueError(f"no gram is sure to survive at a similarity of {least}: {phrase!r}")


def _grams(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every word the hashes of the grams that start there, one for each of
    ``GRAMS`` (0 where the row ends before), and the offsets of the rows in them."""
    low = LOWER[raw]
    starts, ends, row = words(low, offsets, ALNUM)
    h = span_hashes(low, starts, ends)
    out = np.zeros((len(h), len(GRAMS)), np.uint64)
    for column, k in enumerate(GRAMS):
        n = max(len(h) - k + 1, 0)
        total = np.zeros(n, np.uint64)
        for i in range(k):
            total = total * _STEP + h[i: i + n]
        out[:n, column] = np.where(row[:n] == row[len(h) - n:], mix(total, k), np.uint64(0))
    return out.ravel().view(np.int64), np.searchsorted(row, np.arange(len(offsets))) * len(GRAMS)


def template_positions(templates: list[Template]) -> list[tuple[int, int, int]]:
    """(hash, template, place) of every gram of the templates."""
    out = []
    for t, x in enumerate(templates):
        raw = np.frombuffer(" ".join(x.words).encode(), np.uint8)
        hashes = _grams(raw, np.array([0, len(raw)]))[0].reshape(-1, len(GRAMS))[:, GRAMS.index(x.gram)]
        out += [(h, t, i) for i, h in enumerate(hashes[: len(x.words) - x.gram + 1].tolist())]
    return out


def grams(docs: DataFrame) -> DataFrame:
    """doc_id, hash, grams: all rolling hashes of each text, word by word."""

    def run(batches):
        for part in slices(batches):
            values, offsets = _grams(*utf8(part.column("text")))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("hash"),
                 pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int64()))],
                ["doc_id", "hash", "grams"])

    return docs.mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, hash long, grams array<long>")


def spans(docs: DataFrame, templates: list[Template]) -> DataFrame:
    """doc_id, hash, spans (template, low and high diagonal) with votes enough
    to be worth verifying."""
    spark = docs.sparkSession
    positions = template_positions(templates)
    if len(positions) > 100_000:
        raise ValueError("the template table is meant to be small")
    table = F.broadcast(spark.createDataFrame(positions, "gram long, template int, place int"))
    sizes = F.broadcast(spark.createDataFrame(
        [(i, len(t.words), t.votes) for i, t in enumerate(templates)], "template int, size int, enough int"))
    at = F.floor(F.col("pos") / len(GRAMS))
    votes = (grams(docs).select("doc_id", "hash", F.posexplode("grams").alias("pos", "gram")).join(table, "gram")
             .groupBy("doc_id", "hash", "template", (at - F.col("place")).alias("diagonal"))
             .agg(F.countDistinct("place").alias("votes")).join(sizes, "template"))
    along = Window.partitionBy("doc_id", "hash", "template").orderBy("diagonal")
    new = F.when(F.col("diagonal") - F.lag("diagonal").over(along) <= F.col("size"), 0).otherwise(1)
    merged = (votes.withColumn("new", new).withColumn("span", F.sum("new").over(along))
              .groupBy("doc_id", "hash", "template", "enough", "span")
              .agg(F.min("diagonal").alias("low"), F.max("diagonal").alias("high"), F.sum("votes").alias("votes")))
    return (merged.filter(F.col("votes") >= F.col("enough"))
            .groupBy("doc_id", "hash").agg(F.collect_list(F.struct("template", "low", "high")).alias("spans")))


def alignments(phrase: np.ndarray, stretch: np.ndarray, edits: int) -> list[tuple[int, int, int]]:
    """(edits, start, end) of the stretches of words that the phrase becomes
    with so many edits at most, the nearest of those that overlap."""
    n = len(stretch)
    ramp = np.arange(n + 1) * _ONE
    row = np.arange(n, -1, -1)
    for x in phrase:
        new = row + _ONE
        np.minimum(new[1:], row[:-1] + (stretch != x) * _ONE, out=new[1:])
        row = np.minimum.accumulate(new - ramp) + ramp
    distance, start = row >> 32, n - (row & (_ONE - 1))
    out: list[tuple[int, int, int]] = []
    for end in np.flatnonzero(distance <= edits).tolist():
        this = int(distance[end]), int(start[end]), end
        if not out or this[1] >= out[-1][2]:
            out.append(this)
        elif this[0] < out[-1][0]:
            out[-1] = this
    return out


def _exact(phrase: np.ndarray, stretch: np.ndarray) -> list[int]:
    """Places of the phrase in the stretch."""
    n = max(len(stretch) - len(phrase) + 1, 0)
    same = np.ones(n, bool)
    for i, x in enumerate(phrase):
        same &= stretch[i: i + n] == x
    return np.flatnonzero(same).tolist()


def _verify(text: str, found: list[dict], templates: list[Template], vocabulary: dict[bytes, int], n_base: int) -> list[tuple]:
    """(template, first word, word after the last, similarity) of what is found."""
    if not found:
        return []
    raw = np.frombuffer(text.encode(), np.uint8)
    low = LOWER[raw]
    starts, ends, _ = words(low, np.array([0, len(raw)]), ALNUM)
    numbers = np.full(len(starts), -2)  # not looked up yet
    out = set()
    for s in found:
        t = templates[s["template"]]
        size = len(t.words)
        first, last = max(0, s["low"] - t.edits), min(len(starts), s["high"] + size + t.edits)
        for i in (np.flatnonzero(numbers[first:last] == -2) + first).tolist():
            numbers[i] = vocabulary.get(low[starts[i]: ends[i]].tobytes(), -1)
        phrase, stretch = np.array([vocabulary[w.encode()] for w in t.words]), numbers[first:last]
        if s["template"] < n_base:
            out |= {(s["template"], first + i, first + i + size, 1.0) for i in _exact(phrase, stretch)}
        else:
            out |= {(s["template"], first + i, first + j, 1 - d / size) for d, i, j in alignments(phrase, stretch, t.edits)}
    return sorted(out)


def _labels(own: list[tuple], templates: list[Template]) -> set[str]:
    """Labels of the matches that no nearer one overlaps."""
    kept, near = set(), []
    for match in sorted(own, key=lambda m: m[1]):
        near = [m for m in near if m[2] > match[1]]
        kept -= {m for m in near if m[3] < match[3]}
        if all(m[3] <= match[3] for m in near):
            kept.add(match)
        near.append(match)
    return {templates[m[0]].label for m in kept}


def found(docs: DataFrame, notices: list[tuple[str, str]] | None = None, least: float = 0.8,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The columns of :func:`scan` and ``matches``: label, first_word, last_word
    (words from 0) and similarity of every place that was verified."""
    source = texts(docs, id_col, text_col).withColumn("hash", F.xxhash64("text"))
    templates = ([template(p, x, 1.0) for p, x in BASE]
                 + [template(p, x, least) for p, x in (NOTICES if notices is None else notices)])
    candidates = spans(source, templates).select(F.struct("doc_id", "hash").alias("_d"), "spans")
    joined = (source.withColumn("d", F.struct("doc_id", "hash")).join(candidates, F.col("d") == F.col("_d"), "left")
              .select("doc_id", F.regexp_count("text", F.lit(WORD)).cast("long").alias("n_words"),
                      F.when(F.col("spans").isNull(), "").otherwise(F.col("text")).alias("text"), "spans"))
    vocabulary = {w.encode(): i for i, w in enumerate(sorted({w for t in templates for w in t.words}))}
    match = pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("similarity", pa.float64())])

    def run(batches):
        for part in slices(batches):
            out = {k: [] for k in ("n_base", "first_word", "last_word", "base_labels", "labels", "score", "matches")}
            for text, mine in zip(part.column("text").to_pylist(), part.column("spans").to_pylist()):
                every = _verify(text, mine, templates, vocabulary, len(BASE))
                base = [m for m in every if m[0] < len(BASE)]
                names = {templates[m[0]].label for m in base}
                own = _labels([m for m in every if m[0] >= len(BASE)], templates)
                at = [m[1] for m in base]
                for k, v in zip(out, (len(at), min(at, default=None), max(at, default=None), ",".join(sorted(names)),
                                      ",".join(sorted(names | own)), max((m[3] for m in every), default=0.0),
                                      [(templates[t].label, i, j - 1, like) for t, i, j, like in every])):
                    out[k].append(v)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("n_words"), *(pa.array(out[k], pa.int64()) for k in list(out)[:3]),
                 pa.array(out["base_labels"], pa.string()), pa.array(out["labels"], pa.string()), pa.array(out["score"], pa.float64()),
                 pa.array([[dict(zip(match.names, m)) for m in row] for row in out["matches"]], pa.list_(match))],
                ["doc_id", "n_words", *out])

    return joined.mapInArrow(run, f"doc_id {dict(source.dtypes)['doc_id']}, n_words long, n_base long, first_word long, "
                                  "last_word long, base_labels string, labels string, score double, "
                                  "matches array<struct<label string, first_word long, last_word long, similarity double>>")


def scan(docs: DataFrame, notices: list[tuple[str, str]] | None = None, least: float = 0.8,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score (similarity of the best verified span, 0 without one), for every row."""
    return found(docs, notices, least, id_col, text_col).drop("matches")
