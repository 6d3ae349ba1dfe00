"""Periodic runs of words by an enhanced suffix array.

A run is a stretch of words with smallest period q that no neighbouring word
extends, of ``min_length`` words and 2q at least. Its last square (two equal
halves of q words) is branching: the two halves are followed by different
words, so the suffixes at its two halves share exactly q words. Hence

1. the words of a slice of documents become numbers, own ones per document,
   and are joined to one sequence with a separator after each document;
2. the suffixes are sorted by prefix doubling; after the first ``floor`` words
   only suffixes with an equal partner are sorted further. ISA is the inverse;
3. common prefixes of neighbours: directly compared where the words before
   differ, one less than at the position before elsewhere;
4. every neighbour pair k with a common prefix of d words splits its LCP
   interval in two. The suffixes i of the smaller side ask by ISA whether
   i + d or i - d lies in the other side; if so, a branching square of period d
   begins there. A stack of positions finds the intervals; there are no nodes;
5. squares are rotated to the left as long as the words agree, which gives the
   run. Squares that end at the same word with a multiple of a period found
   belong to the same run; they are merged into it.

``floor`` words of common prefix are asked for, the most for which every run
has a branching square that deep (4 for runs of 12 words): a run of a shorter
period has one at a multiple of it. Its own period is then read off the square.

Work is n log n per document, and about linear for prose. Memory follows the
slice, about a megabyte of text, or the longest single document.

Defined cases: words are runs of bytes other than space and 0x09 to 0x0D; null
and empty texts have no words and no runs; rows of equal id are documents of
their own; a null id is kept; ties between longest runs go to the smaller
start, then period; an empty table gives an empty result; extra columns are
not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import slices, texts, utf8

MIN_LENGTH = 12
CELLS = 1 << 20  # elements that one vectorised step looks at


def depth_floor(min_length: int) -> int:
    """Largest depth such that each shorter period has a multiple not below it
    of which two fit into ``min_length`` words."""
    floor = 1
    while all(2 * q * -(-(floor + 1) // q) <= min_length for q in range(1, floor + 1)):
        floor += 1
    return floor


def agreeing(t: np.ndarray, a: np.ndarray, b: np.ndarray, step: int, most: np.ndarray) -> np.ndarray:
    """How many words from places ``a`` and ``b`` on agree (backwards if
    ``step`` is -1), ``most`` at most. The window doubles while words agree."""
    out = np.zeros(len(a), np.int64)
    left, width = np.flatnonzero(most > 0), 8
    while len(left):
        on, rows = [], max(1, CELLS // width)
        for k in range(0, len(left), rows):
            part = left[k: k + rows]
            at = out[part][:, None] + np.arange(width)
            inside = at < most[part][:, None]
            at = np.where(inside, at, 0) * step
            differ = ~inside | (t[a[part][:, None] + at] != t[b[part][:, None] + at])
            stop = differ.any(1)
            out[part] += np.where(stop, differ.argmax(1), width)
            on.append(part[~stop])
        left, width = np.concatenate(on), min(2 * width, CELLS)
    return out


def suffix_array(t: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffix array and inverse of a sequence whose every suffix is cut by a
    word of its own, and for each place of the array whether its suffix shares
    ``depth`` words (a power of two) with the one before."""
    n, h = len(t), 1
    rank = t
    places = np.arange(n)
    while h <= depth:  # ranks by one word, then by 2, 4, ... words, of all suffixes
        following = np.zeros(n, np.int64)
        if h > 1:
            following[: n - h // 2] = rank[h // 2:] + 1
            key = rank * (n + 2) + following
        else:
            key = rank
        order = np.argsort(key, kind="stable")
        new = np.ones(n, bool)
        new[1:] = key[order[1:]] != key[order[:-1]]
        rank = np.empty(n, np.int64)
        rank[order] = np.maximum.accumulate(np.where(new, places, 0))
        h *= 2
    near = ~new
    h = depth
    tied = near.copy()
    tied[:-1] |= near[1:]
    slots = np.flatnonzero(tied)
    while len(slots):
        at = order[slots]
        first, second = rank[at], rank[at + h]
        by = np.lexsort((second, first))
        at, first, second = at[by], first[by], second[by]
        new = np.ones(len(slots), bool)
        new[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
        order[slots] = at
        rank[at] = slots[np.maximum.accumulate(np.where(new, np.arange(len(slots)), 0))]
        tied = ~new
        tied[:-1] |= ~new[1:]
        slots = slots[tied]
        h *= 2
    return order, rank, near


def common_prefixes(t: np.ndarray, order: np.ndarray, near: np.ndarray) -> np.ndarray:
    """For each place of the suffix array that is ``near`` the one before, the
    number of words both share; 0 elsewhere."""
    n = len(t)
    k = np.flatnonzero(near)
    i, j = order[k], order[k - 1]
    alone = (i == 0) | (j == 0) | (t[i - 1] != t[j - 1])
    by_place, last = np.zeros(n, np.int64), np.zeros(n, np.int64)
    a, b = i[alone], j[alone]
    by_place[a] = agreeing(t, a, b, 1, n - np.maximum(a, b))
    last[a] = a
    last = np.maximum.accumulate(last)
    out = np.zeros(n, np.int64)
    out[k] = by_place[last[i]] + last[i] - i
    return out


def sides(k: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Neighbour pairs k (places of the suffix array, ascending) and the words
    they share: first place of the interval on the left of each pair and last
    place of the one on its right. Of equal pairs the later one is inside."""
    left, right, stack = [0] * len(k), [0] * len(k), []
    places, depths = k.tolist(), depth.tolist()
    begin = last = -2
    for x, (place, d) in enumerate(zip(places, depths)):
        if place != last + 1:
            for y in stack:
                right[y] = last
            stack, begin = [], place - 1
        while stack and depths[stack[-1]] >= d:
            right[stack.pop()] = place - 1
        left[x] = places[stack[-1]] if stack else begin
        stack.append(x)
        last = place
    for y in stack:
        right[y] = last
    return np.array(left, np.int64), np.array(right, np.int64)


def branching_squares(order: np.ndarray, rank: np.ndarray, shared: np.ndarray, floor: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and period of every square whose halves are followed by different
    words, of periods from ``floor`` on."""
    n = len(order)
    k = np.flatnonzero(shared >= floor)
    depth = shared[k]
    left, right = sides(k, depth)
    on_left = k - left <= right - k + 1
    low, size = np.where(on_left, left, k), np.where(on_left, k - left, right - k + 1)
    other_low, other_high = np.where(on_left, k, left), np.where(on_left, right, k - 1)
    starts, periods = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    total = np.cumsum(size)
    for some in np.split(np.arange(len(k)), np.searchsorted(total, np.arange(CELLS, total[-1] if len(k) else 0, CELLS))):
        of = np.repeat(some, size[some])
        slot = low[of] + np.arange(len(of)) - np.repeat(np.cumsum(size[some]) - size[some], size[some])
        i, d = order[slot], depth[of]
        for partner, begin in ((i + d, i), (i - d, i - d)):
            there = (partner >= 0) & (partner < n)
            at = rank[np.where(there, partner, 0)]
            hit = there & (other_low[of] <= at) & (at <= other_high[of])
            starts.append(begin[hit])
            periods.append(d[hit])
    return np.concatenate(starts), np.concatenate(periods)


def merged(t: np.ndarray, start: np.ndarray, period: np.ndarray, floor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and smallest period of the runs that the squares belong to."""
    found = [(np.zeros(0, np.int64),) * 3]
    by = np.lexsort((period, start + 2 * period))
    start, period = start[by], period[by]
    while len(start):
        end = start + 2 * period
        new = np.ones(len(end), bool)
        new[1:] = end[1:] != end[:-1]
        i, d = start[new], period[new]  # the shortest square at each end
        q = d.copy()
        for g in range(1, floor):
            fits = (q == d) & (d > g) & (d % g == 0)
            a = i[fits]
            whole = agreeing(t, a, a + g, 1, 2 * d[fits] - g) == 2 * d[fits] - g
            q[np.flatnonzero(fits)[whole]] = g
        s = i - agreeing(t, i - 1, i + q - 1, -1, i)
        found.append((s, end[new], q))
        mine = np.cumsum(new) - 1
        left = (period % q[mine] != 0) | (start < s[mine])
        start, period = start[left], period[left]
    return tuple(np.concatenate(x) for x in zip(*found))


def runs(t: np.ndarray, min_length: int = MIN_LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of the runs of a sequence of numbers in which
    words of their own separate the parts that no run may cross, and end it;
    by start, then period."""
    if len(t) <= min_length:
        return (np.zeros(0, np.int64),) * 3
    floor = depth_floor(min_length)
    order, rank, near = suffix_array(t, 1 << (floor.bit_length() - 1))
    squares = branching_squares(order, rank, common_prefixes(t, order, near), floor)
    start, end, period = merged(t, *squares, floor)
    by = np.lexsort((period, start))
    by = by[(end - start)[by] >= min_length]
    return start[by], (end - start)[by], period[by]


def found_runs(docs: DataFrame, min_length: int = MIN_LENGTH, arrange: Callable[[str, int], np.ndarray | None] | None = None,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, runs (array of start, length and
    period in words, by start, then period) and collapsed, the text's words
    joined by one space without those that any run repeats. ``arrange`` may
    give, for a document's id as text and its number of words, the places of
    the words that stand in the document instead of its own."""

    def one_slice(part: pa.RecordBatch) -> pa.RecordBatch:
        held, numbers, base = [], [], 0
        raw, offsets = utf8(part.column("text"))
        raw = raw.tobytes()
        for doc_id, begin, end in zip(part.column("key").to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist()):
            words = raw[begin:end].split()
            number = {w: x for x, w in enumerate(dict.fromkeys(words), base)}
            ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
            places = arrange(doc_id, len(words)) if arrange and words else None
            if places is not None:
                words, ids = [words[x] for x in places.tolist()], ids[places]
            base += len(number) + 1
            held.append(words)
            numbers.append(np.append(ids, base - 1))  # and a separator
        begins = np.cumsum([0] + [len(x) for x in numbers])
        start, length, period = runs(np.concatenate(numbers), min_length)
        borders = np.searchsorted(start, begins)
        lists, collapsed = [], []
        for x, words in enumerate(held):
            mine = slice(borders[x], borders[x + 1])
            of = np.stack([start[mine] - begins[x], length[mine], period[mine]], 1)
            if len(of):
                edge = np.zeros(len(words) + 1, np.int64)
                np.add.at(edge, of[:, 0] + of[:, 2], 1)
                np.add.at(edge, of[:, 0] + of[:, 1], -1)
                words = [words[y] for y in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]
            lists.append([{"start": a, "length": b, "period": c} for a, b, c in of.tolist()])
            collapsed.append(b" ".join(words))
        return pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array([len(w) for w in held], pa.int64()),
             pa.array(lists, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
             pc.cast(pa.array(collapsed, pa.binary()), options=pc.CastOptions(pa.string(), allow_invalid_utf8=True))], ["doc_id", "n_words", "runs", "collapsed"])

    def run(batches: Iterable[pa.RecordBatch]):
        for part in slices(batches):
            yield one_slice(part)

    source = texts(docs, id_col, text_col)
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.selectExpr("doc_id", "coalesce(cast(doc_id AS string), '') AS key", "text").mapInArrow(
        run, f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def periodic_tail(doc_id: str, n: int) -> np.ndarray | None:
    """The test rule: of one document in ten (crc32 of its id as text) the
    words from some place on are repeated with some period."""
    h = zlib.crc32(doc_id.encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    places = np.arange(n)
    places[a:] = a + (places[a:] - a) % p
    return places
