"""Near duplicates by order MinHash, verified by banded alignment.

Order MinHash: every k-mer of k words is labelled with its occurrence number,
so repeated k-mers count as often as they occur. For each of ``sketches`` hash
functions the ``length`` smallest labelled k-mers are taken and hashed together
in the order in which they stand in the text. Two texts share a sketch about as
likely as their k-mer sets and their order agree, which follows edit
similarity, not only set similarity.

1. Texts with equal words are one node; a huge group of copies is one row from
   here on. Membership goes back to the documents at the end.
2. Nodes with an equal sketch are in one bucket. Each is paired with the
   bucket's hub, its smallest node: a star, so the pairs grow with the buckets'
   members, never with their square. Pairs are verified once.
3. A pair that was refused shares a passage, not a text. Of its node the k-mers
   that the hub has too are left out, and the rest is sketched again: texts that
   are similar agree there as well, and texts that share the passage only do
   not. The new buckets give new stars, which are verified too.
4. Components of all verified pairs are the classes.

Many short sketches are taken (64 of 2 k-mers), so that a pair at the threshold
shares one with probability above 0.9 and a closer pair shares many, in buckets
with different hubs. A link is missed only if each sketch the two texts share,
of the whole and of the rest, has a hub that is similar to neither. Recall against
all pairs is measured in the tests and the README.

Verification: word-level edit distance within the band that the similarity
allows (``least``): by furthest-reaching points on its diagonals while the
distance is small, then row by row over the band; similarity = 1 - distance /
longer length.

Defined cases: words are runs of ASCII letters and digits and of non-ASCII
bytes, A-Z lower-cased; documents without words (null, empty) are alone in
their class; texts under k words are one k-mer; repeated rows are copies; the
class id is the smallest doc_id of the class (null ids only if there is no
other); very long texts are sketched a few hash functions at a time, and an
alignment holds one row of its band; an empty table gives an empty table; other
columns, whatever their names, are kept by ``deduplicated`` and not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, stored, texts, utf8
from .graph import components
from .wordhash import ALNUM, LOWER, mix, span_hashes, words

K, SKETCHES, LENGTH, LEAST = 5, 64, 2, 0.8
REST_SKETCHES = 16
CELLS = 1 << 18  # hash values held at a time
NEAR_EDITS = 24  # edits looked for on diagonals before the whole band is
CROWD = 5_000    # pairs of one hub that share a copy of its words
_STEP = np.uint64(0x100000001B3)
_TOP = np.uint64((1 << 64) - 1)


def kmers(w: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k consecutive words; of all words if there are fewer."""
    k = min(k, len(w))
    out = np.zeros(len(w) - k + 1, np.uint64)
    for j in range(k):
        out = out * _STEP + w[j: j + len(out)]
    return mix(out, 7)


def labelled(kmer: np.ndarray) -> np.ndarray:
    """The k-mers with their occurrence number mixed in."""
    order = np.argsort(kmer, kind="stable")
    same = kmer[order]
    new = np.ones(len(same), bool)
    new[1:] = same[1:] != same[:-1]
    if new.all():
        return kmer
    starts = np.flatnonzero(new)
    number = np.empty(len(kmer), np.uint64)
    number[order] = np.arange(len(kmer)) - np.repeat(starts, np.diff(np.append(starts, len(kmer))))
    return np.where(number > 0, mix(kmer + number * _STEP, 9), kmer)


def order_minhash(kmer: np.ndarray, sketches: int, length: int, seed: int = 0) -> np.ndarray:
    """Sketch hashes of a sequence of k-mers, as signed integers."""
    label = labelled(kmer)
    seeds = (np.arange(1, sketches + 1, dtype=np.uint64) + np.uint64(seed)) * np.uint64(0xA0761D6478BD642F)
    length, out = min(length, len(kmer)), []
    for part in np.array_split(seeds, -(-sketches * len(kmer) // CELLS)):
        h = (label[None, :] ^ part[:, None]) * np.uint64(0xE7037ED1A0B428DB)
        h ^= h >> np.uint64(32)
        rows, least = np.arange(len(part)), np.empty((len(part), length), np.int64)
        for x in range(length):
            least[:, x] = h.argmin(1)
            h[rows, least[:, x]] = _TOP
        least.sort(1)  # in text order
        value = part.copy()
        for x in range(length):
            value = value * _STEP + kmer[least[:, x]]
        out.append(value)
    return mix(np.concatenate(out)).view(np.int64)


def _row_words(batch: pa.RecordBatch, column: str = "text") -> list[np.ndarray]:
    raw, offsets = utf8(batch.column(column))
    low = LOWER[raw]
    starts, ends, row = words(low, offsets, ALNUM)
    h = span_hashes(low, starts, ends)
    return np.split(h, np.searchsorted(row, np.arange(1, batch.num_rows)))


def _node(w: np.ndarray) -> bytes:
    return hashlib.blake2b(w.tobytes(), digest_size=16).digest()


def _lists(rows: list[np.ndarray | None]) -> pa.Array:
    """Arrow lists of signed 64-bit integers; None is null."""
    sizes = [0 if r is None else len(r) for r in rows]
    values = np.concatenate([r for r in rows if r is not None] or [np.zeros(0, np.int64)])
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]), pa.int32()), pa.array(values, pa.int64()),
                                    mask=pa.array([r is None for r in rows], pa.bool_()))


def sketched(source: DataFrame, k: int, sketches: int, length: int) -> DataFrame:
    """doc_id, hash (of the text), node (128-bit digest of the words; null
    without words), key (its first 64 bits) and sketch."""

    def run(batches):
        for part in slices(batches):
            found = [w if len(w) else None for w in _row_words(part)]
            node = [None if w is None else _node(w) for w in found]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("hash"), pa.array(node, pa.binary()),
                 pa.array([None if x is None else _key(x) for x in node], pa.int64()),
                 _lists([None if w is None else order_minhash(kmers(w, k), sketches, length) for w in found])],
                ["doc_id", "hash", "node", "key", "sketch"])

    return source.withColumn("hash", F.xxhash64("text")).mapInArrow(
        run, f"doc_id {dict(source.dtypes)['doc_id']}, hash long, node binary, key long, sketch array<long>")


def _key(node: bytes) -> int:
    return int.from_bytes(node[:8], "little", signed=True)


def banded_distance(a: np.ndarray, b: np.ndarray, most: int) -> int | None:
    """Edit distance of two sequences if it is ``most`` at most, else None."""
    a, b = a.astype(np.int64), b.astype(np.int64)
    head = _agree(a, b, 0, 0, 1)
    a, b = a[head:], b[head:]
    tail = _agree(a[::-1], b[::-1], 0, 0, 1)
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    n = min(len(a), len(b))
    if not n or abs(len(a) - len(b)) > most:
        d = max(len(a), len(b))
        return d if not n and d <= most else None
    near = min(most, NEAR_EDITS)
    d = _on_diagonals(a, b, near)
    return d if d is not None or near == most else _by_rows(a, b, most)


def _agree(a: np.ndarray, b: np.ndarray, x: int, y: int, width: int = 16) -> int:
    """How many words from a[x] and b[y] on agree."""
    start, most = x, min(len(a) - x, len(b) - y)
    while x - start < most:
        size = min(width, most - (x - start))
        differ = a[x: x + size] != b[y: y + size]
        at = int(differ.argmax())
        if differ[at]:
            return x - start + at
        x, y, width = x + size, y + size, min(2 * width, 1 << 16)
    return most


def _on_diagonals(a: np.ndarray, b: np.ndarray, most: int) -> int | None:
    """``reach[k]``: the furthest place in ``a`` on diagonal k (place in b minus
    place in a) after d edits."""
    la, lb = len(a), len(b)
    goal = lb - la
    reach, d = {0: _agree(a, b, 0, 0)}, 0
    while reach.get(goal, -1) < la:
        d += 1
        if d > most:
            return None
        new = {}
        for k in range(max(-d, -la), min(d, lb) + 1):
            # The edits that are left must lead back to the goal's diagonal.
            if abs(goal - k) > most - d:
                continue
            x = max(reach.get(k, -2) + 1, reach.get(k - 1, -1), reach.get(k + 1, -2) + 1)
            x = min(x, la, lb - k)
            if x >= max(0, -k):
                new[k] = x + _agree(a, b, x, x + k)
        reach = new
    return d


def _by_rows(a: np.ndarray, b: np.ndarray, most: int) -> int | None:
    """One row of the band at a time: cell j of row i is the distance of a[:i]
    and b[:i + j - most]."""
    width, far = 2 * most + 1, np.int32(most + 1)
    steps = np.arange(width, dtype=np.int32)
    padded = np.concatenate([np.full(most, -1, np.int64), b, np.full(len(a) + most, -1, np.int64)])
    row = np.where(steps >= most, steps - most, far)
    for i in range(1, len(a) + 1):
        unequal = padded[i - 1: i - 1 + width] != a[i - 1]
        new = row + unequal  # along the diagonal
        new[:-1] = np.minimum(new[:-1], row[1:] + 1)
        if i <= most:  # b's beginning: i words of a against none
            new[: most - i] = far
            new[most - i] = i
        new = np.minimum.accumulate(new - steps) + steps
        if i > len(b) - most:  # beyond b's end
            new[len(b) - i + most + 1:] = far
        row = np.minimum(new, far).astype(np.int32)
        if int(row.min()) > most:
            return None
    d = int(row[len(b) - len(a) + most])
    return d if d <= most else None


def similar(a: np.ndarray, b: np.ndarray, least: float) -> bool:
    longer = max(len(a), len(b))
    most = int(longer * (1 - least) + 1e-9)
    if abs(len(a) - len(b)) > most:
        return False
    # Items without a partner need an edit each.
    both = np.concatenate([a, b])
    order = np.argsort(both, kind="stable")
    both, side = both[order], np.where(order < len(a), 1, -1)
    begins = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]]))
    surplus = np.add.reduceat(side, begins)
    if max(int(surplus[surplus > 0].sum()), -int(surplus[surplus < 0].sum())) > most:
        return False
    # Words changed in place are an alignment too; if they are few, it will do.
    if len(a) == len(b) and np.count_nonzero(a != b) <= most:
        return True
    return banded_distance(a, b, most) is not None


def by_shuffle(df: DataFrame) -> DataFrame:
    """Joined by sort and merge whatever its size: it grows with the input, and
    the plan should be the same for every input."""
    return df.hint("merge")


def pairs_of(buckets: DataFrame) -> DataFrame:
    """a, b: the keys of every bucket with its hub's. ``buckets``: h, key."""
    # Smallest and largest come together on the map side: a huge bucket, and the
    # copies of a text, are one row per map task.
    hubs = buckets.groupBy("h").agg(F.min("key").alias("a"), F.max("key").alias("z")).filter("a <> z").select("h", "a")
    return buckets.join(by_shuffle(hubs), "h").filter("key <> a").select("a", F.col("key").alias("b")).distinct()


def word_rows(source: DataFrame, every: DataFrame, keys: DataFrame) -> DataFrame:
    """key, node, words (32 bits of each word's hash) of the nodes with these
    keys, from one document that has each of them."""
    chosen = every.select("key", "node", "doc_id", "hash").join(by_shuffle(keys), "key").groupBy("node").agg(F.min(F.struct("doc_id", "hash")).alias("d"))
    chosen = by_shuffle(chosen.select(F.col("d.doc_id").alias("_id"), F.col("d.hash").alias("hash")))
    kept = (source.withColumn("hash", F.xxhash64("text"))
            .join(chosen, ["hash"]).filter(F.col("doc_id").eqNullSafe(F.col("_id"))).select("text"))

    def run(batches):
        for part in slices(batches):
            found = [w for w in _row_words(part) if len(w)]
            node = [_node(w) for w in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array([_key(x) for x in node], pa.int64()), pa.array(node, pa.binary()),
                 pa.array([(w >> np.uint64(32)).astype(np.uint32).tobytes() for w in found], pa.binary())],
                ["key", "node", "words"])

    return (kept.mapInArrow(run, "key long, node binary, words binary")
            .groupBy("node").agg(F.first("key").alias("key"), F.first("words").alias("words")))


def checked(pairs: DataFrame, words_of: DataFrame, k: int, length: int, least: float) -> DataFrame:
    """a, b (nodes), key (b's), ok, and of refused pairs the sketches of what
    b has beyond a (``rest``, null if nothing)."""
    # A hub's words are joined to its pairs; those of a hub with many pairs are
    # copied, a copy for every CROWD pairs.
    crowded = stored(pairs.groupBy("a").agg(F.count("*").alias("n")).filter(F.col("n") > CROWD)
                     .select("a", F.ceil(F.col("n") / CROWD).cast("int").alias("copies")))
    dealt = pairs.join(crowded, "a", "left").select(
        "a", "b", F.pmod("b", F.coalesce("copies", F.lit(1))).cast("int").alias("copy"))
    side = words_of.select("key", "node", "words")
    hubs = (side.join(crowded, F.col("key") == F.col("a"), "left")
            .select(F.col("key").alias("a"), F.col("node").alias("node_a"), F.col("words").alias("words_a"),
                    F.explode(F.sequence(F.lit(0), F.coalesce("copies", F.lit(1)) - 1)).alias("copy")))
    both = (dealt.join(by_shuffle(side.select(F.col("key").alias("b"), F.col("node").alias("node_b"), F.col("words").alias("words_b"))), "b")
            .join(by_shuffle(hubs), ["a", "copy"]).select("node_a", "node_b", F.col("b").alias("key"), "words_a", "words_b"))

    def rest(x: np.ndarray, hub: np.ndarray) -> np.ndarray | None:
        mine, shared = kmers(x, k), kmers(hub, k)
        beyond = mine[~np.isin(mine, shared)]
        return order_minhash(beyond, REST_SKETCHES, length, SKETCHES) if 0 < len(beyond) < len(mine) else None

    def run(batches):
        for part in slices(batches, "words_a"):
            ok, more = [], []
            for x, y in zip(part.column("words_a").to_pylist(), part.column("words_b").to_pylist()):
                x, y = (np.frombuffer(z, np.uint32).astype(np.int64) for z in (x, y))
                ok.append(similar(x, y, least))
                more.append(None if ok[-1] else rest(y.astype(np.uint64), x.astype(np.uint64)))
            yield pa.RecordBatch.from_arrays(
                [part.column("node_a"), part.column("node_b"), part.column("key"), pa.array(ok, pa.bool_()), _lists(more)],
                ["a", "b", "key", "ok", "rest"])

    return both.mapInArrow(run, "a binary, b binary, key long, ok boolean, rest array<long>")


def links(every: DataFrame, source: DataFrame, k: int, length: int, least: float) -> DataFrame:
    """a, b: verified pairs that connect every class."""
    buckets = every.filter("key IS NOT NULL").select("key", F.explode("sketch").alias("h"))
    pairs = stored(pairs_of(buckets))
    keys = stored(pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct())
    words_of = stored(word_rows(source, every, keys))
    seen = stored(checked(pairs, words_of, k, length, least))
    rests = seen.filter("rest IS NOT NULL").select("key", F.explode("rest").alias("h"))
    more = stored(pairs_of(rests).join(by_shuffle(pairs), ["a", "b"], "left_anti"))
    again = stored(checked(more, words_of, k, length, least))
    return stored(seen.unionByName(again).filter("ok").select("a", "b").distinct())


def classes(docs: DataFrame, k: int = K, sketches: int = SKETCHES, length: int = LENGTH, least: float = LEAST,
            id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, class_id, n_links (verified links of its text to other texts),
    first (true for the one document of the class that stays), hash (of the text)."""
    source = texts(docs, id_col, text_col)
    every = stored(sketched(source, k, sketches, length))
    edges = links(every, source, k, length, least)
    lowest = every.filter("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("lowest"))
    # What follows the links is as small as they are; other nodes are their own class.
    degree = edges.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("n_links"))
    linked = stored(components(edges).join(degree, "node"))
    named = lowest.join(by_shuffle(linked), "node", "left")
    least_id = stored(named.filter("component IS NOT NULL").groupBy("component").agg(F.min("lowest").alias("class_low")))
    named = named.join(by_shuffle(least_id), "component", "left").select(
        "node", "lowest", "n_links", F.when(F.col("component").isNull(), F.col("lowest")).otherwise(F.col("class_low")).alias("class_id"))
    joined = every.select("doc_id", "hash", "node").join(by_shuffle(named), "node", "left")
    return joined.select(
        "doc_id", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        (F.col("node").isNull() | F.col("doc_id").eqNullSafe(F.col("class_id")) & F.col("lowest").eqNullSafe(F.col("doc_id"))).alias("first"),
        "hash")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """``docs`` with its columns: one document of each class stays, the one
    with the class's id. Rows equal in id and text are one document."""
    marked = classes(docs, id_col=id_col, text_col=text_col, **limits)
    gone = stored(marked.filter(~F.col("first")).select(F.struct("doc_id", "hash").alias("_gone")).distinct())
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    keyed = docs.withColumn("_d", F.struct(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("hash")))
    return keyed.join(by_shuffle(gone), F.col("_d") == F.col("_gone"), "left_anti").select(*docs.columns)
