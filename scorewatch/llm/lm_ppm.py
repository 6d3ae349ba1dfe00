"""Language-model score of documents: prediction by partial matching.

The model is the byte-context trie of the training documents (A-Z lower-cased):
for every context of up to ``order`` bytes, the counts of the symbols that
followed it. A symbol that the longest context has not seen escapes to the next
shorter one (escape estimate: distinct symbols / (distinct + total), method C),
where all symbols that the longer context has seen are excluded from the
counts; below the empty context every symbol left is equally likely. The symbol
after the last byte is an end mark, and what stands before the first byte is
the same mark, so the probabilities of all texts add up to one. The score is
the pretrained code length of the text as a base 10 logarithm.

How it is spread: documents are taken in blocks of about ``block_bytes``. A
block hands on each distinct (order+1)-gram and each distinct word once with its
training count; Spark adds the counts up over the corpus (every training document
counts), builds the trie levels from them by grouping on shorter suffixes, and
works out one log probability per distinct gram by joining the levels. Every block
gets back the values of its own grams and words, by a join and a cogroup, and
adds them up per document. Nothing depends on a broadcast of the model but its
two top levels, which 256^2 entries bound.

Words are runs of non-space bytes; each text has one end token more.

Defined cases: null and empty texts are the end token alone; a very long text
is worked through piece by piece; repeated rows are scored each, and count as
often as they occur; without training documents every symbol has probability
1/256; a null id counts as '' for the fold; an empty table gives an empty
result; extra columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, slices, stored, texts, utf8
from .wordhash import LOWER

END = 0xFF  # not a byte of any UTF-8 text
ORDER = 4


def blocks(docs: DataFrame, block_bytes: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text, block: rows of a file that stand together, where the rows
    come from files, else rows of equal hash, brought together."""
    size = docs.agg(F.count("*").alias("n"), F.sum(F.octet_length(F.col(text_col).cast("string"))).alias("b")).first()
    rows = max(1, int(block_bytes * size.n / max(size.b or 1, 1)))
    try:
        source = texts(docs.select(F.col(id_col), F.col(text_col), F.xxhash64(
            "_metadata.file_path", F.floor(F.col("_metadata.row_index") / rows)).alias("_block")), id_col, text_col, "_block")
    except AnalysisException:  # not a file scan
        n = max(1, -(-size.n // rows))
        source = texts(docs, id_col, text_col).withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)))
        source = source.repartition(n, "block").sortWithinPartitions("block")
    return source


def grams(raw: np.ndarray, offsets: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Code of the ``order`` bytes before and the byte at each place of each
    text and its end, and the row of each."""
    sizes = np.diff(offsets)
    begin = offsets[:-1] + np.arange(len(sizes)) * (order + 1) + order
    buf = np.full(len(raw) + len(sizes) * (order + 1), END, np.uint8)
    row = np.repeat(np.arange(len(sizes)), sizes)
    buf[np.arange(len(raw)) + (row + 1) * (order + 1) - 1] = LOWER[raw]
    code = np.zeros(len(buf) - order, np.int64)
    for j in range(order + 1):
        code <<= 8
        code |= buf[j: j + len(code)]
    # A place is the start of its window plus the order.
    keep = np.ones(len(code), bool)
    for j in range(order):
        keep[(begin - order + j)[1:] - order] = False
    owner = np.repeat(np.arange(len(sizes)), sizes + 1)
    return code[keep], owner


def pieces(batch: pa.RecordBatch, order: int, size: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Codes and rows of a batch; long texts piece by piece."""
    raw, offsets = utf8(batch.column("text"))
    if len(raw) <= size:
        yield grams(raw, offsets, order)
        return
    for i in range(len(offsets) - 1):
        text = raw[offsets[i]: offsets[i + 1]]
        for start in range(0, len(text) + 1, size):
            low = max(0, start - order)
            part = text[low: start + size]
            code, _ = grams(part, np.array([0, len(part)]), order)
            last = start + size > len(text)  # the text's end mark is in this piece
            code = code[start - low: None if last else -1]
            if len(code):
                yield code, np.full(len(code), i)


def tokens(batch: pa.RecordBatch) -> Iterator[list[bytes]]:
    raw, offsets = utf8(batch.column("text"))
    low = LOWER[raw].tobytes()
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        yield low[a:b].split()


def _merge(known: tuple[np.ndarray, np.ndarray], code: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    both, n = np.concatenate([known[0], code]), np.concatenate([known[1], count])
    order = np.argsort(both, kind="stable")
    both, n = both[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]])) if len(both) else np.zeros(0, np.int64)
    return both[first], np.add.reduceat(n, first) if len(first) else n


def occurring(source: DataFrame, order: int) -> DataFrame:
    """block, code, word, n: each distinct gram and word of a block, with its
    count in training texts (may be 0). The empty word is the end token."""

    def counted(block: int, known, words: Counter, others: set) -> Iterator[pa.RecordBatch]:
        kind = ["block", "code", "word", "n"]
        for i in range(0, len(known[0]), 100_000):
            code, n = known[0][i: i + 100_000], known[1][i: i + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(code), block), pa.int64()), pa.array(code, pa.int64()),
                                              pa.nulls(len(code), pa.binary()), pa.array(n, pa.int64())], kind)
        for word in others:
            words.setdefault(word, 0)
        rows = list(words.items())
        for i in range(0, len(rows), 100_000):
            part = rows[i: i + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), block), pa.int64()), pa.nulls(len(part), pa.int64()),
                                              pa.array([w for w, _ in part], pa.binary()), pa.array([n for _, n in part], pa.int64())], kind)

    def run(batches):
        now, known, words, others = None, None, Counter(), set()
        for part in slices(batches):
            block = part.column("block").to_numpy()
            cuts = np.flatnonzero(np.diff(block)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), part.num_rows]):
                if now != int(block[a]):
                    if now is not None:
                        yield from counted(now, known, words, others)
                    now, known = int(block[a]), (np.zeros(0, np.int64), np.zeros(0, np.int64))
                    words, others = Counter(), set()
                rows = part.slice(a, b - a)
                train = rows.column("train").to_numpy(zero_copy_only=False)
                for code, row in pieces(rows, order):
                    learnt = train[row]
                    known = _merge(known, *np.unique(code[learnt], return_counts=True))
                    rest = np.unique(code[~learnt])
                    known = _merge(known, rest, np.zeros(len(rest), np.int64))
                for learn, mine in zip(train.tolist(), tokens(rows)):
                    if learn:
                        words.update(mine)
                        words[b""] += 1
                    else:
                        others.update(mine)
                        others.add(b"")
        if now is not None:
            yield from counted(now, known, words, others)

    return source.select("block", "train", "text").mapInArrow(run, "block long, code long, word binary, n long")


def log_probabilities(asked: DataFrame, order: int) -> DataFrame:
    """code, lp: log10 of the probability of a gram's last byte after the bytes
    before it. ``asked``: code and its training count c (may be 0)."""
    level = asked.filter("c > 0").select("code", "c")
    nodes, entries = [], [None] * (order + 1)
    for k in range(order, -1, -1):
        mask = (1 << 8 * (k + 1)) - 1
        if k < order:
            level = level.groupBy(F.col("code").bitwiseAND(mask).alias("code")).agg(F.sum("c").alias("c"))
        level = entries[k] = checkpointed(level)
    for k in range(order + 1):
        own = entries[k].withColumn("ctx", F.shiftright("code", 8))
        if k:
            # Counts that the shorter context has of the symbols seen here.
            shorter = entries[k - 1].select(F.col("code").alias("short"), F.col("c").alias("below"))
            own = own.withColumn("short", F.col("code").bitwiseAND((1 << 8 * k) - 1)).join(_bounded(shorter, k - 1), "short")
        else:
            own = own.withColumn("below", F.lit(0).cast("long"))
        nodes.append(own.groupBy("ctx").agg(
            F.sum("c").alias("total"), F.count("*").alias("kinds"), F.sum("below").alias("below"),
            F.map_from_entries(F.collect_list(F.struct(F.col("code").bitwiseAND(255), "c"))).alias("seen")))
    rows = (asked.select("code").withColumn("lp", F.lit(0.0)).withColumn("open", F.lit(True))
            .withColumn("x_total", F.lit(0).cast("long")).withColumn("x_kinds", F.lit(0).cast("long")))
    for k in range(order, -1, -1):
        node = nodes[k].select(F.col("ctx").alias("at"), "total", "kinds", "below", "seen")
        rows = rows.withColumn("at", F.shiftright("code", 8).bitwiseAND((1 << 8 * k) - 1)).join(_bounded(node, k - 1), "at", "left")
        hit = F.try_element_at("seen", F.col("code").bitwiseAND(255))
        total, kinds = F.col("total") - F.col("x_total"), F.col("kinds") - F.col("x_kinds")
        step = (F.when(~F.col("open") | F.col("total").isNull() | (kinds == 0), 0.0)
                .when(hit.isNotNull(), F.log10(hit / (total + kinds))).otherwise(F.log10(kinds / (total + kinds))))
        rows = rows.select(
            "code", (F.col("lp") + step).alias("lp"), (F.col("open") & hit.isNull()).alias("open"),
            F.coalesce("below", F.lit(0)).cast("long").alias("x_total"), F.coalesce("kinds", F.lit(0)).cast("long").alias("x_kinds"))
    left = F.greatest(F.lit(256) - F.col("x_kinds"), F.lit(1))  # x_kinds: of the empty context
    return rows.select("code", F.when(F.col("open"), F.col("lp") - F.log10(left)).otherwise(F.col("lp")).alias("lp"))


def _bounded(level: DataFrame, k: int) -> DataFrame:
    """Levels of up to two bytes have 65,536 rows at most; a row's map holds 256
    symbols at most."""
    return F.broadcast(level) if k <= 1 else level


def score(docs: DataFrame, train: Column, order: int = ORDER, block_bytes: int = 24 << 20, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score. ``train``:
    which ids the model learns from (an expression over ``doc_id``)."""
    spark = docs.sparkSession
    source = blocks(docs, block_bytes, id_col, text_col).withColumn("train", F.coalesce(train, F.lit(False)))
    occurred = stored(occurring(source, order))
    # A gram's blocks are added up on the map side first: a common one is a row per task.
    totals = stored(occurred.groupBy("code", "word").agg(F.sum("n").alias("c")))
    total = totals.filter("word IS NOT NULL").agg(
        F.sum("c").alias("n"), F.sum(F.when(F.col("c") > 0, 1).otherwise(0)).alias("v")).first()
    n, v = int(total.n or 0), int(total.v or 0)
    values = log_probabilities(totals.filter("code IS NOT NULL").select("code", "c"), order)
    words_of = totals.filter("word IS NOT NULL").select("word", F.col("c").cast("double").alias("value"))
    needed = (occurred.filter("code IS NOT NULL").join(values, "code")
              .select("block", "code", F.lit(None).cast("binary").alias("word"), F.col("lp").alias("value"))
              .unionByName(occurred.filter("word IS NOT NULL").join(words_of.hint("merge"), "word").select("block", "code", "word", "value")))
    id_type = dict(source.dtypes)["doc_id"]

    def run(texts: pa.Table, model: pa.Table) -> pa.Table:
        is_word = model.column("word").is_valid()
        gram = model.filter(pa.compute.invert(is_word))
        code, lp = gram.column("code").to_numpy(), gram.column("value").to_numpy()
        order_of = np.argsort(code)
        code, lp = code[order_of], lp[order_of]
        word = model.filter(is_word)
        known = dict(zip(word.column("word").to_pylist(), word.column("value").to_pylist()))
        del gram, word, model
        out = []
        for part in slices(texts.to_batches()):
            total = np.zeros(part.num_rows)
            for c, row in pieces(part, order):
                total += np.bincount(row, lp[np.searchsorted(code, c)], part.num_rows)
            size, seen, base = [], [], []
            for mine in tokens(part):
                c = np.fromiter(map(known.__getitem__, (*mine, b"")), np.float64, len(mine) + 1)
                size.append(len(c))
                seen.append(int(np.count_nonzero(c)))
                base.append(float(np.log10(c + 1).sum()) - len(c) * np.log10(n + v + 1))
            out.append(pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(size, pa.int64()), pa.array(seen, pa.int64()),
                 pa.array([n] * len(size), pa.int64()), pa.array(base, pa.float64()), pa.array(total, pa.float64())],
                ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"]))
        kind = pa.schema([("doc_id", texts.schema.field("doc_id").type), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                          ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
        return pa.Table.from_batches(out, kind)

    return (source.select("block", "doc_id", "text").groupBy("block").cogroup(needed.groupBy("block"))
            .applyInArrow(run, f"doc_id {id_type}, n_tokens long, n_known long, train_tokens long, base_score double, score double"))
