"""PPM scores against a dictionary-based model of the definition."""

import math
import random
import zlib
from collections import Counter, defaultdict

import pytest

from scorewatch.llm import lm_ppm
from scorewatch.llm.common import fold


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode()


class Brute:
    def __init__(self, training, order):
        self.order, self.follow = order, defaultdict(Counter)
        for t in training:
            s = bytes([255] * order) + t + b"\xff"
            for i in range(order, len(s)):
                for k in range(order + 1):
                    self.follow[s[i - k:i]][s[i]] += 1

    def lp(self, context, symbol):
        out, excluded = 0.0, set()
        for k in range(self.order, -1, -1):
            seen = self.follow.get(context[len(context) - k:])
            if seen is None:
                continue
            left = {s: c for s, c in seen.items() if s not in excluded}
            size, kinds = sum(left.values()), len(left)
            if symbol in left:
                return out + math.log10(left[symbol] / (size + kinds))
            if kinds:
                out += math.log10(kinds / (size + kinds))
            excluded |= set(left)
        return out - math.log10(256 - len(excluded))

    def score(self, t):
        s = bytes([255] * self.order) + t + b"\xff"
        return sum(self.lp(s[i - self.order:i], s[i]) for i in range(self.order, len(s)))


def held(d):
    return zlib.crc32(str(d if d is not None else "").encode()) % 7 == 2


def check(spark, rows, out, order):
    training = [lowered(t) for d, t in rows if not held(d)]
    model, counts = Brute(training, order), Counter()
    for t in training:
        counts.update(t.split())
        counts[b""] += 1
    n, v = sum(counts.values()), len(counts)
    got = defaultdict(list)
    for r in out.collect():
        got[r.doc_id].append(r)
    assert sum(map(len, got.values())) == len(rows)
    for d, t in rows:
        r = got[d].pop()
        words = [*lowered(t).split(), b""]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words), sum(counts[w] > 0 for w in words), n)
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words))
        assert r.score == pytest.approx(model.score(lowered(t)), rel=1e-9, abs=1e-9)


def corpus(seed, n):
    rnd = random.Random(seed)
    parts = ["ab", "ra", "Ca", "dé", "br", " ", " ", ". ", "\n", "x9"]
    return [(d, "".join(rnd.choices(parts, k=rnd.randrange(0, 60)))) for d in range(n)]


@pytest.mark.parametrize("order,size", [(4, 1 << 20), (2, 300)])
def test_same_as_dictionary_model(spark, order, size):
    rows = corpus(order, 60)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    check(spark, rows, lm_ppm.score(df, fold(7) != 2, order, block_bytes=size), order)


def test_from_files(spark, tmp):
    rows = corpus(11, 50)
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp}/docs")
    check(spark, rows, lm_ppm.score(spark.read.parquet(f"{tmp}/docs"), fold(7) != 2, 4, block_bytes=500), 4)


def test_probabilities_add_up(spark):
    """After any context, the 256 symbols share a probability of one."""
    rows = corpus(5, 30)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    grams = lm_ppm.occurring(lm_ppm.blocks(df, 1 << 20, "doc_id", "text").selectExpr("*", "true AS train"), 3)
    seen = {r.code: r.n for r in grams.filter("code IS NOT NULL").collect()}
    contexts = sorted({c >> 8 for c in seen})[:20] + [0x010203]
    asked = [(c << 8 | s, seen.get(c << 8 | s, 0)) for c in contexts for s in range(256)]
    asked += [(c, n) for c, n in seen.items() if c >> 8 not in set(contexts)]
    lp = lm_ppm.log_probabilities(spark.createDataFrame(asked, "code long, c long"), 3).collect()
    total = Counter()
    for r in lp:
        total[r.code >> 8] += 10 ** r.lp
    assert all(total[c] == pytest.approx(1.0) for c in contexts)


def test_pieces_of_long_text():
    import pyarrow as pa

    text = "abcdefghij" * 30
    batch = pa.record_batch([pa.array([text, "", "xyz"])], ["text"])
    (whole, _), = lm_ppm.pieces(batch, 4)
    for size in (7, 100, 150, 299, 300, 301):
        cut = [c for c, _ in lm_ppm.pieces(batch, 4, size)]
        assert [x for c in cut for x in c.tolist()] == whole.tolist()


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "A b"), (4, "é" * 5000)]
    df = spark.createDataFrame([(*r, "z", 1.5) for r in rows], "doc_id long, text string, block string, score double")
    check(spark, rows, lm_ppm.score(df, fold(7) != 2), 4)
    assert lm_ppm.score(df.limit(0), fold(7) != 2).count() == 0
    none = lm_ppm.score(df.filter("doc_id = 3"), fold(7) > 9).first()
    assert none.train_tokens == 0 and none.n_known == 0 and none.score == pytest.approx(-4 * math.log10(256))
