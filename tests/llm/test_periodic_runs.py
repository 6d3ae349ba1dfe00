import random

import numpy as np
import pytest

from scorewatch.llm import periodic_runs as p


def brute(t, m):
    """Every stretch that keeps a period q, extended as far as it does, with
    the smallest q of each stretch."""
    n, best = len(t), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and t[j] == t[j + q]:
                j += 1
            if j + q - i >= max(m, 2 * q):
                best.setdefault((i, j + q), q)
            i = max(j, i) + 1
    return sorted((s, e - s, q) for (s, e), q in best.items())


def sequence(rng):
    n, k = rng.randrange(120), rng.choice([1, 2, 2, 3, 4, 8])
    t = [rng.randrange(k) for _ in range(n)]
    for _ in range(rng.randrange(4) if n > 3 else 0):
        a = rng.randrange(n)
        q, b = rng.randrange(1, max(2, (n - a) // 2 + 1)), rng.randrange(a, n + 1)
        for i in range(a + q, b):
            t[i] = t[i - q]
    return t


def joined(parts):
    t, begins, base = [], [], 0
    for x in parts:
        begins.append(len(t))
        k = max(x, default=-1) + 1
        t += [base + y for y in x] + [base + k]
        base += k + 1
    return np.array(t, np.int64), begins


@pytest.mark.parametrize("m", [2, 4, 7, 12, 20])
def test_runs_against_brute_force(m):
    rng = random.Random(m)
    for _ in range(400):
        parts = [sequence(rng) for _ in range(rng.randrange(1, 4))]
        t, begins = joined(parts)
        got = list(zip(*(x.tolist() for x in p.runs(t, m))))
        assert sorted(got) == sorted((b + s, n, q) for b, x in zip(begins, parts) for s, n, q in brute(x, m)), parts


@pytest.mark.parametrize("text", ["a" * 300, "ab" * 150, "aab" * 100, "abaab" * 60 + "a", "x" + "abcabd" * 40])
def test_many_squares_one_end(text):
    t = [ord(x) for x in text]
    got = list(zip(*(x.tolist() for x in p.runs(joined([t])[0], 12))))
    assert sorted(got) == brute(t, 12)


def test_depth_floor_keeps_every_period():
    assert p.depth_floor(12) == 4
    for m in range(2, 60):
        f = p.depth_floor(m)
        assert all(any(2 * q * x <= m and q * x >= f for x in range(1, m)) for q in range(1, f))


def test_documents(spark):
    long = " ".join(str(x % 7001) for x in range(150_000))
    rows = [(1, "q " * 11), (2, "q " * 12), (3, "é x\ty\n" * 20 + "end"), (4, None), (5, ""), (5, "z " * 12), (None, "a b " * 9), (6, long)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS runs", "'x' AS key", "'y' AS collapsed")
    got = {(r.doc_id, r.n_words): r for r in p.found_runs(frame).collect()}
    found = {k: [tuple(x) for x in r.runs] for k, r in got.items()}
    assert found == {(1, 11): [], (2, 12): [(0, 12, 1)], (3, 41): [(0, 40, 2)], (4, 0): [], (5, 0): [], (5, 12): [(0, 12, 1)],
                     (None, 18): [(0, 18, 2)], (6, 150_000): [(0, 150_000, 7001)]}
    assert got[(3, 41)].collapsed == "é x y end" and got[(1, 11)].collapsed == " ".join("q" * 11)
    assert len(got[(6, 150_000)].collapsed.split()) == 7001


def test_overlapping_runs_collapse_once(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(f"w{x}" for x in sequence(rng))) for i in range(120)]
    for r in p.found_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        words = rows[r.doc_id][1].split()
        runs = brute(words, 12)
        assert [tuple(x) for x in r.runs] == runs
        assert r.collapsed == " ".join(w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in runs))


def test_tail_rule_and_empty_table(spark):
    planted = [str(i) for i in range(300) if p.periodic_tail(str(i), 50) is not None]
    assert 10 < len(planted) < 60
    places = p.periodic_tail(planted[0], 50)
    assert len(places) == 50 and places.min() == 0 and places.max() < 50
    assert p.found_runs(spark.createDataFrame([], "doc_id long, text string")).collect() == []
