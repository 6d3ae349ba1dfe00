import random
from itertools import permutations

import numpy as np
from pyspark.sql import functions as F

from scorewatch.llm import filter_audit as a

DOCS = "doc_id long, text string, lang string"
LABELS = "doc_id long, quality int, toxic int"


def failing(text):
    words = [w for w in text.replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    return {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text), "D": any(c in "#$%&*|" for c in text)}


def brute(docs, labels):
    """Applies the filters one after the other, in every order."""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    rows = []
    for d, text, lang in docs:
        fails = failing(text or "")
        fails["E"] = d is not None and any(x is not None and x < d and (y or "") == (text or "") for x, y, _ in docs)
        rows.append((lang or "", d in good, d in toxic, fails))
    out = []
    for part in {r[0] for r in rows}:
        mine, removed_by = [r for r in rows if r[0] == part], dict.fromkeys("ABCDE", 0)
        steps = []
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [r for r in left if r[3][f]]
                left = [r for r in left if not r[3][f]]
                removed_by[f] += len(gone)
                steps.append((part, "".join(order), step, len(left), len(gone), sum(r[3][f] for r in mine) - len(gone),
                              sum(r[3][f] and sum(r[3].values()) == 1 for r in mine), sum(r[1] for r in gone), sum(r[2] for r in gone)))
        out += [(*s, removed_by[s[1][s[2] - 1]]) for s in steps]
    return sorted(out)


def audited(spark, docs, labels):
    frame = spark.createDataFrame(docs, DOCS).selectExpr("*", "1 AS n", "2 AS mask", "'x' AS part", "3 AS id", "4 AS _good", "5 AS digest")
    counted = a.cells(frame, spark.createDataFrame(labels, LABELS).selectExpr("*", "'t' AS text", "1 AS n", "2 AS lang"),
                      a.text_filters(F.col("text")), {"good": F.col("quality") == 1, "toxic": F.col("toxic") == 1})
    result = a.audit(counted, "ABCDE", {"good": "good_lost", "toxic": "toxic_lost"})
    return sorted(tuple(r) for r in result.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails",
                                                  "good_lost", "toxic_lost", "shapley").collect())


def some_text(rng):
    words = [rng.choice(["a", "b", "Big", "x#", "é"]) if rng.random() < 0.5 else f"w{i}" for i in range(rng.choice([0, 3, 199, 200, 260]))]
    return rng.choice([" ", "\n", "\t \x0b"]).join(words) + rng.choice(["", " ", " ", "$"])


def test_against_filtering_in_every_order(spark):
    rng = random.Random(5)
    base = [some_text(rng) for _ in range(25)]
    docs = [(i, rng.choice(base), rng.choice(["en", "de", None, ""])) for i in range(120)]
    labels = [(rng.randrange(150), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(90)]
    assert audited(spark, docs, labels) == brute(docs, labels)


def test_nulls_repeated_rows_and_long_texts(spark):
    long = "word " * 200_000 + "END"
    docs = [(None, "t", "en"), (None, "t", "en"), (1, None, "en"), (2, "", None), (2, "", None), (3, "", "en"), (5, "t", "en"), (4, "t", "de"),
            (4, "t", "de"), (4, "t", "en"), (7, long, "en"), (6, long, "en"), (6, long + ".", "en")]
    labels = [(None, 1, 1), (4, 1, 0), (4, 0, 1), (6, 1, None), (2, None, 1)]
    assert audited(spark, docs, labels) == brute(docs, labels)


def test_a_third_of_all_rows_are_copies(spark):
    docs = [(i, "same" if i % 3 == 0 else f"text {i}", "en" if i % 2 else "de") for i in range(3000)]
    assert audited(spark, docs, [(i, 1, 0) for i in range(0, 3000, 5)]) == brute_counts(docs)


def brute_counts(docs):
    """As ``brute``, for texts that are all short and plain: A and E matter only."""
    labels = [(i, 1, 0) for i in range(0, 3000, 5)]
    cut = {t: min(d for d, x, _ in docs if x == t) for t in {"same"}}
    out = []
    for part in ("en", "de"):
        mine = [(d, t) for d, t, lang in docs if lang == part]
        copy = [d for d, t in mine if d > cut.get(t, d)]
        good = {d for d, _, _ in labels}
        a_total = sum(o.index("A") < o.index("E") for o in permutations("ABCDE")) * len(copy) + 120 * (len(mine) - len(copy))
        e_total = sum(o.index("E") < o.index("A") for o in permutations("ABCDE")) * len(copy)
        for o in permutations("ABCDE"):
            left = {d for d, _ in mine}
            for step, f in enumerate(o, 1):
                fails = {d for d, _ in mine} if f == "A" else set(copy) if f == "E" else set()
                gone = left & fails
                left = left - fails
                out.append((part, "".join(o), step, len(left), len(gone), len(fails) - len(gone),
                            len(mine) - len(copy) if f == "A" else 0, len(gone & good), 0, {"A": a_total, "E": e_total}.get(f, 0)))
    return sorted(out)


def test_states_by_gray_code():
    counts = np.random.default_rng(1).integers(0, 50, (32, 3))
    masks = np.arange(32)
    want = np.array([counts[(masks & s) == 0].sum(0) for s in range(32)])
    assert (a.survivors(counts) == want).all()


def test_empty_tables(spark):
    assert audited(spark, [], []) == []
    docs = [(1, "x", "en")]
    assert audited(spark, docs, []) == brute(docs, [])
