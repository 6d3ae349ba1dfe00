"""Containment search against exact shingle sets."""

import random
import re

import pytest

from scorewatch.llm import decontaminate


def shingle_set(text):
    w = [x for x in re.split(r"[\W_]+", (text or "").lower()) if x]
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def brute(docs, items, least=0.8):
    out = set()
    for d, t in docs:
        have = shingle_set(t)
        for i, x in items:
            q = shingle_set(x)
            if q and len(q & have) >= least * len(q) - 1e-9:
                out.add((d, i, len(q), len(q & have)))
    return out


@pytest.fixture(scope="module")
def case():
    rnd = random.Random(7)
    vocabulary = [f"w{i}" for i in range(50)]
    text = lambda n: " ".join(rnd.choices(vocabulary, k=n))
    items = [(i, text(rnd.choice([3, 5, 6, 9, 17, 40, 60]))) for i in range(25)]
    docs = []
    for d in range(80):
        own = text(rnd.choice([0, 4, 50, 400])).split()
        if rnd.random() < 0.7:
            passage = rnd.choice(items)[1].split()
            for _ in range(rnd.choice([0, 0, 1, 2])):
                passage[rnd.randrange(len(passage))] = "changed"
            at = rnd.randrange(len(own) + 1)
            own[at:at] = passage
        docs.append((d, " ".join(own).title() if d % 3 else ", ".join(own)))
    return docs, items


@pytest.mark.parametrize("limits", [{}, {"max_broadcast": 0}, {"max_broadcast": 40_000}, {"spare": 5}])
def test_same_as_exact_containment(spark, case, limits):
    docs, items = case
    got = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"),
                                     spark.createDataFrame(items, "item_id long, text string"), **limits)
    rows = {(r.doc_id, r.item_id, r.n_shingles, r.n_found) for r in got.collect()}
    assert rows == brute(docs, items) and len(rows) > 20


def test_edge_rows(spark):
    item = "one two three four five six seven"
    docs = spark.createDataFrame([(1, f"x {item} y", 1), (1, f"x {item} y", 2), (None, item.upper(), 3), (2, None, 4),
                                  (3, "", 5), (4, "one two three four", 6), (5, "clean text about other things", 7)],
                                 "doc_id long, text string, item_id long")
    items = spark.createDataFrame([(9, item), (9, item), (None, None), (8, ""), (7, "one two three")], "item_id long, text string")
    got = decontaminate.contaminated(docs, items)
    assert sorted((r.doc_id or 0, r.item_id, r.containment) for r in got.collect()) == [(0, 9, 1.0), (1, 9, 1.0)]
    left = decontaminate.clean(docs, items)
    assert left.columns == docs.columns and {r.item_id for r in left.collect()} == {4, 5, 6, 7}
    for a, b in ((docs.limit(0), items), (docs, items.limit(0))):
        assert decontaminate.contaminated(a, b).count() == 0
    assert decontaminate.clean(docs, items.limit(0)).count() == 7


def test_items_of_equal_text_are_searched_once(spark):
    text = "one two three four five six seven eight"
    items = spark.createDataFrame([(i, text) for i in range(300)] + [(None, text), (500, text + " nine")], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"a {text} b"), (2, "nothing of it")], "doc_id long, text string")
    got = decontaminate.contaminated(docs, items)
    # 4 of the longer item's 5 shingles are there: 0.8.
    assert sorted((r.item_id if r.item_id is not None else -1, r.n_found) for r in got.collect()) == [
        (-1, 4), *((i, 4) for i in range(300)), (500, 4)]
    assert [r.doc_id for r in decontaminate.clean(docs, items).collect()] == [2]
