"""License scan: base places against a regex-free brute force, own labels, defined cases."""

import random
import re

from scorewatch.llm import license_scan

PHRASES = {"cc-by": "cc by", "gpl": "general public license", "reserved": "all rights reserved"}


def brute(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)
    at = {k: [i for i in range(len(w)) if w[i:i + len(p.split())] == p.split()] for k, p in PHRASES.items()}
    places = sorted(i for v in at.values() for i in v)
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(k for k, v in at.items() if v))


def base(r):
    return r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels


def test_base_places(spark):
    rnd = random.Random(1)
    parts = ["cc", "by", "CC BY", "cc-by cc-by", "General Public", "license", "all", "rights", "reserved",
             "All Rights Reserved.", "GENERAL PUBLIC LICENSE,", "ünd", "x1", "İ", "K", "cc by"]
    rows = [(d, rnd.choice([" ", "\n", "--"]).join(rnd.choices(parts, k=rnd.randrange(0, 40)))) for d in range(150)]
    out = license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(out) == 150
    for r in out:
        assert base(r) == brute(rows[r.doc_id][1])
        assert 0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))


def test_own_labels(spark):
    rows = [(1, "Licensed under the Apache License, Version 2.0."), (2, "Released under the MIT License."),
            (3, "Redistribution and use, in source and in binary forms, with or without modification are permitted"),
            (4, "Licensed under CC BY-NC 4.0."), (5, "The apache grazes under the license version of two trees"),
            (6, "under the by the nothing released"), (7, "GNU Affero General Public License")]
    out = {r.doc_id: (r.labels, r.base_labels, r.score) for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[1] == ("apache-2.0", "", 1.0) and out[2] == ("mit", "", 1.0) and out[3][0] == "bsd" and 0.8 <= out[3][2] < 1
    assert out[4] == ("cc-by,cc-by-nc", "cc-by", 1.0) and out[5][0] == out[6][0] == "" and out[6][2] == 0
    assert out[7][0] == "agpl,gpl"


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(last + (x != y), row[j] + 1, row[j - 1] + 1)
    return row[-1]


def nearest(phrase, text):
    """Least edit distance of the phrase to any stretch of the text."""
    row = [0] * (len(text) + 1)
    for i, x in enumerate(phrase, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(text, 1):
            last, row[j] = row[j], min(last + (x != y), row[j] + 1, row[j - 1] + 1)
    return min(row)


def test_matches_against_sliding_brute_force(spark):
    """Templates of 3 to 60 words from few words, so grams repeat; copies with
    as many edits as are allowed, one more, and words put in as one piece."""
    rnd = random.Random(7)
    few = [f"w{i}" for i in range(12)]
    notices = [(" ".join(rnd.choices(few, k=n)), f"t{n}") for n in (3, 5, 8, 14, 30, 60)]
    texts = []
    for d in range(90):
        out = rnd.choices(few + ["x", "y", "z"], k=rnd.randrange(0, 60))
        for _ in range(rnd.randrange(0, 4)):
            w = rnd.choice(notices)[0].split()
            edits = int(len(w) * 0.2) + rnd.randrange(-1, 2)
            if edits > 0 and rnd.random() < 0.3:
                at = rnd.randrange(len(w))
                w[at:at] = ["q"] * edits
            else:
                for _ in range(max(edits, 0)):
                    at = rnd.randrange(len(w))
                    w[at: at + rnd.randrange(2)] = rnd.choice([[], ["q"], ["q"]])
            out += w + rnd.choices(few, k=rnd.randrange(0, 20))
        texts.append(out)
    df = spark.createDataFrame([(d, " ".join(w)) for d, w in enumerate(texts)], "doc_id long, text string")
    seen = 0
    for r in license_scan.found(df, notices).collect():
        best = {}
        for m in r.matches:
            phrase, words = dict((b, a) for a, b in notices)[m.label].split(), texts[r.doc_id][m.first_word: m.last_word + 1]
            assert abs(m.similarity - (1 - edit_distance(phrase, words) / len(phrase))) < 1e-9
            best[m.label] = max(best.get(m.label, 0), m.similarity)
        want = {label: 1 - nearest(p.split(), texts[r.doc_id]) / len(p.split()) for p, label in notices}
        want = {k: v for k, v in want.items() if v >= 0.8 - 1e-9}
        assert best.keys() == want.keys() and all(abs(best[k] - want[k]) < 1e-9 for k in want), (r.doc_id, best, want)
        assert abs(r.score - max(want.values(), default=0)) < 1e-9
        seen += len(want)
    assert seen > 90


def test_bodies(spark):
    """Each body is found by its own label, also with every ninth word changed
    and between other words; copies one behind the other are told apart."""
    bodies = [(p, label) for p, label in license_scan.NOTICES if len(p.split()) >= 25]
    assert len(bodies) >= 9
    rows = []
    for p, _ in bodies:
        w = p.split()
        rows.append(" ".join(["some", "words", *w, "and", "more"]))
        rows.append(" ".join("changed" if i % 9 == 4 else x for i, x in enumerate(w)))
    rows += [" ".join([bodies[0][0]] * 3), " ".join(sorted(bodies[0][0].split()))]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    out = {r.doc_id: r for r in license_scan.found(df).collect()}
    for i, (p, label) in enumerate(bodies):
        assert out[2 * i].score == 1 and label in out[2 * i].labels.split(","), label
        assert label in out[2 * i + 1].labels.split(",") and any(
            m.label == label and m.similarity >= 0.8 and m.last_word - m.first_word > 20 for m in out[2 * i + 1].matches), label
    size = len(re.findall(license_scan.WORD, bodies[0][0]))
    three = [m for m in out[len(rows) - 2].matches if m.last_word - m.first_word + 1 == size]
    assert [m.first_word for m in three] == [0, size, 2 * size]
    assert out[len(rows) - 1].labels == ""


def test_template_bounds():
    assert license_scan.template("a b c", "x", 0.8).gram == 2
    long = license_scan.template("w " * 60, "x", 0.8)
    assert (long.gram, long.edits, long.votes) == (4, 12, 9)
    for bad in ("one", ""):
        try:
            license_scan.template(bad, "x", 0.8)
        except ValueError:
            continue
        raise AssertionError(bad)


def test_edge_rows(spark):
    long = "word " * 200_000 + "all rights reserved"
    rows = [(1, None), (2, ""), (3, "cc by"), (3, "cc by"), (None, "cc by cc by"), (4, long), (5, "alone")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, labels string")
    out = sorted(((r.doc_id or 0, *base(r)) for r in license_scan.scan(df).collect()), key=str)
    assert out == sorted(((d or 0, *brute(t)) for d, t in rows), key=str)
    assert license_scan.scan(df.limit(0)).count() == 0
