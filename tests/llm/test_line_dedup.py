"""Line dedup against a brute-force reading of its definition."""

import random
from collections import defaultdict

import pytest

from scorewatch.llm import line_dedup


def brute(docs: dict, least: int) -> dict[int, set[int]]:
    """Line numbers deleted per document: every run of ``least`` words or more
    that begins earlier too, each earlier occurrence tried."""
    seq = {}
    for d, text in docs.items():
        seq[d] = [(n, x) for n, x in enumerate((text or "").split("\n")) if x.strip()]
    places = [(d, i) for d in sorted(docs) for i in range(len(seq[d]))]
    where = defaultdict(list)
    gone = defaultdict(set)
    for d, text in docs.items():  # a later copy of a whole text goes whole
        if any(docs[e] == text for e in docs if e < d) and len((text or "").split()) >= least:
            gone[d].update(range(len(text.split("\n"))))
    for d, i in places:
        line = seq[d][i][1]
        for e, j in where[line]:  # earlier places of the same line
            m = w = 0
            while i + m < len(seq[d]) and j + m < len(seq[e]) and seq[d][i + m][1] == seq[e][j + m][1]:
                w += len(seq[d][i + m][1].split())
                m += 1
            if w >= least:
                gone[d].update(range(seq[d][i][0], seq[d][i + m - 1][0] + 1))
        where[line].append((d, i))
    return dict(gone)


def found(df) -> dict[int, set[int]]:
    out = defaultdict(set)
    for r in df.collect():
        out[r.doc_id].update(range(r.first_line, r.last_line + 1))
    return dict(out)


@pytest.mark.parametrize("seed", range(4))
def test_same_as_brute_force(spark, seed):
    rnd = random.Random(seed)
    lines = [" ".join(rnd.choices("ab cd ef gh".split(), k=rnd.choice([1, 1, 2, 5]))) for _ in range(12)] + ["", "  "]
    docs = {}
    for d in range(40):
        if docs and rnd.random() < 0.2:
            docs[d] = docs[rnd.choice(list(docs))]
        else:
            docs[d] = "\n".join(rnd.choices(lines, k=rnd.randrange(0, 30)))
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    assert found(line_dedup.repeated_runs(df, 12)) == brute(docs, 12)


def test_passage_is_kept_once(spark):
    passage = "\n".join(f"line {i} of a passage that several documents share word for word" for i in range(6))
    rows = [(3, f"own start three\n{passage}\nown end three"), (1, f"{passage}\nthe end of one"),
            (2, "nothing shared here"), (4, passage)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    runs = {r.doc_id: (r.first_line, r.last_line, r.n_words, r.first_doc_id) for r in line_dedup.repeated_runs(df).collect()}
    assert runs == {3: (1, 6, 72, 1), 4: (0, 5, 72, 1)}
    out = dict(line_dedup.deduplicated(df).collect())
    assert out == {1: rows[1][1], 2: rows[2][1], 3: "own start three\nown end three"}


def test_edge_rows(spark):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(1, None, "x", 1), (2, "", "x", 2), (3, long, None, 3), (3, long, "z", 4), (None, long, "y", 5), (5, "  \n", "q", 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, d string, first_line long")
    out = line_dedup.deduplicated(df)
    assert out.columns == df.columns
    # Rows equal in id and text are one document; the copy with a null id comes last.
    assert sorted(out.collect(), key=lambda r: r.first_line) == [r for r in df.collect() if r.first_line != 5]
    assert [tuple(r) for r in line_dedup.repeated_runs(df).collect()] == [(None, 0, 0, 60, 3)]
    empty = df.limit(0)
    assert line_dedup.deduplicated(empty).count() == 0 and line_dedup.repeated_runs(empty).count() == 0


def test_one_line_over_and_over(spark):
    df = spark.createDataFrame([(1, "\n".join(["ten words in this line which is repeated many times"] * 20))], "doc_id long, text string")
    assert found(line_dedup.repeated_runs(df)) == brute(dict(df.collect()), 50) == {1: set(range(1, 20))}


@pytest.mark.parametrize("shares,width", [(1, 1), (2, 3), (64, 1 << 20)])
def test_shares_and_ranges_do_not_matter(spark, monkeypatch, shares, width):
    monkeypatch.setattr(line_dedup, "SHARES", shares)
    monkeypatch.setattr(line_dedup, "RANGE", width)
    rnd = random.Random(11)
    lines = [" ".join(rnd.choices("ab cd ef gh".split(), k=rnd.choice([1, 2, 5]))) for _ in range(6)]
    docs = {d: "\n".join(rnd.choices(lines, [20, 3, 3, 1, 1, 1], k=rnd.randrange(0, 40))) for d in range(30)}
    docs |= {d: docs[7] for d in range(30, 45)}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    assert found(line_dedup.repeated_runs(df, 12)) == brute(docs, 12)


def test_no_share_holds_a_hot_group(spark):
    """What a group knows goes back to its members by shares: of 6,000 copies of
    one text, and of a line that a third of all rows have, no join key holds many."""
    from pyspark.sql import functions as F
    rows = spark.range(9000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 < 2, "the same text")
                                    .otherwise(F.concat(F.lit("own "), "id", F.lit("\na common line"))).alias("text"))
    keyed = line_dedup._keyed(rows, "doc_id", "text")
    again = line_dedup.copies(keyed)
    assert again.count() == 5999 and {r.first.id for r in again.select("first").distinct().collect()} == {0}
    lines = line_dedup._lines(keyed).withColumn("share", line_dedup._share("d", "i"))
    ranks = line_dedup._first_ranks(lines)
    assert ranks.select("line", "line2", "r").distinct().count() == 2
    joined = lines.join(ranks, ["line", "line2", "share"])
    assert joined.count() == 9000 and joined.groupBy("line", "share").count().agg(F.max("count")).first()[0] < 200


def test_first_ranks(spark):
    rnd = random.Random(3)
    lines = [(1, i, rnd.choice([rnd.randrange(-2**63, 2**63), 5, 6, -7]), rnd.randrange(2), i % 4) for i in range(400)]
    got = line_dedup._first_ranks(spark.createDataFrame(lines, "d long, i int, line long, line2 long, share int"))
    ids = [x[2:4] for x in lines]
    repeated = [x for x in ids if ids.count(x) > 1]
    assert {(r.line, r.line2): r.r for r in got.collect()} == {x: sum(y < x for y in repeated) for x in repeated}
    assert got.count() == len({x[2:5] for x in lines if x[2:4] in repeated})
