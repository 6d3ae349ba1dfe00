"""PU learning: held-out accuracy on planted markers, defined cases."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorewatch.llm import toxicity_pu
from scorewatch.llm.common import fold


def corpus(n):
    rnd = random.Random(6)
    vocabulary = [f"word{i}" for i in range(400)]
    markers = ["vile", "stinker", "rotterly", "rotterish", "rottering"]
    docs, labels = [], []
    for d in range(n):
        w = rnd.choices(vocabulary, k=rnd.choice([10, 60, 200]))
        toxic = rnd.random() < 0.12
        if toxic:
            for m in rnd.choices(markers, k=3):
                w.insert(rnd.randrange(len(w)), m)
        docs.append((d, " ".join(w)))
        if rnd.random() < 0.6:
            labels.append((d, int(toxic)))
    return docs, labels


def test_held_out_accuracy(spark):
    docs, labels = corpus(1500)
    out = toxicity_pu.scored(spark.createDataFrame(docs, "doc_id long, text string"),
                             spark.createDataFrame(labels, "doc_id long, toxic int"), fold(5) != 0)
    scores, truth = {r.doc_id: r.score for r in out.collect()}, dict(labels)
    assert len(scores) == 1500
    held = [d for d in truth if zlib.crc32(str(d).encode()) % 5 == 0]
    wrong = sum((scores[d] >= 0.5) != bool(truth[d]) for d in held)
    assert len(held) > 100 and wrong / len(held) < 0.03
    # Bounds on what the fit sees hold, and it still learns.
    few = toxicity_pu.scored(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"),
                             fold(5) != 0, max_positive=40, max_unlabelled=300)
    s = {r.doc_id: r.score for r in few.collect()}
    toxic, clean = [s[d] for d in truth if truth[d]], [s[d] for d in truth if not truth[d]]
    assert np.mean(toxic) > 2 * np.mean(clean)


def test_correction_stays_non_negative():
    rnd = np.random.default_rng(0)
    x = (rnd.random((400, 30)) < 0.1).astype(float)
    positive = np.zeros(400, bool)
    positive[:60] = True
    x[positive, 0] = 1
    w, b = toxicity_pu.nn_pu(x, positive, np.ones(400, bool), 0.15)
    assert np.isfinite(w).all() and w[0] == w.max() and x[positive].mean(0) @ w + b > x[~positive].mean(0) @ w + b


def test_edge_rows(spark):
    docs, labels = corpus(300)
    rows = [(d, t, 1) for d, t in docs] + [(1000, None, 1), (1001, "", 1), (None, "vile vile", 1), (7, docs[7][1], 1), (1002, "vile " * 100_000, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    y = spark.createDataFrame(labels + [(None, 1), (3, None), (5, 1), (5, 0)], "doc_id long, toxic int")
    out = toxicity_pu.scored(df, y, fold(5) != 0).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    by = {r.doc_id: r.score for r in out}
    assert by[1000] == by[1001] and by[1002] > by[1001]
    model = toxicity_pu.fit(df.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), y, fold(5) != 0)
    left = toxicity_pu.kept(df, model)
    assert left.columns == df.columns and {1000, 1001} <= {r.doc_id for r in left.collect()}
    none = toxicity_pu.scored(df, y.filter("toxic = 0"), fold(5) != 0).collect()
    assert len({r.score for r in none}) == 1
    assert toxicity_pu.scored(df.limit(0), y, fold(5) != 0).count() == 0
    assert toxicity_pu.scored(df, y.limit(0), fold(5) != 0).count() == len(rows)


def plain_nn_pu(x, positive, unlabelled, prior, steps, rate=0.05, decay=3e-4, corrected=True):
    """The estimator from its definition: risks by loops over documents, their
    gradients by differences, one branch or the other."""
    import math

    def risk(theta, rows, sign):
        return sum(math.log1p(math.exp(-sign * (sum(a * b for a, b in zip(theta, r)) + theta[-1]))) for r in rows) / len(rows)

    xp, xu = [list(r) for r in x[positive]], [list(r) for r in x[unlabelled]]
    theta = [0.0] * x.shape[1] + [math.log(prior / (1 - prior))]
    m, v, branches = [0.0] * len(theta), [0.0] * len(theta), []
    for t in range(1, steps + 1):
        toxic = lambda th: prior * risk(th, xp, 1)
        clean = lambda th: risk(th, xu, -1) - prior * risk(th, xp, -1)
        branches.append(clean(theta) >= 0)
        aim = (lambda th: toxic(th) + clean(th)) if branches[-1] or not corrected else (lambda th: -clean(th))
        step = []
        for i in range(len(theta)):
            up, down = list(theta), list(theta)
            up[i] += 1e-5
            down[i] -= 1e-5
            step.append((aim(up) - aim(down)) / 2e-5 + (decay * theta[i] if i < len(theta) - 1 else 0))
        m = [0.9 * a + 0.1 * g for a, g in zip(m, step)]
        v = [0.999 * a + 0.001 * g * g for a, g in zip(v, step)]
        theta = [a - rate * (b / (1 - 0.9 ** t)) / (math.sqrt(c / (1 - 0.999 ** t)) + 1e-8) for a, b, c in zip(theta, m, v)]
    return theta, branches


@pytest.mark.parametrize("prior,both", [(0.2, False), (0.7, True)])
def test_risk_and_gradient_against_the_definition(prior, both):
    rng = np.random.default_rng(3)
    positive = np.arange(40) < 15
    x = (rng.random((40, 4)) < np.where(positive[:, None], [0.9, 0.7, 0.5, 0.2], [0.1, 0.3, 0.5, 0.2])).astype(float)
    x[~positive & (np.arange(40) % 3 == 0)] = [1, 1, 0, 0]  # toxic ones among the unlabelled
    want, branches = plain_nn_pu(x, positive, ~positive, prior, 60)
    assert (False in branches) == both and True in branches  # the correction turns negative with the large prior
    w, b = toxicity_pu.nn_pu(x, positive, ~positive, prior, 60)
    # Single precision, and Adam's steps of full size on small gradients: equal to
    # a few hundredths, where leaving the correction out makes a larger difference.
    assert np.allclose([*w, b], want, atol=0.06)
    if both:
        without, _ = plain_nn_pu(x, positive, ~positive, prior, 60, corrected=False)
        assert np.abs(np.array([*w, b]) - without).max() > 0.2
