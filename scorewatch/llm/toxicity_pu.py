"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents (label 1) are the positives; documents drawn from the whole
training part, whatever their label, are the unlabelled text. A linear model
over words and word beginnings is fitted with numpy by minimising

    prior * R_pos(+) + max(0, R_unl(-) - prior * R_pos(-))

with logistic loss: the unlabelled risk is corrected for the toxic share it
holds, and where the correction makes it negative, the step goes the other way
(the non-negative estimator). The prior is the toxic share of all labelled
training rows, or a parameter.

The fit sees at most ``max_positive`` positives and about ``max_unlabelled``
unlabelled documents, chosen by a hash of the id; these bounds are parameters.
Features are hashed words and the first bytes of longer words; those whose
share among positives exceeds that in unlabelled text significantly, at most
``max_features``, take part. Every document is scored, with its whole text.

Defined cases: null and empty texts have no features and get the score of the
intercept; a document with several labels is positive if one of them is 1;
null labels count as none; without positives every score is the prior;
repeated rows are scored each; very long texts are scored whole, a task holds one
of them at a time; an empty table gives an empty table; other columns, whatever
their names, are not read. Labels, lang, source and doc_id are never features.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices, texts, utf8
from .wordhash import ALNUM, LOWER, span_hashes, words

BITS = 19
PREFIX = 5  # bytes of a word's beginning


@dataclass(frozen=True)
class Model:
    features: np.ndarray  # ascending hashed features
    weights: np.ndarray
    intercept: float

    def score(self, rows: np.ndarray, features: np.ndarray, n: int) -> np.ndarray:
        """Scores of n documents from their distinct (row, feature) pairs."""
        total = np.full(n, self.intercept)
        if len(self.features):
            at = np.searchsorted(self.features, features)
            known = self.features[np.minimum(at, len(self.features) - 1)] == features
            np.add.at(total, rows[known], self.weights[at[known]])
        return 1 / (1 + np.exp(-np.clip(total, -40, 40)))


def features(batch: pa.RecordBatch, known: np.ndarray | None = None, column: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, feature) pairs of a batch of texts; ``known``: a table of
    truth values, true for the features that matter."""
    raw, offsets = utf8(batch.column(column))
    low = LOWER[raw]
    starts, ends, row = words(low, offsets, ALNUM)
    shift = np.uint64(64 - BITS + 1)
    whole = (span_hashes(low, starts, ends, 1) >> shift).astype(np.int64)
    long = ends - starts > PREFIX
    head = (span_hashes(low, starts[long], starts[long] + PREFIX, 2) >> shift).astype(np.int64) + (1 << BITS - 1)
    row, feature = np.concatenate([row, row[long]]), np.concatenate([whole, head])
    if known is not None:
        keep = known[feature]
        row, feature = row[keep], feature[keep]
    pairs = np.unique(row << BITS | feature)
    return pairs >> BITS, pairs & (1 << BITS) - 1


def fit_sample(docs: DataFrame, labels: DataFrame, train: Column, max_positive: int, max_unlabelled: int) -> DataFrame:
    """doc_id, text, positive, unlabelled of the documents the fit sees."""
    ids = (labels.filter("toxic = 1 AND doc_id IS NOT NULL").select("doc_id").filter(train).distinct()
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_positive).withColumn("positive", F.lit(True)))
    total = docs.count()
    share = min(1.0, max_unlabelled / max(total, 1))
    drawn = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("unlabelled")), F.lit(1 << 20)) < int(share * (1 << 20))
    # At most max_positive ids: small enough for every executor.
    return (docs.filter(train).join(F.broadcast(ids), "doc_id", "left")
            .withColumn("positive", F.coalesce("positive", F.lit(False))).withColumn("unlabelled", drawn)
            .filter("positive OR unlabelled"))


def _selected(sample: DataFrame, max_features: int, least_z: float) -> tuple[np.ndarray, int, int]:
    """Features that positives have significantly more often."""

    def run(batches):
        counts = np.zeros((2, 1 << BITS), np.int64)
        n = np.zeros(2, np.int64)
        for part in slices(batches):
            row, feature = features(part)
            for k, flag in enumerate(("positive", "unlabelled")):
                mark = part.column(flag).to_numpy(zero_copy_only=False).astype(bool)
                counts[k] += np.bincount(feature[mark[row]], minlength=1 << BITS)
                n[k] += mark.sum()
        for k in range(2):
            at = np.flatnonzero(counts[k])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at) + 1, k), pa.int64()), pa.array(np.append(at, -1), pa.int64()),
                 pa.array(np.append(counts[k][at], n[k]), pa.int64())], ["kind", "feature", "n"])

    rows = (sample.mapInArrow(run, "kind long, feature long, n long").groupBy("feature")
            .agg(F.sum(F.when(F.col("kind") == 0, F.col("n")).otherwise(0)).alias("p"),
                 F.sum(F.when(F.col("kind") == 1, F.col("n")).otherwise(0)).alias("u")))
    size = rows.filter("feature = -1").first()
    if size is None or not size.p or not size.u:
        return np.zeros(0, np.int64), 0 if size is None else size.p, 0 if size is None else size.u
    p, u = F.col("p") / size.p, F.col("u") / size.u
    both = (F.col("p") + F.col("u") + 1) / (size.p + size.u + 1)
    z = (p - u) / F.sqrt(both * (1 - both) * (1 / size.p + 1 / size.u))
    best = rows.filter("feature >= 0").select("feature", z.alias("z")).filter(F.col("z") >= least_z)
    best = best.orderBy(F.desc("z"), "feature").limit(max_features).collect()
    return np.sort(np.array([r.feature for r in best], np.int64)), size.p, size.u


def nn_pu(x: np.ndarray, positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 400,
          rate: float = 0.05, decay: float = 3e-4) -> tuple[np.ndarray, float]:
    """Weights and intercept of the linear model, by Adam on the whole sample."""
    # Single precision throughout: the driver holds no second copy of the sample.
    x = x.astype(np.float32, copy=False)
    xp, xu = x[positive], x[unlabelled]
    w, b = np.zeros(x.shape[1]), float(np.log(prior / (1 - prior)))
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)

    def margin(rows):
        return rows @ w.astype(np.float32) + b

    def gradient(rows, sign, weight):
        # d/dz of log(1 + exp(-sign * z)), averaged
        g = -sign / (1 + np.exp(np.clip(sign * margin(rows), -40, 40))) * (weight / len(rows))
        return np.append(g.astype(np.float32) @ rows, g.sum())

    for t in range(1, steps + 1):
        loss = lambda rows: np.logaddexp(0, margin(rows)).mean()  # noqa: E731  risk of calling them negative
        negative = loss(xu) - prior * loss(xp)
        correction = gradient(xu, -1, 1.0) - gradient(xp, -1, prior)
        step = gradient(xp, 1, prior) + correction if negative >= 0 else -correction
        step[:-1] += decay * w
        m, v = 0.9 * m + 0.1 * step, 0.999 * v + 0.001 * step ** 2
        move = rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        w, b = w - move[:-1], b - float(move[-1])
    return w, b


def fit(docs: DataFrame, labels: DataFrame, train: Column, prior: float | None = None, max_positive: int = 8_000,
        max_unlabelled: int = 24_000, max_features: int = 400, least_z: float = 5.0) -> Model:
    """``docs``: doc_id, text; ``labels``: doc_id, toxic; ``train``: which ids
    the fit may learn from."""
    labels = labels.select(F.col("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter("toxic IS NOT NULL")
    if prior is None:
        share = (labels.filter(train).groupBy("doc_id").agg(F.max(F.when(F.col("toxic") == 1, 1.0).otherwise(0.0)).alias("t"))
                 .agg(F.avg("t")).first()[0])
        prior = min(max(share if share is not None else 0.05, 1e-4), 0.5)
    sample = fit_sample(docs, labels, train, max_positive, max_unlabelled)
    chosen, positives, unlabelled = _selected(sample, max_features, least_z)
    base = float(np.log(prior / (1 - prior)))
    if not len(chosen):
        return Model(chosen, np.zeros(0), base)
    known = np.zeros(1 << BITS, bool)
    known[chosen] = True

    def run(batches):
        for part in slices(batches):
            row, feature = features(part, known)
            cut = np.searchsorted(row, np.arange(part.num_rows + 1))
            at = np.searchsorted(chosen, feature).astype(np.uint16)
            yield pa.RecordBatch.from_arrays(
                [part.column("positive"), part.column("unlabelled"),
                 pa.array([at[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary())],
                ["positive", "unlabelled", "at"])

    rows = sample.mapInArrow(run, "positive boolean, unlabelled boolean, at binary").toArrow()
    x = np.zeros((rows.num_rows, len(chosen)), np.float32)
    for i, at in enumerate(rows.column("at").to_pylist()):
        x[i, np.frombuffer(at, np.uint16)] = 1
    flag = lambda name: rows.column(name).to_numpy().astype(bool)
    weights, intercept = nn_pu(x, flag("positive"), flag("unlabelled"), prior)
    return Model(chosen, weights, intercept)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score (0 to 1, higher: more likely toxic)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = sent.value
        known = np.zeros(1 << BITS, bool)
        known[model.features] = True
        for part in slices(batches):
            row, feature = features(part, known)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(model.score(row, feature, part.num_rows), pa.float64())],
                ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, score double")


def kept(docs: DataFrame, model: Model, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """``docs`` with its columns, without the documents that score ``threshold``
    or more; decided where the rows are, nothing is shuffled."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = sent.value
        known = np.zeros(1 << BITS, bool)
        known[model.features] = True
        for part in slices(batches, text_col):
            row, feature = features(part, known, text_col)
            yield part.filter(pa.array(model.score(row, feature, part.num_rows) < threshold))

    return docs.mapInArrow(run, docs.schema)


def scored(docs: DataFrame, labels: DataFrame, train: Column, **limits) -> DataFrame:
    docs = texts(docs)
    return score(docs, fit(docs, labels, train, **limits))
