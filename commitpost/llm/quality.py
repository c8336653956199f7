"""Quality classifier by positive-unlabelled learning.

Trusted positives are labelled documents of quality 1; unlabelled are all documents without a label. Negatives are never
used. A classifier g on counts of the text minimises the non-negative unbiased risk
``prior * R_p(+) + max(0, R_u(-) - prior * R_p(-))`` with the logistic loss, by Adam; where the second term is negative its
gradient is reversed, so g does not fit the unlabelled documents' positives away. The prior (the share of positives among
the unlabelled) is estimated first: a classifier of positives against unlabelled ranks both, and the smallest ratio of
the shares above a score, with its sampling error, bounds the prior.

The positives are bounded (``POSITIVES``: the rows with the smallest hashes of their ids), the unlabelled are not: they
are dealt by a hash of their ids into parts of about ``PART``, each part is minimised against all the positives, and the
weights are averaged. Sums over parts are of whole numbers, so nothing depends on the layout of the files. Texts are
read once; everything after that is on counts.

Cases: null text is scored as empty; a null id is neither learned from nor held out; of several labels of one document
the lowest counts; without positives or unlabelled documents the score is the prior ``DEFAULT_PRIOR`` for all;
of rows with the same id one (the smallest counts) is learned from; repeated rows are scored alike; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..plans.stage import stage
from .grams import slices
from .rules import COUNTS, EXTRA, STATISTICS, statistics

POSITIVES = 10_000
PART = 32_768
NAMES = [*COUNTS, *EXTRA]
SCALE = 1 << 20
"""Vectors are summed over parts in this fraction of one; sums fit a long for 10**11 documents."""
STEPS, RATE, DECAY = 600, 0.03, 1e-4
DEFAULT_PRIOR = 0.5
CUTS = np.array([0.01, 0.03, 0.1, 0.2, 0.35, 0.5, 0.7, 0.9])


def features(counts: np.ndarray) -> np.ndarray:
    """Rates of symbols, repeated lines and words, capitals and marks, also as steps at CUTS; sizes as logarithms."""
    words, chars, symbols, dup_lines, repeated, size, upper, marks, lines = counts.T.astype(float)
    per_word = np.maximum(words, 1)
    rates = np.stack([
        symbols / per_word, dup_lines / np.maximum(lines, 1), repeated / per_word, upper / np.maximum(chars, 1), marks / per_word,
    ], axis=1)
    steps = (rates[:, :, None] > CUTS).reshape(len(rates), -1)
    sizes = np.stack([np.log1p(words) / 10, chars / per_word / 10, np.log1p(lines) / 10], axis=1)
    return np.hstack([np.minimum(rates, 4), steps, sizes])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def thresholds(positive: np.ndarray) -> np.ndarray:
    """Scores above which between all and a tenth of the positives are."""
    return np.quantile(positive, np.linspace(0, 0.9, 91))


def estimate_prior(positive: np.ndarray, above: np.ndarray, n: int, confidence: float = 1.0) -> float:
    """The smallest (share of unlabelled scores above t + error) / share of positive scores above t; ``above`` tells how
    many of the ``n`` unlabelled are above each of the ``thresholds``."""
    of_positive = (positive[:, None] >= thresholds(positive)).mean(axis=0)
    error = confidence * np.sqrt(0.25 / n) + confidence * np.sqrt(0.25 / len(positive))
    return float(np.clip(((above / n + error) / of_positive).min(), 0.01, 0.99))


def minimise(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None) -> np.ndarray:
    """Weights of g (the last is its offset). With a prior the non-negative risk, without one positives against unlabelled."""
    positive, unlabelled = (np.hstack([x, np.ones((len(x), 1))]) for x in (positive, unlabelled))
    w = np.zeros(positive.shape[1])
    first, second = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, STEPS + 1):
        p, u = _sigmoid(positive @ w), _sigmoid(unlabelled @ w)
        as_positive = positive.T @ (p - 1) / len(p)  # gradients of the risks of calling each +, -
        p_as_negative, u_as_negative = positive.T @ p / len(p), unlabelled.T @ u / len(u)
        if prior is None:
            g = as_positive + u_as_negative
        else:
            loss = lambda s: -np.log(np.maximum(1 - s, 1e-9)).mean()
            rest = loss(u) - prior * loss(p)
            unbiased = u_as_negative - prior * p_as_negative
            g = prior * as_positive + unbiased if rest >= 0 else -unbiased
        g = g + DECAY * w
        first, second = 0.9 * first + 0.1 * g, 0.99 * second + 0.01 * g * g
        w -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return w


@dataclass
class Classifier:
    weights: np.ndarray | None
    prior: float
    low: np.ndarray | None = None
    scale: np.ndarray | None = None

    def scores(self, counts: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(counts), self.prior)
        return _sigmoid((features(counts) - self.low) / self.scale @ self.weights[:-1] + self.weights[-1])


def _summed(dealt: DataFrame, work: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of the vectors that ``work`` makes of the counts of each part."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        vector = work(rows.sort_values(NAMES)[NAMES].to_numpy())
        return pd.DataFrame({"place": np.arange(len(vector)), "n": np.rint(vector * SCALE).astype(np.int64)})

    sums = dealt.groupBy("part").applyInPandas(run, "place bigint, n bigint").groupBy("place").agg(F.sum("n").alias("n"))
    return np.array([r["n"] for r in sums.orderBy("place").collect()], float) / SCALE  # one number for each place


def train(positive: np.ndarray, dealt: DataFrame, n: int) -> Classifier:
    """From the counts of the positives and of ``n`` unlabelled documents in parts."""
    if not len(positive) or not n:
        return Classifier(None, DEFAULT_PRIOR)
    p = features(positive)
    width, everything = p.shape[1], len(p) + n

    def moments(counts: np.ndarray) -> np.ndarray:
        x = features(counts)
        return np.concatenate([x.sum(axis=0), (x * x).sum(axis=0)])

    first, second = np.split(_summed(dealt, moments) + np.concatenate([p.sum(axis=0), (p * p).sum(axis=0)]), [width])
    low = first / everything
    scale = np.maximum(np.sqrt(np.maximum(second / everything - low * low, 0)), 0.05)
    p = (p - low) / scale

    def averaged(prior: float | None) -> np.ndarray:
        return _summed(dealt, lambda c: len(c) * minimise(p, (features(c) - low) / scale, prior)) / n

    ranking = averaged(None)[:-1]
    of_positive = p @ ranking
    at = thresholds(of_positive)
    above = _summed(dealt, lambda c: (((features(c) - low) / scale @ ranking)[:, None] >= at).sum(axis=0))
    prior = estimate_prior(of_positive, above, n)
    return Classifier(averaged(prior), prior, low, scale)


def counted(documents: DataFrame, learned_from: Column) -> DataFrame:
    """doc_id, learn and the counts of each row's text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                counts = statistics(batch["text"])
                yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["learn"], *map(pa.array, counts.T)], ["doc_id", "learn", *NAMES])

    learn = F.coalesce(learned_from, F.lit(False)).alias("learn")
    return documents.select("doc_id", learn, "text").mapInArrow(run, f"doc_id bigint, learn boolean, {STATISTICS}")


def fit(counts: DataFrame, labels: DataFrame) -> Classifier:
    """From the rows of ``counted`` that may be learned from."""
    rows = counts.where("learn and doc_id is not null").groupBy("doc_id").agg(F.min(F.struct(*NAMES)).alias("c"))
    known = labels.where("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    joined = stage(rows.join(known.withColumn("labelled", F.lit(True)), "doc_id", "left"), "learned")
    trusted = joined.where("quality = 1").withColumn("hash", F.xxhash64("doc_id"))
    share = min(1.0, 2 * POSITIVES / max(trusted.count(), 1))  # holds the smallest hashes many times over
    trusted = trusted.where(F.col("hash") <= min(int((share - 0.5) * 2**64), 2**63 - 1))
    chosen = trusted.orderBy("hash", "doc_id").limit(POSITIVES).select("c.*").toPandas()
    positive = chosen.sort_values(NAMES)[NAMES].to_numpy()
    unlabelled = joined.where("labelled is null")
    n = unlabelled.count()
    part = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(-(-n // PART) or 1)).alias("part")
    return train(positive, unlabelled.select(part, "c.*"), n)


def score(documents: DataFrame, labels: DataFrame, learned_from: Column) -> DataFrame:
    """doc_id and score (0 to 1, higher: better) for each row of ``documents``."""
    counts = stage(counted(documents, learned_from), "counts")
    classifier = documents.sparkSession.sparkContext.broadcast(fit(counts, labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.stack([batch[name].to_numpy(zero_copy_only=False) for name in NAMES], axis=1)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(classifier.value.scores(values))], ["doc_id", "score"])

    return counts.select("doc_id", *NAMES).mapInArrow(run, "doc_id bigint, score double")
