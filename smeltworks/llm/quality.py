"""Quality classifier by positive-unlabelled learning: trusted positives, unlabelled web text, an estimated class prior.

One pass over the texts turns each into a few statistics of its form, written to a table of some 140 bytes a document. Two
bounded samples of that table, trusted positives and unlabelled documents, go to the driver. There a
linear classifier of positives against unlabelled ones, scored on the half it was not trained on, yields the class prior by
its best bin: among the documents above a cut, the least ratio of the share of the unlabelled to the share of
the positives, an upper bound of the prior that is tight where the cut leaves positives only. The model then minimises the
non-negative unbiased risk: ``prior * loss(positives as 1) + max(0, loss(unlabelled as 0) - prior * loss(positives as 0))``.
Documents labelled as bad take no part. Scores are a sum over the stored statistics in the JVM.
"""

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smeltworks.llm.common import with_columns
from smeltworks.sources.scratch import materialise

# Rows drawn for training; all others are only scored.
POSITIVES = 10_000
UNLABELLED = 30_000
SEED = 17
STEPS = 600
SHRINK = 1e-3
# One in so many of the rows that may take part is drawn for good measure: a sample falls short of its size by chance.
SPARE = 1.05
# A document counts as good from this score on.
CUT = 0.3
LEAST_PRIOR, MOST_PRIOR = 0.02, 0.98

LOWER, UPPER, WIDE, SPACE, DIGIT, STOP, OTHER = range(7)
NAMES = (
    "words", "letters", "capitals", "space", "digits", "stops", "signs", "distinct", "commonest", "repeats", "distinct_lines",
    "lines", "word_length", "wordless", "variety",
)


def _kinds() -> np.ndarray:
    """The kind of each byte value; bytes of characters beyond ASCII count as letters."""
    kinds = np.full(256, OTHER)
    kinds[128:] = WIDE
    for kind, signs in ((LOWER, "abcdefghijklmnopqrstuvwxyz"), (SPACE, " \t\n\v\f\r"), (DIGIT, "0123456789"), (STOP, ".,")):
        kinds[list(signs.encode())] = kind
    kinds[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")] = UPPER
    return kinds


KINDS = _kinds()


def statistics(text: str | None) -> list[float]:
    """What the form of a text shows, in the order of ``NAMES``. Null is an empty text."""
    data = (text or "").encode()
    words = data.split()
    n, k = max(len(data), 1), len(words)
    signs = np.zeros(256, np.int64)
    for i in range(0, len(data), 1 << 20):
        signs += np.bincount(np.frombuffer(data, np.uint8, min(1 << 20, len(data) - i), i), minlength=256)
    counts = np.bincount(KINDS, signs, minlength=7)
    letters = counts[LOWER] + counts[UPPER] + counts[WIDE]
    seen = Counter(words)
    repeats = sum(a == b for a, b in zip(words, words[1:], strict=False))
    lines = [line for line in data.split(b"\n") if line.strip()]
    return [
        math.log1p(k),
        letters / n,
        counts[UPPER] / max(letters, 1),
        counts[SPACE] / n,
        counts[DIGIT] / n,
        counts[STOP] / n,
        counts[OTHER] / n,
        len(seen) / max(k, 1),
        max(seen.values(), default=0) / max(k, 1),
        repeats / max(k - 1, 1),
        len(set(lines)) / max(len(lines), 1),
        math.log1p(len(lines)),
        len(data) / max(k, 1),
        float(k == 0),
        len(seen) / math.sqrt(max(k, 1)),
    ]


@dataclass(frozen=True)
class Model:
    """Weights of the standardised statistics, the weight of 1, and the prior they were trained under."""

    mean: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]
    bias: float
    prior: float

    def score(self) -> Column:
        """Chance of good quality, from the columns ``NAMES``."""
        total = F.lit(self.bias)
        for name, m, s, w in zip(NAMES, self.mean, self.scale, self.weights, strict=True):
            total = total + (F.col(name) - m) * (w / s)
        return 1 / (1 + F.exp(F.greatest(F.least(-total, F.lit(60.0)), F.lit(-60.0))))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def _descend(size: int, gradient, steps: int = STEPS, rate: float = 0.05) -> np.ndarray:
    """Weights after ``steps`` of gradient descent with momentum and a step size per weight (Adam)."""
    w, first, second = np.zeros(size), np.zeros(size), np.zeros(size)
    for i in range(1, steps + 1):
        g = gradient(w) + SHRINK * w
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        w = w - rate * (first / (1 - 0.9**i)) / (np.sqrt(second / (1 - 0.999**i)) + 1e-8)
    return w


def apart(positives: np.ndarray, unlabelled: np.ndarray) -> np.ndarray:
    """Weights that tell positives from unlabelled rows, both sides weighing the same."""

    def gradient(w):
        miss = -(positives.T @ _sigmoid(-positives @ w)) / len(positives)
        return 0.5 * (miss + unlabelled.T @ _sigmoid(unlabelled @ w) / len(unlabelled))

    return _descend(positives.shape[1], gradient)


def best_bin(positives: np.ndarray, unlabelled: np.ndarray, doubt: float = 0.1) -> float:
    """Share of positives among the unlabelled, from scores of either: the ratio of the shares above the cut where the ratio's
    upper confidence bound is least."""
    cuts = np.sort(positives)[::-1]
    above = np.arange(1, len(cuts) + 1) / len(cuts)
    below = np.searchsorted(np.sort(unlabelled), cuts, side="left") / len(unlabelled)
    slack = sum(math.sqrt(math.log(4 / doubt) / 2 / n) for n in (len(positives), len(unlabelled)))
    at = int(np.argmin((1 - below + slack) / above))
    return float((1 - below[at]) / above[at])


def class_prior(positives: np.ndarray, unlabelled: np.ndarray) -> float:
    """Mean of two estimates, each on the half of the rows that its classifier was not trained on."""
    p, u = np.arange(len(positives)) % 2 == 0, np.arange(len(unlabelled)) % 2 == 0
    if min(len(positives), len(unlabelled)) < 2:
        return 0.5
    found = []
    for a, b in ((p, u), (~p, ~u)):
        w = apart(positives[a], unlabelled[b])
        found.append(best_bin(positives[~a] @ w, unlabelled[~b] @ w))
    return min(max(float(np.mean(found)), LEAST_PRIOR), MOST_PRIOR)


def risk_gradient(w: np.ndarray, positives: np.ndarray, unlabelled: np.ndarray, prior: float) -> np.ndarray:
    """Gradient of the non-negative unbiased risk under the logistic loss. Where the risk of the bad class, unlabelled as 0 less
    the positives among them, has fallen below zero, which only overfitting can do, its gradient is walked back."""
    zp, zu = positives @ w, unlabelled @ w
    bad = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
    as_bad = unlabelled.T @ _sigmoid(zu) / len(unlabelled) - prior * (positives.T @ _sigmoid(zp)) / len(positives)
    if bad < 0:
        return -as_bad
    return as_bad - prior * (positives.T @ _sigmoid(-zp)) / len(positives)


def fit(positives: np.ndarray, unlabelled: np.ndarray, prior: float | None = None) -> Model:
    """The model of two samples of statistics. Without a row on either side every score is a half."""
    zero = (0.0,) * len(NAMES)
    if not len(positives) or not len(unlabelled):
        return Model(zero, (1.0,) * len(NAMES), zero, 0.0, 0.5)
    mean, scale = unlabelled.mean(axis=0), unlabelled.std(axis=0) + 1e-6

    def ready(rows):
        return np.c_[(rows - mean) / scale, np.ones(len(rows))]

    p, u = ready(positives), ready(unlabelled)
    prior = class_prior(p, u) if prior is None else prior
    w = _descend(p.shape[1], lambda w: risk_gradient(w, p, u, prior))
    return Model(tuple(map(float, mean)), tuple(map(float, scale)), tuple(map(float, w[:-1])), float(w[-1]), prior)


def held_out(doc_id: Column) -> Column:
    """Documents that no label may be learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def trusted(labels: DataFrame) -> DataFrame:
    """``doc_id`` of documents that every label calls good, one row each."""
    judged = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("worst"))
    return judged.where("worst = 1").select("doc_id")


def _drawn(rows: DataFrame, size: int) -> np.ndarray:
    """At most ``size`` rows of the statistics, drawn at random with a fixed seed."""
    share = min(1.0, SPARE * size / max(rows.count(), 1))
    picked = (rows.sample(fraction=share, seed=SEED) if share < 1 else rows).select(*NAMES).limit(size).collect()
    return np.array([tuple(r) for r in picked], float).reshape(-1, len(NAMES))


def train(measured: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Model:
    """A model from ``measured(doc_id, *NAMES)``: rows with an id that is not held out, whatever their label, are the unlabelled
    ones; those of them with a trusted id the positives."""
    rows = measured.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    good = rows.join(trusted(labels), "doc_id", "left_semi")
    return fit(_drawn(good, positives), _drawn(rows, unlabelled))


def measure(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the statistics of the whole text, one row per document."""
    fields = ", ".join(f"{n} double" for n in NAMES)
    rows = docs.select("doc_id", "text")
    return with_columns(rows, "text", fields, lambda texts: list(zip(*map(statistics, texts), strict=True)) or [[]] * len(NAMES), keep=["doc_id"])


def quality(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``.

    Null texts are scored like empty ones, repeated rows each get the same score, rows without an id are scored but never
    learned from and not held out. An id with labels that disagree, or with a null label, is trusted only if all its
    labels that are not null call it good. Other columns are ignored. Without a trusted document every score is a half. An empty table gives no rows.
    """
    measured = materialise(measure(docs), "measured")
    model = train(measured, labels, positives, unlabelled)
    scored = measured.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), model.score().alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= CUT, 1).otherwise(0))
