"""Quality classifier by positive-unlabelled learning.

The trusted positives are documents labelled 1; everything else is unlabelled text, in
which good and bad are mixed. The non-negative unbiased risk estimator (Kiryo et al.,
2017) is minimised:

    prior * E_pos[loss(f)] + max(0, E_unl[loss(-f)] - prior * E_pos[loss(-f)])

with the logistic loss, so that the sigmoid of f estimates the chance of label 1. The
features are shape statistics of the whole text, computed by Spark functions; the model
is linear in them and their squares. It is fitted on the driver, on at most
`max_positives` and `max_unlabelled` documents chosen by a hash of their ids; the class
prior counts all labels. Scoring is a projection over all documents.

Defined results: a null text counts as empty and gets a score; ids labelled twice are
trusted only if all their labels are 1; null labels are ignored; without any trusted
positive or any document to learn from, every score is 0.5; an empty table gives an
empty result; other columns are carried and never looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lawloom.llm.common import WHITE, text_or_empty, words

SYMBOLS = "#*$%&|<>~^_=+\\@{}[]"
FEATURES = (
    "symbols", "root_symbols", "capitals", "root_capitals", "digits", "exclamations",
    "bars", "stops", "distinct_words", "log_words", "word_length", "repeated_lines",
)
#: Standardised features are held within this many deviations.
CLIP = 6.0


def with_features(docs: DataFrame) -> DataFrame:
    """The documents with an array `_features` of doubles, in the order of FEATURES."""
    text = text_or_empty("text")
    prepared = docs.withColumns(
        {
            "_words": words(text),
            "_lines": F.split(text, "\n"),
            "_chars": F.length(text),
            "_ink": F.length(F.translate(text, WHITE, "")),
        }
    )

    def share(count: Column, of: str) -> Column:
        return count / F.greatest(F.col(of), F.lit(1))

    def chars(which: str) -> Column:
        return F.col("_chars") - F.length(F.translate(text, which, ""))

    symbols = share(chars(SYMBOLS), "_chars")
    capitals = share(F.col("_chars") - F.length(F.regexp_replace(text, r"\p{Lu}+", "")), "_chars")
    counted = prepared.withColumns(
        {
            "_n_words": F.size("_words"),
            "_n_distinct": F.size(F.array_distinct("_words")),
            "_n_lines": F.size("_lines"),
            "_n_distinct_lines": F.size(F.array_distinct("_lines")),
            "_symbols": symbols,
            "_capitals": capitals,
        }
    )
    values = [
        F.col("_symbols"),
        F.sqrt("_symbols"),
        F.col("_capitals"),
        F.sqrt("_capitals"),
        share(chars("0123456789"), "_chars"),
        share(chars("!"), "_n_words"),
        share(chars("|"), "_n_words"),
        share(chars("."), "_n_words"),
        share(F.col("_n_distinct"), "_n_words"),
        F.log1p("_n_words"),
        share(F.col("_ink"), "_n_words"),
        1 - share(F.col("_n_distinct_lines"), "_n_lines"),
    ]
    return counted.select(
        *[F.col(f"`{c}`") for c in docs.columns], F.array(*[v.cast("double") for v in values]).alias("_features")
    )


@dataclass(frozen=True)
class QualityModel:
    """Means and deviations of the features, weights of features and squares, and a bias."""

    mean: tuple[float, ...]
    deviation: tuple[float, ...]
    linear: tuple[float, ...]
    square: tuple[float, ...]
    bias: float

    def score(self, features: Column) -> Column:
        total = F.lit(self.bias)
        for i in range(len(self.mean)):
            z = (features[i] - F.lit(self.mean[i])) / F.lit(self.deviation[i])
            z = F.greatest(F.lit(-CLIP), F.least(F.lit(CLIP), z))
            total = total + z * (F.lit(self.linear[i]) + z * F.lit(self.square[i]))
        return 1 / (1 + F.exp(-total))


UNINFORMED = QualityModel(*[(0.0,) * len(FEATURES)], (1.0,) * len(FEATURES), *[(0.0,) * len(FEATURES)] * 2, 0.0)


def class_prior(labels: DataFrame, default: float = 0.5) -> float:
    """Share of label 1 among all labels: they are taken to be drawn from the unlabelled text."""
    counts = labels.filter(F.col("quality").isNotNull()).agg(F.avg((F.col("quality") == 1).cast("double"))).first()[0]
    return default if counts is None else min(max(counts, 0.01), 0.99)


def minimise_risk(
    positive: np.ndarray, unlabelled: np.ndarray, prior: float, epochs: int = 600, rate: float = 0.05
) -> np.ndarray:
    """Weights (bias first) that minimise the non-negative risk; Adam over the whole sample."""
    weights = np.zeros(positive.shape[1])
    first, second = np.zeros_like(weights), np.zeros_like(weights)

    def slope(x: np.ndarray, sign: float) -> np.ndarray:
        """Gradient of the mean logistic loss of sign * f."""
        chance = 1 / (1 + np.exp(np.clip(sign * (x @ weights), -30, 30)))
        return -sign * (x * chance[:, None]).mean(axis=0)

    for step in range(1, epochs + 1):
        loss = lambda x: np.logaddexp(0, x @ weights).mean()  # noqa: E731  of calling x negative
        negative_risk = loss(unlabelled) - prior * loss(positive)
        from_negative = slope(unlabelled, -1) - prior * slope(positive, -1)
        if negative_risk < 0:  # it overfits: climb back
            gradient = -from_negative
        else:
            gradient = prior * slope(positive, 1) + from_negative
        gradient = gradient + 1e-4 * weights
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        weights = weights - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return weights


def fit_quality(
    docs: DataFrame, labels: DataFrame, max_positives: int = 5_000, max_unlabelled: int = 10_000, seed: int = 7
) -> QualityModel:
    """Model from the given labels (doc_id, quality); leave held-out labels out before."""
    known = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", "quality")
    order = F.xxhash64(F.lit(seed), "doc_id")
    trusted = known.groupBy("doc_id").agg(F.min("quality").alias("least"), F.max("quality").alias("most"))
    positives = trusted.filter("least = 1 AND most = 1").select("doc_id").orderBy(order, "doc_id").limit(max_positives)
    everyone = docs.filter(F.col("doc_id").isNotNull()).select("doc_id").orderBy(order, "doc_id").limit(max_unlabelled)
    chosen = (
        positives.withColumn("positive", F.lit(1))
        .unionByName(everyone.withColumn("positive", F.lit(0)))
        .groupBy(F.col("doc_id").alias("chosen_id"))
        .agg(F.max("positive").alias("positive"), F.min("positive").alias("unlabelled"))
    )
    # at most max_positives + max_unlabelled ids
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("chosen_id"))
    rows = with_features(sample).select("_features", "positive", "unlabelled").toPandas()
    if not len(rows) or not (rows.positive == 1).any() or not (rows.unlabelled == 0).any():
        return UNINFORMED
    x = np.array(rows["_features"].tolist(), dtype=float)
    mean, deviation = x.mean(axis=0), x.std(axis=0)
    deviation[deviation < 1e-9] = 1.0
    z = np.clip((x - mean) / deviation, -CLIP, CLIP)
    design = np.hstack([np.ones((len(z), 1)), z, z * z])
    weights = minimise_risk(
        design[(rows.positive == 1).to_numpy()], design[(rows.unlabelled == 0).to_numpy()], class_prior(known)
    )
    n = len(FEATURES)
    as_tuple = lambda v: tuple(float(a) for a in v)
    return QualityModel(
        as_tuple(mean), as_tuple(deviation), as_tuple(weights[1 : n + 1]), as_tuple(weights[n + 1 :]), float(weights[0])
    )


def score_documents(docs: DataFrame, model: QualityModel, threshold: float = 0.7) -> DataFrame:
    """The documents with `score` and `predicted` (1 from the threshold on); both are replaced if there."""
    kept = docs.drop("score", "predicted")
    # the explode keeps a later filter from computing the features again for each of its terms
    once = F.explode(F.array(model.score(F.col("_features"))))
    scored = with_features(kept).withColumn("score", once).drop("_features")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
