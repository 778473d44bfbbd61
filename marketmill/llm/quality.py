"""Quality classifier by positive-unlabelled learning.

Trusted positives are texts labelled good; all texts that may be learned from are the
unlabelled web text. A linear model of character n-grams and a few text statistics
minimises the non-negative unbiased risk

    prior * mean(loss of positives as good)
    + max(0, mean(loss of unlabelled as bad) - prior * mean(loss of positives as bad))

with the logistic loss: where the second part falls below zero on a batch, the step goes
back up it. The class prior is estimated from all labels that may be learned from. Document
frequencies and label counts cover all rows; the risk is minimised on a sample of at most
`per_side` rows a side.
"""

from __future__ import annotations

from bisect import bisect
from dataclasses import dataclass
from operator import eq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketmill.llm.common import stored, whole_text
from marketmill.llm.language_id import held_out
from marketmill.llm.ngrams import (
    NGrams,
    document_frequencies,
    inverse_frequencies,
    sample_features,
    scored,
)

PER_SIDE = 2500
EPOCHS = 40
BATCH = 500
STEP = 0.3
DECAY = 1e-5
EDGES = (0.005, 0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.75)


class TextGrams(NGrams):
    """N-grams, and how much a text repeats itself.

    Shares of words that equal the word one, two and three before, of words met before, of
    lines met before, and of words in upper case, each in one of a few ranges.
    """

    statistics = 6
    extra_places = statistics * (len(EDGES) + 1)

    def extras(self, text: str) -> list[int]:
        words, lines = text.split(), text.split("\n")
        total, upper = max(len(words), 1), sum(map(str.isupper, words))
        shares = [sum(map(eq, words, words[lag:])) / total for lag in (1, 2, 3)]
        shares += [1 - len(set(words)) / total, 1 - len(set(lines)) / len(lines), upper / total]
        first = 1 << self.bits
        return [
            first + i * (len(EDGES) + 1) + bisect(EDGES, share) for i, share in enumerate(shares)
        ]


GRAMS = TextGrams(sizes=(1, 2), bits=15, lower=False)


@dataclass
class QualityModel:
    weights: np.ndarray  # 1 x places, times the inverse document frequencies
    bias: float
    prior: float


class Rows:
    """Sparse rows: places and values, one row after the other."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]]):
        self.places = [p for p, _ in rows]
        self.values = [v for _, v in rows]

    def __len__(self) -> int:
        return len(self.places)

    def batch(self, chosen: np.ndarray):
        places = np.concatenate([self.places[i] for i in chosen])
        values = np.concatenate([self.values[i] for i in chosen])
        row = np.repeat(np.arange(len(chosen)), [len(self.places[i]) for i in chosen])
        return places, values, row, len(chosen)


def margins(batch, weights: np.ndarray, bias: float) -> np.ndarray:
    places, values, row, count = batch
    return np.bincount(row, values * weights[places], minlength=count) + bias


def pull(batch, slopes: np.ndarray, width: int) -> np.ndarray:
    """Gradient of the weights, the bias last."""
    places, values, row, _ = batch
    along = np.bincount(places, values * slopes[row], minlength=width)
    return np.append(along, slopes.sum())


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def fit_risk(
    positive: Rows, unlabelled: Rows, prior: float, width: int
) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the non-negative risk, by adaptive steps on batches."""
    w, squares = np.zeros(width + 1), np.full(width + 1, 1e-6)
    w[width] = np.log(prior / (1 - prior))
    shuffled = np.random.default_rng(0)
    rounds = max(1, -(-max(len(positive), len(unlabelled)) // BATCH))
    for _ in range(EPOCHS * rounds):
        p = positive.batch(shuffled.integers(0, len(positive), min(BATCH, len(positive))))
        u = unlabelled.batch(shuffled.integers(0, len(unlabelled), min(BATCH, len(unlabelled))))
        at_p, at_u = margins(p, w[:width], w[width]), margins(u, w[:width], w[width])
        as_bad = np.logaddexp(0, at_u).mean() - prior * np.logaddexp(0, at_p).mean()
        bad_u = pull(u, logistic(at_u) / len(at_u), width)
        bad_p = pull(p, prior * logistic(at_p) / len(at_p), width)
        if as_bad >= 0:
            good = pull(p, -prior * logistic(-at_p) / len(at_p), width)
            gradient = good + bad_u - bad_p
        else:
            gradient = bad_p - bad_u
        gradient += DECAY * w
        squares += gradient**2
        w -= STEP * gradient / np.sqrt(squares)
    return w[:width], float(w[width])


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    per_side: int = PER_SIDE,
) -> QualityModel | None:
    """A model of rows that may be learned from; None without a label.

    `labels` has `id_col` and a `label` of 0 or 1 (null: no label). An id with several
    labels counts as good if one of them is 1. Of rows that repeat an id one is learned from.
    """
    given = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label}`").alias("good"))
    given = given.filter("id IS NOT NULL AND good IS NOT NULL").groupBy("id")
    given = given.agg(F.max("good").alias("good"))
    counted = given.agg(F.count(F.lit(1)), F.sum(F.expr("IF(good = 1, 1, 0)"))).first()
    if not counted[0] or not counted[1]:
        return None
    prior = float(np.clip(counted[1] / counted[0], 0.01, 0.99))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), whole_text(text).alias("text"))
    met, count = document_frequencies(rows.select("text"), GRAMS)
    if not count:
        return None
    idf = inverse_frequencies(met, count, GRAMS)
    known = rows.select("id").filter("id IS NOT NULL").distinct()
    good = given.filter("good = 1").select("id").join(known, "id", "left_semi")
    good = good.orderBy(F.xxhash64("id"), "id").limit(per_side)
    web = known.orderBy(F.xxhash64("id", F.lit("web")), "id").limit(per_side)
    sides = good.withColumn("label", F.lit(1)).unionByName(web.withColumn("label", F.lit(0)))
    # At most 2 * per_side ids, and one row of each.
    sample = rows.join(F.broadcast(sides), "id")
    one = F.min(F.struct(F.xxhash64("text").alias("hash"), "text"))
    sample = sample.groupBy("id", "label").agg(one.alias("row")).select("label", "row.text")
    found = sample_features(stored(sample, "quality-sample"), GRAMS)
    found.sort(key=lambda row: (row[0], len(row[1]), row[1].tobytes()[:64]))
    sides_of = {
        side: Rows([(p, v * idf[p]) for s, p, v in found if s == side]) for side in (0, 1)
    }
    if not len(sides_of[0]) or not len(sides_of[1]):
        return None
    weights, bias = fit_risk(sides_of[1], sides_of[0], prior, GRAMS.width)
    return QualityModel((weights * idf).astype(np.float32)[None, :], bias, prior)


def graded(docs: DataFrame, model: QualityModel | None, text: str = "text") -> DataFrame:
    """`docs` with score (the chance of being good) and predicted (1 from 0.5 on).

    Null texts count as empty; without a model every score is 0.5. Columns of these names
    are replaced.
    """
    if model is None:
        return docs.withColumns({"score": F.lit(0.5), "predicted": F.lit(1)})
    weights = docs.sparkSession.sparkContext.broadcast(model.weights)
    bias = model.bias
    chances = scored(whole_text(text), GRAMS, weights, lambda margin: logistic(margin + bias))
    found = docs.withColumn("score", F.element_at(chances, 1))
    return found.withColumn("predicted", F.expr("IF(score >= 0.5, 1, 0)"))


def grade(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text",
    label: str = "quality",
) -> DataFrame:
    """`docs` with held_out, score and predicted; learned from the rows not held out."""
    flagged = docs.withColumn("held_out", held_out(id_col, 3, 1))
    known = labels.filter(~held_out(id_col, 3, 1))
    model = fit_quality(flagged.filter("NOT held_out"), known, id_col, text, label)
    return graded(flagged, model, text)
