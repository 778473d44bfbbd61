"""Language identification: sparse multinomial logistic regression on character n-grams.

Document frequencies come from all rows that may be learned from. The regression is
trained by follow-the-regularised-leader (proximal, elastic net) on a sample of at most
`per_language` different texts of each language; one in five of them is kept for the temperature that
calibrates the probabilities, if they are 50 or more in all (else it is one). All rows are then scored where they are.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marketmill.llm.common import remainder, spare, stored, whole_text
from marketmill.llm.ngrams import (
    NGrams,
    document_frequencies,
    inverse_frequencies,
    sample_features,
    scored,
)

UNKNOWN = "und"
PER_LANGUAGE = 600
EPOCHS = 3
LEARNING_RATE = 0.5
L1 = 0.02
L2 = 0.01
TEMPERATURES = np.exp(np.linspace(np.log(0.005), np.log(20), 300))
DEALS = 16  # of a language, each of which hands on `per_language` keys at most
GRAMS = NGrams(sizes=(1, 2, 3), bits=18, lower=True)


@dataclass
class LanguageModel:
    languages: list[str]
    weights: np.ndarray  # languages x places, times the inverse document frequencies
    bias: np.ndarray
    temperature: float


def leader_weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The regularised leader: zero where the sum of gradients is below the L1 penalty."""
    shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
    return -shrunk / ((1 + np.sqrt(n)) / LEARNING_RATE + L2)


def softmax(logits: np.ndarray) -> np.ndarray:
    raised = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return raised / raised.sum(axis=-1, keepdims=True)


def fit_leader(
    rows: list[tuple[int, np.ndarray, np.ndarray]], width: int, classes: int
) -> tuple[np.ndarray, np.ndarray]:
    """Weights (places x classes) and bias from rows of (class, places, values)."""
    z = np.zeros((width + 1, classes))
    n = np.zeros((width + 1, classes))
    shuffled = np.random.default_rng(0)
    for _ in range(EPOCHS):
        for at in shuffled.permutation(len(rows)):
            label, places, values = rows[at]
            places, values = np.append(places, width), np.append(values, 1.0)
            w = leader_weights(z[places], n[places])
            miss = softmax(values @ w)
            miss[label] -= 1
            gradient = values[:, None] * miss
            squared = gradient**2
            sigma = (np.sqrt(n[places] + squared) - np.sqrt(n[places])) / LEARNING_RATE
            z[places] += gradient - sigma * w
            n[places] += squared
    w = leader_weights(z, n)
    return w[:width], w[width]


def best_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the logits under which the labels are likeliest.

    A label counts as one that is right in all but one of n + 2 cases, so that the best
    divisor is a finite one also if all n rows are told right.
    """
    if not len(labels):
        return 1.0
    doubt = 1 / (len(labels) + 2)
    targets = np.full(logits.shape, doubt / max(logits.shape[1] - 1, 1))
    targets[np.arange(len(labels)), labels] = 1 - doubt
    losses = [-(targets * np.log(softmax(logits / t) + 1e-12)).sum() for t in TEMPERATURES]
    return float(TEMPERATURES[int(np.argmin(losses))])


def fit_languages(
    learned: DataFrame, text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE
) -> LanguageModel | None:
    """A model of the labelled rows of `learned`; None if there are none.

    Null texts count as empty; rows without a language are not learned from.
    """
    rows = learned.select(whole_text(text).alias("text"), F.col(f"`{lang}`").alias("label"))
    rows = rows.filter("label IS NOT NULL")
    met, count = document_frequencies(rows.select("text"), GRAMS)
    if not count:
        return None
    # The sample is chosen by a hash of the text, on narrow rows, and its texts read then.
    # Copies of one text share a key and take one place.
    keyed = rows.withColumn("key", F.xxhash64("text"))
    narrow = keyed.select("label", "key").distinct()
    narrow = narrow.withColumn("deal", F.pmod("key", F.lit(DEALS)))
    for dealt in (["label", "deal"], ["label"]):
        order = W.partitionBy(*dealt).orderBy("key")
        narrow = narrow.withColumn("rank", F.row_number().over(order))
        narrow = narrow.filter(F.col("rank") <= per_language)
    bounds = narrow.groupBy("label")
    bounds = bounds.agg(F.max("key").alias("last"))
    below = keyed.join(F.broadcast(bounds), "label").filter("key <= last")
    sample = below.dropDuplicates(["label", "key"])
    found = sample_features(stored(sample.select("label", "key", "text"), "languages"), GRAMS)
    found.sort(key=lambda row: (row[0], len(row[1]), row[1].tobytes()[:64]))
    idf = inverse_frequencies(met, count, GRAMS)
    languages = sorted({label for label, _, _ in found})
    number = {language: i for i, language in enumerate(languages)}
    numbered = [(number[label], p, v * idf[p]) for label, p, v in found]
    kept = numbered[::5] if len(numbered) >= 50 else []
    used = [row for i, row in enumerate(numbered) if i % 5] if kept else numbered
    weights, bias = fit_leader(used, GRAMS.width, len(languages))
    logits = np.array([v @ weights[p] + bias for _, p, v in kept]).reshape(-1, len(languages))
    temperature = best_temperature(logits, np.array([row[0] for row in kept], dtype=int))
    return LanguageModel(languages, np.ascontiguousarray((weights * idf[:, None]).T, np.float32), bias, temperature)


def has_letter(text: str) -> Column:
    return whole_text(text).rlike(r"\p{L}")


def identified(docs: DataFrame, model: LanguageModel | None, text: str = "text") -> DataFrame:
    """`docs` with lang_pred and score, the calibrated probability of that language.

    A text that is null or has no letter is `und` with score 0, and so is every text
    without a model. Columns named lang_pred or score are replaced.
    """
    if model is None:
        return docs.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})
    weights = docs.sparkSession.sparkContext.broadcast(model.weights)
    bias, temperature = model.bias, model.temperature
    chances = scored(
        whole_text(text), GRAMS, weights, lambda logits: softmax((logits + bias) / temperature)
    )
    names = F.array(*[F.lit(language) for language in model.languages])
    held = spare(docs, "_chances")[0]
    found = docs.withColumn(held, chances)
    best = F.array_max(held)
    letter = has_letter(text)
    return found.withColumns(
        {
            "lang_pred": F.when(
                letter, F.element_at(names, F.array_position(held, best).cast("int"))
            ).otherwise(F.lit(UNKNOWN)),
            "score": F.when(letter, best).otherwise(F.lit(0.0)),
        }
    ).drop(held)


def held_out(id_col: str, divisor: int, left: int) -> Column:
    """Whether crc32 of the id as text leaves `left`; a null id is not held out."""
    return F.coalesce(remainder(id_col, divisor) == left, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang"):
    """`docs` with held_out, lang_pred and score; learned from the rows not held out.

    Null texts count as empty; rows with a null id are not held out. Repeated rows are one
    text to learn from, and get the same prediction each.
    """
    flagged = docs.withColumn("held_out", held_out(id_col, 4, 2))
    model = fit_languages(flagged.filter("NOT held_out"), text, lang)
    return identified(flagged, model, text)


def in_known_language(
    docs: DataFrame, least_score: float = 0.3, text: str = "text", lang: str = "lang"
) -> DataFrame:
    """The rows whose language is told with `least_score` or more; columns unchanged."""
    looked_at = [F.col(f"`{name}`") for name in ("doc_id", text, lang)]
    rows = docs.select(
        F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"),
        *(c.alias(name) for c, name in zip(looked_at, ("id", "text", "lang"), strict=True)),
    )
    found = identify(rows, "id", "text", "lang")
    kept = found.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_score))
    return kept.select("row.*")
