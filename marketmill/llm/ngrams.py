"""Hashed character n-grams of whole texts: counts, document frequencies, linear scores.

A text's features are the relative frequencies of its n-grams, times their inverse document
frequency. A linear score of them is a mean over the n-grams of a text, so texts are scored
without building their feature vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketmill.llm.common import texts_of

SCALE = 10.0  # of the features: keeps usual values near one
SLICE = 1 << 20  # characters that are hashed at a time
# Odd factors, from a rule: multiples of the 32-bit golden ratio.
FACTORS = [(0x9E3779B1 * (2 * i + 1)) % 2**32 | 1 for i in range(8)]


class NGrams:
    """Hashes the n-grams of texts to 2**bits places."""

    def __init__(self, sizes: tuple[int, ...], bits: int, lower: bool):
        self.sizes = sizes
        self.bits = bits
        self.lower = lower

    @property
    def width(self) -> int:
        """Places of the n-grams and, behind them, of the extras."""
        return (1 << self.bits) + self.extra_places

    extra_places = 0

    def extras(self, text: str) -> list[int]:
        """Further places, of value one each, that the text as a whole has."""
        return []

    def slices(self, text: str) -> Iterator[np.ndarray]:
        """The places of all n-grams of `text`, in slices of bounded size."""
        text = f" {text.lower() if self.lower else text} "
        longest = max(self.sizes)
        for start in range(0, len(text), SLICE):
            part = text[start : start + SLICE + longest - 1]
            codes = np.frombuffer(part.encode("utf-32-le", "replace"), dtype=np.uint32)
            for size in self.sizes:
                count = min(len(codes) - size + 1, SLICE)
                if count > 0:
                    yield self.places(codes, size, count)

    def places(self, codes: np.ndarray, size: int, count: int) -> np.ndarray:
        mixed = codes[:count] * np.uint32(FACTORS[0])
        for i in range(1, size):
            mixed = (mixed ^ (mixed >> np.uint32(15))) + codes[i : i + count] * np.uint32(FACTORS[i])
        mixed = (mixed + np.uint32(size)) * np.uint32(FACTORS[7])
        return (mixed >> np.uint32(32 - self.bits)).astype(np.intp)

    def counts(self, text: str, scratch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and counts of the n-grams; `scratch` is 2**bits zeros, and is left so."""
        for part in self.slices(text):
            np.add.at(scratch, part, 1)
        places = np.flatnonzero(scratch)
        found = scratch[places].copy()
        scratch[places] = 0
        return places, found

    def score(self, text: str, weights: np.ndarray) -> np.ndarray:
        """SCALE times the mean of `weights` (classes x places) over the n-grams."""
        total, seen = np.zeros(len(weights)), 0
        for part in self.slices(text):
            total += [of_class.take(part).sum(dtype=np.float64) for of_class in weights]
            seen += len(part)
        whole = weights[:, np.array(self.extras(text), dtype=np.intp)].sum(axis=1)
        return SCALE * total / max(seen, 1) + whole


def document_frequencies(texts: DataFrame, grams: NGrams) -> tuple[np.ndarray, int]:
    """In how many rows of the one column of `texts` each place is met; the number of rows.

    Each task adds up its own rows, so at most 2**bits rows a task are shuffled and as many
    reach the driver, however many texts there are.
    """
    width = 1 << grams.bits

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = np.zeros(width + 1, dtype=np.int64)
        mark = np.zeros(width, dtype=bool)
        for batch in batches:
            for text in texts_of(batch.column(0)):
                for part in grams.slices(text):
                    mark[part] = True
                places = np.flatnonzero(mark)
                mark[places] = False
                met[places] += 1
                met[width] += 1
        places = np.flatnonzero(met)
        columns = [pa.array(places, pa.int32()), pa.array(met[places], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["place", "met"])

    summed = texts.mapInArrow(partial, "place int, met long").groupBy("place")
    rows = summed.agg(F.sum("met").alias("met")).toArrow()
    met = np.zeros(width + 1, dtype=np.int64)
    met[rows.column("place").to_numpy()] = rows.column("met").to_numpy()
    return met[:width], int(met[width])


def inverse_frequencies(met: np.ndarray, rows: int, grams: NGrams) -> np.ndarray:
    """A factor for each place; one for the extras."""
    factors = np.log((1 + rows) / (1 + met)) + 1
    return np.append(factors, np.ones(grams.extra_places)).astype(np.float32)


def sample_features(sample: DataFrame, grams: NGrams) -> list[tuple[object, np.ndarray, np.ndarray]]:
    """(label, places, values) of the rows (`label`, `text`) of a bounded sample: SCALE times
    the relative frequencies of n-grams, ones of extras."""

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scratch = np.zeros(1 << grams.bits, dtype=np.int32)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            found = [grams.counts(text, scratch) for text in texts]
            extras = [grams.extras(text) for text in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("label"),
                    pa.array([p.astype(np.int32) for p, _ in found], pa.list_(pa.int32())),
                    pa.array([c.astype(np.int32) for _, c in found], pa.list_(pa.int32())),
                    pa.array(extras, pa.list_(pa.int32())),
                ],
                names=["label", "places", "counts", "extras"],
            )

    kind = sample.schema["label"].dataType.simpleString()
    schema = f"label {kind}, places array<int>, counts array<int>, extras array<int>"
    rows = sample.select("label", "text").mapInArrow(features, schema).toArrow()
    out = []
    for batch in rows.to_batches():
        labels = batch.column("label").to_pylist()
        columns = (batch.column(name) for name in ("places", "counts", "extras"))
        for label, places, counts, extras in zip(labels, *columns, strict=True):
            count = counts.values.to_numpy().astype(np.float32)
            extra = extras.values.to_numpy()
            values = np.append(SCALE * count / max(count.sum(), 1), np.ones(len(extra)))
            out.append((label, np.append(places.values.to_numpy(), extra), values))
    return out


def scored(text: Column, grams: NGrams, weights, finish) -> Column:
    """An array of doubles for each text: `finish` of its linear scores (texts x classes).

    `weights` is a Spark broadcast: a row for each class, a column for each place.
    """

    def each(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = weights.value
        for column in columns:
            rows = [grams.score(text, table) for text in texts_of(column)]
            found = finish(np.array(rows).reshape(len(rows), len(table)))
            yield pa.array(list(found), pa.list_(pa.float64()))

    return F.arrow_udf(each, "array<double>")(text)
