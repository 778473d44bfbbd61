"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

Vectors become whole numbers, whose counts and sums are exact. The centred rows X are never
gathered: a step multiplies them by a block of right vectors (X v) and the products by the
rows again (Xt u), both in one pass in which each task hands out its sum. The driver holds
matrices as wide as a vector is long, never a column as long as the table: a left vector is
kept as the combination of X's columns that it is, and tasks make its entries anew. Left
and right vectors are reorthogonalised against all before them, twice.

With a block of one vector the small matrix is bidiagonal; with more it is so by blocks, a
pass does the work of several, and directions of equal deviation are told apart up to the
size of the block. Its singular vectors give the components.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketmill.llm.common import stored

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
BLOCK = 8
ROWS = 8192  # multiplied at a time
LARGEST = float(1 << 52)  # entries beyond this are no exact whole numbers
TINY = 1e-11  # of the largest singular value: a smaller one is no deviation
ROUNDING = 1e-13  # of the largest singular value: a smaller residual is rounding


@dataclass
class Whitening:
    """Fitted to `rows` vectors: exact sums, components (a column each) and variances."""

    rows: int
    sums: np.ndarray
    components: np.ndarray
    variances: np.ndarray
    trace: float
    identity_error: float
    passes: int

    @property
    def explained(self) -> np.ndarray:
        return self.variances / self.trace


def whole_vectors(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """`rows` with `vector` as whole numbers floor(SCALE * c) + SHIFT, unusable rows dropped.

    Dropped are null vectors and those with null or non-finite entries. All that stay have
    the length of the longest that would; shorter ones lack entries and are dropped too. An
    entry of 2**52 / SCALE or more in size fails the job. Other columns are unchanged.
    """
    own = F.col(f"`{vector}`")
    bad = F.exists(
        own, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == F.lit(float("inf")))
    )
    finite = rows.filter(own.isNotNull() & ~bad)
    too_large = F.raise_error(F.lit("an entry of a vector is too large to be whitened"))

    def whole(c):
        scaled = c.cast("double") * F.lit(float(SCALE))
        fits = F.abs(scaled) < F.lit(LARGEST)
        return F.when(fits, F.floor(scaled) + F.lit(SHIFT).cast("long")).otherwise(too_large)

    found = finite.withColumn(vector, F.transform(own, whole))
    longest = found.select(F.max(F.size(F.col(f"`{vector}`")))).first()[0]
    return found.filter(F.size(F.col(f"`{vector}`")) == F.lit(longest or 0))


def matrices(batches: Iterator[pa.RecordBatch], column: int = 0) -> Iterator[np.ndarray]:
    """The vectors of a list column as matrices of some ROWS rows."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            part = batch.column(column).slice(start, ROWS)
            yield part.flatten().to_numpy().reshape(len(part), -1)


def added_up(vectors: DataFrame, each, size: int, kind: str) -> np.ndarray:
    """The sum over all rows of what `each` makes of a matrix of them: `size` numbers.

    A task hands out one number for each place, and as many reach the driver.
    """
    dtype = np.int64 if kind == "long" else np.float64

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=dtype)
        for rows in matrices(batches):
            total += each(rows)
        columns = [pa.array(np.arange(size, dtype=np.int32)), pa.array(total)]
        yield pa.RecordBatch.from_arrays(columns, names=["place", "value"])

    found = vectors.mapInArrow(partial, f"place int, value {kind}").groupBy("place")
    rows = found.agg(F.sum("value").alias("value")).toArrow()
    total = np.zeros(size, dtype=dtype)
    total[rows.column("place").to_numpy()] = rows.column("value").to_numpy()
    return total


def centred(rows: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """Rows less the mean: whole numbers are subtracted before anything is rounded."""
    return (n * rows - sums) / n


def orthogonal_to(block: np.ndarray, basis: np.ndarray) -> np.ndarray:
    for _ in range(2):
        block = block - basis @ (basis.T @ block)
    return block


def next_right(fresh: np.ndarray, right: np.ndarray, block: int, floor: float) -> np.ndarray:
    """Up to `block` orthonormal columns, orthogonal to `right`, that span `fresh`.

    Random ones take the place of directions smaller than `floor`: what no product has
    reached so far is then looked at as well.
    """
    axes, sizes, _ = np.linalg.svd(fresh, full_matrices=False)
    block = min(block, right.shape[0] - right.shape[1])
    axes = axes[:, sizes > floor][:, :block]
    drawn = np.random.default_rng(right.shape[1]).standard_normal((len(right), block - axes.shape[1]))
    drawn = orthogonal_to(drawn, np.column_stack([right, axes]))
    return np.linalg.qr(orthogonal_to(np.column_stack([axes, drawn]), right))[0]


@dataclass
class Bidiagonal:
    """A bidiagonalisation under way: X = U B Vt on what is spanned so far.

    `right` is V. `left` holds U as combinations of the columns of X, `back` is Xt U.
    """

    vectors: DataFrame
    rows: int
    sums: np.ndarray
    right: np.ndarray
    left: np.ndarray
    back: np.ndarray
    largest: float = 0.0
    passes: int = 0

    def products(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of W = X `wanted`: Xt W, Ut W and Wt W, in one pass."""
        n, sums, left = self.rows, self.sums, self.left
        shapes = [(len(wanted), wanted.shape[1]), (left.shape[1], wanted.shape[1])]
        shapes.append((wanted.shape[1], wanted.shape[1]))
        cuts = np.cumsum([a * b for a, b in shapes])

        def each(rows: np.ndarray) -> np.ndarray:
            x = centred(rows, n, sums)
            product = x @ wanted
            parts = (x.T @ product, (x @ left).T @ product, product.T @ product)
            return np.concatenate([part.ravel() for part in parts])

        self.passes += 1
        found = np.split(added_up(self.vectors, each, int(cuts[-1]), "double"), cuts[:-1])
        return tuple(part.reshape(shape) for part, shape in zip(found, shapes, strict=True))

    def add_left(self, current: np.ndarray) -> None:
        """New left vectors: an orthonormal basis of X `current` less its part along U.

        A block is made orthonormal by the eigenvectors of its Gram matrix; unless that is
        well-conditioned this is done again, and only then are small directions left out.
        """
        wanted = current - self.left @ (self.back.T @ current)
        for again in (False, True):
            back, against, gram = self.products(wanted)
            wanted, back = wanted - self.left @ against, back - self.back @ against
            gram = gram - against.T @ against
            values, axes = np.linalg.eigh((gram + gram.T) / 2)
            top = max(float(values[-1]), 0.0)
            self.largest = max(self.largest, 0.0 if again else top**0.5)
            if not again and top <= (ROUNDING * self.largest) ** 2:
                return
            kept = values > (1e-12 * top if again else -1)
            turn = axes[:, kept] / np.sqrt(np.maximum(values[kept], 1e-15 * top))
            wanted, back = wanted @ turn, back @ turn
            if values[0] > 1e-3 * top:
                break
        self.left = np.column_stack([self.left, wanted])
        self.back = np.column_stack([self.back, back])

    def triplets(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Singular values of the small matrix, their right vectors, and their residuals."""
        of_left, sizes, of_right = np.linalg.svd(self.back.T @ self.right, full_matrices=False)
        outside = orthogonal_to(self.back, self.right) @ of_left
        return sizes, self.right @ of_right.T, np.linalg.norm(outside, axis=0)


def fit_whitening(
    vectors: DataFrame, components: int = COMPONENTS, block: int = BLOCK
) -> Whitening | None:
    """Components of the one column of `vectors` (whole numbers, equal lengths); None without rows.

    Runs until the wanted components have residuals of rounding size or all directions are
    spanned. Directions without variance are no components, so there may be fewer than
    `components`. Of more equal deviations than `block` some may be missed.
    """
    width = vectors.select(F.max(F.size(vectors.columns[0]))).first()[0] or 0
    counted = added_up(vectors, lambda x: np.append(x.sum(axis=0), len(x)), width + 1, "long")
    n, sums = int(counted[-1]), counted[:-1]
    if not n or not width:
        return None
    none = np.zeros((width, 0))
    current = next_right(none, none, block, 0.0)
    fit = Bidiagonal(vectors, n, sums, current, none, none)
    while True:
        known = fit.left.shape[1]
        fit.add_left(current)
        sizes, axes, residuals = fit.triplets()
        found = len(sizes) >= components and fit.left.shape[1] > known
        if found and residuals[:components].max() <= ROUNDING * fit.largest:
            break
        if fit.right.shape[1] >= width:
            break
        fresh = orthogonal_to(fit.back[:, known:], fit.right)
        current = next_right(fresh, fit.right, block, ROUNDING * fit.largest)
        fit.right = np.column_stack([fit.right, current])
    kept = np.flatnonzero(sizes > TINY * fit.largest)[:components]
    axes, variances = axes[:, kept], sizes[kept] ** 2 / n
    whiter = axes / np.sqrt(variances)
    count = len(kept)

    def moments(rows: np.ndarray) -> np.ndarray:
        x = centred(rows, n, sums)
        y = x @ whiter
        return np.concatenate([(y.T @ y).ravel(), y.sum(axis=0), [np.square(x).sum()]])

    total = added_up(vectors, moments, count * count + count + 1, "double")
    mean = total[count * count : -1] / n
    covariance = total[: count * count].reshape(count, count) / n - np.outer(mean, mean)
    error = float(np.abs(covariance - np.eye(count)).max(initial=0.0))
    return Whitening(n, sums, axes, variances, float(total[-1]) / n, error, fit.passes + 2)


def deviations(rows: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray | list[int]:
    """The sum over dimensions of (n * x - sum) ** 2, exact; one beyond 64 bits fails."""
    reach = n * int(np.abs(rows).max(initial=0)) + int(np.abs(sums).max(initial=0))
    if reach < 1 << 62:
        apart = n * rows - sums
        if int(np.abs(apart).max(initial=0)) ** 2 * max(rows.shape[1], 1) < 1 << 63:
            return np.square(apart).sum(axis=1)
    return [sum((n * x - s) ** 2 for x, s in zip(r, sums.tolist(), strict=True)) for r in rows.tolist()]


def whiten(rows: DataFrame, model: Whitening, vector: str, id_col: str) -> DataFrame:
    """vec_id, deviation, whitened (an array of doubles): one row per row of `rows`."""
    n, sums = model.rows, model.sums
    whiter = model.components / np.sqrt(model.variances)
    kind = rows.schema[id_col].dataType.simpleString()

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found, apart = batch.column(0), [], []
            for part in matrices(iter([batch]), 1):
                found += list(centred(part, n, sums) @ whiter)
                apart += list(deviations(part, n, sums))
            columns = [ids, pa.array(apart, pa.int64()), pa.array(found, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "deviation", "whitened"])

    chosen = rows.select(F.col(f"`{id_col}`"), F.col(f"`{vector}`"))
    return chosen.mapInArrow(each, f"vec_id {kind}, deviation long, whitened array<double>")


def whitened_components(
    rows: DataFrame,
    id_col: str = "vec_id",
    vector: str = "embedding",
    components: int = COMPONENTS,
    block: int = BLOCK,
) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error.

    A row for each usable row (see `whole_vectors`) and component, numbered from 1 by
    falling variance. Repeated rows, ids and null ids count like any other. There are no
    rows where nothing varies: in an empty table, for one vector or for equal ones.
    Other columns are not looked at.
    """
    chosen = rows.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{vector}`").alias("vector"))
    usable = stored(whole_vectors(chosen, "vector"), "whole-vectors")
    model = fit_whitening(usable.select("vector"), components, block)
    kind = usable.schema["vec_id"].dataType.simpleString()
    if model is None or not len(model.variances):
        schema = f"vec_id {kind}, component int, n long, deviation long, whitened double"
        return rows.sparkSession.createDataFrame([], schema + ", explained double, identity_error double")
    shares = F.array(*[F.lit(float(x)) for x in model.explained])
    each = whiten(usable, model, "vector", "vec_id").select(
        "vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened")
    )
    return each.select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        F.lit(model.rows).cast("long").alias("n"),
        "deviation",
        "whitened",
        shares[F.col("place")].alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )
