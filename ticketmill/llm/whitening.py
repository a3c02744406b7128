"""Whitening of vectors along their principal components, by Golub-Kahan-Lanczos bidiagonalisation.

The fit list, X, has each distinct vector once, centred. From a unit vector v1 on, products X v give left
vectors u and products Xᵀu give the next v; what is left of each once the earlier ones are subtracted is its
norm, an entry of the bidiagonal matrix B with X V = U B. Both sides are orthogonalised anew against all
earlier vectors. The singular values of B are those of X, so deviations times the root of n; its right
singular vectors, put together from V, are the components.

The u are as long as the list, so none is stored: u = X w, and w has as many entries as a vector. One job a
step goes over the rows: each row's part of X w, and from it, at once, the row's part of Xᵀu and of the
products with all earlier u. What leaves a task is one sum for each dimension and step. There are as many
steps as dimensions, since a repeated eigenvalue shows up only then: a Lanczos chain finds one of its
vectors, ends, and goes on from a new start that is orthogonal to all before.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmill.llm.storage import kept

#: Vector entries become whole numbers: floor(LEVELS * entry).
LEVELS = 256
#: Of the norm of all of X: shorter vectors are rounding errors.
TINY = 1e-13


@dataclass(frozen=True)
class Whitening:
    """n distinct vectors with these sums; components (rows) by falling variance, and what they explain."""

    n: int
    sums: list[int]
    components: np.ndarray
    variances: np.ndarray
    explained: np.ndarray
    identity_error: float

    def centred(self, rows: np.ndarray) -> np.ndarray:
        return rows - np.array(self.sums, float) / max(self.n, 1)

    def whitened(self, rows: np.ndarray) -> np.ndarray:
        return self.centred(rows) @ (self.components / np.sqrt(self.variances)[:, None]).T


def levels(vector: Column) -> Column:
    """The entries as whole numbers; null for null vectors and those with null or non-finite entries."""
    entries = F.transform(vector, lambda c: c.cast("double"))
    unfit = F.exists(entries, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.when(~unfit, F.transform(entries, lambda c: F.floor(c * LEVELS)))


def matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def summed(rows: DataFrame, d: int, part, length: int) -> np.ndarray:
    """The sum over all rows of what part(matrix of a batch) gives, an array of that length. Each task sends
    one partial sum for each place; Spark adds them up."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(length)
        for batch in batches:
            total += part(matrix(batch["x"], d))
        yield pa.record_batch([pa.array(np.arange(length)), pa.array(total)], ["place", "value"])

    sums = rows.mapInArrow(partial, "place bigint, value double").groupBy("place").agg(F.sum("value").alias("value"))
    out = np.zeros(length)
    for r in sums.collect():
        out[r["place"]] = r["value"]
    return out


def orthogonal(v: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """v without its parts along the others; twice, since once leaves rounding errors."""
    for _ in range(2):
        for o in others:
            v = v - (o @ v) * o
    return v


def bidiagonalise(product, d: int, tiny: float) -> tuple[np.ndarray, np.ndarray]:
    """(V, its columns the right vectors; B). product(p, W) gives, of u = Xp: u·u, Xᵀu and (XW)ᵀu."""
    rng = np.random.default_rng(0)

    def fresh() -> np.ndarray:
        v = np.zeros(d)
        while np.linalg.norm(v) < 1e-8:
            v = orthogonal(rng.standard_normal(d) / np.sqrt(d), right)
        return v / np.linalg.norm(v)

    right: list[np.ndarray] = []
    right.append(fresh())
    w, back, b = np.zeros((0, d)), np.zeros((0, d)), np.zeros((d, d))
    p = right[0]
    for j in range(d):
        square, z, along = product(p, w)
        p, z = p - along @ w, z - along @ back
        alpha = float(np.sqrt(max(square - along @ along, 0.0)))
        if alpha > tiny:
            b[j, j] = alpha
            w, back = np.vstack([w, p / alpha]), np.vstack([back, z / alpha])
        else:  # X takes this vector to nothing new: its u has no part in anything
            w, back = np.vstack([w, np.zeros(d)]), np.vstack([back, np.zeros(d)])
        if j + 1 == d:
            break
        rest = orthogonal(back[j] - b[j, j] * right[j], right)
        beta = float(np.linalg.norm(rest))
        if beta > tiny:
            b[j, j + 1] = beta
            # Dividing by a small norm enlarges what is left along earlier vectors.
            v = orthogonal(rest / beta, right)
            right.append(v / np.linalg.norm(v))
            p = right[-1] - beta * w[j]
        else:
            right.append(fresh())
            p = right[-1]
    return np.array(right).T, b


def fit(vectors: DataFrame, k: int, vector: str = "embedding") -> Whitening:
    """Of all vectors, each distinct one counting once. Components without variance are left out, so there are
    fewer than k for lists of few or equal vectors; for no vectors, none.

    Null vectors, and those with a null or non-finite entry, take no part, nor do those of another length
    than the most frequent one (of equally frequent ones, the longer)."""
    found = vectors.select(levels(F.col(vector)).alias("x")).filter("x IS NOT NULL")
    distinct = kept(found.groupBy("x").agg(F.lit(1).alias("one")).select("x"), "fit-list")
    sizes = distinct.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n"))
    most = sizes.orderBy(F.desc("n"), F.desc("d")).first()
    if most is None or most["d"] == 0:
        return Whitening(0, [], np.zeros((0, 0)), np.zeros(0), np.zeros(0), 0.0)
    d, n = most["d"], most["n"]
    rows = distinct.filter(F.size("x") == d)
    whole = F.col("v").cast("decimal(38,0)")
    totals = rows.select(F.posexplode("x").alias("place", "v")).groupBy("place").agg(
        F.sum(whole).alias("s"), F.sum(whole * whole).alias("q")
    )
    by_place = {r["place"]: (int(r["s"]), int(r["q"])) for r in totals.collect()}
    sums = [by_place[i][0] for i in range(d)]
    #: n² times the trace of the covariance, exact.
    spread = sum(n * q - s * s for s, q in by_place.values())
    empty = Whitening(n, sums, np.zeros((0, d)), np.zeros(0), np.zeros(0), 0.0)
    if spread == 0:
        return empty

    def product(p: np.ndarray, w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        both = np.vstack([p, w])

        def part(x: np.ndarray) -> np.ndarray:
            x = empty.centred(x)
            along = x @ both.T
            u = along[:, 0]
            return np.concatenate([[u @ u], u @ x, u @ along[:, 1:]])

        out = summed(rows, d, part, 1 + d + len(w))
        return out[0], out[1 : 1 + d], out[1 + d :]

    norm = float(np.sqrt(spread / n))
    right, b = bidiagonalise(product, d, TINY * norm)
    _, deviations, turned = np.linalg.svd(b)
    real = [i for i in range(min(k, d)) if deviations[i] > 1e3 * TINY * norm]
    variances = deviations[real] ** 2 / n
    components = (right @ turned.T).T[real]
    found = Whitening(n, sums, components, variances, variances / (spread / n / n), 0.0)
    size = len(real)

    def squares(x: np.ndarray) -> np.ndarray:
        y = found.whitened(x)
        return np.concatenate([y.sum(axis=0), (y.T @ y).ravel()])

    totals = summed(rows, d, squares, size + size * size) / n
    mean, second = totals[:size], totals[size:].reshape(size, size)
    error = np.abs(second - np.outer(mean, mean) - np.eye(size)).max(initial=0.0)
    return Whitening(n, sums, components, variances, found.explained, float(error))


def whiten(vectors: DataFrame, model: Whitening, vector: str = "embedding") -> DataFrame:
    """The rows that have a vector of the model's length and finite entries only, without the vector, with
    whitened (array of double, one for each component) and deviation (decimal: the exact square distance of n
    times the vector from the sums); columns of these names go. Repeated rows stay, each with its values. The
    model, of a size that goes with the dimensions alone, is sent to the tasks."""
    d = len(model.sums)
    schema = "struct<whitened: array<double>, deviation: decimal(38,0)>"

    @F.arrow_udf(schema)
    def score(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            x = matrix(column, d)
            y = model.whitened(x)
            offsets = pa.array(np.arange(len(y) + 1) * y.shape[1], pa.int32())
            away = [x_ * model.n - s for x_, s in zip(x.astype(object).T, model.sums)]
            total = sum((a * a for a in away), np.zeros(len(x), object))
            yield pa.StructArray.from_arrays(
                [
                    pa.ListArray.from_arrays(offsets, pa.array(y.ravel())),
                    pa.array([Decimal(int(t)) for t in total], pa.decimal128(38, 0)),
                ],
                ["whitened", "deviation"],
            )

    rest = [c for c in vectors.columns if c not in (vector, "whitened", "deviation")]
    rows = vectors.select(F.struct(*rest).alias("row"), levels(F.col(vector)).alias("x"))
    rows = rows.filter(F.col("x").isNotNull() & (F.size("x") == d) & F.lit(d > 0))
    return rows.select("row", score("x").alias("y")).select("row.*", "y.whitened", "y.deviation")
