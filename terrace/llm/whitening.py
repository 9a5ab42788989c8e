"""Whitened embeddings: principal components of all different vectors, each with variance one.

Entries become integers, floor(scale * entry). Spark makes the list of different vectors (the
fit list), sums its entries, and then adds up products of entries that are centred on the
nearest integer to their mean; tasks multiply their vectors as matrices and hand on one number per pair
of dimensions. All sums are whole numbers, so the covariance has one rounding per entry and
does not depend on the order of rows. Its components come by contour integration (``feast``);
only this matrix of dimensions by dimensions is on the driver. All rows, repeated ones too,
are then projected in Spark, and the covariance of the projected fit list is measured.

Defined results: rows whose vector is null or holds a null, NaN or infinity drop out. Vectors
of different length are fitted apart, each length among its own. Repeated rows give repeated
results and count once in the fit; a null id stays null. Components without variance (at
rounding level) are not returned, so one single vector, equal vectors and empty vectors give
no rows, nor does an empty table. ``deviation`` is null where it passes 64 bits. Sums beyond
38 digits are an error. Only the id and vector columns are read.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.feast import largest_eigenpairs
from terrace.llm.inner_product import whole_numbers
from terrace.llm.tables import stored

COMPONENTS = 4
SCALE = 256
SUMS = "d int, i int, j int, value decimal(38,0)"


def _matrices(column: pa.ListArray):
    """(length, rows of that length, matrix) for a batch of integer vectors."""
    lengths = np.diff(column.offsets.to_numpy())
    flat, starts = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()[:-1]
    for d in np.unique(lengths):
        rows = np.flatnonzero(lengths == d)
        yield int(d), rows, flat[starts[rows][:, None] + np.arange(d)]


def _exact(matrix: np.ndarray) -> np.ndarray:
    """The type in which sums over products of the matrix' rows are exact."""
    largest = int(np.abs(matrix).max(initial=0)) ** 2 * max(matrix.shape)
    return matrix.astype(float) if largest < 2**53 else matrix if largest < 2**62 and largest >= 0 else matrix.astype(object)


def _sums(fit: DataFrame, products) -> DataFrame:
    """Sums over the fit list of what ``products(length, matrix)`` gives as a matrix of whole numbers, each added up exactly."""

    def tell(batches):
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for d, _, matrix in _matrices(batch.column(0)):
                found = products(d, matrix)
                added = np.array([[int(x) for x in row] for row in found], dtype=object)
                totals[d] = totals[d] + added if d in totals else added
        for d, total in totals.items():
            rows = [(d, i, j, Decimal(int(x))) for i, row in enumerate(total) for j, x in enumerate(row) if j >= i or len(total) == 1]
            names, kinds = ("d", "i", "j", "value"), (pa.int32(), pa.int32(), pa.int32(), pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return fit.mapInArrow(tell, SUMS).groupBy("d", "i", "j").agg(F.sum("value").alias("value"))


class Fit:
    """Of one length of vectors: how many different ones, sums, eigenvalues and the scaled projection."""

    def __init__(self, n: int, sums: list[int], covariance: np.ndarray, components: int):
        values, vectors = largest_eigenpairs(covariance, components)
        some = values > len(covariance) * np.finfo(float).eps * values.max(initial=0)
        self.n, self.sums, self.values = n, np.array(sums, dtype=object), values[some]
        self.projection = vectors[:, some] / np.sqrt(self.values)
        self.explained = self.values / np.trace(covariance)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - sums, exact."""
        largest = self.n * max(1, int(np.abs(x).max(initial=0))) * 2
        return self.n * x - self.sums.astype(np.int64) if largest < 2**62 else self.n * x.astype(object) - self.sums

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        return (centred.astype(float) / self.n) @ self.projection

    @staticmethod
    def deviations(centred: np.ndarray) -> list[int | None]:
        if centred.dtype != object and int(np.abs(centred).max(initial=0)) ** 2 * max(1, centred.shape[1]) < 2**62:
            return (centred**2).sum(axis=1).tolist()
        found = (sum(int(x) ** 2 for x in row) for row in centred)
        return [x if x < 2**63 else None for x in found]


def fit_components(fit: DataFrame, components: int) -> dict[int, Fit]:
    """A fit for every length of vectors in the list ``fit`` (x) of different integer vectors."""
    sums = _sums(fit, lambda d, m: np.array([[len(m), *m.astype(object if np.abs(m).max(initial=0) > 2**31 else np.int64).sum(axis=0)]], dtype=object)).collect()
    totals: dict[int, list[int]] = {}
    for row in sorted(sums, key=lambda r: (r["d"], r["j"])):
        totals.setdefault(row["d"], []).append(int(row["value"]))
    totals = {d: t for d, t in totals.items() if d}
    centres = {d: np.array([(2 * s + t[0]) // (2 * t[0]) for s in t[1:]], dtype=np.int64) for d, t in totals.items()}

    def products(d: int, matrix: np.ndarray) -> np.ndarray:
        y = _exact(matrix - centres[d])
        return y.T @ y

    grams = {d: np.zeros((d, d), dtype=object) for d in totals}
    for row in _sums(fit.where("size(x) > 0"), products).collect():
        grams[row["d"]][row["i"], row["j"]] = grams[row["d"]][row["j"], row["i"]] = int(row["value"])
    out = {}
    for d, (n, *s) in totals.items():
        rest = [a - n * int(c) for a, c in zip(s, centres[d], strict=True)]
        covariance = np.array([[(n * grams[d][i, j] - rest[i] * rest[j]) / (n * n) for j in range(d)] for i in range(d)])
        out[d] = Fit(n, s, covariance, components)
    return out


def identity_errors(fit: DataFrame, fits: dict[int, Fit]) -> dict[int, float]:
    """Per length: the largest absolute entry of the projected fit list's covariance minus the identity."""

    def project(batches):
        for batch in batches:
            for d, _, matrix in _matrices(batch.column(0)):
                if d in fits and len(fits[d].values):
                    w = fits[d].whitened(fits[d].centred(matrix))
                    yield pa.RecordBatch.from_arrays([pa.array([d] * len(w), pa.int32()), pa.array(w.tolist(), pa.list_(pa.float64()))], names=["d", "w"])

    found = stored(fit.mapInArrow(project, "d int, w array<double>"), "whitened-fit")
    most = max((len(f.values) for f in fits.values()), default=0)
    if not most:
        return {}
    means = found.groupBy("d").agg(*[F.avg(F.get("w", F.lit(i))).alias(f"m{i}") for i in range(most)])
    centred = found.join(F.broadcast(means), "d")  # a row for each length of vectors
    at = lambda i: F.get("w", F.lit(i)) - F.col(f"m{i}")
    pairs = [(i, j) for i in range(most) for j in range(i, most)]
    entries = centred.groupBy("d").agg(*[F.avg(at(i) * at(j)).alias(f"c{i}_{j}") for i, j in pairs]).collect()
    return {r["d"]: max(abs(r[f"c{i}_{j}"] - (i == j)) for i, j in pairs if r[f"c{i}_{j}"] is not None) for r in entries}


def whiten(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) per usable row and component."""
    ready = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), whole_numbers(F.col(vector), scale).alias("x")).where("x IS NOT NULL")
    fit = stored(ready.select("x").distinct(), "fit-list")
    fits = fit_components(fit, components)
    errors = identity_errors(fit, fits)

    def project(batches):
        for batch in batches:
            for d, rows, matrix in _matrices(batch.column(0)):
                if d not in errors:
                    continue
                own = fits[d]
                centred = own.centred(matrix)
                columns = [
                    batch.column(1).take(pa.array(rows)),
                    pa.array([own.n] * len(rows), pa.int64()),
                    pa.array(own.deviations(centred), pa.int64()),
                    pa.array(own.whitened(centred).tolist(), pa.list_(pa.float64())),
                    pa.array([own.explained.tolist()] * len(rows), pa.list_(pa.float64())),
                    pa.array([errors[d]] * len(rows), pa.float64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "n", "deviation", "w", "e", "identity_error"])

    told = ready.select("x", "vec_id").mapInArrow(project, "vec_id long, n long, deviation long, w array<double>, e array<double>, identity_error double")
    opened = told.select("vec_id", "n", "deviation", "e", "identity_error", F.posexplode("w").alias("at", "whitened"))
    return opened.select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), "n", "deviation", "whitened", F.get("e", F.col("at")).alias("explained"), "identity_error"
    )

