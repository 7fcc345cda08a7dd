"""Whitening of embeddings by shifted CholeskyQR.

Components of the vectors become integers, whose sums are exact, and rows are centred by these
sums before anything is multiplied. Passes over the rows gather the Gram matrix of the centred
rows, orthogonalised by triangular solves with the R of the passes before; the Cholesky factor of
each Gram matrix, shifted where it is not positive, is composed onto R. Once the Gram matrix is
the identity, R holds the rows' singular values and right singular vectors: the components.

Tasks hand over one Gram matrix each as rows of it, which Spark adds up; sums, factors and
components, some squares of the dimension, are all that comes to the driver and goes to tasks.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmart.llm.common import passing_tables, written
from tillmart.llm.embedding_links import _lists

# A longer vector is refused: squares of the dimension go to the driver and to every task.
MOST_DIMENSIONS = 4096
MOST_PASSES = 12
# Integers up to this are told apart by doubles, and their differences fit a long.
LARGEST = float(1 << 52)
# The Gram matrix counts as the identity when its eigenvalues are this near to one.
NEAR_ONE = 1e-10
# R is composed of at least so many factors, which makes small components exact as well.
LEAST_FACTORS = 2
# Directions with a smaller share of the largest singular value are rounding, not variance.
ROUNDING = 1e-12
ROWS_AT_ONCE = 2048

ENTRIES = "dimension int, row int, entries array<double>"


@dataclass(frozen=True)
class Fit:
    """What the vectors of one length say: their number, sums, factor and components.

    `r` factorises the centred rows times `basis`, whose columns leave out directions in which
    rows do not differ.
    """

    n: int
    sums: list[int]
    basis: np.ndarray | None = None
    r: np.ndarray | None = None
    values: np.ndarray | None = None  # eigenvalues of the covariance, falling
    components: np.ndarray | None = None  # unit eigenvectors, one a column
    trace: float = 0.0
    mean: np.ndarray | None = None  # of the whitened rows, up to rounding zero
    identity_error: float = 0.0

    @property
    def dimension(self) -> int:
        return len(self.sums)


def usable(vector: Column) -> Column:
    """Whether a vector is not null, not empty, and holds only finite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & (F.size(vector) > 0), F.lit(False))


def _by_dimension(column) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers of lists of equal length, with their values as a matrix, in parts."""
    values, lengths = _lists(column)
    first = np.cumsum(lengths) - lengths
    for dimension in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == dimension)
        for low in range(0, len(at), ROWS_AT_ONCE):
            rows = at[low : low + ROWS_AT_ONCE]
            yield rows, values[first[rows][:, None] + np.arange(dimension)]


def _integers(values: np.ndarray, scale: int, offset: int) -> np.ndarray:
    scaled = np.floor(values.astype(np.float64) * scale)
    if (np.abs(scaled) >= LARGEST).any():
        raise ValueError("a component is too large for an exact integer")
    return scaled.astype(np.int64) + offset


def _distances(x: np.ndarray, fit: Fit) -> np.ndarray:
    """n x - S, exact: as long integers where they fit, else as Python's."""
    sums = np.array(fit.sums, object)
    reach = fit.n * max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))
    if max(reach, max(map(abs, fit.sums))) < 1 << 61:
        return x * np.int64(fit.n) - sums.astype(np.int64)
    return x.astype(object) * fit.n - sums


def _centred(x: np.ndarray, fit: Fit) -> np.ndarray:
    return _distances(x, fit).astype(np.float64) / fit.n


def _sums_task(batches: Iterable[pa.RecordBatch], scale: int, offset: int) -> Iterator[pa.RecordBatch]:
    counts: dict[int, int] = {}
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for rows, values in _by_dimension(batch.column(0)):
            dimension = values.shape[1]
            if dimension > MOST_DIMENSIONS:
                raise ValueError(f"a vector of {dimension} components; {MOST_DIMENSIONS} are allowed")
            counts[dimension] = counts.get(dimension, 0) + len(rows)
            # Sums of 2048 integers below 2**52 stay below 2**63; the whole sums are Python's.
            part = _integers(values, scale, offset).sum(axis=0).astype(object)
            sums[dimension] = sums.get(dimension, 0) + part
    for dimension, count in counts.items():
        columns = [
            pa.array([dimension], pa.int32()),
            pa.array([count], pa.int64()),
            pa.array([[str(value) for value in sums[dimension]]]),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["dimension", "n", "sums"])


def _gather(
    batches: Iterable[pa.RecordBatch], fits: dict[int, Fit], made: Callable[[np.ndarray, Fit], np.ndarray],
    scale: int, offset: int,
) -> Iterator[pa.RecordBatch]:
    """The Gram matrix of what `made` makes of centred rows; row -1 holds the sums of them."""
    grams: dict[int, np.ndarray] = {}
    for batch in batches:
        for _, values in _by_dimension(batch.column(0)):
            fit = fits[values.shape[1]]
            rows = made(_centred(_integers(values, scale, offset), fit), fit)
            told = np.vstack([rows.sum(axis=0), rows.T @ rows])
            grams[fit.dimension] = grams.get(fit.dimension, 0) + told
    for dimension, told in grams.items():
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(told), dimension, np.int32)),
                pa.array(np.arange(-1, len(told) - 1, dtype=np.int32)),
                pa.array(list(told)),
            ],
            ["dimension", "row", "entries"],
        )


def solved(rows: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Rows times the inverse of an upper triangular matrix, column by column."""
    found = np.empty_like(rows)
    for j in range(len(r)):
        found[:, j] = (rows[:, j] - found[:, :j] @ r[:j, j]) / r[j, j]
    return found


def _orthogonal(rows: np.ndarray, fit: Fit) -> np.ndarray:
    return rows if fit.r is None else solved(rows @ fit.basis, fit.r)


def _white(rows: np.ndarray, fit: Fit) -> np.ndarray:
    return (rows @ fit.components) / np.sqrt(fit.values)


def _white_about_mean(rows: np.ndarray, fit: Fit) -> np.ndarray:
    return _white(rows, fit) - fit.mean


def _gram_pass(
    vectors: DataFrame, fits: dict[int, Fit], made: Callable, scale: int, offset: int
) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each dimension the sums and the Gram matrix over all rows.

    Rows of the matrices are added up by key, so no task and not the driver holds more than
    one matrix for each length of vectors.
    """
    task = functools.partial(_gather, fits=fits, made=made, scale=scale, offset=offset)
    parts = vectors.mapInArrow(task, ENTRIES)
    cells = parts.select("dimension", "row", F.posexplode("entries").alias("place", "entry"))
    added = cells.groupBy("dimension", "row", "place").agg(F.sum("entry").alias("entry"))
    lines = added.groupBy("dimension", "row").agg(
        F.sort_array(F.collect_list(F.struct("place", "entry"))).alias("cells")
    )
    told: dict[int, dict[int, list[float]]] = {}
    for line in lines.select("dimension", "row", "cells.entry").collect():
        told.setdefault(line["dimension"], {})[line["row"]] = line["entry"]
    return {
        dimension: (np.array(rows[-1]), np.array([rows[i] for i in range(len(rows) - 1)]))
        for dimension, rows in told.items()
    }


def shifted_cholesky(gram: np.ndarray, n: int) -> np.ndarray:
    """The upper triangular factor of a Gram matrix, with a shift where it is not positive."""
    d = len(gram)
    size = max(float(np.linalg.norm(gram, 2)), np.finfo(float).tiny)
    shift = 11 * (n * d + d * (d + 1)) * np.finfo(float).eps / 2 * size
    for extra in (0.0, min(shift, size * 1e-3), size * 1e-2):
        try:
            return np.linalg.cholesky(gram + extra * np.eye(d)).T
        except np.linalg.LinAlgError:
            continue
    raise np.linalg.LinAlgError("the Gram matrix is not positive even when shifted")


def _is_settled(gram: np.ndarray) -> bool:
    return bool((np.abs(np.linalg.eigvalsh(gram) - 1) < NEAR_ONE).all())


def fit_whitening(
    vectors: DataFrame, scale: int, offset: int, most_components: int
) -> dict[int, Fit]:
    """The fit of the vectors of each length, from the column `vector` of usable ones."""
    parts = vectors.mapInArrow(
        functools.partial(_sums_task, scale=scale, offset=offset), "dimension int, n long, sums array<string>"
    )
    whole = parts.select(
        "dimension", "n", F.posexplode("sums").alias("place", "part")
    ).groupBy("dimension", "place")
    added = whole.agg(
        F.sum("n").alias("n"), F.sum(F.col("part").cast("decimal(38,0)")).cast("string").alias("total")
    )
    fits: dict[int, Fit] = {}
    told: dict[int, dict[int, tuple[int, int]]] = {}
    for row in added.collect():
        told.setdefault(row["dimension"], {})[row["place"]] = (row["n"], int(row["total"]))
    for dimension, places in told.items():
        fits[dimension] = Fit(places[0][0], [places[i][1] for i in range(dimension)])
    if not fits:
        return {}
    factorised = _factorised(vectors, fits, scale, offset)
    fits = {d: _components(fit, most_components) for d, fit in factorised.items()}
    means = _gram_pass(vectors, fits, _white, scale, offset)
    nothing = (np.zeros(0), None)
    fits = {d: _with(fit, mean=means.get(d, nothing)[0] / fit.n) for d, fit in fits.items()}
    for d, (_, gram) in _gram_pass(vectors, fits, _white_about_mean, scale, offset).items():
        wrong = np.abs(gram / fits[d].n - np.eye(len(gram)))
        fits[d] = _with(fits[d], identity_error=float(wrong.max(initial=0.0)))
    return fits


def _with(fit: Fit, **changes) -> Fit:
    return Fit(**{**fit.__dict__, **changes})


def _factorised(vectors: DataFrame, fits: dict[int, Fit], scale: int, offset: int) -> dict[int, Fit]:
    """Gram passes until the rows of each length are orthogonal under their R."""
    for number in range(MOST_PASSES):
        grams = _gram_pass(vectors, fits, _orthogonal, scale, offset)
        settled = True
        for dimension, fit in fits.items():
            gram = grams[dimension][1] if dimension in grams else np.zeros((0, 0))
            if not number and not gram.any():  # all rows alike: no direction at all
                nothing = np.zeros((0, 0))
                fits[dimension] = _with(fit, basis=np.zeros((dimension, 0)), r=nothing)
            elif number < LEAST_FACTORS or not _is_settled(gram):
                fits[dimension] = _composed(fit, gram)
                settled = False
        if settled:
            return fits
    raise ArithmeticError(f"the rows are not orthogonal after {MOST_PASSES} passes")


def _composed(fit: Fit, gram: np.ndarray) -> Fit:
    """The factor of another pass composed onto R, without directions of rounding size."""
    if not len(gram):
        return fit
    factor = shifted_cholesky(gram, fit.n)
    if fit.r is None:
        return _with(fit, basis=np.eye(len(gram)), r=factor, trace=float(np.trace(gram)) / fit.n)
    r = factor @ fit.r
    _, lengths, directions = np.linalg.svd(r)
    kept = lengths > lengths[0] * ROUNDING
    if kept.all():
        return _with(fit, r=r)
    return _with(fit, basis=fit.basis @ directions[kept].T, r=np.diag(lengths[kept]))


def _components(fit: Fit, most: int) -> Fit:
    """Components by falling variance, from the singular values of R."""
    _, lengths, directions = np.linalg.svd(fit.r)
    return _with(
        fit, values=lengths[:most] ** 2 / fit.n, components=fit.basis @ directions[:most].T
    )


def _whiten_task(
    batches: Iterable[pa.RecordBatch], fits: dict[int, Fit], scale: int, offset: int
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, values in _by_dimension(batch.column(1)):
            fit = fits[values.shape[1]]
            count = len(fit.values)
            if not count:
                continue
            x = _integers(values, scale, offset)
            distances = _distances(x, fit)
            reach = float(np.abs(distances.astype(np.float64)).max(initial=0.0))
            if reach * reach * fit.dimension >= 2.0**62:
                distances = distances.astype(object)
            deviation = [
                int(total) if total < 1 << 63 else None for total in (distances * distances).sum(axis=1)
            ]
            white = _white(_centred(x, fit), fit)
            size = len(rows) * count
            ids = batch.column(0).take(pa.array(np.repeat(rows, count)))
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(rows))),
                    pa.array(np.full(size, fit.n, np.int64)),
                    pa.array([total for total in deviation for _ in range(count)], pa.int64()),
                    pa.array(white.ravel()),
                    pa.array(np.tile(fit.values / fit.trace, len(rows))),
                    pa.array(np.full(size, fit.identity_error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )


def whitened_rows(
    vectors: DataFrame,
    scale: int = 64,
    offset: int = 1_000_000,
    most_components: int = 32,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error for each usable row.

    Entries become x = floor(scale * c) + offset. `n` is the number of rows of the fit,
    `deviation` the exact sum over dimensions of (n x - S)^2, null where it does not fit a long;
    `whitened` is the centred row's share of a component over the root of the component's
    variance. Components are numbered from 1 by falling variance; directions in which rows do
    not differ are none, so a row may have fewer than `most_components`, and rows that are all
    alike, or a single row, have none. Rows whose vector is null, empty, or holds a null or a
    component that is not finite are dropped. Rows of another length are fitted among themselves.
    Repeated rows and rows with a null id count and are returned each. A component of 2**52 and
    more after scaling, or a vector of over 4096 components, ends the job with an error. Other
    columns are not read; an empty table gives no rows.
    """
    given = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("vector"))
    given = given.filter(usable(F.col("vector")))
    id_type = given.schema["vec_id"].dataType.simpleString()
    with passing_tables(vectors.sparkSession):
        # Kept, as the result reads it: all passes read the few usable columns.
        stored = written(given, "usable-vectors", keep=True)
        fits = fit_whitening(stored.select("vector"), scale, offset, most_components)
    task = functools.partial(_whiten_task, fits=fits, scale=scale, offset=offset)
    columns = (
        f"vec_id {id_type}, component int, n long, deviation long, whitened double, "
        "explained double, identity_error double"
    )
    return stored.mapInArrow(task, columns)
