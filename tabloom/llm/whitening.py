"""Principal components and whitening of embeddings, eigenvectors to double precision.

Vectors are turned into whole numbers, so their sums are exact however the work is cut up, and every
entry is centred before anything is multiplied. Tasks send partial sums and partial covariances; the
matrix, whose size is that of one vector squared, is solved on the driver: float32 eigenvectors are
corrected by Ogita-Aishima iterations, which need matrix products only, in extended precision. Where
eigenvalues are too close for the iteration to tell them apart, the cluster's vectors are turned
within the space that they span, by solving the small problem projected on it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import arrow_mapped
from tabloom.sources.shared import stored

RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


@dataclass(frozen=True)
class Settings:
    components: int = 8
    #: An entry c becomes the whole number floor(scale * c) + offset.
    scale: int = 1024
    offset: int = 100_000
    #: Entries of this size or more count as not finite: sums of their whole numbers must stay exact.
    largest: float = 2.0**30
    rounds: int = 30


def whole_numbers(lists: pa.ListArray, settings: Settings) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For every length of usable vectors in the batch: the length, their places, and their whole numbers as rows."""
    offsets = lists.offsets.to_numpy().astype(np.int64)
    values = np.asarray(lists.values.to_numpy(zero_copy_only=False), np.float64)
    with np.errstate(invalid="ignore"):
        bad = np.concatenate([[0], np.cumsum(~(np.abs(values) < settings.largest))])
    lengths = np.diff(offsets)
    good = np.asarray(lists.is_valid()) & (lengths > 0) & (bad[offsets[1:]] == bad[offsets[:-1]])
    for length in np.unique(lengths[good]):
        places = np.flatnonzero(good & (lengths == length))
        rows = values[offsets[places][:, None] + np.arange(length)]
        yield int(length), places, np.floor(settings.scale * rows).astype(np.int64) + settings.offset


@dataclass(frozen=True)
class Fit:
    """What all vectors of the fit list share: their length, number and exact sums."""

    dims: int
    n: int
    sums: tuple[int, ...]

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``x - sums / n``, rounded once: the whole part of the mean is taken off first."""
        return (x - self.floors) - self.rests / self.n

    @property
    def floors(self) -> np.ndarray:
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def rests(self) -> np.ndarray:
        return np.array([s % self.n for s in self.sums], np.int64)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The exact sum of ``(n * x - sums) ** 2`` of every row, null where a long can't hold it.

        Products wrap around at 2^64, so whatever fits a long in the end is exact."""
        about = (self.centred(x) ** 2).sum(axis=1) * float(self.n) ** 2
        with np.errstate(over="ignore"):
            wrapped = (np.uint64(self.n % (1 << 64)) * (x - self.floors).astype(np.uint64) - self.rests.astype(np.uint64)) ** 2
            exact = wrapped.sum(axis=1, dtype=np.uint64)
        return [int(e) if a < 2.0**62 or (a < 2.0**63.5 and e < 1 << 63) else None for a, e in zip(about, exact, strict=True)]


def fitted(vectors: DataFrame, settings: Settings) -> Fit | None:
    """Number and sums of the usable vectors of the commonest length (of equally common ones the
    greatest); none if there are no vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def rows(lengths: list[int]) -> pa.RecordBatch:
            parts = [(k, *held.pop(k)) for k in lengths]
            return pa.RecordBatch.from_arrays(
                [pa.array([p[0] for p in parts], pa.int32()), pa.array([p[1] for p in parts], pa.int64()), pa.array([p[2].tolist() for p in parts], pa.list_(pa.int64()))],
                names=["dims", "n", "sums"],
            )

        for batch in batches:
            for length, places, x in whole_numbers(batch.column(0), settings):
                n, sums = held.get(length, (0, 0))
                held[length] = (n + len(places), sums + x.sum(axis=0))
            # Entries are below 2^41, so sums over 2^20 rows stay well inside a long.
            yield rows([k for k, (n, _) in held.items() if n >= 1 << 20])
        yield rows(list(held))

    partial = arrow_mapped(vectors.select("embedding"), run, "dims int, n long, sums array<long>")
    totals = partial.select("dims", "n", F.posexplode("sums").alias("pos", "value")).groupBy("dims", "pos")
    totals = stored(totals.agg(F.sum("n").alias("n"), F.sum(F.col("value").cast("decimal(38,0)")).alias("value")), "sums")
    chosen = totals.where("pos = 0").orderBy(F.desc("n"), F.desc("dims")).select("dims", "n").first()
    if chosen is None:
        return None
    # One number per entry of a vector.
    sums = {r["pos"]: int(r["value"]) for r in totals.where(F.col("dims") == chosen["dims"]).collect()}
    return Fit(chosen["dims"], chosen["n"], tuple(sums[k] for k in range(chosen["dims"])))


def covariance(vectors: DataFrame, fit: Fit, settings: Settings) -> np.ndarray:
    """The covariance of the whole numbers, divisor n; each task sends the half of its own matrix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products = np.zeros((fit.dims, fit.dims))
        for batch in batches:
            for length, _, x in whole_numbers(batch.column(0), settings):
                if length == fit.dims:
                    centred = fit.centred(x)
                    products += centred.T @ centred
        half = [products[i, i:].tolist() for i in range(fit.dims)]
        yield pa.RecordBatch.from_arrays([pa.array(range(fit.dims), pa.int32()), pa.array(half, pa.list_(pa.float64()))], names=["i", "half"])

    partial = arrow_mapped(vectors.select("embedding"), run, "i int, half array<double>")
    cells = partial.select("i", F.posexplode("half").alias("pos", "value")).groupBy("i", (F.col("i") + F.col("pos")).alias("j")).agg(F.sum("value").alias("value"))
    out = np.zeros((fit.dims, fit.dims))
    for i, j, value in cells.collect():
        out[i, j] = out[j, i] = value / fit.n
    return out


def clusters(values: np.ndarray, least: float) -> list[np.ndarray]:
    """Groups of two and more eigenvalues whose neighbours are no more than ``least`` apart."""
    order = np.argsort(values, kind="stable")
    cuts = np.flatnonzero(np.diff(values[order]) > least) + 1
    return [group for group in np.split(order, cuts) if len(group) > 1]


def eigen(matrix: np.ndarray, rounds: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors as columns of a symmetric matrix.

    float32 gives the start. Each round computes how far the columns are from orthonormal and the
    matrix from diagonal in their basis, and corrects all pairs of columns at once by first order;
    digits double each time. Pairs of eigenvalues closer than the round can resolve are left to the
    sub-solve of their cluster, in which they are well apart. Vectors of an eigenvalue that is
    multiple to the last digit are some orthonormal basis of their space."""
    size = len(matrix)
    unit = np.abs(matrix).max(initial=0.0)
    if unit == 0:
        return np.zeros(size), np.eye(size)
    a = matrix.astype(np.longdouble) / np.longdouble(unit)
    norm, one = np.sqrt((a * a).sum()), np.eye(size, dtype=np.longdouble)
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.longdouble)
    tiny = size * np.finfo(np.longdouble).eps
    for _ in range(rounds):
        off = one - x.T @ x
        inside = x.T @ a @ x
        inside = (inside + inside.T) / 2
        values = inside.diagonal() / (1 - off.diagonal())
        beside = inside - np.diag(values)
        error, skew = np.sqrt((beside**2).sum()), np.sqrt((off**2).sum())
        if error <= 8 * tiny * norm and skew <= 8 * tiny:
            break
        least = max(2 * (error + norm * skew), tiny)
        gaps = values[None, :] - values[:, None]
        apart = np.abs(gaps) > least
        step = np.where(apart, (inside + values[None, :] * off) / np.where(apart, gaps, 1), off / 2)
        x = x + x @ step
        for group in clusters(values, float(least)):
            part = x[:, group]
            small = part.T @ (a @ part - part * values[group].mean())
            small = (small + small.T) / 2
            spread = np.abs(small).max()
            if spread > tiny:
                x[:, group] = part @ np.linalg.eigh((small / spread).astype(np.float64))[1].astype(np.longdouble)
        # Steps between all but equal eigenvalues are uncertain; what they do to orthogonality is undone.
        x = x + x @ (one - x.T @ x) / 2
    x = x / np.sqrt((x * x).sum(axis=0))
    values = (x * (a @ x)).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    x, values = x[:, order], values[order]
    top = np.abs(x).argmax(axis=0)
    signs = np.where(x[top, np.arange(size)] < 0, -1, 1)
    return (values * np.longdouble(unit)).astype(np.float64), (x * signs).astype(np.float64)


def projected(vectors: DataFrame, fit: Fit, basis: np.ndarray, settings: Settings) -> DataFrame:
    """``vec_id``, ``deviation`` and the centred vector in the columns of ``basis``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, places, x in whole_numbers(batch.column(1), settings):
                if length != fit.dims:
                    continue
                coordinates = fit.centred(x) @ basis
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(places)),
                        pa.array(fit.deviations(x), pa.int64()),
                        pa.FixedSizeListArray.from_arrays(pa.array(coordinates.ravel()), basis.shape[1]).cast(pa.list_(pa.float64())),
                    ],
                    names=["vec_id", "deviation", "whitened"],
                )

    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    return arrow_mapped(rows, run, "vec_id long, deviation long, whitened array<double>")


def identity_error(rows: DataFrame, count: int) -> float | None:
    """The largest entry, sign aside, of the covariance of the ``whitened`` arrays less the identity."""
    if not count:
        return None
    entry = [F.get("whitened", k) for k in range(count)]
    means = rows.agg(*[F.avg(e).alias(f"m{k}") for k, e in enumerate(entry)]).first()
    centred = [e - F.lit(means[k]) for k, e in enumerate(entry)]
    cells = {(i, j): F.avg(centred[i] * centred[j]).alias(f"c{i}_{j}") for i in range(count) for j in range(i, count)}
    found = rows.agg(*cells.values()).first()
    return max(abs(found[f"c{i}_{j}"] - (i == j)) for i, j in cells)


def whitened(vectors: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per usable vector and component: ``vec_id``, ``component`` from 1 by falling
    eigenvalue, ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``.

    Left out are vectors that are null or empty, hold null or non-finite entries or entries of 2^30
    and more, or have another length than most vectors (of equally common lengths the greatest
    counts). Rows with a null or repeated ``vec_id`` are vectors like any other. ``deviation`` is null
    where it exceeds a long. A component whose eigenvalue is zero up to rounding has null ``whitened``
    and takes no part in ``identity_error``; if all are, ``explained`` and ``identity_error`` are null.
    Vectors with fewer entries than components have as many components as entries. An empty table
    gives no rows. Other columns are left behind, whatever their names.
    """
    spark = vectors.sparkSession
    fit = fitted(vectors, settings)
    if fit is None:
        return spark.createDataFrame([], RESULT)
    matrix = covariance(vectors, fit, settings)
    values, basis = eigen(matrix, settings.rounds)
    values, basis = values[: settings.components], basis[:, : settings.components]
    trace = float(matrix.trace())
    count = int((values > fit.dims * 2.0**-50 * trace).sum())
    rows = stored(projected(vectors, fit, basis[:, :count] / np.sqrt(values[:count]) if count else np.zeros((fit.dims, 1)), settings), "whitened")
    error = F.lit(identity_error(rows, count)).cast("double")
    components = [
        F.struct(
            F.lit(k + 1).alias("component"),
            (F.get("whitened", k) if k < count else F.lit(None).cast("double")).alias("whitened"),
            F.lit(float(value) / trace if trace > 0 else None).cast("double").alias("explained"),
        )
        for k, value in enumerate(values)
    ]
    long = rows.select("vec_id", "deviation", F.inline(F.array(*components)))
    return long.select("vec_id", "component", F.lit(fit.n).cast("long").alias("n"), "deviation", "whitened", "explained", error.alias("identity_error"))
