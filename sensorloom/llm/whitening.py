"""Whitening of embeddings by mixed-precision eigenvectors.

Vectors become whole numbers, so their count, sums and covariance are exact: tasks sum products of limbs that a double
holds without rounding, Spark adds the parts as decimals, and the covariance of at most ``dimension`` squared numbers is what
reaches the driver.  Products are of vectors less the rounded mean; the rest of the mean is taken off exactly.

The eigenvectors start in float32 and are corrected in extended precision (Ogita and Aishima): one step of matrix products
makes both the residual of orthogonality and the off-diagonal part of the projected matrix quadratically smaller.
Eigenvalues that a step cannot tell apart form a cluster; their subspace is solved on its own, shifted and scaled, so that its
inner gaps count, and the steps go on until nothing moves.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.llm.tables import stored

SCALE = 64
SHIFT = 1_000_000
REACH = 2.0**40  # entries times SCALE beyond it count as it
LIMB = 20
BLOCK = 4096  # rows whose limb products a double adds up exactly
STEPS = 40
Extended = np.longdouble


def refined(a: np.ndarray, x: np.ndarray, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and eigenvectors of symmetric ``a`` (extended), from approximate eigenvectors ``x``."""
    a, x = a.astype(Extended), x.astype(Extended)
    d = len(a)
    unit = np.eye(d, dtype=Extended)
    tiny = np.finfo(Extended).eps
    size = np.abs(a).sum(axis=1).max() if d else Extended(0)
    value = np.zeros(d, Extended)
    for _ in range(steps):
        r = unit - x.T @ x
        s = x.T @ a @ x
        value = np.diag(s) / (1 - np.diag(r))
        order = np.argsort(-value, kind="stable")
        x, value, r, s = x[:, order], value[order], r[np.ix_(order, order)], s[np.ix_(order, order)]
        off = s - np.diag(value)
        if d == 0 or max(np.abs(off).max() / size, np.abs(r).max()) <= 2 * d * tiny:
            break  # what is left is rounding, which a step would blow up between close eigenvalues
        gap = value[None, :] - value[:, None]
        apart = np.abs(gap) > 2 * (np.linalg.norm(off.astype(float)) + float(size) * np.linalg.norm(r.astype(float)))
        step = np.where(apart, (s + value[None, :] * r) / np.where(apart, gap, 1), r / 2)
        x = x + x @ step
        for run in _clusters(apart):
            _solve_cluster(a, x, value, run, tiny * size)
    for _ in range(2):
        x = x + x @ ((unit - x.T @ x) / 2)
    value = np.diag(x.T @ a @ x).copy()
    order = np.argsort(-value, kind="stable")
    return value[order], x[:, order]


def _clusters(apart: np.ndarray) -> list[slice]:
    """Runs of two or more neighbours that are not ``apart``."""
    cut = [0, *(np.flatnonzero(np.diag(apart, 1)) + 1), len(apart)]
    return [slice(b, e) for b, e in zip(cut[:-1], cut[1:]) if e - b > 1]


def _solve_cluster(a: np.ndarray, x: np.ndarray, value: np.ndarray, run: slice, floor: Extended) -> None:
    """Turn the vectors of a cluster to the eigenvectors within their span, unless its inside is below rounding."""
    own = x[:, run]
    own = own + own @ ((np.eye(own.shape[1], dtype=Extended) - own.T @ own) / 2)
    middle = value[run].mean()
    inner = own.T @ (a @ own - middle * own)
    inner = (inner + inner.T) / 2
    spread = np.abs(inner).max()
    off = np.abs(inner - np.diag(np.diag(inner))).max()
    if off <= 64 * floor or off <= 1e-3 * np.abs(np.diff(np.sort(np.diag(inner)))).min():
        return
    _, turn = np.linalg.eigh((inner / spread).astype(np.float64))
    turn = turn[:, ::-1].astype(Extended)
    turn = turn + turn @ ((np.eye(len(turn), dtype=Extended) - turn.T @ turn) / 2)
    x[:, run] = own @ turn


def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors of ``a``: float32 first, then corrected.  Each vector's largest entry is positive."""
    size = np.abs(a).max() if a.size else 0
    if not size:
        return np.zeros(len(a), Extended), np.eye(len(a), dtype=Extended)
    scaled = a / size
    _, x = np.linalg.eigh(scaled.astype(np.float32))
    value, x = refined(scaled, x[:, ::-1])
    top = np.abs(x).argmax(axis=0)
    return value * size, x * np.where(x[top, np.arange(len(x))] < 0, -1, 1)


def _rows(batch: pa.RecordBatch, dimension: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and whole-number vectors of the rows that count, by length; vectors with null or non-finite entries don't."""
    column = batch.column("vector")
    length = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    for d in np.unique(length[length > 0]) if dimension is None else [dimension]:
        place = np.flatnonzero(length == d)
        flat = pc.cast(column.take(pa.array(place)).flatten(), pa.float64()).to_numpy(zero_copy_only=False).reshape(len(place), d)
        sound = np.isfinite(flat).all(axis=1)
        # scaled only within reach, so that huge entries do not overflow
        whole = np.floor(np.clip(flat[sound], -REACH / SCALE, REACH / SCALE) * SCALE).astype(np.int64)
        yield place[sound], whole


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per length and dimension: number of vectors and their sum."""
    found: dict[int, tuple[int, np.ndarray]] = {}

    def parts() -> Iterator[pa.RecordBatch]:
        for d, (n, total) in found.items():
            columns = [pa.array([d] * d, pa.int32()), pa.array(range(d), pa.int32()), pa.array([n] * d, pa.int64()), pa.array([str(v) for v in total], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["d", "i", "n", "part"])
        found.clear()

    for batch in batches:
        for place, whole in _rows(batch):
            for at in range(0, len(whole), BLOCK):
                n, total = found.get(whole.shape[1], (0, np.zeros(whole.shape[1], object)))
                found[whole.shape[1]] = n + len(whole[at : at + BLOCK]), total + whole[at : at + BLOCK].sum(axis=0).astype(object)
        if sum(found) > 1 << 18:
            yield from parts()
    yield from parts()


def products(z: np.ndarray) -> np.ndarray:
    """Exact sum of outer products of whole-number rows (object array of int)."""
    total = np.zeros((z.shape[1], z.shape[1]), object)
    for at in range(0, len(z), BLOCK):
        part = z[at : at + BLOCK]
        limbs, shift = [], 0
        while True:
            low = part & ((1 << LIMB) - 1) if np.abs(part).max(initial=0) >= 1 << LIMB else part
            limbs.append((shift, low.astype(np.float64)))
            part = (part - low) >> LIMB
            shift += LIMB
            if not part.any():
                break
        for s, left in limbs:
            for t, right in limbs:
                total += (left.T @ right).astype(np.int64).astype(object) << (s + t)
    return total


@dataclass(frozen=True)
class Moments:
    """Number of vectors, their exact sums (of shifted whole numbers), and n squared times their covariance, exact."""

    n: int
    sums: tuple[int, ...]
    scatter: np.ndarray

    @property
    def covariance(self) -> np.ndarray:
        n2 = self.n * self.n
        return np.array([[Extended(int(v // n2)) + Extended(v % n2) / Extended(n2) for v in row] for row in self.scatter], Extended).reshape(self.scatter.shape)


def moments(vectors: DataFrame) -> Moments | None:
    """Of the vectors of the most frequent length (the longest of several); None without any.  Two passes."""
    sums = stored(
        vectors.mapInArrow(_sums, "d int, i int, n long, part string")
        .groupBy("d", "i").agg(F.sum("n").alias("n"), F.sum(F.col("part").cast("decimal(38,0)")).alias("total")),
        "whitening-sums",
    )
    first = sums.where("i = 0").orderBy(F.desc("n"), F.desc("d")).first()
    if first is None:
        return None
    d, n = first["d"], first["n"]
    total = [int(r["total"]) for r in sums.where(F.col("d") == d).orderBy("i").collect()]  # one row per dimension
    middle = np.array([round(Fraction(s, n)) for s in total], np.int64)

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = np.zeros((d, d), object)
        for batch in batches:
            for _, whole in _rows(batch, d):
                part += products(whole - middle)
        i, j = np.triu_indices(d)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array([str(v) for v in part[i, j]])], ["i", "j", "part"])

    rows = vectors.mapInArrow(scatter, "i int, j int, part string").groupBy("i", "j").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total"))
    out = np.zeros((d, d), object)
    rest = [s - n * int(m) for s, m in zip(total, middle)]
    for row in rows.collect():  # one row per pair of dimensions
        i, j = row["i"], row["j"]
        out[i, j] = out[j, i] = n * int(row["total"]) - rest[i] * rest[j]
    return Moments(n, tuple(s + n * SHIFT for s in total), out)


def whiten(vectors: DataFrame, components: int = 32, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per remaining vector and component: ``key``, component, n, deviation, whitened, explained, identity_error.

    Rows whose vector is null, empty, or holds null or non-finite entries are left out, as are those of another length than
    the most frequent.  Entries beyond 2^40 / 64 count as that.  ``deviation`` is a decimal without places; it is null
    beyond 38 digits.  Components without variance (eigenvalue at most dimension x 2^-50 of the largest) have no rows, so
    an empty table, a single vector and equal vectors give an empty result.  Equal eigenvalues leave a basis of their
    space to choice.  Null keys and repeated rows stay; other columns are not read.
    """
    narrow = vectors.select(F.col(key).alias("key"), F.col(vector).alias("vector"))
    names = [key, "component", "n", "deviation", "whitened", "explained", "identity_error"]
    types = [narrow.schema["key"].dataType, T.IntegerType(), T.LongType(), T.StringType(), T.DoubleType(), T.DoubleType(), T.DoubleType()]
    schema = T.StructType([T.StructField(n, t) for n, t in zip(names, types)])
    exact = F.col("deviation").cast("decimal(38,0)").alias("deviation")
    columns = [exact if n == "deviation" else F.col(n) for n in names]
    found = moments(narrow)
    if found is None:
        return vectors.sparkSession.createDataFrame([], schema).select(columns)
    n, d, sums = found.n, len(found.sums), found.sums
    covariance = found.covariance
    value, basis = eigen(covariance)
    count = int(min(components, (value > value[0] * d * 2.0**-50).sum())) if value[0] > 0 else 0
    trace = np.trace(covariance)
    explained = (value[:count] / trace).astype(np.float64) if count else np.zeros(0)
    turn = (basis[:, :count] / np.sqrt(value[:count])).astype(np.float64)
    plain = np.array([s - n * SHIFT for s in sums], object)  # n times the mean, less the shift
    base = np.array([s // n for s in plain], np.int64)
    rest = np.array([float(Fraction(int(s - n * int(b)), n)) for s, b in zip(plain, base)])

    def projected(whole: np.ndarray) -> np.ndarray:
        return ((whole - base) - rest) @ turn

    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = np.zeros((count + 1, count))
        for batch in batches:
            for _, whole in _rows(batch, d):
                w = projected(whole)
                part[:count] += w.T @ w
                part[count] += w.sum(axis=0)
        i, j = np.indices(part.shape)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(part.ravel())], ["i", "j", "part"])

    square = np.zeros((count + 1, count))
    if count:
        for row in narrow.mapInArrow(checked, "i int, j int, part double").groupBy("i", "j").agg(F.sum("part").alias("part")).collect():  # components squared
            square[row["i"], row["j"]] = row["part"] / n
    identity = float(np.abs(square[:count] - np.outer(square[count], square[count]) - np.eye(count)).max()) if count else 0.0

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place, whole in _rows(batch, d):
                for at in range(0, len(place), BLOCK):
                    own, part = pa.array(place[at : at + BLOCK]), whole[at : at + BLOCK]
                    m = len(part)
                    arrays = [
                        batch.column("key").take(own.take(pa.array(np.repeat(np.arange(m), count)))),
                        pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), m)),
                        pa.array(np.full(m * count, n, np.int64)),
                        pa.array([str(v) for v in _deviations(part, n, plain)], pa.string()).take(pa.array(np.repeat(np.arange(m), count))),
                        pa.array(projected(part).ravel()),
                        pa.array(np.tile(explained, m)),
                        pa.array(np.full(m * count, identity)),
                    ]
                    yield pa.RecordBatch.from_arrays(arrays, names)

    return narrow.mapInArrow(written, schema).select(columns)


def _deviations(whole: np.ndarray, n: int, plain: np.ndarray) -> np.ndarray:
    """Exact sum over dimensions of (n * x - S)^2 for each row."""
    far = int(np.abs(whole).max(initial=0)) * n + int(max(abs(int(v)) for v in plain))
    if far * far * whole.shape[1] < 1 << 63:
        away = whole * n - plain.astype(np.int64)
        return (away * away).sum(axis=1)
    away = whole.astype(object) * n - plain
    return (away * away).sum(axis=1)
