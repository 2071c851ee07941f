"""Whitening of embeddings with eigenvectors found by contour integration (FEAST).

Vectors become whole numbers, and each distinct one counts once. Two passes of
Spark give the sums and the covariance. Its spectrum is cut into intervals by
inertia counts. For each interval a block of vectors is filtered by quadrature
of the resolvent along a circle around it, that is by solves with complex
shifts of the covariance, and a Rayleigh-Ritz step takes the components out of
what is left; the inertia says how many there must be. The covariance is
dimension by dimension, whatever the number of rows, and is worked on by the
driver. A last pass over the rows projects them.

Null vectors and vectors with null or non-finite entries are left out, as are
those with an entry of 2**56 or more, which has no 64-bit form, and those whose
length is not the one most distinct vectors have (the longer of two; length 0
never counts). Repeated rows and ids give rows each. An empty table, and one
whose vectors are all equal, has no components and gives no row; components
without variance are left out. A deviation that needs over 64 bits is null.
Columns other than the id and the vector are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyframe.plans.lineage import materialize
from tallyframe.plans.matrices import PARTS, cut, summed

SCALE, SHIFT = 64, 1_000_000
MOST_ABS = 2.0**56
COMPONENTS = 16
#: Nodes of the quadrature on half the circle; most eigenvalues of one interval.
NODES, PER_INTERVAL = 16, 8
MOST_ROUNDS = 40
#: Share of the trace below which an eigenvalue is round-off.
NOISE = 1e-13


# ---- vectors as whole numbers


def _matrices(vectors: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and floor(64 * entry) of the usable vectors, one matrix for each length."""
    lengths = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
    lengths = np.where(np.isnan(lengths), -1, lengths).astype(np.int64) if lengths.dtype.kind == "f" else lengths
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(float)  # a null entry is NaN
    starts = np.cumsum(np.maximum(lengths, 0)) - np.maximum(lengths, 0)
    for length in np.unique(lengths[lengths >= 0]):
        rows = np.flatnonzero(lengths == length)
        entries = flat[starts[rows, None] + np.arange(length)]
        usable = (np.abs(entries) < MOST_ABS).all(axis=1)  # False for NaN
        yield rows[usable], np.floor(SCALE * entries[usable]).astype(np.int64)


def _pack(rows: np.ndarray) -> list[bytes]:
    """Each vector in the fewest bytes an entry that hold it, after one byte that says how many."""
    top = np.maximum(rows.max(axis=1, initial=0), ~rows.min(axis=1, initial=0))
    return [bytes([width]) + row.astype(f"<i{width}").tobytes() for row, width in zip(rows, np.select([top < 1 << 7, top < 1 << 15, top < 1 << 31], [1, 2, 4], 8).tolist())]


def _unpack(packed: list[bytes]) -> np.ndarray:
    """x of each vector (all of one length)."""
    return np.array([np.frombuffer(data, f"<i{data[0]}", offset=1).astype(np.int64) for data in packed]) + SHIFT


def _pack_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, rows in _matrices(batch.column(0)):
            if len(rows):
                yield pa.RecordBatch.from_arrays([pa.array(_pack(rows), pa.binary()), pa.array([rows.shape[1]] * len(rows), pa.int32())], names=["x", "length"])


def fit_list(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """Every distinct usable vector once, packed (``x``), of the length most of them have (``length``)."""
    packed = vectors.select(column).mapInArrow(_pack_all, "x binary, length int").filter("length > 0")
    distinct = materialize(packed.distinct())
    usual = distinct.groupBy("length").count().orderBy(F.desc("count"), F.desc("length")).first()
    return distinct.filter(F.col("length") == (usual["length"] if usual else 0))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        for low in range(0, batch.num_rows, 4096):
            yield _unpack(batch.column(0).slice(low, 4096).to_pylist())


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number and sums of one task's vectors, in two halves that cannot overflow."""
    count, high, low = 0, 0, 0
    for x in _blocks(batches):
        count, high, low = count + len(x), high + (x >> 32).sum(axis=0), low + (x & 0xFFFFFFFF).sum(axis=0)
    if count:
        places = pa.array(range(len(high)), pa.int32())
        yield pa.RecordBatch.from_arrays([places, pa.array([count] * len(high)), pa.array(high), pa.array(low)], names=["place", "n", "high", "low"])


def sums(fit: DataFrame) -> tuple[int, list[int]]:
    """n and S of the fit list, exact; (0, []) if it is empty."""
    parts = fit.select("x").mapInArrow(_sums, "place int, n bigint, high bigint, low bigint")
    exact = [F.sum(F.col(name).cast("decimal(28,0)")).alias(name) for name in ("n", "high", "low")]
    rows = parts.groupBy("place").agg(*exact).orderBy("place").collect()  # one row a dimension
    return (int(rows[0]["n"]) if rows else 0), [(int(r["high"]) << 32) + int(r["low"]) for r in rows]


def deviations(x: np.ndarray, n: int, total: list[int]) -> np.ndarray:
    """n * x - S, exact: 64-bit where that is safe, else Python's own integers."""
    most = max(map(abs, total), default=0) + n * int(np.abs(x).max(initial=0))
    kind = np.int64 if most < 1 << 62 else object
    return x.astype(kind) * n - np.array(total, kind)


def centred(x: np.ndarray, n: int, total: list[int]) -> np.ndarray:
    """x - S / n in doubles, rounded once."""
    return (deviations(x, n, total) / n).astype(float)


def second_moments(fit: DataFrame, n: int, total: list[int], onto: np.ndarray | None = None) -> np.ndarray:
    """Covariance of the fit list, or of its projection on the columns of ``onto``."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for x in _blocks(batches):
            y = centred(x, n, total)
            y = y if onto is None else y @ onto
            out = y.T @ y if out is None else out + y.T @ y
        if out is not None:
            yield cut(out)

    size = len(total) if onto is None else onto.shape[1]
    return summed(fit.select("x").mapInArrow(task, PARTS), (size, size)) / max(n, 1)


# ---- eigenvectors of the covariance


def inertia_below(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues are below ``shift``: the negative pivots of L D L' (Bunch and Parlett)."""
    a = matrix - shift * np.eye(len(matrix))
    below = 0
    while len(a):
        diagonal = np.abs(np.diagonal(a))
        p = int(diagonal.argmax())
        off = np.abs(a - np.diag(np.diagonal(a)))
        i, j = np.unravel_index(off.argmax(), off.shape)
        if diagonal[p] == 0 and off[i, j] == 0:
            return below
        # A pivot of one row, or of two rows where no diagonal entry is large enough.
        pivot = [p] if diagonal[p] >= 0.6404 * off[i, j] else [int(i), int(j)]
        rest = np.setdiff1d(np.arange(len(a)), pivot)
        block, side = a[np.ix_(pivot, pivot)], a[np.ix_(rest, pivot)]
        below += int(block[0, 0] < 0) if len(pivot) == 1 else 1
        a = a[np.ix_(rest, rest)] - side @ np.linalg.solve(block, side.T)
        a = (a + a.T) / 2
    return below


class Spectrum:
    """A symmetric matrix cut by inertia."""

    def __init__(self, matrix: np.ndarray):
        self.matrix = matrix
        self.above_all = float(np.abs(matrix).sum(axis=1).max(initial=0.0)) * 1.0001
        self.noise = float(np.trace(matrix)) * NOISE

    def above(self, shift: float) -> int:
        return len(self.matrix) - inertia_below(self.matrix, shift)

    def split(self, low: float, high: float, least: int, most: int) -> tuple[float, int] | None:
        """A shift between ``low`` and ``high`` with ``least`` to ``most`` eigenvalues above, and how many; None if there is none."""
        while high > low * (1 + 1e-9):
            middle = float(np.sqrt(low) * np.sqrt(high))
            found = self.above(middle)
            # The count has to hold around the shift: it must not lie on an eigenvalue.
            if least <= found <= most and self.above(middle * (1 - 1e-10)) == found:
                return middle, found
            if found < least:
                high = middle
            else:
                low = middle
        return None

    def intervals(self, components: int) -> list[tuple[float, float, int]]:
        """(low, high, eigenvalues inside) that hold the ``components`` greatest eigenvalues above round-off."""
        lowest, count = self.noise, self.above(self.noise)
        if count > components:
            cut = self.split(lowest, self.above_all, components, components + PER_INTERVAL)
            lowest, count = cut or (lowest, count)
        todo, done = [(lowest, self.above_all, count, 0)], []
        while todo:
            low, high, of_low, of_high = todo.pop()
            inside = of_low - of_high
            half = of_high + inside // 2
            # As even as the eigenvalues allow; a cluster that no shift parts stays whole.
            cut = inside > PER_INTERVAL and (
                self.split(low, high, half - inside // 4, half + inside // 4) or self.split(low, high, of_high + 1, of_low - 1)
            )
            if cut:
                todo += [(low, cut[0], of_low, cut[1]), (cut[0], high, cut[1], of_high)]
            elif inside:
                done.append((*self.tightened(low, high, of_low, of_high), inside))
        return sorted(done)

    def tightened(self, low: float, high: float, of_low: int, of_high: int, steps: int = 8) -> tuple[float, float]:
        """Ends nearer to the eigenvalues inside: a small circle leaves what is outside farther off."""
        for _ in range(steps):
            middle = float(np.sqrt(low) * np.sqrt(high))
            found = self.above(middle)
            if found == of_high:
                high = middle
            elif found == of_low:
                low = middle
            else:
                break
        for end, wanted in ((0, of_low), (1, of_high)):
            inner = float(np.sqrt(low) * np.sqrt(high))
            for _ in range(steps):
                outer = (low, high)[end]
                middle = float(np.sqrt(outer) * np.sqrt(inner))
                if self.above(middle) != wanted:
                    inner = middle
                elif end:
                    high = middle
                else:
                    low = middle
        # A little outwards, so that no end lies on an eigenvalue it has come up to.
        return low * (1 - 1e-9), high * (1 + 1e-9)


def contour_filter(matrix: np.ndarray, low: float, high: float, block: np.ndarray) -> np.ndarray:
    """The part of ``block`` in the eigenspace of ``low`` to ``high``, nearly.

    The integral of the resolvent along a circle through both ends is the
    projector. Its lower half is the conjugate of the upper, so Gauss-Legendre
    nodes on the upper half and real parts are enough.
    """
    at, weight = np.polynomial.legendre.leggauss(NODES)
    around = (high - low) / 2 * np.exp(0.5j * np.pi * (at + 1))
    out = np.zeros_like(block)
    for turn, w in zip(around, weight):
        shifted = ((low + high) / 2 + turn) * np.eye(len(matrix)) - matrix
        out += w / 2 * (turn * np.linalg.solve(shifted, block.astype(complex))).real
    return out


def interval_vectors(matrix: np.ndarray, low: float, high: float, count: int) -> np.ndarray:
    """The ``count`` eigenvectors whose eigenvalues lie between ``low`` and ``high``."""
    size = len(matrix)
    width = min(size, 2 * count + 4)
    scale = np.abs(matrix).sum(axis=1).max()
    draw = np.random.default_rng(12)
    while True:
        block, best = draw.standard_normal((size, width)), np.inf
        for _ in range(MOST_ROUNDS):
            basis = np.linalg.qr(contour_filter(matrix, low, high, block))[0]
            values, turn = np.linalg.eigh(basis.T @ matrix @ basis)
            block = basis @ turn
            inside = (values > low) & (values < high)
            rest = np.linalg.norm(matrix @ block[:, inside] - block[:, inside] * values[inside], axis=0).max(initial=0.0)
            if inside.sum() == count and rest <= 1e-13 * scale:
                return block[:, inside]
            if inside.sum() == count and rest <= 1e-11 * scale and rest >= best:
                return block[:, inside]  # as exact as the arithmetic allows
            best = min(best, rest) if inside.sum() == count else best
        if width == size:
            raise ArithmeticError(f"{int(inside.sum())} eigenvalues between {low} and {high}, the inertia says {count}")
        width = min(size, 2 * width)


def components(matrix: np.ndarray, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of up to ``most`` components with variance."""
    spectrum = Spectrum(matrix)
    if not spectrum.noise > 0:
        return np.zeros(0), np.zeros((len(matrix), 0))
    found = [interval_vectors(matrix, *interval) for interval in spectrum.intervals(most)]
    if not found:
        return np.zeros(0), np.zeros((len(matrix), 0))
    # One Rayleigh-Ritz step over all intervals makes their vectors orthogonal to each other.
    basis = np.linalg.qr(np.hstack(found))[0]
    values, turn = np.linalg.eigh(basis.T @ matrix @ basis)
    order = np.argsort(-values, kind="stable")[:most]
    vectors = (basis @ turn)[:, order]
    largest = np.abs(vectors).argmax(axis=0)
    return values[order], vectors * np.sign(vectors[largest, np.arange(len(order))])


# ---- projected rows


def _project(n: int, total: list[int], values: np.ndarray, onto: np.ndarray, trace: float):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, size = len(values), len(total)
        for batch in batches:
            for low in range(0, batch.num_rows, 4096):
                part = batch.slice(low, 4096)
                for rows, x in _matrices(part.column(1)):
                    if x.shape[1] != size or not len(rows):
                        continue
                    exact = deviations(x + SHIFT, n, total)
                    safe = exact.dtype != object and int(np.abs(exact).max()) ** 2 * size < 1 << 63
                    squares = ((exact if safe else exact.astype(object)) ** 2).sum(axis=1).tolist()
                    deviation = [s if s < 1 << 63 else None for s in squares]
                    white = (exact / n).astype(float) @ onto
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column(0).take(pa.array(np.repeat(rows, k))),
                            pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
                            pa.array(deviation, pa.int64()).take(pa.array(np.repeat(np.arange(len(rows)), k))),
                            pa.array(white.ravel()),
                            pa.array(np.tile(values / trace, len(rows))),
                        ],
                        names=["vec_id", "component", "deviation", "whitened", "explained"],
                    )

    return task


def whiten(vectors: DataFrame, most: int = COMPONENTS) -> DataFrame:
    """A row for each usable vector (``vec_id``, ``embedding``) and component.

    ``n`` is the size of the fit list and ``identity_error`` the largest entry
    by which the whitened fit list's covariance differs from the identity.
    """
    kind = vectors.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, deviation bigint, whitened double, explained double"
    fit = fit_list(vectors)
    n, total = sums(fit)
    matrix = second_moments(fit, n, total) if n else np.zeros((0, 0))
    values, axes = components(matrix, most)
    onto = axes / np.sqrt(values)
    error = 0.0
    if len(values):
        error = float(np.abs(second_moments(fit, n, total, onto) - np.eye(len(values))).max())
    # The axes are of fixed size and travel with the tasks.
    rows = vectors.select("vec_id", "embedding").mapInArrow(_project(n, total, values, onto, float(np.trace(matrix))), schema)
    if not len(values):
        rows = rows.limit(0)
    return rows.select(
        "vec_id", "component", F.lit(n).cast("bigint").alias("n"), "deviation", "whitened", "explained", F.lit(error).alias("identity_error")
    )


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{folder}/embeddings.parquet"))
