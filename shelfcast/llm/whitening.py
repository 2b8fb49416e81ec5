"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

Entries become whole numbers, x = floor(64 * c) + 1000000.  The fit list is each distinct x vector once, a written table.
The leading eigenvectors of its covariance V are found without V: a pass over the fit list sends a block Q of columns
to V Q, as centred XᵀXQ summed over the tasks, and a recurrence of such passes applies a Chebyshev polynomial that is
small on the unwanted part of the spectrum and grows fast above it.  QR and Rayleigh-Ritz follow on the driver, on a matrix
of as many rows as a vector has entries.  Vectors that have converged are locked, so that the polynomial need not span the
whole range of eigenvalues.  The iteration ends when a pass over all components certifies them: what V does to each and
what its eigenvalue does differ by no more than ``CERTIFIED`` of the largest eigenvalue.

Defined cases: vectors that are null, empty, or hold a null or non-finite entry are dropped; vectors of several lengths,
entries of 2**46 and above, and deviations beyond a long are errors; repeated rows and ids are returned each, and fitted
once for each distinct vector; there are as many components as directions with variance, at most ``components``, so one
distinct vector or an empty table gives no rows.  Other columns are not looked at.
"""

from __future__ import annotations

import dataclasses
import math
from collections.abc import Callable, Iterator
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.session import materialise

if TYPE_CHECKING:
    import numpy as np
    import pyarrow as pa

COMPONENTS = 16
GUARD = 32  # further columns of the block; the more, the faster the wanted ones part from the rest
GROWTH = 1e7  # of the polynomial at the largest eigenvalue, at most; beyond, columns become copies of one
LONGEST = 30  # passes of one polynomial
CONVERGED = 2e-14  # of the largest eigenvalue: what is left of a vector that is locked
CERTIFIED = 1e-13
MOST_ROUNDS = 200  # a fit that takes more is an error
NOTHING = 1e-12  # of the largest eigenvalue: a direction with less variance has none
SLICE = 4096  # rows multiplied at a time
ENTRY = 2.0**52  # of 64 * c


@dataclasses.dataclass(frozen=True)
class Whitening:
    """What a fit has found: sums exactly, components as columns."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    variances: np.ndarray
    trace: float
    identity_error: float
    passes: int


def quantised(embeddings: DataFrame) -> DataFrame:
    """``vec_id`` and ``x`` of the rows that remain."""
    entries = F.col("embedding").cast("array<double>")
    usable = F.forall(entries, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < math.inf), F.lit(False)))

    def whole(c):
        large = F.raise_error(F.lit("an entry is too large to be a whole number times 64"))
        return F.when(F.abs(c) * 64 < ENTRY, F.floor(c * 64) + 1000000).otherwise(large.cast("long"))

    rows = embeddings.filter(F.coalesce(usable & (F.size(entries) > 0), F.lit(False)))
    return rows.select("vec_id", F.transform(entries, whole).alias("x"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """The lists of a column as rows of whole numbers."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def slices(batches: Iterator, place: int, width: int) -> Iterator:
    """``batch`` and its matrix, some rows at a time."""
    for batch in batches:
        for begin in range(0, batch.num_rows, SLICE):
            part = batch.slice(begin, SLICE)
            yield part, matrix(part.column(place), width)


class Centre:
    """Means of whole numbers, split in their whole and their broken part, so that centring loses no digit."""

    def __init__(self, n: int, sums: list[int]):
        import numpy as np

        self.whole = np.array([s // n for s in sums], np.int64)
        self.part = np.array([s % n for s in sums], np.int64)
        self.n = n

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole) - self.part / self.n

    def deviation(self, x: np.ndarray) -> np.ndarray:
        """Sum of (n * x - S) ** 2 of each row, exactly."""
        import numpy as np

        apart = x - self.whole
        most = float(np.abs(apart).max(initial=0)) * self.n + self.n
        if most**2 * x.shape[1] < 2.0**62:
            return ((apart * self.n - self.part) ** 2).sum(axis=1)
        exact = [sum((int(a) * self.n - int(p)) ** 2 for a, p in zip(row, self.part)) for row in apart]
        if max(exact) >= 2**63:
            raise OverflowError("a deviation does not fit in a long")
        return np.array(exact, np.int64)


def summed(fit: DataFrame, width: int, part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over the fit list of ``part``, which makes a matrix of a slice of it; tasks add up their own slices.

    Only sums of the size of one matrix leave a task, a row for each of its cells.
    """
    import numpy as np

    empty = part(np.empty((0, width), np.int64))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        total = np.zeros(empty.shape)
        for _, x in slices(batches, 0, width):
            total += part(x)
        cells = pa.array(range(total.size), pa.int32())
        yield pa.RecordBatch.from_arrays([cells, pa.array(total.ravel())], ["cell", "value"])

    found = fit.select("x").mapInArrow(run, "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value"))
    cells = found.toArrow()
    total = np.zeros(empty.size)
    total[cells["cell"].to_numpy()] = cells["value"].to_numpy()
    return total.reshape(empty.shape)


def subspace(fit: DataFrame, centre: Centre, n: int, width: int, components: int, guard: int):
    """Eigenvectors as columns, their eigenvalues by falling size, and the passes it took."""
    import numpy as np

    passes = 0

    def apply(block: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1

        def part(x):
            z = centre(x)
            return z.T @ (z @ block)

        return summed(fit, width, part) / n

    def apart(block: np.ndarray, locked: np.ndarray) -> np.ndarray:
        """An orthonormal basis of the block without the locked directions."""
        for _ in range(2):
            block = np.linalg.qr(block - locked @ (locked.T @ block))[0]
        return block

    def filtered(block: np.ndarray, top: float, cut: float) -> np.ndarray:
        """The Chebyshev polynomial of V that is within one on [0, cut], scaled to one at ``top``."""
        half = cut / 2
        degree = int(min(LONGEST, max(1, math.log(GROWTH) / math.acosh(max(top / half - 1, 1 + 1e-9)))))
        first = sigma = half / (top - half)
        before, block = block, (apply(block) - half * block) * (sigma / half)
        for _ in range(degree - 1):
            after = 1 / (2 / first - sigma)
            before, block = block, 2 * (apply(block) - half * block) * (after / half) - sigma * after * before
            sigma = after
        return block

    locked = np.empty((width, 0))
    block = apart(np.random.default_rng(0).standard_normal((width, min(width, components + guard))), locked)
    largest = 0.0
    for _ in range(MOST_ROUNDS):
        image = apply(block)
        values, turn = np.linalg.eigh((block.T @ image + image.T @ block) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        block, image = block @ turn, image @ turn
        largest = max(largest, float(values[0]))
        rest = np.linalg.norm(image - block * values, axis=0)
        done = 0  # only a leading run is locked, so that none is passed over
        while done < len(values) and locked.shape[1] + done < components and rest[done] <= CONVERGED * largest:
            done += 1
        locked, block, values = np.hstack([locked, block[:, :done]]), block[:, done:], values[done:]
        if locked.shape[1] == min(components, width):
            image = apply(locked)
            values_of, turn = np.linalg.eigh((locked.T @ image + image.T @ locked) / 2)
            values_of, turn = values_of[::-1], turn[:, ::-1]
            found = locked @ turn
            rest = np.linalg.norm(image @ turn - found * values_of, axis=0)
            above = bool(len(values)) and values[0] > values_of[-1] + CERTIFIED * largest
            if rest.max() <= CERTIFIED * largest and not above:
                return found, values_of, passes
            block, locked, values = np.hstack([found, block]), locked[:, :0], np.concatenate([values_of, values])
        top = float(values[0])
        cut = min(max(float(values[-1]), 1e-6 * top), 0.999 * top)
        if top > 0:
            block = filtered(block, top, cut)
        block = apart(block, locked)
    raise ArithmeticError(f"components were not certified after {passes} passes")


def fit_whitening(fit: DataFrame, components: int = COMPONENTS, guard: int = GUARD) -> Whitening | None:
    """Components of the fit list ``x``; none if it is empty or has no variance."""
    import numpy as np

    bounds = fit.agg(F.min(F.size("x")), F.max(F.size("x"))).first()
    if bounds[0] is None:
        return None
    if bounds[0] != bounds[1]:
        raise ValueError(f"vectors have {bounds[0]} to {bounds[1]} entries")
    width = bounds[0]
    entries = fit.select(F.posexplode("x").alias("place", "value")).groupBy("place")
    counted = sorted(entries.agg(F.count("value"), F.sum("value")).collect())
    n, sums = counted[0][1], [row[2] for row in counted]
    centre = Centre(n, sums)
    trace = float(summed(fit, width, lambda x: (centre(x) ** 2).sum(axis=0)[:, None]).sum() / n)
    if not trace > 0:
        return None
    vectors, variances, passes = subspace(fit, centre, n, width, components, guard)
    real = variances > NOTHING * variances[0]
    vectors, variances = vectors[:, real], variances[real]
    scaled = vectors / np.sqrt(variances)

    def products(x):
        white = centre(x) @ scaled
        return white.T @ white

    error = np.abs(summed(fit, width, products) / n - np.eye(len(variances))).max()
    return Whitening(n, sums, vectors, variances, trace, float(error), passes)


def whiten(embeddings: DataFrame, components: int = COMPONENTS, guard: int = GUARD) -> DataFrame:
    """A row for each vector that remains and each component, numbered from 1 by falling variance."""
    rows = quantised(embeddings)
    kind = embeddings.schema["vec_id"].dataType.simpleString()
    schema = (
        f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, "
        "identity_error double"
    )
    model = fit_whitening(materialise(rows.select("x").distinct()), components, guard)
    if model is None:
        return embeddings.sparkSession.createDataFrame([], schema)

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        centre, count = Centre(model.n, model.sums), len(model.variances)
        scaled = model.vectors / np.sqrt(model.variances)
        share = model.variances / model.trace
        for part, x in slices(batches, 1, len(model.sums)):
            size = len(x)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).take(pa.array(np.repeat(np.arange(size), count))),
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), size)),
                    pa.array(np.full(size * count, model.n)),
                    pa.array(np.repeat(centre.deviation(x), count)),
                    pa.array((centre(x) @ scaled).ravel()),
                    pa.array(np.tile(share, size)),
                    pa.array(np.full(size * count, model.identity_error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(run, schema)
