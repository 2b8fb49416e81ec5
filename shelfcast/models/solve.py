"""The solve of each series: the only Python that runs inside tasks.

Spark streams design rows in Arrow batches, series after series; a series has at most one row per
calendar day, and no more than one batch and one series are held at a time.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

# Ship these few functions with the task, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TOLERANCE = 1e-8  # of the fitted values, in units of the series' scale
SEARCH_TOLERANCE = 3e-4  # where fits only rank trials
MOST_ROUNDS = 2000  # a fit that takes more is reported as not settled
LEAD_IN = 20  # reweighted rounds before the first Newton step
TREND_PRIOR = 5.0
NOISE_PRIOR = 0.5
NOISE_FLOOR = 1e-4
BEND_FLOOR = 1e-3


class Fit(NamedTuple):
    """For each trial: coefficients, noise, whether it settled, and the largest slope left.

    The slope is that of the penalised objective in the coefficients, over the sum of the sizes of the
    parts that cancel in it: zero at the optimum, one where nothing cancels.
    """

    beta: np.ndarray
    noise: np.ndarray
    settled: np.ndarray
    slope: np.ndarray


def _objective(lost, size, beta, variance, fixed, bends, strength) -> np.ndarray:
    """Negative log posterior; the Laplace prior is rounded off within ``BEND_FLOOR`` of zero."""
    bent = np.abs(beta[:, bends])
    rounded = np.where(bent > BEND_FLOOR, bent - BEND_FLOOR / 2, bent**2 / (2 * BEND_FLOOR))
    smooth = (fixed * beta**2).sum(axis=1) / 2 + (strength * rounded).sum(axis=1)
    return lost / (2 * variance) + smooth + size * np.log(variance) / 2


def fit_settled(
    x: np.ndarray,
    y: np.ndarray,
    n_cp: int,
    n_season: int,
    priors: np.ndarray,
    holidays_prior: float,
    tolerance: float = TOLERANCE,
) -> Fit:
    """The most probable coefficients and noise for each row (changepoint, seasonality prior) of ``priors``.

    Normal priors on everything but the changepoints, which have a Laplace prior. A round improves the
    coefficients, by the better of a Newton step and a reweighted step (which never makes them worse),
    and then the noise. A trial is done when its fitted values stop moving; all trials share one Gram matrix.
    """
    trials, whole = len(priors), x.shape[1]
    # An event or flag that never occurs in training has a zero coefficient; leave it out of the solve.
    used = np.flatnonzero(x.any(axis=0))
    x = x[:, used]
    bends = np.flatnonzero((used >= 2) & (used < 2 + n_cp))
    fixed = np.full((trials, whole), holidays_prior**-2)
    fixed[:, :2] = TREND_PRIOR**-2
    fixed[:, 2 : 2 + n_cp] = 0.0
    fixed[:, 2 + n_cp : 2 + n_cp + n_season] = 1.0 / priors[:, 1:] ** 2
    fixed, strength = fixed[:, used], 1.0 / priors[:, :1]
    gram, moment, diagonal = x.T @ x, x.T @ y, np.arange(len(used))
    curve = NOISE_PRIOR**-2

    def lost(beta):
        return ((y[None] - beta @ x.T) ** 2).sum(axis=1)

    def solved(weight, linear, variance):
        system = np.repeat(gram[None], len(weight), axis=0)
        system[:, diagonal, diagonal] += (weight + 1e-10) * variance[:, None]
        return np.linalg.solve(system, (moment - linear * variance[:, None])[:, :, None])[:, :, 0]

    variance = np.full(trials, max(float(np.var(y)), NOISE_FLOOR**2))
    beta, fitted = np.zeros((trials, len(used))), np.zeros((trials, len(y)))
    active = np.arange(trials)
    for rounds in range(MOST_ROUNDS):
        now, noise, held, force = beta[active], variance[active], fixed[active], strength[active]
        bent = np.abs(now[:, bends])
        weight, straight = held.copy(), np.zeros(held.shape)
        weight[:, bends] = force / np.maximum(bent, BEND_FLOOR) if rounds else force**2
        new = solved(weight, straight, noise)
        if rounds >= LEAD_IN and len(bends):
            inside = bent <= BEND_FLOOR
            weight[:, bends] = np.where(inside, force / BEND_FLOOR, 0.0)
            straight[:, bends] = np.where(inside, 0.0, force * np.sign(now[:, bends]))
            step = solved(weight, straight, noise) - now
            parts = (held, bends, force)
            best = _objective(lost(new), len(y), new, noise, *parts)
            for length in (1.0, 0.25, 0.0625):
                tried = now + length * step
                value = _objective(lost(tried), len(y), tried, noise, *parts)
                new = np.where((value < best)[:, None], tried, new)
                best = np.minimum(value, best)
        beta[active] = new
        noise = (np.sqrt(len(y) ** 2 + 4 * curve * lost(new)) - len(y)) / (2 * curve)
        variance[active] = np.maximum(noise, NOISE_FLOOR**2)
        moved = np.abs(new @ x.T - fitted[active]).max(axis=1)
        fitted[active] = new @ x.T
        active = active[moved > tolerance]
        if not len(active):
            break
    pull = fixed * beta
    pull[:, bends] += strength * np.clip(beta[:, bends] / BEND_FLOOR, -1.0, 1.0)
    push = (y[None] - beta @ x.T) @ x / variance[:, None]
    size = np.abs(y[None] - beta @ x.T) @ np.abs(x) / variance[:, None] + np.abs(pull)
    slope = np.abs(pull - push) / np.maximum(size, 1e-9)
    every = np.zeros((trials, whole))
    every[:, used] = beta
    settled = ~np.isin(np.arange(trials), active)
    return Fit(every, np.sqrt(variance), settled, slope.max(axis=1, initial=0.0))


def fit_map(
    x: np.ndarray, y: np.ndarray, n_cp: int, n_season: int, priors: np.ndarray, holidays_prior: float
) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients and noise of ``fit_settled``."""
    return fit_settled(x, y, n_cp, n_season, priors, holidays_prior)[:2]


class Series(NamedTuple):
    """The design rows of one series: where they lie in their table, and as numpy arrays."""

    start: int
    stop: int
    x: np.ndarray
    y: np.ndarray
    train: np.ndarray
    head: dict[str, float]


def whole_tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Cut a stream of batches at series starts (``pos`` 0), so that no table splits a series.

    The rows of a series are adjacent, since they come straight out of one exploded array.
    """
    held: list[pa.Table] = []
    for batch in batches:
        table = pa.Table.from_batches([batch])
        starts = np.flatnonzero(table.column("pos").to_numpy() == 0)
        if not len(starts):
            held.append(table)
            continue
        done = pa.concat_tables([*held, table.slice(0, starts[-1])])
        held = [table.slice(starts[-1])]
        if done.num_rows:
            yield done.combine_chunks()
    if held and sum(t.num_rows for t in held):
        yield pa.concat_tables(held).combine_chunks()


def series_of(table: pa.Table, heads: Sequence[str]) -> Iterator[Series]:
    lists = table.column("x").chunk(0)
    offsets = lists.offsets.to_numpy()
    values = lists.values.to_numpy(zero_copy_only=False)
    y = table.column("y").to_numpy().astype(float)
    train = table.column("is_train").to_numpy().astype(bool)
    constant = {h: table.column(h).to_numpy() for h in heads}
    starts = np.flatnonzero(table.column("pos").to_numpy() == 0)
    for start, stop in zip(starts, [*starts[1:], table.num_rows]):
        x = values[offsets[start] : offsets[stop]].reshape(stop - start, -1)
        head = {h: v[start] for h, v in constant.items()}
        yield Series(start, stop, x, y[start:stop], train[start:stop], head)


def forecast_batches(
    holidays_prior: float, kept: Sequence[str]
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Add fitted values, the spread of their error, the noise and the mean bend to the rows of every series."""
    heads = ("y_scale", "n_cp", "n_season", "_cp_prior", "_season_prior")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_tables(batches):
            yhat, spread, error, bend = np.full((4, table.num_rows), np.nan)
            position = table.column("t").to_numpy()
            for s in series_of(table, heads):
                rows, known = slice(s.start, s.stop), s.y[s.train]
                if len(known) < 2:
                    yhat[rows] = known.mean() if len(known) else np.nan
                    continue
                scale, n_cp = s.head["y_scale"], int(s.head["n_cp"])
                priors = np.array([[s.head["_cp_prior"], s.head["_season_prior"]]])
                beta, noise = fit_map(
                    s.x[s.train], known / scale, n_cp, int(s.head["n_season"]), priors, holidays_prior
                )
                yhat[rows] = s.x @ beta[0] * scale
                # Trend bends keep coming at the historic rate and size after the last observation.
                ahead = np.maximum(position[rows] - 1.0, 0.0)
                size = np.abs(beta[0, 2 : 2 + n_cp]).mean() if n_cp else 0.0
                error[rows], bend[rows] = scale * noise[0], scale * size
                spread[rows] = scale * np.sqrt(noise[0] ** 2 + 2 * n_cp * size**2 * ahead**3 / 3)
            fitted = table.select(list(kept))
            for name, column in (("yhat", yhat), ("_spread", spread), ("_noise", error), ("_bend", bend)):
                fitted = fitted.append_column(name, pa.array(column, mask=np.isnan(column)))
            yield from fitted.to_batches()

    return run


def optimum_batches(
    holidays_prior: float, kept: Sequence[str]
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One row for every series that is fitted: whether its fit settled, and the slope left there."""
    heads = ("n_cp", "n_season", "y_scale", "_cp_prior", "_season_prior")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_tables(batches):
            rows, settled, slope = [], [], []
            for s in series_of(table, heads):
                known = s.y[s.train]
                if len(known) < 2:
                    continue
                priors = np.array([[s.head["_cp_prior"], s.head["_season_prior"]]])
                sizes = int(s.head["n_cp"]), int(s.head["n_season"])
                fit = fit_settled(
                    s.x[s.train], known / s.head["y_scale"], *sizes, priors, holidays_prior
                )
                rows.append(s.start)
                settled.append(bool(fit.settled[0]))
                slope.append(float(fit.slope[0]))
            if rows:
                found = table.select(list(kept)).take(rows)
                found = found.append_column("settled", pa.array(settled))
                yield from found.append_column("slope", pa.array(slope)).to_batches()

    return run


def test_batches(
    trials: Sequence[tuple[int, float, float]], holidays_prior: float, kept: Sequence[str]
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Predict the test rows of every series and fold once per trial."""
    numbers = np.array([t[0] for t in trials], dtype=np.int32)
    priors = np.array([t[1:] for t in trials], dtype=float)
    heads = ("y_scale", "n_cp", "n_season")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_tables(batches):
            rows, predicted = [], []
            for s in series_of(table, heads):
                scale = s.head["y_scale"]
                beta = fit_settled(
                    s.x[s.train],
                    s.y[s.train] / scale,
                    int(s.head["n_cp"]),
                    int(s.head["n_season"]),
                    priors,
                    holidays_prior,
                    SEARCH_TOLERANCE,
                ).beta
                rows.append(s.start + np.flatnonzero(~s.train))
                predicted.append(beta @ s.x[~s.train].T * scale)
            tested = np.concatenate(rows)
            yhat = np.concatenate(predicted, axis=1)
            repeated = table.select(list(kept)).take(np.tile(tested, len(numbers)))
            repeated = repeated.append_column("trial_id", pa.array(np.repeat(numbers, len(tested))))
            yield from repeated.append_column("yhat", pa.array(yhat.ravel())).to_batches()

    return run


def error_batches(
    trials: Sequence[tuple[int, float, float]], holidays_prior: float, kept: Sequence[str]
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sums of the errors of every series and fold, one row per trial instead of one per test row and trial.

    With a column ``_trials``, the numbers in the first row of a series say which trials it wants.
    """
    numbers = np.array([t[0] for t in trials], dtype=np.int32)
    priors = np.array([t[1:] for t in trials], dtype=float)
    heads = ("y_scale", "n_cp", "n_season")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_tables(batches):
            wanted = table.column("_trials") if "_trials" in table.column_names else None
            rows, found = [], []
            for s in series_of(table, heads):
                asked = slice(None)
                if wanted is not None:
                    asked = np.flatnonzero(np.isin(numbers, wanted[s.start].as_py()))
                scale = s.head["y_scale"]
                sizes = int(s.head["n_cp"]), int(s.head["n_season"])
                beta = fit_settled(
                    s.x[s.train], s.y[s.train] / scale, *sizes, priors[asked], holidays_prior, SEARCH_TOLERANCE
                ).beta
                tested = ~s.train & ~np.isnan(s.y)
                gap = s.y[tested] - beta @ s.x[tested].T * scale
                chosen = numbers[asked]
                rows.append(np.full(len(chosen), s.start))
                size = np.full(len(chosen), float(tested.sum()))
                found.append((chosen, size, (gap**2).sum(axis=1), np.abs(gap).sum(axis=1)))
            if not rows:
                continue
            repeated = table.select(list(kept)).take(np.concatenate(rows))
            for name, parts in zip(("trial_id", "n", "squares", "sizes"), zip(*found)):
                column = np.concatenate(parts)
                repeated = repeated.append_column(name, pa.array(column.astype(np.int64) if name == "n" else column))
            yield from repeated.to_batches()

    return run
