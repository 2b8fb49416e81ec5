from __future__ import annotations

import calendar as months
import dataclasses
import datetime as dt
import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfcast.models import additive, design, search, solve, tweedie
from shelfcast.models.design import ForecastConfig

D = dt.date
SCHEMA = "store string, business_unit string, ds date, y double, black_week int, christmas int"
TRAIN_END = D(2021, 12, 31)
CFG = ForecastConfig(train_end=TRAIN_END)


def month_end(i):
    year, month = 2017 + i // 12, i % 12 + 1
    return D(year, month, months.monthrange(year, month)[1])


def rows(store, n=61, product="p", level=lambda i, d: 50 + i):
    return [
        (store, product, d, float(level(i, d)), int(d.month == 11), int(d.month == 12))
        for i, d in enumerate(map(month_end, range(n)))
    ]


def wave(i, d):
    return 100 + 2 * i + 20 * math.sin(2 * math.pi * (d - D(1970, 1, 1)).days / 365.25) + 15 * (d.month == 11)


@pytest.fixture(scope="module")
def series(spark):
    data = rows("line") + rows("wave", level=wave) + rows("flat", level=lambda i, d: 7)
    data += rows("A_B", n=13) + rows("one", n=1) + rows("zero", level=lambda i, d: 0)
    data += [("new", "p", D(2022, 1, 31), 0.0, 0, 0)]
    return spark.createDataFrame(data, SCHEMA)


@pytest.fixture(scope="module")
def fitted(series):
    return additive.forecast(series, CFG, run_date=D(2022, 1, 5)).collect()


def of(fitted, store):
    return sorted((r for r in fitted if r["store"] == store), key=lambda r: r["ds"])


def test_one_row_per_series_and_date(fitted):
    keys = [(r["store"], r["business_unit"], r["ds"]) for r in fitted]
    assert len(keys) == len(set(keys))
    assert [len(of(fitted, s)) for s in ("line", "A_B", "one", "new")] == [61, 14, 2, 1]
    assert {r["training_date"] for r in fitted} == {D(2022, 1, 5)}


def test_bounds_enclose_the_forecast(fitted):
    for r in fitted:
        if r["yhat_lower"] is not None:
            assert 0 <= r["yhat_lower"] <= r["yhat"] <= r["yhat_upper"]


def test_line_and_wave_are_recovered(fitted):
    for store, level in (("line", lambda i, d: 50 + i), ("wave", wave)):
        got = of(fitted, store)
        for i, r in enumerate(got[:-1]):
            assert r["yhat"] == pytest.approx(level(i, month_end(i)), abs=2.5), (store, r["ds"])
        assert got[-1]["ds"] == D(2022, 1, 31) and got[-1]["y"] == level(60, month_end(60))
        assert got[-1]["yhat"] == pytest.approx(level(60, month_end(60)), abs=5)


def test_short_series(fitted):
    assert [(r["yhat"], r["yhat_upper"]) for r in of(fitted, "one")] == [(50.0, None)] * 2
    assert [(r["ds"], r["yhat"]) for r in of(fitted, "new")] == [(D(2022, 1, 31), None)]
    assert all(abs(r["yhat"]) < 1e-6 for r in of(fitted, "zero"))
    assert all(abs(r["yhat"] - 7) < 0.1 for r in of(fitted, "flat"))


def test_placeholder_future_is_not_an_actual(spark):
    data = [(*r, r[2] > TRAIN_END) for r in rows("line")]
    df = spark.createDataFrame(data, SCHEMA + ", is_future boolean")
    last = additive.forecast(df, CFG).orderBy(F.desc("ds")).first()
    assert last["ds"] == D(2022, 1, 31) and last["y"] is None and last["yhat"] > 0


def test_repeated_dates_are_one_observation(spark):
    halves = [(s, p, d, y / 2, b, c) for s, p, d, y, b, c in rows("line")]
    twice = additive.forecast(spark.createDataFrame(halves * 2, SCHEMA), CFG)
    once = additive.forecast(spark.createDataFrame(rows("line"), SCHEMA), CFG)
    assert [tuple(r) for r in twice.orderBy("ds").collect()] == [tuple(r) for r in once.orderBy("ds").collect()]


def test_result_does_not_depend_on_partitions(spark, series):
    few = additive.forecast(series, dataclasses.replace(CFG, tasks=1), run_date=TRAIN_END)
    many = additive.forecast(series.repartition(7), dataclasses.replace(CFG, tasks=13), run_date=TRAIN_END)
    order = ["store", "ds"]
    assert [tuple(r) for r in few.orderBy(*order).collect()] == [tuple(r) for r in many.orderBy(*order).collect()]


@pytest.mark.parametrize("size", [1, 2, 5, 100])
def test_batches_are_cut_at_series_starts(size):
    pos = [0, 1, 2, 0, 0, 1, 2, 3, 4, 5, 0, 1]
    table = pa.table({"pos": pa.array(pos, pa.int32()), "v": list(range(len(pos)))})
    got = list(solve.whole_tables(iter(table.to_batches(max_chunksize=size))))
    assert [v for t in got for v in t["v"].to_pylist()] == list(range(len(pos)))
    assert all(t["pos"][0].as_py() == 0 for t in got)


def test_no_batches_no_tables():
    empty = pa.record_batch({"pos": pa.array([], pa.int32())})
    assert list(solve.whole_tables(iter([]))) == [] == list(solve.whole_tables(iter([empty])))


def test_fit_with_more_columns_than_rows():
    x = np.column_stack([np.ones(5), np.arange(5), np.random.default_rng(1).normal(size=(5, 20))])
    beta, noise = solve.fit_map(x, np.arange(5.0), 0, 20, np.array([[0.05, 10.0], [0.5, 0.1]]), 10.0)
    assert beta.shape == (2, 22) and np.isfinite(beta).all() and (noise > 0).all()


def test_small_changepoint_prior_bends_less():
    t = np.linspace(0, 1, 60)
    cps = np.linspace(0.05, 0.75, 10)
    x = np.column_stack([np.ones(60), t, np.maximum(t[:, None] - cps, 0)])
    y = np.where(t < 0.5, t, 1 - t)
    beta, _ = solve.fit_map(x, y, 10, 0, np.array([[0.001, 1.0], [0.5, 1.0]]), 10.0)
    bends = np.abs(beta[:, 2:]).sum(axis=1)
    assert bends[0] < bends[1]


def test_normal_stats_are_the_gram_matrix(spark, series):
    cfg = dataclasses.replace(CFG, changepoints=2, yearly_order=1)
    frame = design.design_matrix(design.with_future(design.series_rows(series, cfg), cfg), cfg)
    points = frame.filter("store = 'wave' AND is_train").collect()
    z = np.array([[*r["x"], r["y"]] for r in points])
    gram = z.T @ z
    got = design.normal_stats(frame).filter("store = 'wave'").collect()
    assert len(got) == z.shape[1] * (z.shape[1] + 1) // 2
    for r in got:
        assert r["total"] == pytest.approx(gram[r["i"], r["j"]], rel=1e-9, abs=1e-9) and r["n"] == 60


def test_regressors_are_standardised_unless_binary(spark):
    data = [(s, p, d, y, b * 2 if d.year == 2019 else b, c) for s, p, d, y, b, c in rows("line")]
    cfg = dataclasses.replace(CFG, events=(), country_holidays=False, yearly_order=0, changepoints=0)
    df = spark.createDataFrame(data, SCHEMA)
    frame = design.design_matrix(design.with_future(design.series_rows(df, cfg), cfg), cfg)
    x = np.array([r["x"] for r in frame.filter("is_train").orderBy("ds").collect()])
    assert x.shape[1] == 4 and set(x[:, 3]) == {0.0, 1.0}
    assert x[:, 2].mean() == pytest.approx(0, abs=1e-12) and x[:, 2].std(ddof=1) == pytest.approx(1)


def test_folds_hold_only_real_observations(spark):
    data = [(*r, r[2] > D(2021, 10, 31)) for r in rows("line")]
    df = spark.createDataFrame(data, SCHEMA + ", is_future boolean")
    got = additive.cross_validate(df, CFG, [(0, 0.05, 10.0)], [D(2021, 6, 1), D(2021, 10, 1), D(2021, 11, 1)], 60)
    assert {(r["cutoff"], r["ds"]) for r in got.collect()} == {
        (D(2021, 6, 1), D(2021, 6, 30)), (D(2021, 6, 1), D(2021, 7, 31)), (D(2021, 10, 1), D(2021, 10, 31)),
    }


def test_search_picks_the_smallest_error_and_refits(spark, series):
    trials = [(0, 0.001, 0.01), (1, 0.05, 10.0)]
    cutoffs = [D(2020, 6, 1), D(2020, 12, 1)]
    best, refit = search.search_and_forecast(series, CFG, trials, cutoffs, 60)
    chosen = {r["store"]: r for r in best.collect()}
    assert chosen["wave"]["trial_id"] == 1 and chosen["wave"]["seasonality_prior"] == 10.0
    assert set(chosen) == {"line", "wave", "flat", "zero"}
    assert {r["store"] for r in refit.select("store").distinct().collect()} == {
        "line", "wave", "flat", "A_B", "one", "zero", "new",
    }
    preds = additive.cross_validate(series, CFG, trials, cutoffs, 60).filter("store = 'wave'").collect()
    for trial in (0, 1):
        errors = [(r["y"] - r["yhat"]) ** 2 for r in preds if r["trial_id"] == trial]
        assert len(errors) == 3  # two month ends within 60 days of June, one of December
        if trial == 1:
            assert chosen["wave"]["rmse"] == pytest.approx(np.sqrt(np.mean(errors)))


CUTOFFS = [D(2020, 3, 1), D(2020, 9, 1), D(2021, 3, 1), D(2021, 9, 1)]


def noisy(spark):
    pick = np.random.default_rng(11)
    data = rows("season", level=lambda i, d: round(wave(i, d) + 4 * pick.normal()))
    data += rows("bent", level=lambda i, d: round(60 + 2 * abs(i - 30) + 3 * pick.normal()))
    data += rows("noise", level=lambda i, d: int(pick.integers(0, 90))) + rows("flat", level=lambda i, d: 7)
    data += rows("short", n=45, level=lambda i, d: 10 + i % 5) + rows("one", n=1)
    return spark.createDataFrame(data, SCHEMA)


def test_summed_errors_are_those_of_the_predictions(spark):
    df, trials = noisy(spark), search.random_trials(5, seed=2)
    points = additive.cross_validate(df, CFG, trials, CUTOFFS, 60)
    gap = F.col("y") - F.col("yhat")
    want = points.groupBy("store", "cutoff", "trial_id").agg(
        F.count("*").alias("n"), F.sum(gap * gap).alias("squares"), F.sum(F.abs(gap)).alias("sizes")
    )
    got = additive.fold_errors(design.series_rows(df, CFG), CFG, trials, CUTOFFS, 60)
    got = {(r["store"], r["cutoff"], r["trial_id"]): r for r in got.collect()}
    want = want.collect()
    assert len(want) == len(got) == 5 * (4 * 4 + 2)
    for r in want:
        found = got[r["store"], r["cutoff"], r["trial_id"]]
        assert (found["n"], found["squares"], found["sizes"]) == pytest.approx((r["n"], r["squares"], r["sizes"]))


def by_hand(errors, complete):
    """Winner and number of fits of halving, from the squares of every trial (rows) on every fold (columns)."""
    alive, done = list(range(len(errors))), np.zeros(errors.shape, bool)
    for rung in range(errors.shape[1]):
        done[alive, rung] = True
        if rung < errors.shape[1] - 1:
            alive.sort(key=lambda t: (errors[t, : rung + 1].sum(), t))
            alive = alive[: math.ceil(len(alive) / 2)]
    for rung in range(1, errors.shape[1] if complete else 0):
        bound = min(errors[t].sum() for t in range(len(errors)) if done[t].all())
        for t in range(len(errors)):
            if not done[t].all() and (errors[t] * done[t]).sum() <= bound:
                done[t, rung] = True
    whole = [t for t in range(len(errors)) if done[t].all()]
    return min(whole, key=lambda t: (errors[t].sum(), t)), done.sum()


def test_halving_drops_and_revives_as_stated(spark):
    # The errors of a flat series are rounding, so its order of trials means nothing.
    df, trials = noisy(spark).filter("store NOT IN ('flat', 'one')"), search.random_trials(24, seed=5)
    every = additive.fold_errors(design.series_rows(df, CFG), CFG, trials, CUTOFFS, 120).collect()
    found = {}
    for complete in (True, False):
        found[complete] = {r["store"]: r for r in search.halving(df, CFG, trials, CUTOFFS, 120, complete=complete).collect()}
    for store in ("season", "bent", "noise", "short"):
        folds = sorted({r["cutoff"] for r in every if r["store"] == store}, reverse=True)
        errors = np.zeros((24, len(folds)))
        for r in every:
            if r["store"] == store:
                errors[r["trial_id"], folds.index(r["cutoff"])] = r["squares"]
        assert found[True][store]["trial_id"] == errors.sum(axis=1).argmin()
        # A series that lacks the latest folds starts at its own first one, with the trials halved from there on.
        if len(folds) == len(CUTOFFS):
            for complete, rows_ in found.items():
                assert (rows_[store]["trial_id"], rows_[store]["n_fits"]) == by_hand(errors, complete)
    assert found[False]["season"]["n_fits"] == 24 + 12 + 6 + 3 < 24 * 4 / 2
    print({c: {s: r["n_fits"] for s, r in f.items()} for c, f in found.items()})


def test_halving_revives_a_trial_dropped_too_early(spark):
    df, trials = noisy(spark).filter("store = 'noise'"), search.random_trials(24, seed=9)
    want = search.search(df, CFG, trials, CUTOFFS, 60).first()
    got = search.halving(df, CFG, trials, CUTOFFS, 60, keep=0.05).first()
    assert got["trial_id"] == want["trial_id"] and got["n_fits"] > 24 + 2 + 1 + 1
    with pytest.raises(ValueError):
        search.halving(df, CFG, trials, CUTOFFS, 60, keep=0)


def test_trial_lists():
    grid = search.grid_trials()
    assert len(grid) == 16 and grid[0] == (0, 0.001, 0.01) and grid[-1] == (15, 0.5, 10.0)
    drawn = search.random_trials(20, seed=3)
    assert drawn == search.random_trials(20, seed=3) != search.random_trials(20, seed=4)
    assert all(0.001 <= c <= 0.5 and 0.01 <= s <= 10 for _, c, s in drawn)


def test_tweedie_learns_levels_and_season(spark):
    data = []
    for k, base in enumerate((5, 20, 80)):
        data += rows(f"s{k}", level=lambda i, d, b=base: b * (3 if d.month == 12 else 1))
    df = spark.createDataFrame(data, SCHEMA)
    cfg = tweedie.TweedieConfig(train_end=D(2021, 6, 30), valid_from=D(2021, 5, 31), folds=2, draws=2)
    got = tweedie.tweedie_forecast(df, cfg, ridge=1e-6, run_date=D(2022, 1, 1)).collect()
    assert len(got) == 3 * 7
    assert {r["training_date"] for r in got} == {D(2022, 1, 1)}
    for r in got:
        assert r["y_prediction"] == pytest.approx(r["y"], rel=0.35)
    searched = tweedie.search(df.filter("ds <= '2021-06-30'"), cfg)
    assert len(searched) == 2 and searched[0][0] <= searched[1][0]
    assert tweedie.validation_score(df, cfg, 1e-6).first()["n_scored"] == 3


def test_tweedie_draws_are_distinct_and_repeatable():
    cfg = tweedie.TweedieConfig()
    assert len(set(tweedie.draws(cfg))) == 10 and tweedie.draws(cfg) == tweedie.draws(cfg)


def test_tweedie_keeps_independent_features(spark):
    data = [(float(i), 2.0 * i + 1, float(i % 3), 7.0, float(i % 3 + 2 * i)) for i in range(50)]
    df = spark.createDataFrame(data, "a double, b double, c double, d double, e double")
    assert tweedie.independent(df, ["a", "b", "c", "d", "e"]) == ["a", "c"]
    assert tweedie.independent(df.limit(0), ["a", "b"]) == []


def test_fits_settle_at_the_optimum():
    pick = np.random.default_rng(4)
    at = np.linspace(0, 1, 62)
    hinges = [np.maximum(at - c, 0) for c in np.linspace(0, 0.8, 27)[1:-1]]
    waves = [f(10 * np.pi * j * at) for j in range(1, 11) for f in (np.sin, np.cos)]
    x = np.column_stack([np.ones(62), at, *hinges, *waves])
    priors = np.array([[a, b] for a in (0.001, 0.05, 0.5) for b in (0.01, 10.0)])
    for _ in range(5):
        y = np.abs(pick.normal(0.4, 0.2, 62) + np.where(at > 0.5, at, 0))
        fit = solve.fit_settled(x, y / y.max(), 25, 20, priors, 10.0)
        assert fit.settled.all() and fit.slope.max() < 1e-4
        best = fit.beta @ x.T
        for _ in range(20):  # nothing near is better
            other = fit.beta + pick.normal(0, 1e-3, fit.beta.shape)
            assert (penalised(x, y / y.max(), other, fit.noise, priors) >= penalised(x, y / y.max(), fit.beta, fit.noise, priors) - 1e-9).all()
        assert np.isfinite(best).all()


def penalised(x, y, beta, noise, priors):
    lost = ((y - beta @ x.T) ** 2).sum(axis=1) / (2 * noise**2)
    bent = np.abs(beta[:, 2:27])
    round_off = np.where(bent > solve.BEND_FLOOR, bent - solve.BEND_FLOOR / 2, bent**2 / (2 * solve.BEND_FLOOR))
    normal = (beta[:, :2] ** 2).sum(axis=1) / (2 * solve.TREND_PRIOR**2)
    return lost + normal + (round_off / priors[:, :1]).sum(axis=1) + ((beta[:, 27:] / priors[:, 1:]) ** 2).sum(axis=1) / 2


def test_placeholders_before_the_train_end_do_not_train(spark):
    data = [(*r, False) for r in rows("s", n=40)] + [("s", "p", month_end(40), 0.0, 0, 0, True)]
    cfg = dataclasses.replace(CFG, train_end=month_end(40))
    got = additive.forecast(spark.createDataFrame(data, SCHEMA + ", is_future boolean"), cfg)
    last = got.filter(F.col("ds") == F.lit(month_end(40))).collect()
    assert got.agg({"ds": "max"}).first()[0] == month_end(41)
    assert len(last) == 1 and not last[0]["is_train"] and last[0]["yhat"] == pytest.approx(90, rel=0.1)


def test_daily_series_with_weekly_season(spark):
    def level(i):
        return 20.0 + 5 * (i % 7 == 5)

    data = [("s", "p", D(2021, 1, 1) + dt.timedelta(days=i), level(i), 0, 0) for i in range(120)]
    cfg = dataclasses.replace(CFG, freq="D", periods=7, weekly_order=3, train_end=D(2021, 4, 30))
    got = additive.forecast(spark.createDataFrame(data, SCHEMA), cfg).orderBy("ds").collect()
    assert len(got) == 127 and got[-1]["ds"] == D(2021, 5, 7)
    for i, r in enumerate(got):
        assert r["yhat"] == pytest.approx(level(i), abs=1.0)


def test_grouped_function_sees_whole_series(spark, series):
    def count(key, pdf):
        return pdf.iloc[:1].assign(n=len(pdf))[["store", "n"]]

    got = additive.apply_per_series(series, count, "store string, n long").collect()
    assert {r["store"]: r["n"] for r in got}["line"] == 61
