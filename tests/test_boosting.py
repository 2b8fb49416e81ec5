from __future__ import annotations

import datetime as dt
import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.models import boosting, tweedie

D = dt.date
KEYS = ("store", "business_unit")


def test_draws_are_distinct_points_of_the_space():
    cfg = tweedie.TweedieConfig()
    found = boosting.draws(cfg)
    assert found == boosting.draws(cfg) and len(set(found)) == 10
    space = len(boosting.RATES) * len(boosting.DEPTHS) * len(boosting.PENALTIES) * len(boosting.SHARES)
    assert space == 72


def brute_split(g, h, penalty, allowed, least):
    """The best of all splits of one node, from sums by feature and bin: the feature and the left bins."""

    def gain(x, y):
        return x * x / max(y + penalty, 1e-300)

    bins = g.shape[1]
    best = (1e-9, 0, (1 << bins) - 1)
    for feature in range(g.shape[0]):
        whole = gain(g[feature].sum(), h[feature].sum())
        for cut in range(bins):
            left, right = h[feature, : cut + 1].sum(), h[feature, cut + 1 :].sum()
            if allowed[feature] and left >= least and right >= least:
                value = gain(g[feature, : cut + 1].sum(), left) + gain(g[feature, cut + 1 :].sum(), right) - whole
                if value > best[0] * (1 + 1e-12) + 1e-12:
                    best = (value, feature, (1 << (cut + 1)) - 1)
    return best[1:]


def test_splits_equal_brute_force():
    pick = np.random.default_rng(4)
    g = pick.standard_normal((6, 3, 4, 8))
    h = pick.integers(0, 4, g.shape).astype(float)
    g[0, 0], h[0, 1] = 0.0, 0.0
    penalty = np.array([0.0, 1.0, 10.0, 0.0, 1.0, 5.0])
    allowed = pick.random((6, 4)) < 0.8
    feature, left = boosting.best_splits(g, h, penalty, allowed, [False] * 4, 2.0)
    for i, j in itertools.product(range(6), range(3)):
        assert (feature[i, j], left[i, j]) == brute_split(g[i, j], h[i, j], penalty[i], allowed[i], 2.0)


def test_unordered_splits_are_the_best_of_all_subsets():
    pick = np.random.default_rng(5)
    g, h = pick.standard_normal((20, 1, 1, 7)), pick.uniform(1, 3, (20, 1, 1, 7))
    feature, left = boosting.best_splits(g, h, np.zeros(20), np.ones((20, 1), bool), [True], 0.5)
    for i in range(20):
        a, b = g[i, 0, 0], h[i, 0, 0]

        def gain(mask):
            side = np.array([mask >> k & 1 for k in range(7)], bool)
            return sum(a[x].sum() ** 2 / b[x].sum() for x in (side, ~side))

        assert gain(int(left[i, 0])) == pytest.approx(max(map(gain, range(1, 127))))


@pytest.fixture(scope="module")
def cells(spark):
    pick = np.random.default_rng(8)
    rows = [
        (model, bool(pick.random() < 0.8), pick.integers(0, 5, 3).tolist(), float(pick.integers(0, 30)))
        for model in (0, 1)
        for _ in range(400)
    ]
    return rows, spark.createDataFrame(rows, "model int, train boolean, bins array<int>, y double")


def test_one_tree_equals_a_tree_grown_row_by_row(cells):
    """Base, splits and leaf values, each level's sums taken from the rows."""
    rows, frame = cells
    settings = [boosting.Draw(0.5, 2, 1.0, 1.0), boosting.Draw(0.3, 1, 0.0, 1.0)]
    forest = boosting.fit(boosting.cells(frame), settings, 1.1, rounds=1)
    for model, draw in enumerate(settings):
        mine = [(bins, y) for m, train, bins, y in rows if m == model and train]
        base = math.log(sum(y for _, y in mine) / len(mine))
        assert forest.base[model] == pytest.approx(base)
        low, high = math.exp(-0.1 * base), math.exp(0.9 * base)
        reached = {0: mine}
        splits, values = forest.trees[0]
        for level, (feature, left) in enumerate(splits[: draw.depth]):
            after = {}
            for place, held in reached.items():
                g, h = np.zeros((2, 3, boosting.BINS))
                for bins, y in held:
                    for f, b in enumerate(bins):
                        g[f, b] += high - y * low
                        h[f, b] += 0.9 * high + 0.1 * y * low
                want = brute_split(g, h, draw.penalty, [True] * 3, boosting.LEAST)
                assert (feature[model, place], left[model, place]) == want
                after[2 * place] = [x for x in held if want[1] >> x[0][want[0]] & 1]
                after[2 * place + 1] = [x for x in held if not want[1] >> x[0][want[0]] & 1]
            reached = after
        for place, held in reached.items():
            g = sum(high - y * low for _, y in held)
            h = sum(0.9 * high + 0.1 * y * low for _, y in held)
            leaf = place << (len(splits) - draw.depth)  # a shallower tree's rows go left below its leaves
            assert values[model, leaf] == pytest.approx(draw.rate * max(-2, min(2, -g / (h + draw.penalty))))


def test_grouped_cells_give_the_model_of_the_rows(cells):
    rows, frame = cells
    settings = [boosting.Draw(0.5, 2, 1.0, 1.0), boosting.Draw(0.3, 3, 10.0, 0.7)]
    whole = boosting.fit(boosting.cells(frame), settings, 1.1, rounds=6)
    single = frame.selectExpr("model", "train", "bins", "1D AS n", "y", "y * y AS y2")
    assert np.allclose(whole.trees[-1][1], boosting.fit(single, settings, 1.1, rounds=6).trees[-1][1])


def interacting(spark):
    """Sales whose season differs by product, which no sum of effects describes."""
    rows = []
    for s, p in itertools.product(range(6), range(4)):
        for k in range(84):
            day = D(2015 + k // 12, k % 12 + 1, 28)
            peak = 9 if day.month <= 6 and p < 2 else 1
            rows.append((f"s{s}", f"p{p}", day, (4 + 3 * s) * peak + (7 * k + s) % 3, int(day.month == 11)))
    frame = spark.createDataFrame(rows, "store string, business_unit string, ds date, y bigint, black_week int")
    return frame.withColumn("ds", F.last_day("ds"))


def test_boosting_beats_the_linear_model_where_features_interact(spark):
    series = interacting(spark)
    cfg = tweedie.TweedieConfig(train_end=D(2020, 12, 31), valid_from=D(2020, 11, 30), folds=2, draws=6)
    tagged = tweedie.tag_split(series, cfg.train_end, cfg.valid_from)
    train = tagged.filter("is_train").drop("is_train", "is_valid", "is_predict")
    boosted, linear = boosting.search(train, cfg), tweedie.search(train, cfg)
    assert len(boosted) == 6 and boosted == sorted(boosted, key=lambda x: x[0])
    assert boosted[0][0] < linear[0][0]
    trees = boosting.predicted(tagged, cfg, boosted[0][1], KEYS).filter("is_predict")
    wide, model, _ = tweedie._trained(tagged, cfg, KEYS, linear[0][1])
    ours, other = (boosting.deviance(x, cfg.power).first() for x in (trees, model.transform(wide.filter("is_predict"))))
    assert ours.n_scored == other.n_scored == 6 * 4 * 12
    assert ours.deviance < 0.7 * other.deviance


def test_the_search_scores_what_a_fit_of_each_fold_predicts(spark, monkeypatch):
    """Models grown side by side are the models grown alone."""
    series = interacting(spark)
    draw = boosting.Draw(0.3, 2, 1.0, 1.0)
    monkeypatch.setattr(boosting, "draws", lambda cfg: [draw])
    cfg = tweedie.TweedieConfig(train_end=D(2021, 12, 31), valid_from=D(2021, 11, 30), folds=2)
    rmse, _ = boosting.search(series, cfg, rounds=3)[0]
    lost, tested = 0.0, 0
    tagged = boosting.time_series_folds(series, cfg.folds, KEYS)
    for fold in range(cfg.folds):
        rows = tagged.filter(F.col("fold") == fold).withColumn("is_train", F.col("role") == "train")
        found = boosting.predicted(rows, cfg, draw, KEYS, rounds=3).filter("role = 'test'")
        part = found.agg(F.sum(F.pow(F.col("y") - F.col("y_prediction"), F.lit(2))), F.count("y")).first()
        lost, tested = lost + part[0], tested + part[1]
    assert rmse == pytest.approx(math.sqrt(lost / tested))


def test_no_sales_at_all(spark):
    series = interacting(spark).withColumn("y", F.lit(0).cast("long"))
    cfg = tweedie.TweedieConfig(train_end=D(2020, 12, 31), valid_from=D(2020, 11, 30), folds=2, draws=2)
    got = boosting.boosted_forecast(series, cfg, draw=boosting.Draw(0.3, 2, 1.0, 1.0)).collect()
    assert len(got) == 6 * 4 * 12 and all(0 <= r.y_prediction < 1e-6 for r in got)


def test_a_draw_that_does_not_settle_comes_last(spark, monkeypatch):
    cfg = tweedie.TweedieConfig(train_end=D(2021, 12, 31), valid_from=D(2021, 11, 30), folds=2, draws=3)
    fit, bad = tweedie._fit, tweedie.draws(cfg)[0]

    def failing(train, cfg, ridge):
        if ridge == bad:
            raise tweedie.NotSettled("no")
        return fit(train, cfg, ridge)

    monkeypatch.setattr(tweedie, "_fit", failing)
    found = tweedie.search(interacting(spark), cfg)
    assert found[-1] == (math.inf, bad) and all(math.isfinite(r) for r, _ in found[:-1])


def test_fits_settle_at_high_levels(spark):
    """Sums of many large values, whose rounding is above a tolerance of 1e-10."""
    rows = [
        (f"s{i % 40}", f"p{i % 23}", D(2015 + k // 12, k % 12 + 1, 28), 90 + (i * 7 + k * 13) % 150, int(k % 12 == 10))
        for i in range(300)
        for k in range(36)
    ]
    series = spark.createDataFrame(rows, "store string, business_unit string, ds date, y bigint, black_week int")
    cfg = tweedie.TweedieConfig(train_end=D(2017, 12, 31), valid_from=D(2017, 11, 30))
    tagged = tweedie.tag_split(series, cfg.train_end, cfg.valid_from)
    for ridge in tweedie.RIDGE[::3]:
        assert tweedie._trained(tagged, cfg, KEYS, ridge)[1].summary.numIterations < 20


def test_fits_settle_where_sales_are_many_and_levels_alike(spark):
    """Months of a large table: levels far from zero beside their spread, nearly copies of the intercept."""
    rows = [
        (
            f"s{i % 40}",
            f"p{i % 23}",
            D(2015 + k // 12, k % 12 + 1, 28),
            1_000_000 + 60 * (i % 40) + 50 * (i % 23) + (i * 7919 + k * 104729) % 20_011 + 30_000 * (k % 12 == 10),
            int(k % 12 == 10),
        )
        for i in range(300)
        for k in range(36)
    ]
    series = spark.createDataFrame(rows, "store string, business_unit string, ds date, y bigint, black_week int")
    cfg = tweedie.TweedieConfig(train_end=D(2017, 12, 31), valid_from=D(2017, 11, 30))
    found = {r["parameter"]: r["score"] for r in tweedie.optimum(series, cfg, tweedie.RIDGE[0]).collect()}
    assert {"intercept", "store_level", "business_unit_level", "black_week", "year_centred"} < set(found)
    assert max(map(abs, found.values())) < 1e-9

    wide, model, names = tweedie._trained(
        tweedie.tag_split(series, cfg.train_end, cfg.valid_from), cfg, KEYS, tweedie.RIDGE[0]
    )
    got = model.transform(wide.filter("is_train")).select("y", "y_prediction", *names).toPandas()
    x, y = got[names].to_numpy(), got["y"].to_numpy()
    center = x.mean(axis=0)
    design = np.column_stack([np.ones(len(x)), x - center])
    penalty = np.diag([0.0] + [tweedie.RIDGE[0]] * len(names))
    beta = np.r_[np.log(y.mean()), np.zeros(len(names))]
    for _ in range(20):  # reweighted least squares by hand
        mu = np.exp(design @ beta)
        weight = mu ** (2 - cfg.power)
        work = design @ beta + (y - mu) / mu
        squares = design.T @ (design * weight[:, None]) / weight.sum()
        beta = np.linalg.solve(squares + penalty, design.T @ (weight * work) / weight.sum())
    assert got["y_prediction"].to_numpy() == pytest.approx(np.exp(design @ beta), rel=1e-9)


def test_unknown_keys_have_the_level_of_the_whole(spark):
    rows = [("a", "p", D(2020, 1, 31), 4, 0), ("b", "p", D(2020, 1, 31), 8, 0), ("new", None, D(2020, 2, 29), 0, 0)]
    df = spark.createDataFrame(rows, "store string, business_unit string, ds date, y bigint, black_week int")
    wide, _ = tweedie.features(df, df.filter("ds < '2020-02-01'"), tweedie.TweedieConfig())
    got = {r["store"]: (r["store_level"], r["business_unit_level"]) for r in wide.collect()}
    assert got["a"] == pytest.approx((np.log(5 / 7), 0.0)) and got["b"] == pytest.approx((np.log(9 / 7), 0.0))
    assert got["new"] == (0.0, 0.0)
    wide, _ = tweedie.features(df, df.filter("false"), tweedie.TweedieConfig())
    assert all(r["store_level"] == r["business_unit_level"] == 0.0 for r in wide.collect())
