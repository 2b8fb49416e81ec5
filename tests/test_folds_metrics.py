from __future__ import annotations

import datetime as dt
import math

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from shelfcast.functions import metrics
from shelfcast.models.tweedie import tag_split
from shelfcast.operators import folds

D = dt.date
SERIES = "store string, business_unit string, ds date, y double"


def days(n, store="s"):
    return [(store, "p", D(2021, 1, 1) + dt.timedelta(days=i), float(i)) for i in range(n)]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.integers(1, 40), st.integers(2, 6))
def test_expanding_folds_by_brute_force(spark, rows, n):
    df = spark.createDataFrame(days(rows), SERIES)
    size = rows // (n + 1)
    want = set()
    for fold in range(n):
        start = rows - (n - fold) * size
        if size:
            want |= {(fold, "train", float(i)) for i in range(start)}
            want |= {(fold, "test", float(i)) for i in range(start, start + size)}
    got = folds.time_series_folds(df, n).collect()
    assert {(r["fold"], r["role"], r["y"]) for r in got} == want and len(got) == len(want)


def test_rolling_folds_never_see_the_future(spark):
    df = spark.createDataFrame(days(100), SERIES)
    cutoffs = [D(2021, 2, 1), D(2021, 3, 1)]
    tagged = folds.rolling_origin_folds(df, cutoffs, 30).collect()
    for cutoff in cutoffs:
        train = [r["ds"] for r in tagged if r["cutoff"] == cutoff and r["role"] == "train"]
        test = [r["ds"] for r in tagged if r["cutoff"] == cutoff and r["role"] == "test"]
        assert max(train) == cutoff and min(test) == cutoff + dt.timedelta(days=1) and len(test) == 30


def test_incomplete_horizons(spark):
    df = spark.createDataFrame(days(60), SERIES)
    cutoffs = [D(2021, 1, 15), D(2021, 2, 20)]
    kept = folds.rolling_origin_folds(df, cutoffs, 30)
    skipped = folds.rolling_origin_folds(df, cutoffs, 30, incomplete="skip")
    assert {r["cutoff"] for r in kept.collect()} == set(cutoffs)
    assert {r["cutoff"] for r in skipped.collect()} == {cutoffs[0]} and "_last" not in skipped.columns
    with pytest.raises(ValueError):
        folds.rolling_origin_folds(df, cutoffs, 30, incomplete="error")


def test_rounding(spark):
    values = [1.8, 1.81, -0.5, -0.1, 2.0, None, float("nan")]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, yhat double")
    got = [r["yhat"] for r in metrics.round_up_above(df, ["yhat"]).orderBy("i").collect()]
    assert got == [1, 2, -1, 0, 2, None, None]


def test_clip_keeps_null_and_nan(spark):
    df = spark.createDataFrame([(0, -1.0), (1, float("nan")), (2, None), (3, 2.0)], "i int, yhat double")
    once = metrics.clip_negative(df, ["yhat"])
    got = [r["yhat"] for r in once.orderBy("i").collect()]
    assert got[0] == 0.0 and math.isnan(got[1]) and got[2] is None and got[3] == 2.0
    twice = [r["yhat"] for r in metrics.clip_negative(once, ["yhat"]).orderBy("i").collect()]
    assert twice[0] == got[0] and twice[2:] == got[2:]


def test_score_ignores_placeholders_and_zero_range(spark):
    rows = [("a", 4.0, 0.0, False), ("a", 4.0, 4.0, False), ("a", 0.0, 99.0, True), ("b", 1.0, 0.0, False), ("b", 3.0, 3.0, False)]
    df = spark.createDataFrame(rows, "store string, y double, yhat double, is_future boolean")
    got = {r["store"]: r for r in metrics.score(df, ["store"]).collect()}
    assert got["a"]["n_scored"] == 2 and got["a"]["root_mae"] == pytest.approx(2**0.5)
    assert got["a"]["normalised"] is None and got["a"]["rmse"] == pytest.approx(8**0.5)
    assert got["b"]["normalised"] == pytest.approx(0.5**0.5 / 2)


def test_first_trial_wins_a_tie(spark):
    rows = [("s", "p", 2, 1.0), ("s", "p", 1, 1.0), ("s", "p", 0, 3.0), ("s", "p", 3, None), ("s", "p", 4, float("nan"))]
    df = spark.createDataFrame(rows, "store string, business_unit string, trial_id int, rmse double")
    assert [(r["trial_id"], r["rmse"]) for r in metrics.best_trial(df).collect()] == [(1, 1.0)]


def test_split_masks_overlap(spark):
    df = spark.createDataFrame([(D(2021, 11, 30),), (D(2021, 12, 31),), (D(2022, 1, 31),)], "ds date")
    got = [(r["is_train"], r["is_valid"], r["is_predict"]) for r in tag_split(df).orderBy("ds").collect()]
    assert got == [(True, False, False), (True, True, False), (False, False, True)]


def test_cv_metrics(spark):
    df = spark.createDataFrame([("s", "p", 0, 1.0, 4.0), ("s", "p", 0, 2.0, 2.0)], "store string, business_unit string, trial_id int, y double, yhat double")
    row = metrics.cv_metrics(df).first()
    assert (row["rmse"], row["mae"], row["n_scored"]) == (pytest.approx(4.5**0.5), 1.5, 2)
