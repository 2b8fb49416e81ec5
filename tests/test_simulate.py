"""Simulated intervals against plain Python, on any partitioning, and on months held out."""

from __future__ import annotations

import calendar
import datetime as dt
import hashlib
import math
import random
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.models import additive, simulate
from shelfcast.models.design import ForecastConfig

D = dt.date
SCHEMA = "store string, business_unit string, ds date, t double, yhat double, noise double, bend double, rate double"


def steps_of(count: int = 4, ahead: int = 5) -> list[tuple]:
    pick = random.Random(3)
    rows = []
    for s in range(count):
        store = None if s == 0 else f"s{s}"
        t = 1.0
        for i in range(ahead):
            t += pick.choice([0.0, 0.02, 0.1])
            rows.append((store, "p", D(2022, 1, 1 + i), t, 10.0 * s + i, 0.5 * s, 4.0 * s, 25.0))
    return rows


def plain(rows: list[tuple], draws: int) -> dict:
    """Every draw's path, step after step."""
    out: dict = {}
    for store, unit in {r[:2] for r in rows}:
        path = sorted(r for r in rows if r[:2] == (store, unit))
        for draw in range(1, draws + 1):
            last, bends = 1.0, []
            for _, _, ds, t, yhat, noise, bend, rate in path:
                digest = hashlib.md5(f"{store or ''}|{unit}|{draw}|{ds}".encode()).hexdigest()
                u = [(int(digest[6 * i : 6 * i + 6], 16) + 0.5) / 16**6 for i in range(5)]
                gap, last = t - last, t
                likely = 1 - math.exp(-rate * gap)
                if u[0] < likely:
                    size = -math.copysign(1, u[1] - 0.5) * math.log(1 - 2 * abs(u[1] - 0.5))
                    bends.append((bend * math.sqrt(rate * gap / likely) * size, t - (1 - u[2]) * gap))
                error = noise * math.sqrt(-2 * math.log(u[3])) * math.cos(2 * math.pi * u[4])
                out[store, ds, draw] = yhat + sum(a * (t - at) for a, at in bends) + error
    return out


def test_paths_equal_plain_python(spark):
    rows = steps_of()
    frame = spark.createDataFrame(rows, SCHEMA)
    got = {(r.store, r.ds, r.draw): r.value for r in simulate.simulate(frame, draws=40).collect()}
    want = plain(rows, 40)
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)
    found = simulate.simulated_interval(frame, draws=40, width=0.9).collect()
    for r in found:
        values = [want[r.store, r.ds, d] for d in range(1, 41)]
        assert (r.lower, r.upper) == pytest.approx(tuple(np.quantile(values, [0.05, 0.95])), abs=1e-9)
    assert simulate.simulated_interval(frame.limit(0)).count() == 0


def test_any_partitioning_draws_the_same(spark):
    frame = spark.createDataFrame(steps_of(30), SCHEMA)
    one = simulate.simulated_interval(frame.coalesce(1), draws=50).collect()
    many = simulate.simulated_interval(frame.repartition(13), draws=50).collect()
    assert sorted(map(str, one)) == sorted(map(str, many))


def test_steps_are_shuffled_once_before_they_are_multiplied(spark):
    found = simulate.simulated_interval(spark.createDataFrame(steps_of(), SCHEMA), draws=50)
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.index("Generate explode") < plan.index("Exchange hashpartitioning")  # the exchange lies below


def test_spread_is_that_of_the_model(spark):
    """Noise alone gives normal quantiles; bends alone the variance of 2 x bend^2 x rate x t^3 / 3."""
    rows = [("noise", "p", D(2022, 1, 1), 1.1, 5.0, 2.0, 0.0, 25.0)]
    rows += [("bends", "p", D(2022, 1, 1) + dt.timedelta(i), 1 + (i + 1) / 50, 0.0, 0.0, 3.0, 25.0) for i in range(25)]
    frame = spark.createDataFrame(rows, SCHEMA)
    drawn = simulate.simulate(frame, draws=4000)
    low, high = drawn.filter("store = 'noise'").agg(F.percentile("value", 0.1), F.percentile("value", 0.9)).first()
    half = 2.0 * NormalDist().inv_cdf(0.9)
    assert low == pytest.approx(5 - half, abs=0.25) and high == pytest.approx(5 + half, abs=0.25)
    spread = drawn.filter("store = 'bends'").groupBy("ds").agg(F.stddev_pop("value")).orderBy("ds").collect()
    assert spread[-1][1] == pytest.approx(math.sqrt(2 * 25 * 9 * 0.5**3 / 3), rel=0.08)


def test_coverage_of_months_held_out(spark):
    """Series whose trend bends as the model supposes: coverage of the simulated interval beside the analytic one."""
    pick = random.Random(11)
    rows = []
    for s in range(60):
        level, slope = 200.0, pick.uniform(-1, 1)
        for i in range(72):
            if i % 3 == 0:
                slope += pick.choice([-1, 1]) * pick.expovariate(1 / 0.3)
            level += slope
            day = D(2016 + i // 12, i % 12 + 1, calendar.monthrange(2016 + i // 12, i % 12 + 1)[1])
            rows.append((f"s{s}", "p", day, max(level + pick.gauss(0, 3), 0.0), 0, 0))
    series = spark.createDataFrame(rows, "store string, business_unit string, ds date, y double, black_week int, christmas int")
    cfg = ForecastConfig(train_end=D(2021, 6, 30))
    inside = F.avg(F.col("y").between(F.col("yhat_lower"), F.col("yhat_upper")).cast("double"))
    wide = F.avg(F.col("yhat_upper") - F.col("yhat_lower"))
    found = {}
    for draws in (0, 400):
        ahead = additive.forecast(series, cfg, draws=draws)
        past = ahead.filter("is_train").agg(inside).first()[0]
        found[draws] = (*ahead.filter("NOT is_train AND y IS NOT NULL").agg(inside, wide).first(), past)
    print(found)
    assert found[0][2] == found[400][2]  # history keeps the analytic interval
    assert abs(found[400][0] - found[0][0]) < 0.1
    assert found[400][1] < found[0][1] * 1.02
    assert found[400][0] > 0.6
