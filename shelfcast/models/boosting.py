"""Gradient boosting with the Tweedie deviance over all series, as one distributed model.

Features are cut into bins, and rows with equal bins become one weighted row, since gradients depend on a row's bins and its
sums alone.  A level of a tree is one aggregation: gradients and hessians, as columns, summed by node, feature and
bin.  Only these sums reach the driver, which picks the splits: of numbers at a value, of stores and products, whose bins have
no order, after sorting the bins by the step that each asks for.  All draws of a search and all folds are rows of one
frame and grow their trees in the same jobs, so a search takes as many jobs as a single fit.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import itertools
import math
import random
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from shelfcast.models import tweedie
from shelfcast.models.tweedie import TweedieConfig
from shelfcast.operators.clean import stamp_run
from shelfcast.operators.folds import time_series_folds
from shelfcast.session import materialise

BINS = 32  # of a feature, at most 62; values that hold less than a bin's share of the rows may share one
ROUNDS = 12
WRITTEN = 4  # trees between two writes of the margins
LEAST = 1.0  # hessian of a leaf
# What the random search draws from.
RATES, DEPTHS, PENALTIES, SHARES = (0.2, 0.3, 0.5), (2, 3), (0.0, 1.0, 10.0, 100.0), (0.5, 0.7, 1.0)


@dataclasses.dataclass(frozen=True)
class Draw:
    """Learning rate, levels of a tree, penalty on leaf values, share of the features a tree may use."""

    rate: float
    depth: int
    penalty: float
    share: float


@dataclasses.dataclass
class Forest:
    """Trees of several models; a split is a feature and the bins that go left, as bits, for each model and node."""

    base: np.ndarray
    trees: list[tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]]

    def margin(self, begin: int = 0) -> Column:
        """What the trees from ``begin`` on add, for rows with ``model`` and ``bins``."""
        added = F.lit(0.0)
        for splits, values in self.trees[begin:]:
            added = added + _looked_up(values, F.col("model") * values.shape[1] + node(splits))
        return added


def draws(cfg: TweedieConfig) -> list[Draw]:
    """Distinct draws from the 72 points of the search space, the same for every run with the same seed."""
    space = list(itertools.product(RATES, DEPTHS, PENALTIES, SHARES))
    return [Draw(*point) for point in random.Random(cfg.seed).sample(space, min(cfg.draws, len(space)))]


def _looked_up(values: np.ndarray, place: Column) -> Column:
    kind = "D" if values.dtype.kind == "f" else "L" if values.max(initial=0) >= 1 << 31 else ""
    return F.get(F.expr(f"array({','.join(f'{v!r}{kind}' for v in values.ravel().tolist())})"), place)


def node(splits: list[tuple[np.ndarray, np.ndarray]]) -> Column:
    """The node, counted from 0 on its level, that a row reaches through the splits of the levels above."""
    reached = F.lit(0)
    for level, (feature, left) in enumerate(splits):
        place = F.col("model") * (1 << level) + reached
        bit = F.call_function("shiftright", _looked_up(left, place), F.get("bins", _looked_up(feature, place)))
        reached = reached * 2 + (1 - bit.bitwiseAND(F.lit(1))).cast("int")
    return reached


def cut_points(train: DataFrame, names: Sequence[str], bins: int = BINS) -> list[list[float]]:
    """For each feature the values at which its bins end, at most ``bins`` - 1, from one aggregation."""
    shares = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    row = train.agg(*[F.percentile_approx(F.col(n).cast("double"), shares, 100 * bins).alias(n) for n in names]).first()
    return [sorted(set(row[n] or [])) for n in names]


def binned(frame: DataFrame, names: Sequence[str], cuts: list[list[float]]) -> Column:
    """The number of the bin of each feature."""
    counts = []
    for name, ends in zip(names, cuts, strict=True):
        passed = [(F.col(name) > F.lit(end)).cast("int") for end in ends]
        counts.append(sum(passed[1:], passed[0]) if passed else F.lit(0))
    return F.array(*counts)


def cells(rows: DataFrame) -> DataFrame:
    """Rows with equal ``model``, ``train`` and ``bins`` as one, with their number ``n`` and the sums of y and y²."""
    return rows.groupBy("model", "train", "bins").agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.sum("y").alias("y"), F.sum(F.col("y") * F.col("y")).alias("y2")
    )


def histogram(state: DataFrame, power: float, reached: Column) -> DataFrame:
    """Sums of gradients and hessians by ``model``, ``node``, ``feature`` and ``bin``; ``state`` has a ``margin``.

    The loss is half the Tweedie deviance, and the margin is the logarithm of the prediction.
    """
    low, high = F.exp(F.col("margin") * (1 - power)), F.exp(F.col("margin") * (2 - power))
    rows = state.filter("train").select(
        "model",
        reached.alias("node"),
        "bins",
        (F.col("n") * high - F.col("y") * low).alias("g"),
        (F.col("n") * high * (2 - power) - F.col("y") * low * (1 - power)).alias("h"),
    )
    parts = rows.select("model", "node", F.posexplode("bins").alias("feature", "bin"), "g", "h")
    return parts.groupBy("model", "node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))


def best_splits(
    g: np.ndarray,
    h: np.ndarray,
    penalty: np.ndarray,
    allowed: np.ndarray,
    unordered: Sequence[bool],
    least: float = LEAST,
) -> tuple[np.ndarray, np.ndarray]:
    """Feature and left bins, as bits, of the split of each (model, node) that lowers the loss most; all left for none.

    ``g`` and ``h`` are sums by model, node, feature and bin; of equal splits the first feature and bin is taken.
    """
    models, nodes, features, bins = g.shape
    weight = penalty[:, None, None, None]
    asked = np.where(np.asarray(unordered)[:, None], g / np.maximum(h + weight, 1e-12), np.arange(bins))
    order = np.argsort(asked, axis=3, kind="stable")
    left_g, left_h = (np.take_along_axis(x, order, axis=3).cumsum(axis=3) for x in (g, h))
    all_g, all_h = left_g[..., -1:], left_h[..., -1:]
    right_g, right_h = all_g - left_g, all_h - left_h

    def gain(x, y):
        return x * x / np.maximum(y + weight, 1e-300)

    found = gain(left_g, left_h) + gain(right_g, right_h) - gain(all_g, all_h)
    possible = (left_h >= least) & (right_h >= least) & allowed[:, None, :, None]
    found = np.where(possible, found, -np.inf).reshape(models, nodes, -1)
    best = found.argmax(axis=2)
    real = np.take_along_axis(found, best[..., None], axis=2)[..., 0] > 1e-9
    bits = (1 << order.astype(np.int64)).cumsum(axis=3).reshape(models, nodes, -1)
    left = np.take_along_axis(bits, best[..., None], axis=2)[..., 0]
    return np.where(real, best // bins, 0), np.where(real, left, (1 << bins) - 1)


def fit(
    state: DataFrame,
    settings: Sequence[Draw],
    power: float,
    rounds: int = ROUNDS,
    seed: int = 0,
    unordered: int = 0,
) -> Forest:
    """A model for each of the ``settings``, from the cells that train; ``model`` numbers them.

    The bins of the first ``unordered`` features have no order.  Model i uses the bins of its own cells; every level of all trees of a round is one job.
    """
    models = len(settings)
    depth = max((d.depth for d in settings), default=0)
    penalty, rate = (np.array([getattr(d, name) for d in settings]) for name in ("penalty", "rate"))
    means = state.filter("train").groupBy("model").agg((F.sum("y") / F.sum("n")).alias("mean"))
    base = np.full(models, math.log(1e-9))
    for model, mean in means.collect():
        base[model] = math.log(max(mean, 1e-9))
    forest = Forest(base, [])
    width = state.agg(F.max(F.size("bins"))).first()[0]
    if not width:
        return forest
    start = _looked_up(base, F.col("model"))
    written, at = materialise(state.withColumn("margin", start)), 0
    pick = random.Random(seed)
    for round_ in range(rounds):
        if round_ - at == WRITTEN:
            written, at = materialise(written.withColumn("margin", F.col("margin") + forest.margin(at))), round_
        now = written.withColumn("margin", F.col("margin") + forest.margin(at))
        allowed = np.zeros((models, width), bool)
        for i, draw in enumerate(settings):
            allowed[i, pick.sample(range(width), max(1, round(draw.share * width)))] = True
        splits: list[tuple[np.ndarray, np.ndarray]] = []
        for level in range(depth):
            sums = histogram(now, power, node(splits)).toArrow()
            place = tuple(sums[c].to_numpy() for c in ("model", "node", "feature", "bin"))
            g, h = np.zeros((2, models, 1 << level, width, BINS))
            g[place], h[place] = sums["g"].to_numpy(), sums["h"].to_numpy()
            feature, goes_left = best_splits(g, h, penalty, allowed, np.arange(width) < unordered)
            ended = np.array([d.depth <= level for d in settings])
            feature[ended], goes_left[ended] = 0, (1 << BINS) - 1
            splits.append((feature, goes_left))
        left = (splits[-1][1][..., None] >> np.arange(BINS) & 1).astype(bool)
        chosen = [np.take_along_axis(x, splits[-1][0][..., None, None], axis=2)[:, :, 0] for x in (g, h)]
        sides = [np.stack([(x * left).sum(axis=2), (x * ~left).sum(axis=2)], axis=2) for x in chosen]
        down, curve = (x.reshape(models, -1) for x in sides)
        step = -down / np.maximum(curve + penalty[:, None], 1e-12)
        # A leaf without sales would go to minus infinity; no step is longer than a factor of e to the second.
        forest.trees.append((splits, np.clip(step, -2.0, 2.0) * rate[:, None]))
    return forest


def features(
    df: DataFrame, train: DataFrame, cfg: TweedieConfig, keys: Sequence[str]
) -> tuple[DataFrame, list[str]]:
    """``df`` with the features of the linear model, but year and month as numbers, and keys of one mean told apart.

    The keys come first.
    """
    wide, names = tweedie.features(df, train, cfg, keys)
    levels = [f"{key}_level" for key in keys]
    # Less than any difference of means that matters, so that bins are still made of keys with like means.
    apart = {f"{k}_level": F.col(f"{k}_level") + F.pmod(F.xxhash64(k), F.lit(1 << 20)) * 1e-12 for k in keys}
    rest = [n for n in names if n not in levels and not n.startswith("month_") and n != "year_centred"]
    return wide.withColumns(apart), [*levels, *rest, "year", "month"]


def search(
    train: DataFrame, cfg: TweedieConfig, keys: Sequence[str] = ("store", "business_unit"), rounds: int = ROUNDS
) -> list[tuple[float, Draw]]:
    """Cross-validated (rmse, draw) of every draw, best first."""
    tagged = materialise(time_series_folds(train, cfg.folds, keys))
    tried = draws(cfg)
    parts = []
    for fold in range(cfg.folds):
        rows = tagged.filter(F.col("fold") == fold)
        known = rows.filter("role = 'train'")
        wide, names = features(rows, known, cfg, keys)
        wide = materialise(wide.select("y", "role", *names))
        cuts = cut_points(wide.filter("role = 'train'"), names)
        marked = wide.select(
            F.lit(fold).alias("model"), (F.col("role") == "train").alias("train"), binned(wide, names, cuts).alias("bins"), "y"
        )
        parts.append(cells(marked))
    state = parts[0]
    for part in parts[1:]:
        state = state.unionByName(part)
    each = F.transform(F.sequence(F.lit(0), F.lit(len(tried) - 1)), lambda d: d * cfg.folds + F.col("model"))
    state = materialise(state.withColumn("model", F.explode(each)))
    settings = [draw for draw in tried for _ in range(cfg.folds)]
    forest = fit(state, settings, cfg.power, rounds, cfg.seed, len(keys))
    margin = _looked_up(forest.base, F.col("model")) + forest.margin()
    mean = F.exp(margin)
    lost = F.col("y2") - 2 * mean * F.col("y") + F.col("n") * mean * mean
    asked = state.filter("NOT train").groupBy(F.floor(F.col("model") / cfg.folds).alias("draw"))
    found = asked.agg(F.sum(lost).alias("lost"), F.sum("n").alias("n")).collect()
    return sorted(((math.sqrt(max(r.lost, 0.0) / r.n), tried[r.draw]) for r in found), key=lambda x: (x[0], str(x[1])))


def predicted(
    tagged: DataFrame, cfg: TweedieConfig, draw: Draw, keys: Sequence[str], rounds: int = ROUNDS
) -> DataFrame:
    """Rows of ``tagged`` with ``y_prediction``, by a model of those that train."""
    wide, names = features(tagged, tagged.filter("is_train"), cfg, keys)
    wide = materialise(wide)
    cuts = cut_points(wide.filter("is_train"), names)
    marked = wide.withColumns({"model": F.lit(0), "train": F.col("is_train"), "bins": binned(wide, names, cuts)})
    forest = fit(materialise(cells(marked.filter("train"))), [draw], cfg.power, rounds, cfg.seed, len(keys))
    mean = F.exp(F.lit(float(forest.base[0])) + forest.margin())
    return marked.withColumn("y_prediction", mean).drop("model", "train", "bins")


def boosted_forecast(
    series: DataFrame,
    cfg: TweedieConfig | None = None,
    keys: Sequence[str] = ("store", "business_unit"),
    draw: Draw | None = None,
    run_date: dt.date | None = None,
) -> DataFrame:
    """Predictions after the training end, by the best draw of the search or by a given one."""
    cfg = cfg or TweedieConfig()
    tagged = materialise(tweedie.tag_split(series, cfg.train_end, cfg.valid_from))
    if draw is None:
        train = tagged.filter("is_train").drop("is_train", "is_valid", "is_predict")
        draw = search(train, cfg, keys)[0][1]
    found = predicted(tagged, cfg, draw, keys).filter("is_predict")
    return stamp_run(found.select("ds", *keys, *cfg.regressors, "y", "y_prediction"), run_date)


def deviance(scored: DataFrame, power: float) -> DataFrame:
    """One row: ``n_scored`` and the mean Tweedie deviance of ``y_prediction``; rows without ``y`` are not scored."""
    y, mean = F.col("y").cast("double"), F.greatest(F.col("y_prediction"), F.lit(1e-9))
    own = F.pow(y, F.lit(2 - power)) / ((1 - power) * (2 - power))
    lost = own - y * F.pow(mean, F.lit(1 - power)) / (1 - power) + F.pow(mean, F.lit(2 - power)) / (2 - power)
    return scored.filter(y.isNotNull()).agg(F.count(F.lit(1)).alias("n_scored"), (2 * F.avg(lost)).alias("deviance"))
