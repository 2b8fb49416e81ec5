"""Forecast intervals from simulated trends.

After the last observation the trend goes on bending at its historic rate: in each step it may bend once, at a uniform
place and by a Laplace-distributed amount. Each draw is one path of such bends plus noise; the interval lies between
quantiles over all draws. Random numbers are digits of a hash of (series, draw, date), so the same draws come out on any
partitioning, after any retry, and in SQL.

Defined cases: a null key counts as an empty text; a step that does not lie after the one before it cannot bend;
rows of one series and date take the same random numbers; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfcast.schema import SERIES

DRAWS = 1000
_DIGITS = 6  # hexadecimal digits of a random number, of which a hash holds five


def _uniform(digest: Column, number: int) -> Column:
    """Random number ``number`` (0 to 4) of a hash, strictly between 0 and 1."""
    digits = F.conv(F.substring(digest, 1 + _DIGITS * number, _DIGITS), 16, 10).cast("double")
    return (digits + 0.5) / float(16**_DIGITS)


def simulate(steps: DataFrame, keys: Sequence[str] = SERIES, draws: int = DRAWS) -> DataFrame:
    """``steps`` with ``draw`` (from 1) and its ``value``, one row for every step and draw.

    ``steps`` are the dates after the last observation: ``ds``, ``t`` (1 at the last observation), ``yhat``, ``noise``
    (standard deviation), ``bend`` (mean size of a bend, per unit of ``t``) and ``rate`` (bends per unit of ``t``).
    Steps are shuffled once by series, before they are multiplied; paths and quantiles stay where they are.
    """
    before = F.lag("t").over(Window.partitionBy(*keys).orderBy("ds"))
    rows = steps.withColumn("_gap", F.greatest(F.col("t") - F.coalesce(before, F.lit(1.0)), F.lit(0.0)))
    rows = rows.withColumn("draw", F.explode(F.sequence(F.lit(1), F.lit(draws))))
    named = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    rows = rows.withColumn("_digest", F.md5(F.concat_ws("|", *named, "draw", F.col("ds").cast("date").cast("string"))))
    happens, size, place, radius, angle = (_uniform(F.col("_digest"), i) for i in range(5))
    bends = F.col("rate") * F.col("_gap")
    likely = 1.0 - F.exp(-bends)
    laplace = -F.signum(size - 0.5) * F.log(1.0 - 2.0 * F.abs(size - 0.5))
    # Several bends in a step are one that is larger, with the same variance.
    amount = F.when(happens < likely, F.col("bend") * F.sqrt(bends / likely) * laplace).otherwise(0.0)
    noise = F.col("noise") * F.sqrt(-2.0 * F.log(radius)) * F.cos(2.0 * math.pi * angle)
    rows = rows.withColumns({"_amount": amount, "_at": F.col("t") - (1.0 - place) * F.col("_gap"), "_noise": noise})
    so_far = Window.partitionBy(*keys, "draw").orderBy("ds").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    slope, offset = F.sum("_amount").over(so_far), F.sum(F.col("_amount") * F.col("_at")).over(so_far)
    value = F.col("yhat") + F.col("t") * slope - offset + F.col("_noise")
    return rows.withColumn("value", value).drop("_gap", "_digest", "_amount", "_at", "_noise")


def simulated_interval(
    steps: DataFrame, keys: Sequence[str] = SERIES, draws: int = DRAWS, width: float = 0.8
) -> DataFrame:
    """``lower`` and ``upper`` of every series and date: the quantiles that hold ``width`` of the draws."""
    low = (1.0 - width) / 2
    return simulate(steps, keys, draws).groupBy(*keys, "ds").agg(
        F.percentile("value", F.lit(low)).alias("lower"), F.percentile("value", F.lit(1.0 - low)).alias("upper")
    )
