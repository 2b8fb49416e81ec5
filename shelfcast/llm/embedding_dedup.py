"""Embedding near-dedup by collision-counting projections.

Equal vectors are one class.  Every class is projected on many random lines.  Each list sorts the classes by one
projection, and a class collides with those in the window around its own place.  As such a window alone holds a constant
share of all rows, a list sorts inside cells that the sides of further random planes make, as many planes as
keep cells at about ``CELL`` classes; planes pass through the medians of a bounded sample, so that cells are
even where vectors crowd on one side of the origin.  Collisions are counted for each pair over all lists, and the cosine of
every pair that reaches the least count is computed in double precision.

The number of lists and the least count are calibrated: sampled vectors get partners at exactly the least cosine, in
random directions, and the lists grow until the share of those pairs with at least ``FEWEST`` collisions reaches
``RECALL``; then the least count is the largest that still has this recall.  Partners nearer than that collide more often.

A cell of more than ``CELL_LIMIT`` classes is cut in slices, each pair of slices a task of its own that counts what lies
between them, so a hot cell is neither held whole nor capped.  Links become components by rounds of star contraction.

Defined cases: vectors that are null, empty, zero, or hold a null or non-finite entry link with nothing and are kept; so do
vectors of different lengths; equal vectors link, whatever their ids; rows that share an id are each returned; the smallest
id that is not null names a component; an empty table gives no rows.  Other columns are not looked at.
"""

from __future__ import annotations

import dataclasses
import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.simhash import components
from shelfcast.session import materialise

COSINE = 0.95
RECALL = 0.9999  # of pairs at the least cosine, by the calibration
FEWEST = 2  # collisions that make a candidate, at least
CELL = 32  # classes in a cell, about
WINDOW = 0.5  # half of it, in units of a unit vector's projection on a standard normal direction
SAMPLE = 1000  # classes that the medians and the calibration look at
PARTNERS = 10  # of each of them in the calibration
LISTS = 8  # they grow by as many
MOST_LISTS = 512
CELL_LIMIT = 20_000
PAIRS = 1 << 19  # made at a time


@dataclasses.dataclass(frozen=True)
class Lines:
    """``planes`` (lists x planes x entries) with their ``middles``, ``lines`` (lists x entries), and the least count."""

    planes: np.ndarray
    middles: np.ndarray
    lines: np.ndarray
    least: int = FEWEST

    def cells(self, units: np.ndarray) -> np.ndarray:
        """The cell of each vector (row) in each list (column): the side of every plane as a bit."""
        lists, planes, width = self.planes.shape
        sides = units @ self.planes.reshape(-1, width).T >= self.middles.ravel()
        return sides.reshape(len(units), lists, planes) @ (1 << np.arange(planes, dtype=np.int64))

    def places(self, units: np.ndarray) -> np.ndarray:
        return units @ self.lines.T


def drawn(sample: np.ndarray, classes: int, cosine: float = COSINE, recall: float = RECALL, cell: int = CELL) -> Lines:
    """Lines for so many classes, calibrated on sampled unit vectors."""
    pick = np.random.default_rng(0)
    width = sample.shape[1]
    depth = max(0, round(math.log2(max(1, classes) / cell)))
    middle, sample = sample, np.repeat(sample, PARTNERS, axis=0)
    away = pick.standard_normal(sample.shape)
    away -= sample * (away * sample).sum(axis=1, keepdims=True)
    length = np.linalg.norm(away, axis=1, keepdims=True)
    away = np.where(length > 0, away / np.where(length > 0, length, 1), sample)
    partner = cosine * sample + math.sqrt(1 - cosine**2) * away
    planes, middles, lines = np.empty((0, depth, width)), np.empty((0, depth)), np.empty((0, width))
    counts = np.zeros(len(sample), np.int64)
    while len(lines) < MOST_LISTS:
        more = pick.standard_normal((LISTS, depth, width))
        cuts = np.median(middle @ more.reshape(-1, width).T, axis=0).reshape(LISTS, depth)
        new = Lines(more, cuts, pick.standard_normal((LISTS, width)))
        near = np.abs(new.places(sample) - new.places(partner)) <= WINDOW
        counts += (near & (new.cells(sample) == new.cells(partner))).sum(axis=1)
        planes, middles = np.concatenate([planes, more]), np.concatenate([middles, cuts])
        lines = np.concatenate([lines, new.lines])
        if (counts >= FEWEST).mean() >= recall:
            break
    least = int(np.quantile(counts, 1 - recall, method="lower"))
    return Lines(planes, middles, lines, max(FEWEST, least))


def classes_of(embeddings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``vec_id`` and ``code`` of each row (null: links with nothing), and a row for each class of equal vectors.

    A class has ``node``, ``code`` (128 bits of hash), ``vec_id`` (smallest), ``copies`` and its ``unit`` vector.
    """
    entries = F.col("embedding").cast("array<double>")

    def finite(c: Column) -> Column:
        return F.coalesce(~F.isnan(c) & (F.abs(c) < math.inf), F.lit(False))

    usable = F.forall(entries, finite) & F.exists(entries, lambda c: c != 0)
    same = F.transform(entries, lambda c: c + F.lit(0.0))  # zero has one sign
    code = F.struct(F.xxhash64(F.lit(1), same).alias("a"), F.xxhash64(F.lit(2), same).alias("b"))
    usable = F.coalesce(usable, F.lit(False))
    rows = embeddings.select("vec_id", F.when(usable, code).alias("code"), entries.alias("entries"))
    # Scaled by the largest entry first, so that squares neither overflow nor vanish.
    most = F.array_max(F.transform("entries", F.abs))
    scaled = F.transform("entries", lambda c: c / F.col("most"))
    norm = F.sqrt(F.aggregate("entries", F.lit(0.0), lambda a, c: a + c * c))
    grouped = rows.filter("code IS NOT NULL").groupBy("code").agg(
        F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("copies"), F.first("entries").alias("entries")
    )
    units = grouped.withColumn("most", most).withColumn("entries", scaled).withColumn("norm", norm)
    unit = F.transform("entries", lambda c: c / F.col("norm"))
    units = units.select(F.monotonically_increasing_id().alias("node"), "code", "vec_id", "copies", unit.alias("unit"))
    return rows.select("vec_id", "code"), materialise(units)


def listed(classes: DataFrame, lines: Lines) -> DataFrame:
    """``node``, ``width``, ``list``, ``cell`` and ``place`` of every class in every list."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        lists, width = lines.lines.shape
        for whole in batches:
            for begin in range(0, whole.num_rows, 2048):
                batch = whole.slice(begin, 2048)
                units = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(batch.column(0).to_numpy(), lists)),
                        pa.array(np.tile(np.arange(lists, dtype=np.int32), len(units))),
                        pa.array(lines.cells(units).ravel()),
                        pa.array(lines.places(units).ravel()),
                    ],
                    ["node", "list", "cell", "place"],
                )

    return classes.select("node", "unit").mapInArrow(run, "node bigint, list int, cell bigint, place double")


def collisions(keyed: DataFrame) -> DataFrame:
    """Pairs ``a`` > ``b`` in one window, a row for each list where they are; rows of a cell stand together by place.

    ``keyed`` has ``key``, ``node``, ``place`` and ``slice``: null, or the slice of a cell that was cut, where ``across``
    says whether the key stands for two slices, of which only pairs between them are meant.
    """

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def solve(key, node, place, part, across):
            number = np.cumsum(np.concatenate([[True], key[1:] != key[:-1]])) - 1
            # Cells follow each other along one line, too far apart for a window to reach from one to the next.
            line = number * (4 * WINDOW + 2 * np.abs(place).max(initial=0) + 1) + place
            count = np.searchsorted(line, line + WINDOW, "right") - np.arange(len(line)) - 1
            ends = np.cumsum(count)
            begin = 0
            while begin < len(line):
                last = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + PAIRS)))
                size = count[begin:last]
                left = np.repeat(np.arange(begin, last), size)
                first = np.cumsum(size) - size
                right = left + 1 + np.arange(len(left)) - np.repeat(first, size)
                meant = ~across[left] | (part[left] != part[right])
                x, y = node[left[meant]], node[right[meant]]
                if len(x):
                    yield pa.RecordBatch.from_arrays([pa.array(np.maximum(x, y)), pa.array(np.minimum(x, y))], ["a", "b"])
                begin = last

        held = None
        for batch in batches:
            now = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            now = now if held is None else [np.concatenate(x) for x in zip(held, now, strict=True)]
            if not len(now[0]):
                continue
            cut = int(np.searchsorted(now[0], now[0][-1]))  # the last cell may go on in the next batch
            held = [x[cut:] for x in now]
            if cut:
                yield from solve(*(x[:cut] for x in now))
        if held is not None and len(held[0]):
            yield from solve(*held)

    return keyed.select("key", "node", "place", "slice", "across").mapInArrow(run, "a bigint, b bigint")


def candidates(classes: DataFrame, lines: Lines, limit: int = CELL_LIMIT) -> DataFrame:
    """Pairs ``a`` > ``b`` of classes that collide often enough."""
    rows = materialise(listed(classes, lines).withColumn("cell", F.xxhash64("list", "cell")))
    large = materialise(
        rows.groupBy("cell").count().filter(F.col("count") > limit).select(
            F.col("cell").alias("large"), F.ceil(2 * F.col("count") / limit).cast("int").alias("slices")
        )
    )
    rows = rows.join(large, F.col("cell") == F.col("large"), "left")
    mine = F.pmod(F.xxhash64("node"), F.col("slices")).cast("int")
    rows = rows.withColumn("slice", F.coalesce(mine, F.lit(0)))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce("slices", F.lit(1)) - 1)))
    pair = F.xxhash64("cell", F.least("slice", "other"), F.greatest("slice", "other"))
    key = F.when(F.col("slices").isNull(), F.col("cell")).otherwise(pair)
    keyed = rows.select(key.alias("key"), "node", "place", "slice", (F.col("slice") != F.col("other")).alias("across"))
    keyed = keyed.repartition("key").sortWithinPartitions("key", "place")
    return collisions(keyed).groupBy("a", "b").count().filter(F.col("count") >= lines.least).select("a", "b")


def verified(pairs: DataFrame, classes: DataFrame, cosine: float) -> DataFrame:
    """The pairs whose cosine is large enough."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            x, y = (c.flatten().to_numpy(zero_copy_only=False) for c in batch.columns[2:])
            shape = (batch.num_rows, -1)
            if batch.num_rows:
                near = np.einsum("ij,ij->i", x.reshape(shape), y.reshape(shape)) >= cosine
                yield batch.select([0, 1]).filter(pa.array(near))

    units = [classes.select(F.col("node").alias(n), F.col("unit").alias(f"unit_{n}")) for n in ("a", "b")]
    found = pairs.join(units[0], "a").join(units[1], "b").select("a", "b", "unit_a", "unit_b")
    return found.mapInArrow(run, "a bigint, b bigint")


def links(classes: DataFrame, cosine: float = COSINE, recall: float = RECALL, cell: int = CELL) -> DataFrame:
    """Links ``a`` > ``b`` between classes, whose vectors have one length each; a written table."""
    found = None
    widths = classes.groupBy(F.size("unit").alias("width")).count().collect()  # as many rows as lengths
    for width, count in sorted(tuple(row) for row in widths):
        alike = classes.filter(F.size("unit") == width)
        rows = alike.orderBy(F.xxhash64("code"), "code").limit(SAMPLE).select("unit").collect()
        lines = drawn(np.array([row.unit for row in rows]), count, cosine, recall, cell)
        pairs = verified(candidates(alike, lines), alike, cosine)
        found = pairs if found is None else found.unionByName(pairs)
    if found is None:
        found = classes.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0)
    return materialise(found)


def near_duplicates(
    embeddings: DataFrame, cosine: float = COSINE, recall: float = RECALL, cell: int = CELL
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` for every row."""
    rows, classes = classes_of(embeddings)
    edges = links(classes, cosine, recall, cell)
    small = classes.select("node", "vec_id", "copies")
    both = edges.union(edges.select("b", "a")).toDF("node", "partner")
    partners = small.select(F.col("node").alias("partner"), F.col("copies").alias("times"))
    linked = both.join(partners, "partner").groupBy("node").agg(F.sum("times").alias("linked"))
    roots = components(edges).withColumnRenamed("node", "member")
    joined = small.join(roots, F.col("node") == F.col("member"), "left")
    joined = materialise(joined.select("node", "vec_id", F.coalesce("root", "node").alias("root")))
    names = joined.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    members = joined.select("node", "root").join(names, "root").select("node", "component_id")
    known = classes.select("node", "code", "copies").join(linked, "node", "left").join(members, "node")
    total = (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("total")
    known = materialise(known.select(F.col("code").alias("known"), total, "component_id"))
    found = rows.join(known, F.col("code") == F.col("known"), "left")
    name = F.when(F.col("known").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    found = found.select("vec_id", F.coalesce("total", F.lit(0)).cast("long").alias("n_links"), name.alias("component_id"))
    return found.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
