"""SimHash near-dedup through BK-trees.

Every text gets a 64-bit fingerprint.  Distinct fingerprints are dealt to shards so that any two within the
radius meet in at least one: with ``blocks`` blocks of bits, two fingerprints that differ in at most ``radius``
bits agree on ``blocks - radius`` whole blocks, and there is a shard for each value of each such choice of
blocks.  A task builds the BK-trees of its shards, children keyed by their integer Hamming distance to the
parent, and every member searches its shard's tree along the edges within the radius.  Trees are not broadcast
whole: together they grow with the corpus, so each travels to the tasks that search it.  A shard with more than
``tree_limit`` members is cut into slices, and each pair of slices becomes a tree of its own, searched by its own
task.  A shard reports the links it found as a spanning star, never as pairs, so groups of copies cost as many
rows as they have members; stars are merged to components by rounds of star contraction written to the shared folder.

Defined cases: a null text is the empty text, whose fingerprint is zero and links like any other; ids that are
null count only where a component has no other; equal texts share a fingerprint; an empty table gives no rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import keep_rows, texts
from shelfcast.session import materialise

SEED = 42
SHINGLE = 3
RADIUS = 3
BLOCKS = 5
TREE_LIMIT = 50_000


def text_fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """SimHash of the lower-cased (A-Z) words' shingles: a bit is set where over half of the hashes have it."""
    import numpy as np
    import xxhash

    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = list(itertools.accumulate(map(len, words), lambda end, size: end + 1 + size))
    starts = [0, *(end + 1 for end in ends)]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :], strict=False)], "<u8")
    ones = np.zeros(64, np.int64)
    for begin in range(0, len(hashes), 200):  # sums of 200 bits fit in a byte
        bits = np.unpackbits(hashes[begin : begin + 200].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += np.add.reduce(bits, axis=0, dtype=np.uint8)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id``, ``fp`` (the fingerprint's 64 bits as a long) and ``text_hash`` of the whole text, which is Spark's ``xxhash64``."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import xxhash

        for batch in batches:
            rows = batch.column(1).to_pylist()
            prints = np.array([text_fingerprint(t, shingle) for t in rows], "<u8").view("<i8")
            whole = np.array([xxhash.xxh64_intdigest(t.encode("utf-8", "replace"), SEED) for t in rows], "<u8").view("<i8")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(prints), pa.array(whole)], ["doc_id", "fp", "text_hash"]
            )

    return texts(docs).mapInArrow(run, f"doc_id {kind}, fp bigint, text_hash bigint")


def shards(prints: DataFrame, radius: int, blocks: int) -> DataFrame:
    """``shard`` and ``fp``: a row for each choice of blocks that must agree."""
    if not 0 <= radius < blocks <= 16:
        raise ValueError("there must be more blocks than bits of the radius, 16 at most")
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    keys = []
    for n, chosen in enumerate(itertools.combinations(range(blocks), blocks - radius)):
        mask = sum(((1 << (edges[b + 1] - edges[b])) - 1) << edges[b] for b in chosen)
        mask -= (mask >> 63) << 64
        keys.append(F.struct(F.lit(n).alias("choice"), F.col("fp").bitwiseAND(F.lit(mask)).alias("bits")))
    return prints.select("fp", F.explode(F.array(*keys)).alias("shard"))


def build_forest(root, fps):
    """Children of every node, for trees whose members share a ``root`` (the index of their first member).

    Returns ``first``, where ``children[first[66 * node + d] : first[66 * node + d + 1]]`` are the child of
    ``node`` at distance ``d`` (one at most), and ``children``.
    """
    import numpy as np

    size = len(fps)
    active = np.flatnonzero(root != np.arange(size))
    at = root[active]
    codes, kids = [], []
    while len(active):
        code = at * 66 + np.bitwise_count(fps[active] ^ fps[at])
        order = np.argsort(code, kind="stable")
        code, active = code[order], active[order]
        new = np.concatenate([[True], code[1:] != code[:-1]])
        codes.append(code[new])
        kids.append(active[new])
        at = active[new][np.cumsum(new) - 1][~new]
        active = active[~new]
    code = np.concatenate([*codes, np.empty(0, np.int64)]).astype(np.int64)
    order = np.argsort(code, kind="stable")
    children = np.concatenate([*kids, np.empty(0, np.int64)]).astype(np.int64)[order]
    first = np.concatenate([[0], np.cumsum(np.bincount(code, minlength=66 * size))])
    return first, children


def search_forest(root, fps, first, children, radius: int, frontier: int = 1 << 17) -> Iterator:
    """Pairs of indexes within the radius: every member searches its tree, all trees level by level."""
    import numpy as np

    for begin in range(0, len(fps), 1 << 16):
        query = np.arange(begin, min(begin + (1 << 16), len(fps)))
        todo = [(query, root[query])]
        while todo:
            query, node = todo.pop()
            if len(query) > frontier:
                half = len(query) // 2
                todo += [(query[half:], node[half:]), (query[:half], node[:half])]
                continue
            apart = np.bitwise_count(fps[query] ^ fps[node]).astype(np.int64)
            hit = (apart <= radius) & (node < query)
            if hit.any():
                yield query[hit], node[hit]
            low = first[66 * node + np.maximum(apart - radius, 0)]
            count = first[66 * node + np.minimum(apart + radius, 64) + 1] - low
            if total := int(count.sum()):
                ends = np.cumsum(count)
                place = np.arange(total) + np.repeat(low - ends + count, count)
                todo.append((np.repeat(query, count), children[place]))


def smallest_members(size: int, pairs: Iterator):
    """The smallest index that each index reaches over ``pairs``."""
    import numpy as np

    label = np.arange(size)
    for a, b in pairs:
        while True:
            x, y = label[a], label[b]
            apart = x != y
            if not apart.any():
                break
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
            while (label[label] != label).any():
                label = label[label]
    return label


def shard_stars(keyed: DataFrame, radius: int) -> DataFrame:
    """Edges ``a`` > ``b`` that span what each cell links; rows of a cell stand together in a partition."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def solve(cell, fps):
            new = np.concatenate([[True], cell[1:] != cell[:-1]])
            start = np.flatnonzero(new)
            sizes = np.diff(np.append(start, len(cell)))
            alone = np.repeat(sizes == 1, sizes)
            cell, fps = cell[~alone], fps[~alone]
            if not len(cell):
                return
            new = np.concatenate([[True], cell[1:] != cell[:-1]])
            root = np.flatnonzero(new)[np.cumsum(new) - 1]
            plain = fps.view(np.uint64)
            label = smallest_members(
                len(fps), search_forest(root, plain, *build_forest(root, plain), radius)
            )
            linked = label != np.arange(len(label))
            a, b = fps[linked], fps[label[linked]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], ["a", "b"]
            )

        held = [np.empty(0, np.int64)] * 2
        for batch in batches:
            now = [np.concatenate([h, batch.column(i).to_numpy(zero_copy_only=False)]) for i, h in enumerate(held)]
            if not len(now[0]):
                continue
            cut = int(np.searchsorted(now[0], now[0][-1]))  # the last cell may go on in the next batch
            held = [x[cut:] for x in now]
            if cut:
                yield from solve(now[0][:cut], now[1][:cut])
        if len(held[0]):
            yield from solve(*held)

    return keyed.mapInArrow(run, "a bigint, b bigint")


def links(prints: DataFrame, radius: int, blocks: int, tree_limit: int) -> DataFrame:
    """Edges between distinct fingerprints within the radius, at most one less than the members of a cell."""
    rows = shards(prints, radius, blocks).select(F.xxhash64("shard").alias("cell"), "fp")
    large = materialise(
        rows.groupBy("cell").count().filter(F.col("count") > tree_limit).select(
            F.col("cell").alias("large"), F.ceil(2 * F.col("count") / tree_limit).alias("slices")
        )
    )
    mine = F.pmod(F.xxhash64("fp"), F.col("slices"))
    dealt = rows.join(large, F.col("cell") == F.col("large"), "left").withColumn(
        "other",
        F.explode(F.sequence(F.lit(0), F.coalesce(F.col("slices").cast("int"), F.lit(1)) - 1)),
    )
    cell = F.when(F.col("slices").isNull(), F.col("cell")).otherwise(
        F.xxhash64("cell", F.least(mine, F.col("other")), F.greatest(mine, F.col("other")))
    )
    # Two cells that share a hash become one tree, which links only what is within the radius.
    keyed = dealt.select(cell.alias("key"), "fp").repartition("key").sortWithinPartitions("key", "fp")
    return shard_stars(keyed, radius).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node it reaches, for the nodes of ``edges`` (columns a > b) but the roots.

    Alternates large and small stars until nothing changes; every round is a written table.
    """

    def fingerprint(frame: DataFrame) -> tuple:
        return tuple(frame.agg(F.count("a"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    edges = materialise(edges)
    state = fingerprint(edges)
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = materialise(large.filter("a > b").distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        child = F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b"))
        small = small.select(child.alias("a"), F.col("m").alias("b"))
        edges = materialise(small.filter("a > b").distinct())
        before, state = state, fingerprint(edges)
        if state == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(
    docs: DataFrame,
    shingle: int = SHINGLE,
    radius: int = RADIUS,
    blocks: int = BLOCKS,
    tree_limit: int = TREE_LIMIT,
) -> DataFrame:
    """``doc_id``, ``fp``, ``text_hash``, ``component_id`` and ``first`` for every row.

    ``component_id`` is the smallest id that links reach; ``first`` is the (id, text hash) that stands for the
    component, which tells apart rows that share an id.
    """
    marked = materialise(fingerprints(docs, shingle))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "text_hash")).alias("first")
    prints = materialise(marked.groupBy("fp").agg(least))
    roots = components(links(prints.select("fp"), radius, blocks, tree_limit))
    joined = prints.join(roots, F.col("fp") == F.col("node"), "left")
    joined = joined.select("fp", "first", F.coalesce("root", "fp").alias("root"))
    firsts = joined.groupBy("root").agg(F.min("first").alias("first"))
    members = materialise(joined.select("fp", "root").join(firsts, "root").select("fp", "first"))
    return marked.join(members, "fp").select(
        "doc_id",
        "fp",
        "text_hash",
        F.col("first.doc_id").alias("component_id"),
        F.col("first.text_hash").alias("first_hash"),
    )


def keep_one_each(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """Rows of ``docs`` that stand for their component, with all their columns; a repeated row stays once."""
    found = near_duplicates(docs, shingle, radius)
    stays = F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("text_hash") == F.col("first_hash"))
    decisions = found.groupBy("doc_id", F.col("text_hash").alias("key")).agg(
        F.first(stays).alias("kept"), F.count(F.lit(1)).alias("copies")
    )
    return keep_rows(docs, decisions, F.xxhash64(F.coalesce("text", F.lit(""))))
