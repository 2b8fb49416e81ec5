"""Best-fit packing of tokenised documents into sequences of fixed capacity.

Large-item matching: at most two pieces longer than a third of the capacity fit one sequence, so these are matched
greedily first, each with the longest partner that still fits; smaller pieces then go, longest first, into the
sequence with the smallest gap that takes them.  Lengths are whole numbers up to the capacity, so the plan is made on
the number of pieces of each length, a table no longer than the capacity however many documents there are, and says for
each length which ranks go to which sequences at which offset.  Spark ranks the pieces within their lengths and
looks their places up; no piece passes through the driver.

Defined cases: a null text is the empty text, one end token; only documents longer than the capacity are cut;
repeated rows are packed as often as they come; an empty table gives no rows.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import coder, texts, vocabulary_path
from shelfcast.session import materialise

CAPACITY = 2048
VOCABULARY = "word_bpe_49k.json"
END_ID = 0

#: A slot of the plan: pieces of ``length`` ranked ``rank`` to ``rank + count - 1`` go to the sequences from
#: ``sequence`` on, one each, at ``offset``.
Slot = tuple[int, int, int, int, int]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[Slot], int]:
    """Slots ``(length, rank, count, sequence, offset)`` for so many pieces of each length, and the sequences used."""
    if any(not 0 < length <= capacity for length in counts):
        raise ValueError("lengths must lie between 1 and the capacity")
    left = {length: n for length, n in counts.items() if n}
    used = dict.fromkeys(left, 0)
    slots: list[Slot] = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap: runs of sequences (first, count)
    sizes: list[int] = []  # gaps that occur, ascending
    sequences = 0

    def put(length: int, count: int, sequence: int) -> None:
        slots.append((length, used[length], count, sequence, offset))
        used[length] += count
        left[length] -= count

    def leave(gap: int, first: int, count: int) -> None:
        if gap:
            if gap not in gaps:
                gaps[gap] = []
                bisect.insort(sizes, gap)
            gaps[gap].append((first, count))

    large = sorted(length for length in left if 3 * length > capacity)
    while large:
        length = large.pop()
        if not left[length]:
            continue
        offset, at = 0, bisect.bisect_right(large, capacity - length)
        while at and not left[large[at - 1]]:
            at -= 1
        if 2 * length <= capacity and left[length] > 1:  # its own kind is the longest partner left
            pairs = left[length] // 2
            put(length, pairs, sequences)
            offset = length
            put(length, pairs, sequences)
            leave(capacity - 2 * length, sequences, pairs)
            sequences += pairs
        elif at:
            other = large[at - 1]
            pairs = min(left[length], left[other])
            put(length, pairs, sequences)
            offset = length
            put(other, pairs, sequences)
            leave(capacity - length - other, sequences, pairs)
            sequences += pairs
        else:
            alone = left[length]
            put(length, alone, sequences)
            leave(capacity - length, sequences, alone)
            sequences += alone
        if left[length]:
            large.append(length)
    for length in sorted((x for x in left if left[x]), reverse=True):
        while left[length]:
            at = bisect.bisect_left(sizes, length)
            if at == len(sizes):
                fresh = -(-left[length] // (capacity // length))
                leave(capacity, sequences, fresh)
                sequences += fresh
                continue
            gap = sizes[at]
            first, count = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap], sizes[at]
            # As many of this length as a sequence takes, while there are enough for all of the run.
            each = max(1, min(gap // length, left[length] // count))
            taken = min(count, left[length])
            for i in range(each):
                offset = capacity - gap + i * length
                put(length, taken, first)
            leave(gap - each * length, first, taken)
            if taken < count:
                leave(gap, first + taken, count - taken)
    return slots, sequences


def pieces(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """Every document's pieces: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``; ``part`` and ``nth``.

    ``nth`` numbers a task's pieces of one length, ``part`` is the task.  ``keep_ids`` adds ``ids``, the
    little-endian unsigned 32-bit ids themselves.
    """
    path = path or vocabulary_path(VOCABULARY)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        seen = np.zeros(capacity + 1, np.int64)
        part = TaskContext.get().partitionId()
        for whole in batches:
            for begin, ids, ends in coder(path).encode(whole.column(1)):
                batch = whole.slice(begin, len(ends) - 1)
                tail = np.array([end_id], "<u4").tobytes()
                rows, starts, lengths, crcs, payloads = [], [], [], [], []
                for row in range(batch.num_rows):
                    raw = ids[ends[row] : ends[row + 1]].tobytes() + tail
                    for start in range(0, len(raw) // 4, capacity):
                        cut = raw[4 * start : 4 * (start + capacity)]
                        rows.append(row)
                        starts.append(start)
                        lengths.append(len(cut) // 4)
                        crcs.append(zlib.crc32(cut))
                        if keep_ids:
                            payloads.append(cut)
                lengths = np.array(lengths, np.int64)
                order = np.argsort(lengths, kind="stable")
                first = np.searchsorted(lengths[order], lengths[order])
                nth = np.empty(len(order), np.int64)
                nth[order] = np.arange(len(order)) - first + seen[lengths[order]]
                np.add.at(seen, lengths, 1)
                starts = np.array(starts, np.int64)
                columns = [
                    batch.column(0).take(pa.array(rows, pa.int64())),
                    pa.array((starts // capacity).astype(np.int32)),
                    pa.array(starts),
                    pa.array(lengths),
                    pa.array(crcs, pa.int64()),
                    pa.array(np.full(len(order), part, np.int32)),
                    pa.array(nth),
                ]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"]
                if keep_ids:
                    columns.append(pa.array(payloads, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, part int, nth bigint"
    return texts(docs).mapInArrow(run, schema + ", ids binary" * keep_ids)


def pack(
    docs: DataFrame,
    capacity: int = CAPACITY,
    path: str | None = None,
    end_id: int = END_ID,
    keep_ids: bool = False,
) -> DataFrame:
    """Every piece with its ``sequence_id`` and ``offset``."""
    from pyspark.sql import Window

    spark = docs.sparkSession
    found = materialise(pieces(docs, capacity, path, end_id, keep_ids))
    # One row for each length and task; a length's tasks are few, however many pieces they hold.
    tasks = materialise(found.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")))
    counts = {r["length"]: r["n"] for r in tasks.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots, _ = plan(counts, capacity)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = tasks.select(
        F.col("length").alias("__length"),
        F.col("part").alias("__part"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__base"),
    )
    on = (F.col("length") == F.col("__length")) & (F.col("part") == F.col("__part"))
    # As many rows as lengths times tasks, which grows with the corpus: merged, not broadcast.
    ranked = found.join(base.hint("merge"), on).withColumn("rank", F.col("nth") + F.col("__base"))
    ranked = ranked.drop("__length", "__part", "__base", "part", "nth")
    shared = spark.sparkContext.broadcast(slots)  # bounded by the capacity, not by the documents
    del slots

    def place(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        table = np.array(sorted(shared.value), np.int64).reshape(-1, 5)
        code = table[:, 0] << 44 | table[:, 1]
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            slot = np.searchsorted(code, length << 44 | rank, "right") - 1
            sequence = table[slot, 3] + rank - table[slot, 1]
            keep = [n for n in batch.schema.names if n != "rank"]
            columns = [batch.column(n) for n in keep] + [pa.array(sequence), pa.array(table[slot, 4])]
            yield pa.RecordBatch.from_arrays(columns, [*keep, "sequence_id", "offset"])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema if f.name != "rank")
    return ranked.mapInArrow(place, f"{kept}, sequence_id bigint, offset bigint")
