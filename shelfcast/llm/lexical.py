"""Ranked lexical search over bit-sliced Bloom signatures.

Documents are dealt to blocks of similar size.  The signature of a document is a Bloom filter of its terms, and once more
of each (term, level) it reaches, where levels are numbers of occurrences.  A block stores its signatures bit-sliced:
one row of bits for each place of the filter, a column for each document.  The rows of a term's places, combined by AND,
are a bitmap of the documents that may hold it: never too few, sometimes too many.  The levels give the
most occurrences a document may have, its length is known, and so the weighted sum of a query's bitmaps bounds
its score from above.

A first pass over the blocks takes each query's documents with the highest bounds and rescores them exactly, which gives
a score that the last of the best documents reaches at least.  A second pass takes every document whose bound
reaches that score, equal ones too, and rescores it exactly; all others are provably excluded.  Rescoring reads only the
texts of those documents past a bitmap of fixed size; that counts the query's terms, and no text is shuffled.

Defined cases: null and empty texts, and texts without a term, hold none and are never found; rows that share an id are
documents of their own, and so are repeated rows, which get ranks one after the other; a null id comes last among equal
scores; an item is an id of the benchmark, whose distinct texts count as one query; an item without a term, or whose terms
no document holds, gives no rows; empty tables give no rows.  Other columns are not looked at.
"""

from __future__ import annotations

import dataclasses
import math
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import texts
from shelfcast.session import materialise

BEST = 20
LEVELS = (1, 2, 3, 5, 9, 17)  # occurrences from which a level counts
BITS = 16  # of the filter for each entry
PROBES = 8
STEP = 1.5  # between the sizes of filters
LARGEST = 1 << 22  # bits; the filters of longer documents are fuller, so that they are rescored more often
BLOCK = 1024  # documents
CELLS = 1 << 24  # bits of a block
SEED = 42
ITEMS = 10_000  # searched at a time
CHUNK = 128  # items whose bounds are held at a time
READ = 300  # texts read at a time
SLICE = 1 << 15  # entries of filters made at a time
WORDS = 1 << 16  # of the bitmap that texts must pass to be rescored
_LEVEL_SALT = np.uint64(0x9E3779B97F4A7C15)

#: Terms are the maximal runs of ASCII letters and digits and of all that is not ASCII; A-Z are lowered.
_PLAIN = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 or 48 <= b <= 57 else 32 for b in range(256)
)


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(_PLAIN).split()


def counted(batch) -> tuple:
    """Of some texts: the distinct terms, and for each term a text holds the text, the term's number and its
    occurrences, by text; then the terms of each text with repeats.
    """
    import pyarrow as pa
    import pyarrow.compute as pc

    whole = pa.concat_arrays([pc.fill_null(batch, "").cast(pa.large_string())])
    offsets = np.frombuffer(whole.buffers()[1], np.int64)[whole.offset : whole.offset + len(whole) + 1]
    data = whole.buffers()[2].to_pybytes() if whole.buffers()[2] else b""
    plain = data[offsets[0] : offsets[-1]].translate(_PLAIN)
    begins = pa.py_buffer((offsets - offsets[0]).tobytes())
    split = pc.ascii_split_whitespace(pa.LargeStringArray.from_buffers(len(whole), begins, pa.py_buffer(plain)))
    owner = np.repeat(np.arange(len(whole)), pc.list_value_length(split).to_numpy(zero_copy_only=False))
    coded = split.flatten().dictionary_encode()
    code = coded.indices.to_numpy().astype(np.int64)
    words = coded.dictionary.cast(pa.large_binary()).to_pylist()
    if b"" in words:  # where a text begins or ends with other signs
        real = code != words.index(b"")
        owner, code = owner[real], code[real]
    pairs, times = np.unique(owner * len(words) + code, return_counts=True)
    size = max(1, len(words))
    return words, pairs // size, pairs % size, times, np.bincount(owner, minlength=len(whole))


def hashes(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.array([xxhash.xxh64_intdigest(w, SEED) for w in words], np.uint64)


def probes(hashed: np.ndarray, level: np.ndarray | int, bits: np.ndarray | int) -> np.ndarray:
    """The places of an entry in a filter, a row for each entry."""
    mixed = hashed ^ (np.asarray(level, np.uint64) * _LEVEL_SALT)
    mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(29)
    first, step = mixed & np.uint64(0xFFFFFFFF), (mixed >> np.uint64(32)) | np.uint64(1)
    return ((first[:, None] + np.arange(PROBES, dtype=np.uint64) * step[:, None]) % np.atleast_1d(bits).astype(np.uint64)[:, None]).astype(np.int64)


def filter_bits(entries: int) -> int:
    """Bits of the filter for so many entries: the next of the sizes, whole bytes."""
    wanted = min(LARGEST, BITS * max(entries, 4))
    return -(-math.ceil(STEP ** math.ceil(math.log(wanted, STEP) - 1e-9)) // 8) * 8


def signatures(owner: np.ndarray, hashed: np.ndarray, times: np.ndarray, texts: int) -> tuple[list[int], list[bytes]]:
    """Bits of each text's filter, and the filter; of the hash and occurrences of each term a text holds."""
    sizes = sum(np.bincount(owner[times >= least], minlength=texts) for least in LEVELS)
    bits = np.array([filter_bits(int(n)) for n in sizes], np.int64)
    ends = np.cumsum(bits)
    starts = ends - bits
    flat = np.zeros(ends[-1] if texts else 0, bool)
    for level, least in enumerate(LEVELS):
        some = np.flatnonzero(times >= least)
        for begin in range(0, len(some), SLICE):
            part = some[begin : begin + SLICE]
            of = owner[part]
            flat[starts[of][:, None] + probes(hashed[part], level, bits[of])] = True
    packed = np.packbits(flat, bitorder="little").tobytes()
    return bits.tolist(), [packed[a // 8 : b // 8] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]


class Block:
    """Documents of one filter size, as they come in."""

    def __init__(self, bits: int):
        self.bits, self.ids, self.prints, self.lengths, self.filters = bits, [], [], [], []

    def add(self, doc, print_: int, length: int, filter_: bytes) -> None:
        self.ids.append(doc)
        self.prints.append(print_)
        self.lengths.append(length)
        self.filters.append(filter_)

    def full(self) -> bool:
        return len(self.ids) >= BLOCK or len(self.ids) * self.bits >= CELLS

    def row(self, kind) -> list:
        import pyarrow as pa

        filters = np.frombuffer(b"".join(self.filters), np.uint8).reshape(len(self.ids), -1)
        places = np.unpackbits(filters, axis=1, bitorder="little").T
        return [
            pa.array([self.ids], pa.list_(kind)),
            pa.array([self.prints], pa.list_(pa.int64())),
            pa.array([self.lengths], pa.list_(pa.int64())),
            pa.array([self.bits], pa.int32()),
            pa.array([np.packbits(places, axis=1, bitorder="little").tobytes()], pa.binary()),
            pa.array([len(self.ids)], pa.int64()),
            pa.array([sum(self.lengths)], pa.int64()),
        ]


def build_index(docs: DataFrame) -> DataFrame:
    """A row for each block: ids, text hashes, lengths, and the slices of the signatures; a written table."""
    names = ["ids", "prints", "lengths", "bits", "slices", "n_docs", "n_terms"]
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import xxhash

        open_: dict[int, Block] = {}
        kind = None
        for whole in batches:
            kind = whole.schema.field(0).type
            for begin in range(0, whole.num_rows, READ):
                part = whole.slice(begin, READ)
                words, owner, code, times, lengths = counted(part.column(1))
                bits, filters = signatures(owner, hashes(words)[code], times, part.num_rows)
                for i, (doc, text) in enumerate(zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True)):
                    if lengths[i]:
                        block = open_.setdefault(bits[i], Block(bits[i]))
                        print_ = xxhash.xxh64_intdigest(text.encode("utf-8", "replace"), SEED)
                        block.add(doc, print_ - ((print_ >> 63) << 64), int(lengths[i]), filters[i])
                        if block.full():
                            yield pa.RecordBatch.from_arrays(open_.pop(bits[i]).row(kind), names)
        for block in open_.values():
            yield pa.RecordBatch.from_arrays(block.row(kind), names)

    schema = (
        f"ids array<{kind}>, prints array<bigint>, lengths array<bigint>, bits int, slices binary, "
        "n_docs bigint, n_terms bigint"
    )
    return materialise(texts(docs).mapInArrow(run, schema))


@dataclasses.dataclass
class Queries:
    """Items with their terms, and what the whole table says about these."""

    items: list
    terms: list[bytes]
    item: np.ndarray  # of each (item, term), by item
    term: np.ndarray
    times: np.ndarray
    n_docs: int = 0
    n_terms: int = 0
    weights: np.ndarray | None = None

    @classmethod
    def of(cls, rows: list) -> Queries:
        """From rows of an id and a list of texts."""
        found = [(item, Counter(t for text in texts for t in terms_of(text))) for item, texts in rows]
        found = [(item, times) for item, times in found if times]
        terms = sorted(set().union(*(times for _, times in found)))
        number = {t: i for i, t in enumerate(terms)}
        entries = [(i, number[t], n) for i, (_, times) in enumerate(found) for t, n in sorted(times.items())]
        columns = np.array(entries, np.int64).reshape(-1, 3).T
        return cls([item for item, _ in found], terms, *columns)

    def weigh(self, n_docs: int, n_terms: int, holders: np.ndarray) -> None:
        self.n_docs, self.n_terms = n_docs, n_terms
        weights = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(n) + 1))) for n in holders]
        self.weights = np.array(weights, np.int64)

    def shares(self, often: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """(1000000000 tf) div (1000 tf + 12 m), never less for more occurrences."""
        m = 75 + 25 * lengths * self.n_docs // self.n_terms
        return 1000000000 * often // np.maximum(1000 * often + 12 * m, 1)

    def scores(self, values: np.ndarray) -> np.ndarray:
        """Of every item, from the value of every term."""
        starts = np.searchsorted(self.item, np.arange(len(self.items)))
        return np.add.reduceat(values[self.term] * self.times, starts)

    def bounds(self, bits: int, slices: bytes, lengths: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Upper bounds of the scores of a block's documents: the number of the first item, and a row for each item."""
        rows = np.frombuffer(slices, np.uint8).reshape(bits, -1)
        most = [least - 1 for least in LEVELS[1:]]
        steps = [self.shares(np.minimum(n, lengths), lengths) for n in most] + [self.shares(lengths, lengths)]
        table = np.stack([np.zeros(len(lengths), np.int64), *steps])
        hashed = hashes(self.terms)
        for begin in range(0, len(self.items), CHUNK):
            low, high = np.searchsorted(self.item, [begin, begin + CHUNK])
            terms, place = np.unique(self.term[low:high], return_inverse=True)
            held = np.bitwise_and.reduce(rows[probes(hashed[terms], 0, bits)], axis=1)
            some = held.any(axis=1)
            reached = np.zeros((len(terms), len(lengths)), np.uint8)
            left, held = np.flatnonzero(some), held[some]
            for level in range(len(LEVELS)):
                if level:
                    held = held & np.bitwise_and.reduce(rows[probes(hashed[terms[left]], level, bits)], axis=1)
                    again = held.any(axis=1)
                    left, held = left[again], held[again]
                if not len(left):
                    break
                reached[left] += np.unpackbits(held, axis=1, count=len(lengths), bitorder="little")
            value = np.take_along_axis(table, reached, axis=0) * self.weights[terms, None]
            item = self.item[low:high] - begin
            size = min(CHUNK, len(self.items) - begin)
            found = np.zeros((size, len(lengths)), np.int64)
            lit = np.flatnonzero(some[place])
            for i, t, n in zip(item[lit].tolist(), place[lit].tolist(), self.times[low:high][lit].tolist(), strict=True):
                found[i] += value[t] if n == 1 else value[t] * n
            yield begin, found


def holders(docs: DataFrame, queries: Queries) -> np.ndarray:
    """Documents that hold each term of the queries, exactly."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        number = {t: i for i, t in enumerate(queries.terms)}
        total = np.zeros(len(number), np.int64)
        for whole in batches:
            for begin in range(0, whole.num_rows, READ):
                words, _, code, _, _ = counted(whole.column(1).slice(begin, READ))
                asked = np.array([number.get(w, -1) for w in words], np.int64)
                of = asked[code] if len(words) else asked
                total += np.bincount(of[of >= 0], minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["term", "n"])

    found = texts(docs).mapInArrow(run, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(len(queries.terms), np.int64)
    total[found["term"].to_numpy()] = found["n"].to_numpy()
    return total


def bounded(index: DataFrame, queries: Queries, least: np.ndarray | None, best: int) -> DataFrame:
    """``item`` (number), ``doc_id``, ``print`` and ``bound`` of the documents whose bound reaches the item's ``least``.

    Without ``least``, those that may be among the ``best`` by their bounds, at least as many as there are.
    """
    kind = index.schema["ids"].dataType.elementType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        floor = np.ones(len(queries.items), np.int64) if least is None else np.maximum(least, 1)
        top = np.zeros((len(queries.items), best), np.int64)
        for batch in batches:
            ids, prints, sizes, bits, slices = batch.columns[:5]
            for i in range(batch.num_rows):
                lengths = sizes[i].values.to_numpy()
                names, codes = ids[i].values, prints[i].values
                for begin, found in queries.bounds(bits[i].as_py(), slices[i].as_buffer(), lengths):
                    rows = slice(begin, begin + len(found))
                    if least is None:
                        most = found if found.shape[1] <= best else -np.partition(-found, best - 1, axis=1)[:, :best]
                        both = np.hstack([top[rows], most])
                        top[rows] = -np.partition(-both, best - 1, axis=1)[:, :best]
                        floor[rows] = np.maximum(1, top[rows].min(axis=1))
                    item, doc = np.nonzero(found >= floor[rows, None])
                    if len(item):
                        columns = [pa.array(item + begin), names.take(pa.array(doc)), codes.take(pa.array(doc))]
                        columns.append(pa.array(found[item, doc]))
                        yield pa.RecordBatch.from_arrays(columns, ["item", "doc_id", "print", "bound"])

    blocks = index.select("ids", "prints", "lengths", "bits", "slices")
    return blocks.mapInArrow(run, f"item bigint, doc_id {kind}, print bigint, bound bigint")


def rescored(docs: DataFrame, queries: Queries, pairs: DataFrame) -> DataFrame:
    """``item`` (number), ``doc_id`` and the exact ``score`` of the documents that ``pairs`` name; a written table."""
    pairs = materialise(pairs.select("item", "doc_id", "print").distinct())
    word = F.shiftrightunsigned("print", 6).bitwiseAND(F.lit(WORDS - 1)).alias("word")
    bit = F.expr("shiftleft(1L, cast(print & 63 AS int))")
    passed = np.zeros(WORDS, np.int64)
    for row in pairs.groupBy(word).agg(F.bit_or(bit)).collect():  # at most ``WORDS`` rows
        passed[row[0]] = row[1]
    passes = passed.view(np.uint64)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def read(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import xxhash

        number = {t: i for i, t in enumerate(queries.terms)}
        for whole in batches:
            for begin in range(0, whole.num_rows, READ):
                part = whole.slice(begin, READ)
                prints = [xxhash.xxh64_intdigest(t.encode("utf-8", "replace"), SEED) for t in part.column(1).to_pylist()]
                code = np.array(prints, np.uint64)
                at = ((code >> np.uint64(6)) & np.uint64(WORDS - 1)).astype(np.int64)
                hit = pa.array((passes[at] >> (code & np.uint64(63)) & np.uint64(1)).astype(bool))
                part, code = part.filter(hit), code[hit.to_numpy(zero_copy_only=False)]
                if not part.num_rows:
                    continue
                words, owner, term, times, lengths = counted(part.column(1))
                asked = np.array([number.get(w, -1) for w in words], np.int64)
                of = asked[term] if len(words) else asked
                owner, of, times = owner[of >= 0], of[of >= 0], times[of >= 0]
                ends = pa.array(np.searchsorted(owner, np.arange(part.num_rows + 1)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(ends, pa.array(x.astype(np.int64))) for x in (of, times)]
                columns = [part.column(0), pa.array(code.view(np.int64)), pa.array(lengths), *lists]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "print", "length", "terms", "times"])

    def score(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            asked, length, terms, times = (batch.column(c) for c in ("items", "length", "terms", "times"))
            ids, items, found = [], [], []
            for i in range(batch.num_rows):
                values = np.zeros(len(queries.terms), np.int64)
                held = terms[i].values.to_numpy()
                size = np.int64(length[i].as_py())
                values[held] = queries.weights[held] * queries.shares(times[i].values.to_numpy(), size)
                wanted = asked[i].values.to_numpy()
                ids.append(np.full(len(wanted), i))
                items.append(wanted)
                found.append(queries.scores(values)[wanted])
            if ids:
                row, item, score = (np.concatenate(x) for x in (ids, items, found))
                real = score > 0
                columns = [pa.array(item[real]), batch.column("doc_id").take(pa.array(row[real])), pa.array(score[real])]
                yield pa.RecordBatch.from_arrays(columns, ["item", "doc_id", "score"])

    schema = f"doc_id {kind}, print bigint, length bigint, terms array<bigint>, times array<bigint>"
    counts = texts(docs).mapInArrow(read, schema)
    # A document has at most as many items as are searched at a time.
    wanted = pairs.groupBy(F.col("doc_id").alias("id"), F.col("print").alias("code")).agg(
        F.collect_list("item").alias("items")
    )
    same = (F.col("print") == F.col("code")) & F.col("doc_id").eqNullSafe(F.col("id"))
    joined = counts.join(wanted, same).select("doc_id", "items", "length", "terms", "times")
    return materialise(joined.mapInArrow(score, f"item bigint, doc_id {kind}, score bigint"))


def ranked(scores: DataFrame, best: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return scores.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)


def search_block(docs: DataFrame, index: DataFrame, queries: Queries, best: int = BEST) -> DataFrame:
    """``item`` (number), ``rank``, ``doc_id`` and ``score`` of each item's best documents."""
    totals = index.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    queries.weigh(*totals, holders(docs, queries))
    likely = bounded(index, queries, None, best)
    order = Window.partitionBy("item").orderBy(F.desc("bound"), "print", "doc_id")
    likely = likely.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= best)
    first = ranked(rescored(docs, queries, likely), best).groupBy("item")
    least = np.zeros(len(queries.items), np.int64)
    for item, count, score in first.agg(F.count("score"), F.min("score")).collect():  # a row for each item
        least[item] = score if count == best else 0
    return ranked(rescored(docs, queries, bounded(index, queries, least, best)), best)


def search(docs: DataFrame, items: DataFrame, best: int = BEST, index: DataFrame | None = None) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id`` and ``score``: for each item its best documents with a score above zero."""
    index = build_index(docs) if index is None else index
    spark = docs.sparkSession
    kinds = [x.schema[c].dataType.simpleString() for x, c in ((items, "item_id"), (docs, "doc_id"))]
    found = spark.createDataFrame([], f"item_id {kinds[0]}, rank int, doc_id {kinds[1]}, score bigint")
    asked = items.groupBy("item_id").agg(F.array_sort(F.collect_set("text")).alias("texts")).orderBy("item_id")
    rows = asked.toLocalIterator()
    while block := [tuple(row) for row in islice(rows, ITEMS)]:
        queries = Queries.of(block)
        if not queries.items:
            continue
        names = spark.createDataFrame(list(enumerate(queries.items)), f"item bigint, item_id {kinds[0]}")
        best_of = search_block(docs, index, queries, best).join(F.broadcast(names), "item")  # at most ``ITEMS``
        found = found.unionByName(best_of.select("item_id", "rank", "doc_id", "score"))
    return found
