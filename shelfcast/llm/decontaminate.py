"""Benchmark decontamination by SimHash of item-sized windows.

Each benchmark item is compared with the windows of a document that have as many words as the item.  A window's
SimHash sums its shingles' hash bits, each weighted by the shingle's letters.  The fingerprints of the items are
indexed by blocks of bits: two fingerprints within the radius differ in at most ``radius // blocks`` bits of some
block, so looking up every block of a window, its near values included, misses no item within the radius.  The
exact weighted similarity of the shingle multisets then decides.  A window that holds no shingle of an item of its size
has similarity zero; such windows are not fingerprinted.  A text of fewer words than an item is one window for it, and
the items that share a shingle with it and are not too long are compared by the exact similarity at once.

Items go to the tasks in passes of at most ``per_pass`` items, whatever the size of the benchmark; documents stay
where they are and are never shuffled.

Defined cases: words are lower-cased runs of letters, digits and underscores; an item of fewer words than a shingle
is one shingle as it stands; a null or wordless item or text matches nothing; equal items each match; of windows
that overlap, the most similar, then the first, is reported for each item.
"""

from __future__ import annotations

import functools
import re
from collections import Counter
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import filter_texts, texts

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 19
BLOCKS = 5
PER_PASS = 2000

_WORD = re.compile(r"\w+")
_BASE = 0x9E3779B97F4A7C15


def _weight(shingle: tuple[str, ...]) -> int:
    return sum(map(len, shingle))


def _signed_bits(shingles: list[tuple[str, ...]]):
    """A row for each shingle: its weight, negative where the hash has a zero bit."""
    import numpy as np
    import xxhash

    hashes = np.array([xxhash.xxh64_intdigest(" ".join(s).encode("utf-8", "replace")) for s in shingles], "<u8")
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.int64)
    return (2 * bits - 1) * np.array([_weight(s) for s in shingles], np.int64)[:, None]


def _packed(sums):
    import numpy as np

    return np.packbits(sums > 0, axis=-1, bitorder="little").view("<u8")[..., 0]


def shingles_of(words: list[str], size: int) -> list[tuple[str, ...]]:
    size = min(size, len(words))
    return list(zip(*(words[i:] for i in range(size)), strict=False)) if words else []


def similarity(a: Counter, b: Counter) -> float:
    """Weighted Jaccard similarity of two shingle multisets."""
    both = sum(_weight(s) * min(n, b[s]) for s, n in a.items() if s in b)
    whole = sum(_weight(s) * n for s, n in a.items()) + sum(_weight(s) * n for s, n in b.items()) - both
    return both / whole if whole else 0.0


class ItemIndex:
    """The items of one pass: their shingles, and their fingerprints by blocks of bits."""

    def __init__(self, items: list[tuple], shingle: int, least: float, radius: int, blocks: int):
        import itertools

        import numpy as np

        self.shingle, self.least, self.radius = shingle, least, radius
        self.items = [(key, _WORD.findall((text or "").lower())) for key, text in items]
        self.items = [(key, words) for key, words in self.items if words]
        self.counts = [Counter(shingles_of(words, shingle)) for _, words in self.items]
        self.vocabulary: dict[str, int] = {}
        for _, words in self.items:
            for word in words:
                self.vocabulary.setdefault(word, len(self.vocabulary) + 1)
        self.lengths = np.array([len(words) for _, words in self.items], np.int64)
        self.prints = np.array(
            [_packed(_signed_bits(shingles_of(words, shingle)).sum(axis=0)) for _, words in self.items], np.uint64
        )
        #: By shingle size: the codes of the items' shingles, ascending, and the sizes of the items with them.
        self.codes = {}
        #: Items by the code of each of their shingles, those of fewer words than ``shingle`` under none.
        self.holders: dict[int, list[int]] = {}
        self.weights = [sum(_weight(g) * n for g, n in c.items()) for c in self.counts]
        self.longest = max((len(words) for _, words in self.items), default=0)
        for n, (_, words) in enumerate(self.items):
            if len(words) >= shingle:
                ids = np.array([self.vocabulary[w] for w in words], np.int64)
                for code in set(self.code(ids, shingle).tolist()):
                    self.holders.setdefault(code, []).append(n)
        for size in sorted({min(shingle, len(words)) for _, words in self.items}):
            found: dict[int, set[int]] = {}
            for _, words in self.items:
                if min(shingle, len(words)) == size:
                    for code in self.code(np.array([self.vocabulary[w] for w in words], np.int64), size).tolist():
                        found.setdefault(code, set()).add(len(words))
            order = sorted(found)
            self.codes[size] = (np.array(order, np.uint64), [sorted(found[c]) for c in order])
        #: Sorted ``(block, item length, block value)`` codes with their items, near values included.
        edges = [round(64 * i / blocks) for i in range(blocks + 1)]
        self.blocks = [(a, (1 << (b - a)) - 1) for a, b in zip(edges, edges[1:], strict=False)]
        entries, owners = [], []
        for n, (shift, mask) in enumerate(self.blocks):
            width = mask.bit_length()
            flips = [
                sum(1 << i for i in chosen)
                for few in range(radius // blocks + 1)
                for chosen in itertools.combinations(range(width), few)
            ]
            values = ((self.prints >> np.uint64(shift)) & np.uint64(mask)).astype(np.int64)
            near = values[:, None] ^ np.array(flips, np.int64)[None, :]
            entries.append((n << 56 | self.lengths[:, None] << 24 | near).ravel())
            owners.append(np.repeat(np.arange(len(values)), len(flips)))
        entries, owners = np.concatenate(entries), np.concatenate(owners)
        order = np.argsort(entries, kind="stable")
        self.entries, self.owners = entries[order], owners[order]

    @staticmethod
    def code(ids, size: int):
        """A hash of each run of ``size`` word numbers."""
        import numpy as np

        count = len(ids) - size + 1
        out = np.zeros(max(count, 0), np.uint64)
        for i in range(size if count > 0 else 0):
            out = (out + ids[i : i + count].astype(np.uint64)) * np.uint64(_BASE)
        return out

    def starts(self, words: list[str]) -> dict[int, list[int]]:
        """By window size, the starts of the windows that hold a shingle of an item of that size."""
        import numpy as np

        ids = np.fromiter(map(self.vocabulary.get, words, [0] * len(words)), np.int64, len(words))
        known = np.flatnonzero(ids)
        out: dict[int, set[int]] = {}
        for size, (codes, sizes) in self.codes.items():
            if len(known) < size:
                continue
            # Runs of ``size`` known words end where the count of known words grew by ``size`` over as many words.
            ends = known[size - 1 :][known[size - 1 :] - known[: len(known) - size + 1] == size - 1]
            if not len(ends):
                continue
            begins = ends - size + 1
            code = np.zeros(len(begins), np.uint64)
            for i in range(size):
                code = (code + ids[begins + i].astype(np.uint64)) * np.uint64(_BASE)
            place = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
            for hit in np.flatnonzero(codes[place] == code).tolist():
                begin = int(begins[hit])
                for length in sizes[place[hit]]:
                    low, high = max(0, begin + size - length), min(begin, len(words) - length)
                    if low <= high:
                        out.setdefault(length, set()).update(range(low, high + 1))
        return {length: sorted(found) for length, found in out.items()}

    def longer(self, words: list[str]) -> list[tuple[int, float]]:
        """``(item, similarity)`` of the matching items that have more words than the whole text."""
        import numpy as np

        if not self.shingle <= len(words) < self.longest:
            return []
        ids = np.fromiter(map(self.vocabulary.get, words, [0] * len(words)), np.int64, len(words))
        held = {n for code in set(self.code(ids, self.shingle).tolist()) for n in self.holders.get(code, ())}
        held = sorted(n for n in held if self.lengths[n] > len(words))
        if not held:
            return []
        counts = Counter(shingles_of(words, self.shingle))
        weight = sum(_weight(g) * n for g, n in counts.items())
        near = [n for n in held if weight >= self.least * self.weights[n]]  # similarity is at most their ratio
        likes = ((n, similarity(counts, self.counts[n])) for n in near)
        return [(n, like) for n, like in likes if like >= self.least]

    def matches(self, words: list[str]) -> list[tuple[int, int, float]]:
        """``(item, first word, similarity)`` of the matching windows, overlapping ones of an item resolved."""
        import numpy as np

        found: dict[int, list[tuple[float, int]]] = {n: [(-like, 0)] for n, like in self.longer(words)}
        for length, starts in self.starts(words).items():
            size = min(self.shingle, length)
            runs = np.split(np.array(starts), np.flatnonzero(np.diff(starts) != 1) + 1)
            for run in runs:
                low, high = int(run[0]), int(run[-1])
                grams = shingles_of(words[low : high + length], size)
                sums = np.concatenate([np.zeros((1, 64), np.int64), np.cumsum(_signed_bits(grams), axis=0)])
                span = length - size + 1
                prints = _packed(sums[span:] - sums[:-span])
                pairs = set()
                for n, (shift, mask) in enumerate(self.blocks):
                    value = ((prints >> np.uint64(shift)) & np.uint64(mask)).astype(np.int64)
                    code = n << 56 | length << 24 | value
                    first = np.searchsorted(self.entries, code)
                    last = np.searchsorted(self.entries, code, "right")
                    for i in np.flatnonzero(last > first).tolist():
                        pairs.update((i, int(item)) for item in self.owners[first[i] : last[i]])
                for i, item in sorted(pairs):
                    if int(prints[i] ^ self.prints[item]).bit_count() > self.radius:
                        continue
                    like = similarity(Counter(grams[i : i + span]), self.counts[item])
                    if like >= self.least:
                        found.setdefault(item, []).append((-like, low + i))
        out = []
        for item, windows in sorted(found.items()):
            length, taken = len(self.items[item][1]), []
            for unlike, start in sorted(windows):
                if all(abs(start - other) >= length for other in taken):
                    taken.append(start)
                    out.append((item, start, -unlike))
        return out


_LAST: list = [None, None]


def _index(items: list[tuple], settings: tuple) -> ItemIndex:
    """The index of a pass, built once for each worker process."""
    if _LAST[0] != (items, settings):
        _LAST[:] = (items, settings), ItemIndex(items, *settings)
    return _LAST[1]


def item_passes(benchmark: DataFrame, per_pass: int) -> Iterator[list[tuple]]:
    """The items, about ``per_pass`` of them at a time."""
    passes = max(1, -(-benchmark.count() // per_pass))
    dealt = benchmark.select("item_id", "text").withColumn(
        "pass", F.pmod(F.xxhash64("item_id", "text"), F.lit(passes))
    )
    for number in range(passes):
        items = dealt.filter(F.col("pass") == number).select("item_id", "text").toArrow().to_pylist()
        yield sorted(((r["item_id"], r["text"]) for r in items), key=repr)


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    shingle: int = SHINGLE,
    least: float = SIMILARITY,
    radius: int = RADIUS,
    blocks: int = BLOCKS,
    per_pass: int = PER_PASS,
) -> DataFrame:
    """A row for each place where a document holds an item.

    ``doc_id``, ``item_id``, ``start`` and ``end`` (code points, end exclusive) and ``similarity``.
    """
    spark = docs.sparkSession
    doc_kind = docs.schema["doc_id"].dataType.simpleString()
    item_kind = benchmark.schema["item_id"].dataType.simpleString()
    schema = (
        f"doc_id {doc_kind}, item_id {item_kind}, start bigint, end bigint, similarity double"
    )
    settings = (shingle, least, radius, blocks)

    def one_pass(items: list[tuple]) -> DataFrame:
        shared = spark.sparkContext.broadcast(items)  # at most about ``per_pass`` items

        def run(batches: Iterator) -> Iterator:
            import pyarrow as pa

            index = _index(shared.value, settings)
            for batch in batches:
                if not index.items:
                    continue
                out: list[tuple] = []
                for row, text in enumerate(batch.column(1).to_pylist()):
                    words = _WORD.findall(text.lower())
                    if hits := index.matches(words):
                        places = [m.span() for m in _WORD.finditer(text)]
                        if len(places) != len(words):  # lower-casing made or undid a word's border
                            places = [m.span() for m in _WORD.finditer(text.lower())]
                        for item, start, like in hits:
                            key, item_words = index.items[item]
                            end = places[min(start + len(item_words), len(places)) - 1][1]
                            out.append((row, key, places[start][0], end, like))
                if out:
                    row, key, start, end, like = zip(*out, strict=True)
                    at = pa.array(row, pa.int64())
                    columns = [
                        batch.column(0).take(at),
                        pa.array(key),
                        pa.array(start, pa.int64()),
                        pa.array(end, pa.int64()),
                        pa.array(like, pa.float64()),
                    ]
                    names = ["doc_id", "item_id", "start", "end", "similarity"]
                    yield pa.RecordBatch.from_arrays(columns, names).cast(wanted)

        from pyspark.sql.pandas.types import to_arrow_schema
        from pyspark.sql.types import _parse_datatype_string

        wanted = to_arrow_schema(_parse_datatype_string(schema))
        return texts(docs).mapInArrow(run, schema)

    return functools.reduce(DataFrame.unionByName, map(one_pass, item_passes(benchmark, per_pass)))


def keep_clean(
    docs: DataFrame,
    benchmark: DataFrame,
    shingle: int = SHINGLE,
    least: float = SIMILARITY,
    radius: int = RADIUS,
    blocks: int = BLOCKS,
    per_pass: int = PER_PASS,
) -> DataFrame:
    """Rows of ``docs`` that hold no benchmark item, with all their columns, repeated rows too."""
    settings = (shingle, least, radius, blocks)

    def clean(items: list[tuple]) -> Callable:
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def keeps(texts_):
            import numpy as np

            index = _index(shared.value, settings)
            split = (_WORD.findall(text.lower()) for text in texts_.to_pylist())
            return np.array([not (index.items and index.matches(words)) for words in split], bool)

        return keeps

    for items in item_passes(benchmark, per_pass):
        docs = filter_texts(docs, clean(items))
    return docs
