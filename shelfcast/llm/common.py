"""What the text operators share: table access, row filters, the public tokenizer."""

from __future__ import annotations

import functools
import json
import os
import sys
from collections.abc import Callable, Iterable, Iterator
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.session import materialise

if TYPE_CHECKING:
    import numpy as np
    import pyarrow as pa

#: Of the regular expression ``[\x20\x09-\x0D]``.
WHITE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """Only ``doc_id`` and ``text`` (null: empty), whatever else the table holds."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


def fold(modulus: int) -> Column:
    """crc32 of the id as text, by ``modulus``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(modulus))


def without(docs: DataFrame, dropped: DataFrame, how: str = "left_anti") -> DataFrame:
    """Rows of ``docs`` that match no row of ``dropped`` in all its columns, nulls matching nulls.

    What is dropped grows with the documents, so it is never broadcast: both sides are sorted and merged.
    """
    other = dropped.select(*(F.col(c).alias(f"__dropped_{c}") for c in dropped.columns)).hint("merge")
    on = [F.col(c).eqNullSafe(F.col(f"__dropped_{c}")) for c in dropped.columns]
    return docs.join(other, functools.reduce(lambda a, b: a & b, on), how)


def keep_rows(docs: DataFrame, decisions: DataFrame, key: Column) -> DataFrame:
    """Rows of ``docs`` whose ``doc_id`` and ``key`` are kept; of rows that share both, the longest text.

    ``decisions`` has ``doc_id``, ``key``, ``kept`` and ``copies`` (rows that share both).
    """
    names = ["doc_id", F.col("key").alias("__key")]
    decisions = materialise(decisions.select("doc_id", "key", "kept", "copies"))
    dropped = materialise(decisions.filter("not kept").select(*names))
    repeated = materialise(decisions.filter("kept and copies > 1").select(*names))
    left = without(docs.withColumn("__key", key), dropped)
    if repeated.isEmpty():
        return left.select(*docs.columns)
    again = without(left, repeated, "left_semi").groupBy("doc_id", "__key")
    longest = F.max_by(F.struct(*docs.columns), F.struct(F.length("text"), "text"))
    once = again.agg(longest.alias("row")).select("row.*")
    return without(left, repeated).select(*docs.columns).unionByName(once)


def filter_texts(docs: DataFrame, keeps: Callable[[pa.Array], np.ndarray]) -> DataFrame:
    """Rows of ``docs`` whose text ``keeps`` marks, with all their columns; nothing is shuffled.

    ``keeps`` runs in the tasks, on some texts at a time (null: empty), and returns a boolean for each.
    """
    place = docs.columns.index("text")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        for whole in batches:
            for begin in range(0, whole.num_rows, 1000):
                batch = whole.slice(begin, 1000)
                yield batch.filter(pa.array(keeps(pc.fill_null(batch.column(place), ""))))

    return docs.mapInArrow(run, docs.schema)


def smallest_hashes(rows: DataFrame, group: str, code: str, most: Column) -> DataFrame:
    """At most ``most`` rows of each group, those with the smallest ``code``, a 64-bit hash that no two rows share.

    Hashes are spread evenly, so the share of them that is sure to hold the smallest is known from the group's
    size; only that share is ranked, and no group meets whole in one task.  ``group`` has few values.
    """
    total = materialise(rows.groupBy(F.col(group).alias("__group")).agg(F.count(F.lit(1)).alias("__n")))
    place = F.col(code).cast("double") / 2.0**64 + 0.5
    near = rows.join(F.broadcast(total), F.col(group) == F.col("__group"))
    near = near.filter(place * F.col("__n") <= 2 * most + 50)
    ranked = near.withColumn("__rank", F.row_number().over(Window.partitionBy(group).orderBy(code)))
    return ranked.filter(F.col("__rank") <= most).drop("__group", "__n", "__rank")


def vocabulary_path(name: str) -> str:
    """Place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Coder:
    """Token ids of whole texts through the tokenizers library, each distinct word of a batch encoded once.

    For a tokenizer whose pre-tokens never hold white space, nor letters or digits beside other signs, and that
    lower-cases: its ids of a text are then the ids of the text's words, one after the other, and those of a word with
    signs behind it are the word's and the signs'.  Special tokens' strings in a text are ordinary text.  Words
    that come twice in a batch are remembered; beyond ``limit`` the older ones go first.
    """

    SIGNS = ".,;:!?|*%$#&()"

    def __init__(self, path: str, limit: int = 200_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            plan = json.load(file)
        self.tokenizer = Tokenizer.from_str(json.dumps(plan))
        self.tokenizer.encode_special_tokens = True
        steps = (plan["normalizer"] or {}).get("normalizers", [])
        #: Without the normaliser, for Latin words, which NFC leaves alone and ``str.lower`` lowers as it does.
        self.latin = None
        if [x["type"] for x in steps] == ["NFC", "Replace", "Lowercase"]:
            self.latin = Tokenizer.from_str(json.dumps(plan | {"normalizer": None}))
            self.latin.encode_special_tokens = True
        self.limit, self.known, self.older = limit, {}, {}

    def ids(self, words: list[str]) -> list[bytes]:
        """Ids of each word."""
        if not self.latin:
            return self._joined(self.tokenizer, words)
        out: list[bytes] = [b""] * len(words)
        latin = [i for i, w in enumerate(words) if w.isascii() or max(w) < "\u0250"]
        rest = sorted(set(range(len(words))).difference(latin))
        for i, ids in zip(latin, self._joined(self.latin, [words[i].lower() for i in latin]), strict=True):
            out[i] = ids
        for i, ids in zip(rest, self._joined(self.tokenizer, [words[i] for i in rest]), strict=True):
            out[i] = ids
        return out

    @staticmethod
    def _joined(tokenizer, words: list[str]) -> list[bytes]:
        """Many words are encoded as one text, with a mark between them that none of them holds."""
        import numpy as np

        used = set("".join(words))
        mark = next(c for c in map(chr, range(0x2190, 0x2600)) if c not in used)
        *lead, code = tokenizer.encode(mark, add_special_tokens=False).ids
        parts = [words[begin : begin + 500] for begin in range(0, len(words), 500)]
        texts = [f" {mark} ".join([*part, ""]) for part in parts]
        out = []
        for part, coded in zip(parts, tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            found = np.array(coded.ids, "<u4")
            ends = np.flatnonzero(found == code)
            if len(ends) != len(part):  # the mark's last id is also one of a word's
                each = tokenizer.encode_batch_fast(part, add_special_tokens=False)
                out += [np.array(e.ids, "<u4").tobytes() for e in each]
                continue
            raw = found.tobytes()
            starts = np.concatenate([[0], ends[:-1] + 1]) * 4
            out += [raw[a:b] for a, b in zip(starts.tolist(), ((ends - len(lead)) * 4).tolist(), strict=True)]
        return out

    def _by_word(self, words: pa.Array) -> list[bytes]:
        """Ids of each of the distinct ``words``."""
        import numpy as np
        import pyarrow.compute as pc

        stem = pc.ascii_rtrim(words, characters=self.SIGNS)
        # A capital I with a dot becomes two code points, the second one a sign.
        ends = pc.and_not(pc.match_substring_regex(stem, r"[\p{L}\p{N}]$"), pc.ends_with(stem, "İ"))
        stem = pc.ascii_lower(pc.if_else(ends, stem, words))
        coded = stem.dictionary_encode()
        stems, which = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        found = list(map(self.known.get, stems))
        if gaps := [i for i, ids in enumerate(found) if ids is None]:
            new = []
            for i in gaps:
                found[i] = self.older.get(stems[i])
                new += [i] * (found[i] is None)
            for i, ids in zip(new, self.ids([stems[i] for i in new]), strict=True):
                found[i] = ids
            times = np.bincount(which, minlength=len(stems))
            self.known.update((stems[i], found[i]) for i in gaps if times[i] > 1)
            if len(self.known) > self.limit:
                self.older, self.known = self.known, {}
        out = [found[i] for i in which.tolist()]
        over = (pc.binary_length(words).to_numpy() - pc.binary_length(stem).to_numpy()).astype(np.int64)
        for size in np.unique(over[over > 0]).tolist():
            rows = np.flatnonzero(over == size)
            tails = pc.utf8_slice_codeunits(words.take(rows), -size).dictionary_encode()
            ids = self.ids(tails.dictionary.to_pylist())
            for row, tail in zip(rows.tolist(), tails.indices.to_pylist(), strict=True):
                out[row] += ids[tail]
        return out

    def encode(self, batch: pa.Array | Iterable[str | None], rows: int = 500) -> Iterator[tuple]:
        """``(first text, ids, ends)`` of every ``rows`` texts: the unsigned 32-bit ids of all of them, one after the
        other, and where each text's begin and the last's end.
        """
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        if not isinstance(batch, pa.Array):
            batch = pa.array(batch, pa.large_string())
        split = pc.ascii_split_whitespace(pc.fill_null(batch.cast(pa.large_string()), ""))
        counts = pc.list_value_length(split).to_numpy(zero_copy_only=False)
        coded = split.flatten().dictionary_encode()
        del split
        found = self._by_word(coded.dictionary)
        ids = np.frombuffer(b"".join(found), "<u4")
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        first = np.cumsum(size) - size
        place = np.concatenate([[0], np.cumsum(counts)])
        for begin in range(0, len(batch), rows):
            last = min(begin + rows, len(batch))
            which = coded.indices.slice(place[begin], place[last] - place[begin]).to_numpy()
            ends = np.concatenate([[0], np.cumsum(size[which])])
            at = np.repeat(first[which] - ends[:-1], size[which])
            at += np.arange(len(at))
            yield begin, ids[at], ends[place[begin : last + 1] - place[begin]]


def once_a_process(limit: int) -> Callable:
    """Remembers the last ``limit`` results, like ``functools.lru_cache``, in a worker process across its tasks.

    Every task gets a copy of its own of this package's functions, so what they share is kept in ``sys``, by name.
    """

    def wrap(make: Callable) -> Callable:
        @functools.wraps(make)
        def get(*key):
            results = vars(sys).setdefault("shelfcast_kept", {}).setdefault(make.__qualname__, {})
            result = results.pop(key) if key in results else make(*key)
            while len(results) >= limit:
                del results[next(iter(results))]
            results[key] = result
            return result

        return get

    return wrap


@once_a_process(2)
def coder(path: str) -> Coder:
    """One coder for each worker process."""
    return Coder(path)
