"""Language identification by segmentation-marginalised unigrams.

A language is a distribution over the pieces of a fixed public vocabulary.  A word's probability is the sum over
all its segmentations into pieces, which the forward algorithm takes; a text's is the product over its words.  The
piece probabilities are fitted by expectation maximisation (forward-backward counts) on the word counts of a
bounded sample: at most ``per_language`` distinct texts of each language, those with the smallest text hash.
Every text is scored whole.  Words are runs of letters, lower-cased; a letter that the vocabulary lacks is a
piece of its own, equally unlikely in each language.

Defined cases: a text that is null or has no letter is ``und`` with score 0; without training rows every text
with a letter is ``und`` with score 0 too; of languages with equal probability the first by name is predicted; rows
without a language do not train; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import filter_texts, fold, once_a_process, smallest_hashes, texts, vocabulary_path
from shelfcast.session import materialise

if TYPE_CHECKING:
    import pyarrow as pa

VOCABULARY = "piece_bpe_32k.model"
PER_LANGUAGE = 800
ROUNDS = 3
LONGEST = 12  # code points of a piece; the vocabulary's longer ones are not used
FIT_WORD = 64  # code points of a word of the sample; longer ones do not train, but are scored like any other
SMOOTHING = 0.1
UNDETERMINED = "und"

_WORD = re.compile(r"[^\W\d_]+")
_PRIME = 0x9E3779B97F4A7C15


def words_of(text: str | None) -> list[str]:
    """Runs of letters, each with the mark that begins a word."""
    found = _WORD.findall((text or "").lower())
    return [w for w in found if w.isalpha() or any(map(str.isalpha, w))]


class Pieces:
    """The vocabulary's pieces of at most ``longest`` code points, found by hash in arrays of words."""

    def __init__(self, path: str, longest: int = LONGEST):
        import numpy as np
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        every = (model.id_to_piece(i) for i in range(model.get_piece_size()) if not model.is_control(i))
        self.pieces = sorted({p.lower() for p in every if len(p) <= longest and not p.startswith("<0x")})
        self.longest = longest
        with np.errstate(over="ignore"):
            hashes = np.array([self._hash(p) for p in self.pieces], np.uint64)
        order = np.argsort(hashes)
        self.sorted, self.which = hashes[order], order.astype(np.int64)
        self.unknown = len(self.pieces)

    @staticmethod
    def _hash(piece: str):
        import numpy as np

        value = np.uint64(0)
        for c in piece:
            value = (value + np.uint64(ord(c) + 1)) * np.uint64(_PRIME)
        return value

    def _find(self, hashes):
        """Index of the piece, or -1."""
        import numpy as np

        place = np.minimum(np.searchsorted(self.sorted, hashes), len(self.sorted) - 1)
        return np.where(self.sorted[place] == hashes, self.which[place], -1)

    def spans(self, words: list[str]) -> Iterator[tuple]:
        """For words of one length: ``(end, size, piece)`` of every place where pieces can stand, by end.

        ``piece`` has an entry for each word: the index of its piece there, or -1; a single code point without a
        piece is ``unknown``.
        """
        import numpy as np

        length = len(words[0])
        points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), length)
        points = np.ascontiguousarray(points.T).astype(np.uint64) + np.uint64(1)
        begun: list = []  # hashes of the pieces that began up to ``longest`` places before
        for end in range(1, length + 1):
            begun = [*begun[-self.longest + 1 :], np.zeros(len(words), np.uint64)]
            for i, value in enumerate(begun):
                begun[i] = (value + points[end - 1]) * np.uint64(_PRIME)
            for i, value in enumerate(begun):
                size = len(begun) - i
                piece = self._find(value)
                if size == 1:
                    piece = np.where(piece < 0, self.unknown, piece)
                if (piece >= 0).any():
                    yield end, size, piece


def _by_length(words: list[str], most: int = 1 << 18) -> Iterator[list[int]]:
    """Indexes of words, grouped by length, at most ``most`` code points or one word at a time."""
    groups: dict[int, list[int]] = {}
    for i, word in enumerate(words):
        groups.setdefault(len(word), []).append(i)
    for length, rows in groups.items():
        step = max(1, most // max(1, length))
        yield from (rows[b : b + step] for b in range(0, len(rows), step))


def log_probabilities(words: list[str], pieces: Pieces, weights):
    """Logarithm of each word's probability in each language, all segmentations summed."""
    import numpy as np

    kinds = weights.shape[1]
    table = np.vstack([weights, np.zeros((1, kinds))])  # index -1: no piece
    out = np.zeros((len(words), kinds))
    for rows in _by_length(words):
        size = len(rows)
        forward = {0: np.ones((size, kinds))}
        scale = np.zeros((size, kinds))
        at, total = 0, None
        length = len(words[rows[0]])
        for end, width, piece in pieces.spans([words[i] for i in rows]):
            if end != at:
                if at:
                    forward[at] = total
                    forward.pop(at - pieces.longest, None)
                    if at % 16 == 0:  # long words would leave the range of floats
                        for k in forward:
                            forward[k] = forward[k] / total
                        scale += np.log(total)
                at, total = end, np.zeros((size, kinds))
            total += forward[end - width] * table[piece]
        out[rows] = np.log(total) + scale if length else 0.0
    return out


def fit(words: list[str], counts, pieces: Pieces, rounds: int = ROUNDS):
    """Piece probabilities by language, a column each, from word counts by language."""
    import numpy as np

    kinds = counts.shape[1]
    size = pieces.unknown + 1
    weights = np.full((size, kinds), 1.0 / size)
    groups = []
    for rows in _by_length(words, 1 << 16):
        spans = list(pieces.spans([words[i] for i in rows]))
        groups.append((rows, [(e, w, p.astype(np.int32)) for e, w, p in spans]))
    for _ in range(rounds):
        expected = np.full((size + 1, kinds), SMOOTHING)
        table = np.vstack([weights, np.zeros((1, kinds))])
        for rows, spans in groups:
            length = len(words[rows[0]])
            forward = np.zeros((length + 1, len(rows), kinds))
            backward = np.zeros((length + 1, len(rows), kinds))
            forward[0] = backward[length] = 1.0
            for end, width, piece in spans:
                forward[end] += forward[end - width] * table[piece]
            for end, width, piece in reversed(spans):
                backward[end - width] += backward[end] * table[piece]
            whole = forward[length]
            share = np.divide(counts[rows], whole, out=np.zeros_like(whole), where=whole > 1e-290)
            for end, width, piece in spans:
                use = forward[end - width] * table[piece] * backward[end] * share
                for kind in range(kinds):
                    expected[:, kind] += np.bincount(piece + 1, use[:, kind], size + 1)[np.r_[1 : size + 1, 0]]
        weights = expected[:size] / expected[:size].sum(axis=0)
        weights[pieces.unknown] = weights[pieces.unknown].min()
    return weights


@once_a_process(2)
def _pieces(path: str, longest: int) -> Pieces:
    return Pieces(path, longest)


class Scorer:
    """Scores texts, each distinct word once; ``limit`` bounds the words remembered."""

    def __init__(self, model: dict, limit: int = 150_000):
        self.names, self.weights = model["languages"], model["weights"]
        self.pieces = _pieces(model["path"], model["longest"])
        self.limit, self.known, self.values = limit, {}, None

    def totals(self, batch: list[str | None]):
        """Whether a text has a letter, and its log-probability in each language."""
        import numpy as np

        split = [words_of(text) for text in batch]
        if self.values is None or len(self.known) > self.limit:
            self.known, self.values = {}, np.empty((0, len(self.names)))
        missing = list(set().union(*split).difference(self.known))
        if missing:
            marked = ["▁" + w for w in missing]
            self.known.update(zip(missing, range(len(self.values), len(self.values) + len(missing)), strict=True))
            self.values = np.vstack([self.values, log_probabilities(marked, self.pieces, self.weights)])
        flat = np.fromiter((self.known[w] for words in split for w in words), np.int64)
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        begins = np.cumsum(sizes) - sizes
        sums = np.zeros((len(split), len(self.names)))
        some = sizes > 0
        if some.any():
            sums[some] = np.add.reduceat(self.values[flat], begins[some], axis=0)
        return some, sums


def sample(docs: DataFrame, training: Column, per_language: int = PER_LANGUAGE) -> DataFrame:
    """``lang``, ``word`` and ``n`` of at most ``per_language`` distinct texts a language."""
    usable = docs.filter(training & F.col("lang").isNotNull() & F.col("text").isNotNull())
    hashed = materialise(usable.select("lang", F.xxhash64("text").alias("h")).distinct())
    chosen = smallest_hashes(hashed, "lang", "h", F.lit(per_language))
    chosen = materialise(chosen.select(F.col("lang").alias("__lang"), F.col("h").alias("__h")))
    on = (F.col("lang") == F.col("__lang")) & (F.xxhash64("text") == F.col("__h"))
    taken = usable.select("lang", "text").join(F.broadcast(chosen), on).select("lang", "text")

    def run(batches: Iterator) -> Iterator:
        from collections import Counter

        import pyarrow as pa

        for batch in batches:
            counts: dict = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts.setdefault(lang, Counter()).update(words_of(text))
            rows = [(lang, w, n) for lang, c in counts.items() for w, n in c.items() if len(w) <= FIT_WORD]
            if rows:
                columns = [pa.array(x) for x in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "word", "n"])

    counted = taken.dropDuplicates(["lang", "text"]).mapInArrow(run, "lang string, word string, n bigint")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def train(
    docs: DataFrame,
    training: Column | None = None,
    per_language: int = PER_LANGUAGE,
    path: str | None = None,
    rounds: int = ROUNDS,
    longest: int = LONGEST,
) -> dict:
    """A model from ``text`` and ``lang`` of the rows that ``training`` selects."""
    import numpy as np

    path = path or vocabulary_path(VOCABULARY)
    found = sample(docs, F.lit(True) if training is None else training, per_language).toArrow().to_pydict()
    names = sorted(set(found["lang"]))
    words = sorted(set(found["word"]))
    row, column = {w: i for i, w in enumerate(words)}, {n: i for i, n in enumerate(names)}
    counts = np.zeros((len(words), len(names)))
    for lang, word, n in zip(found["lang"], found["word"], found["n"], strict=True):
        counts[row[word], column[lang]] = n
    weights = fit(["▁" + w for w in words], counts, Pieces(path, longest), rounds) if words else None
    return {"languages": names if words else [], "weights": weights, "path": path, "longest": longest}


class Predictor:
    """The predictions of a model for some texts at a time."""

    def __init__(self, model: dict):
        import numpy as np

        self.names = np.array([*model["languages"], UNDETERMINED], dtype=object)
        self.scorer = Scorer(model) if len(self.names) > 1 else None

    def __call__(self, texts_: pa.Array):
        """Number of each text's language (the last one is undetermined), and its posterior."""
        import numpy as np

        if not self.scorer:
            return np.zeros(len(texts_), int), np.zeros(len(texts_))
        some, sums = self.scorer.totals(texts_.to_pylist())
        share = np.exp(sums - sums.max(axis=1, keepdims=True))
        best = np.where(some, sums.argmax(axis=1), len(self.names) - 1)
        return best, np.where(some, share.max(axis=1) / share.sum(axis=1), 0.0)


def identify(docs: DataFrame, model: dict) -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` (the language's posterior) for every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)  # pieces times languages
    del model

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        predict = Predictor(shared.value)
        for whole in batches:
            for begin in range(0, whole.num_rows, 1000):
                batch = whole.slice(begin, 1000)
                best, score = predict(batch.column(1))
                columns = [batch.column(0), pa.array(predict.names[best], pa.string()), pa.array(score)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang_pred", "score"])

    return texts(docs).mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: dict, least: float = 0.5) -> DataFrame:
    """Rows of ``docs`` whose language is determined with a posterior of at least ``least``, repeated rows too."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    del model
    held: list = []

    def keeps(texts_):
        if not held:
            held.append(Predictor(shared.value))
        best, score = held[0](texts_)
        return (best < len(held[0].names) - 1) & (score >= least)

    return filter_texts(docs, keeps)


def training_fold() -> Column:
    """Rows that may train: crc32 of the id as text, modulo 4, is not 2."""
    return fold(4) != 2
