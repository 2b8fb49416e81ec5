"""Toxic spans and document scores from a linear-chain conditional random field.

Labels mark documents, so the token labels come from them: words and word beginnings are weighed by how much more often
documents marked toxic hold them, and a token of such a document is labelled toxic if the lower bound of its log odds
is high.  The field has two states, clean and toxic; a token's emission depends on the class of its own log odds
and of its neighbours', and the transitions let toxic tokens hang together.  Forward and backward passes over whole
texts give each token's marginal; the marginals' sum, their largest and the length give the document's score by
a logistic model, and runs of tokens with marginals from one half up are the offending spans.

The log odds that a training text is read with come from the other half of the sample, so chance finds in one half
cost weight in the other.  The sample is bounded: at most ``per_class`` texts of each label, one of each group of
texts that share their smallest five-word hash, so near copies count once.  Labels, language, source and id are
never inputs of a score.

Defined cases: a null text is the empty text; a text without words gets the score of no marginals; without texts of
both labels every score is 0; labels that are null do not train, of several labels of an id the highest counts;
repeated rows are each returned; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import fold, smallest_hashes, texts
from shelfcast.session import materialise

PER_CLASS = {1: 1000, 0: 2000}
EDGES = (0.5, 1.0, 1.5, 2.0, 2.5, 3.0, 4.0)  # of the classes of log odds
TOXIC_FROM = 1.5  # log odds of a token labelled toxic
PREFIXES = range(3, 9)
LEAST_TEXTS = 3  # that hold a word or beginning of the lexicon
GRAM = 5  # words of the runs that tell near copies
SEGMENT = 48  # tokens of a training segment
TELLING, PLAIN = 3, 10  # segments without such a class train one in ten, and count tenfold
STEPS = 150

_WORD = re.compile(r"\w+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def parts_of(word: str) -> list[str]:
    """The word, and its beginnings."""
    return [word, *("^" + word[:n] for n in PREFIXES if n < len(word))]


def lexicon(toxic: list[set[str]], clean: list[set[str]]) -> dict[str, float]:
    """Lower bounds of the log odds of words and beginnings, from the texts' sets of words."""
    yes: Counter = Counter()
    for words in toxic:
        yes.update({part for word in words for part in parts_of(word)})
    yes = Counter({part: n for part, n in yes.items() if n >= LEAST_TEXTS})
    no: Counter = Counter()
    for words in clean:
        no.update({part for word in words for part in parts_of(word)}.intersection(yes))
    out = {}
    for part, n in yes.items():
        m = no[part]
        odds = math.log((n + 0.5) / (len(toxic) + 1)) - math.log((m + 0.5) / (len(clean) + 1))
        low = odds - math.sqrt(1 / (n + 0.5) + 1 / (m + 0.5))
        if low >= EDGES[0]:
            out[part] = low
    return out


def log_odds(word: str, weights: dict[str, float]) -> float:
    return max(weights.get(part, 0.0) for part in parts_of(word))


class Classes:
    """The class of a word's log odds; ``limit`` bounds the words remembered."""

    def __init__(self, weights: dict[str, float], limit: int = 200_000):
        self.weights, self.limit, self.known = weights, limit, {}

    def of(self, words: list[str]) -> list[int]:
        import bisect

        found = list(map(self.known.get, words))
        if None in found:
            if len(self.known) > self.limit:
                self.known = {}
            for i, value in enumerate(found):
                if value is None:
                    word = words[i]
                    if (value := self.known.get(word)) is None:
                        value = self.known[word] = bisect.bisect_right(EDGES, log_odds(word, self.weights))
                    found[i] = value
        return found


def emissions(classes, begins, model):
    """Log odds of toxic against clean of every token; all texts in a row, ``begins`` of each and the end."""
    import numpy as np

    before = np.concatenate([[0], classes[:-1]]).astype(np.int8)
    after = np.concatenate([classes[1:], [0]]).astype(np.int8)
    before[begins[:-1]] = 0
    after[begins[1:] - 1] = 0
    return model["bias"] + model["own"][classes] + model["before"][before] + model["after"][after]


def marginals(scores, begins, sizes, model):
    """Probability of toxic of every token, for texts of ``sizes`` (none empty) that begin at ``begins``.

    The passes run over the places of all texts at once, the longest texts first; the state of a pass is
    the ratio of the two messages.
    """
    import numpy as np

    order = np.argsort(-sizes, kind="stable")
    start, size = begins[order], sizes[order]
    active = np.searchsorted(-size, -np.arange(size[0]), "left")  # texts longer than the place
    odds = np.exp(np.clip(scores, -30, 30))
    stay0, to1, to0, stay1 = np.exp(model["transitions"])
    forward, backward = np.empty(len(scores)), np.empty(len(scores))
    state = odds[start] * math.exp(model["start"])
    forward[start] = state
    for place in range(1, size[0]):
        n = active[place]
        at = start[:n] + place
        state = odds[at] * (to1 + stay1 * state[:n]) / (stay0 + to0 * state[:n])
        forward[at] = state
    last = start + size - 1
    ratio = np.ones(len(start))
    backward[last] = 1.0
    for place in range(1, size[0]):
        n = active[place]
        at = last[:n] - place
        reach = odds[at + 1] * ratio[:n]
        ratio = (to0 + stay1 * reach) / (stay0 + to1 * reach)
        backward[at] = ratio
    both = forward * backward
    return both / (1 + both)


def train_field(classes, labels, weights):
    """Fits the field to segments, a row each: classes and labels of their tokens, and the segment's weight."""
    import numpy as np

    classes, labels = np.ascontiguousarray(classes.T), np.ascontiguousarray(labels.T)  # a column each from here on
    length, rows = classes.shape
    kinds = len(EDGES) + 1
    sides = [classes, np.pad(classes, ((1, 0), (0, 0)))[:-1], np.pad(classes, ((0, 1), (0, 0)))[1:]]
    # Parameters: bias, own, before and after classes, four transitions, start.  A class's weight is the sum of its
    # step and those below, so a class that the sample lacks weighs what the one below it weighs.
    size = 1 + 3 * kinds + 5
    theta, mean, square = np.zeros(size), np.zeros(size), np.zeros(size)
    theta[0] = -4.0
    theta[2 : 1 + kinds] = 1.0
    pairs = np.array(
        [
            (((labels[:-1] == a) & (labels[1:] == b)) * weights).sum()
            for a, b in ((0, 0), (0, 1), (1, 0), (1, 1))
        ]
    )
    total = weights.sum() * length
    for step in range(1, STEPS + 1):
        tables = np.cumsum(theta[1 : 1 + 3 * kinds].reshape(3, kinds), axis=1)
        scores = theta[0] + sum(table[side] for table, side in zip(tables, sides, strict=True))
        odds = np.exp(np.clip(scores, -30, 30))
        stay0, to1, to0, stay1 = np.exp(theta[1 + 3 * kinds : 5 + 3 * kinds])
        forward, backward = np.empty((length, rows)), np.ones((length, rows))
        forward[0] = odds[0] * math.exp(theta[-1])
        for t in range(1, length):
            f = forward[t - 1]
            forward[t] = odds[t] * (to1 + stay1 * f) / (stay0 + to0 * f)
        for t in range(length - 2, -1, -1):
            reach = odds[t + 1] * backward[t + 1]
            backward[t] = (to0 + stay1 * reach) / (stay0 + to1 * reach)
        both = forward * backward
        off = (labels - both / (1 + both)) * weights
        gradient = [off.sum()[None]]
        gradient += [np.cumsum(np.bincount(side.ravel(), off.ravel(), kinds)[::-1])[::-1] for side in sides]
        f, reach = forward[:-1], odds[1:] * backward[1:]
        joint = [stay0, to1 * reach, to0 * f, stay1 * f * reach]
        whole = sum(joint)
        gradient.append(pairs - np.array([(part / whole * weights).sum() for part in joint]))
        gradient.append(off[0].sum()[None])
        slope = np.concatenate(gradient) / total - 1e-5 * theta
        mean = 0.9 * mean + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        theta = theta + 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-9)
    bias, own, prev, nxt = theta[0], *np.cumsum(theta[1 : 1 + 3 * kinds].reshape(3, kinds), axis=1)
    return {
        "bias": bias,
        "own": own,
        "before": prev,
        "after": nxt,
        "transitions": theta[1 + 3 * kinds : 5 + 3 * kinds],
        "start": theta[-1],
    }


def flat_marginals(split: Iterable[list[str]], classes: Classes, model: dict):
    """Marginals of all texts in a row, and where each text begins and the last one ends."""
    import numpy as np

    found = [np.array(classes.of(words), np.int8) for words in split]
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.concatenate([[0], np.cumsum(sizes)])
    some = sizes > 0
    if not some.any():
        return np.empty(0), ends
    scores = emissions(np.concatenate(found), np.append(ends[:-1][some], ends[-1]), model)
    return marginals(scores, ends[:-1][some], sizes[some], model), ends


def features(p, ends):
    """Of each text: the logarithm of one and the sum of its marginals, the largest, and that of its length."""
    import numpy as np

    sizes = np.diff(ends)
    out = np.zeros((len(sizes), 3))
    some = sizes > 0
    if some.any():
        out[some, 0] = np.log1p(np.add.reduceat(p, ends[:-1][some]))
        out[some, 1] = np.maximum.reduceat(p, ends[:-1][some])
    out[:, 2] = np.log1p(sizes) / 10
    return out


def train_score(x, labels, weights):
    """Logistic model of the features by Newton's method, with a small ridge."""
    import numpy as np

    x = np.column_stack([np.ones(len(x)), x])
    theta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        slope = x.T @ (weights * (labels - p)) - 1e-2 * theta
        bend = (x * (weights * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(x.shape[1])
        move = np.linalg.solve(bend, slope)
        theta = theta + move
        if np.abs(move).max() < 1e-8:
            break
    return theta


def apply_score(x, theta):
    import numpy as np

    return 1 / (1 + np.exp(-np.clip(theta[0] + x @ theta[1:], -30, 30)))


def sample(docs: DataFrame, labels: DataFrame, training: Column, per_class: dict[int, int]) -> DataFrame:
    """``toxic`` and ``text`` of the training texts, and ``share``: labelled rows for each text of its label."""
    marks = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    marks = marks.groupBy(F.col("doc_id").alias("__id")).agg(F.max("toxic").cast("int").alias("toxic"))
    rows = texts(docs.filter(training))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            sketches = np.zeros(batch.num_rows, np.int64)
            for row, text in enumerate(batch.column(1).to_pylist()):
                words = text.encode("utf-8", "replace").lower().split()
                codes = np.fromiter(map(zlib.crc32, words), np.uint64, len(words))
                size = min(GRAM, len(codes))
                grams = np.zeros(len(codes) - size + 1 if size else 0, np.uint64)
                for i in range(size):
                    grams = (grams + codes[i : i + len(grams)] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
                grams = (grams ^ (grams >> np.uint64(29))) >> np.uint64(1)
                sketches[row] = int(grams.min()) if len(grams) else 0
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sketches)], ["doc_id", "sketch"])

    # Sketches meet the labels, texts do not: only ids and hashes are shuffled.
    sketched = rows.mapInArrow(run, f"doc_id {kind}, sketch bigint")
    sketched = sketched.join(marks.hint("merge"), F.col("doc_id") == F.col("__id"))
    one = sketched.groupBy("toxic", "sketch").agg(F.min("doc_id").alias("first_id"))
    one = materialise(one.withColumn("code", F.xxhash64("sketch")))
    totals = one.groupBy("toxic").agg(F.count(F.lit(1)).alias("texts"))
    most = F.create_map(*(F.lit(x) for pair in per_class.items() for x in pair))[F.col("toxic")]
    taken = smallest_hashes(one, "toxic", "code", most)
    taken = taken.join(F.broadcast(totals), "toxic")  # a row for each label
    taken = materialise(taken.select(F.col("first_id").alias("__id"), "toxic", "texts"))
    chosen = rows.join(F.broadcast(taken), F.col("doc_id") == F.col("__id"))  # as many as the sample's bound
    return chosen.groupBy("doc_id").agg(
        F.max("toxic").alias("toxic"), F.max("text").alias("text"), F.max("texts").alias("texts")
    )


def train(
    docs: DataFrame,
    labels: DataFrame,
    training: Column | None = None,
    per_class: dict[int, int] | None = None,
) -> dict | None:
    """A model from the labelled rows that ``training`` selects; None unless there are texts of both labels."""
    import numpy as np

    training = F.lit(True) if training is None else training
    found = sample(docs, labels, training, per_class or PER_CLASS).toArrow().sort_by("doc_id")
    ids = found["doc_id"].to_pylist()
    labels_ = found["toxic"].to_numpy().astype(np.int64)
    if not ids or labels_.min() == labels_.max():
        return None
    held = np.bincount(labels_, minlength=2)
    weights = found["texts"].to_numpy() / held[labels_]
    once: dict[str, str] = {}  # one object for each distinct word
    split = [[once.setdefault(w, w) for w in words_of(text.as_py())] for text in found["text"]]
    del found, once
    sets = [set(words) for words in split]

    def made(rows) -> dict[str, float]:
        return lexicon([sets[i] for i in rows if labels_[i]], [sets[i] for i in rows if not labels_[i]])

    whole = made(range(len(ids)))
    half = np.array([zlib.crc32(b"%d" % i) % 2 for i in ids])
    other = [Classes(made(np.flatnonzero(half != h))) for h in (0, 1)]
    del sets
    classes, tokens = [], []
    for i, words in enumerate(split):
        classes.append(np.array(other[half[i]].of(words), np.int64))
        marks = [log_odds(w, whole) >= TOXIC_FROM for w in words] if labels_[i] else [False] * len(words)
        tokens.append(np.array(marks, np.int64))
    pieces = []
    for i, row in enumerate(classes):
        for begin in range(0, len(row), SEGMENT):
            part, marks = row[begin : begin + SEGMENT], tokens[i][begin : begin + SEGMENT]
            telling = marks.any() or part.max() >= TELLING
            if telling or (begin // SEGMENT + i) % PLAIN == 0:
                pad = (0, SEGMENT - len(part))
                pieces.append((np.pad(part, pad), np.pad(marks, pad), weights[i] * (1 if telling else PLAIN)))
    if not pieces:
        return None
    x, y, w = (np.array(v) for v in zip(*pieces, strict=True))
    model = train_field(x, y, w / w.mean())
    scores = np.zeros((len(ids), 3))
    for h in (0, 1):
        rows = np.flatnonzero(half == h)
        if len(rows):
            scores[rows] = features(*flat_marginals([split[i] for i in rows], other[h], model))
    model["score"] = train_score(scores, labels_, weights / weights.mean())
    return model | {"lexicon": whole}


def score(docs: DataFrame, model: dict | None) -> DataFrame:
    """``doc_id``, ``score``, ``predicted`` and ``spans`` (start:end in code points, comma-joined) of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, score double, predicted int, spans string"
    if model is None:
        empty = (F.lit(0.0).alias("score"), F.lit(0).alias("predicted"), F.lit("").alias("spans"))
        return docs.select("doc_id", *empty)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample
    del model

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        model = shared.value
        classes = Classes(model["lexicon"])
        for whole in batches:
            for begin in range(0, whole.num_rows, 2500):
                batch = whole.slice(begin, 2500)
                rows = batch.column(1).to_pylist()
                p, ends = flat_marginals(map(words_of, rows), classes, model)
                found = apply_score(features(p, ends), model["score"])
                spans = [""] * len(rows)
                hot = np.flatnonzero(p >= 0.5)
                for row in np.unique(np.searchsorted(ends, hot, "right") - 1).tolist():
                    # Lower-casing may change a text's length, never the number of its words but for odd letters.
                    places = [m.span() for m in _WORD.finditer(rows[row])]
                    if len(places) != ends[row + 1] - ends[row]:
                        places = [m.span() for m in _WORD.finditer(rows[row].lower())]
                    mine = hot[(hot >= ends[row]) & (hot < ends[row + 1])] - ends[row]
                    runs = np.split(mine, np.flatnonzero(np.diff(mine) != 1) + 1)
                    spans[row] = ",".join(f"{places[r[0]][0]}:{places[r[-1]][1]}" for r in runs)
                columns = [batch.column(0), pa.array(found), pa.array((found >= 0.5).astype(np.int32))]
                columns.append(pa.array(spans, pa.string()))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "score", "predicted", "spans"])

    return texts(docs).mapInArrow(run, schema)


def training_fold() -> Column:
    """Rows that may train: crc32 of the id as text, modulo 5, is not 0."""
    return fold(5) != 0
