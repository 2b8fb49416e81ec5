"""Language identification and toxicity: probabilities against enumeration, accuracy on rows held out."""

from __future__ import annotations

import itertools
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.llm import language, toxicity
from shelfcast.llm.common import fold, table, vocabulary_path

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def pieces():
    return language.Pieces(vocabulary_path(language.VOCABULARY))


def segmentations(word: str, known: set[str], longest: int):
    if not word:
        yield []
    for size in range(1, min(longest, len(word)) + 1):
        if size == 1 or word[:size] in known:
            yield from ([word[:size], *rest] for rest in segmentations(word[size:], known, longest))


def test_forward_sums_all_segmentations(pieces):
    pick = np.random.default_rng(1)
    weights = pick.random((pieces.unknown + 1, 3)) * 0.01
    index = {p: i for i, p in enumerate(pieces.pieces)}
    words = ["▁the", "▁reading", "▁straße", "▁日x", "▁a", "▁"]
    got = language.log_probabilities(words, pieces, weights)
    for word, row in zip(words, got, strict=True):
        total = sum(
            np.prod([weights[index.get(p, pieces.unknown)] for p in parts], axis=0)
            for parts in segmentations(word, set(index), pieces.longest)
        )
        assert np.allclose(row, np.log(total))


def test_long_words_stay_in_range(pieces):
    weights = np.full((pieces.unknown + 1, 2), 1e-5)
    got = language.log_probabilities(["▁" + "x" * 30_000], pieces, weights)
    assert np.isfinite(got).all() and (got < -1000).all()


def test_fit_raises_the_likelihood(pieces):
    words = ["▁" + w for w in ["reading", "read", "ring", "kring", "lesen", "gelesen"]]
    counts = np.array([[5, 0], [3, 0], [2, 1], [0, 2], [0, 6], [0, 3]], float)

    def likelihood(rounds):
        weights = language.fit(words, counts, pieces, rounds)
        assert np.allclose(weights.sum(axis=0), 1, atol=1e-2)
        return (language.log_probabilities(words, pieces, weights) * counts).sum()

    assert likelihood(1) < likelihood(2) < likelihood(6)


def test_language_on_held_out_rows(spark):
    docs = table(spark, SF_DIR, "documents")
    model = language.train(docs, language.training_fold())
    found = language.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").filter(fold(4) == 2).collect()
    assert len(found) > 200
    assert sum(r.lang == r.lang_pred for r in found) >= 0.98 * len(found)
    assert all(0 <= r.score <= 1 for r in found)


def test_language_of_odd_rows(docs, corpus, no_docs):
    model = language.train(docs)
    found = language.identify(docs, model).collect()
    assert len(found) == len(corpus)
    by_id = {r.doc_id: r for r in found}
    for i in (200, 201, 202, 203):
        assert (by_id[i].lang_pred, by_id[i].score) == ("und", 0.0)
    assert {by_id[i].lang_pred for i in (204, 205, 206, 207)} <= {"aa", "bb"}
    kept = language.keep_identified(docs, model)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.lang_pred != "und" and r.score >= 0.5 for r in found)
    nothing = language.train(no_docs)
    assert language.identify(no_docs, nothing).count() == 0
    assert {(r.lang_pred, r.score) for r in language.identify(docs, nothing).collect()} == {("und", 0.0)}


def test_labels_never_enter_a_prediction(docs):
    model = language.train(docs)
    other = docs.withColumn("lang", F.lit("zz")).withColumn("source", F.lit("?"))
    same = language.identify(docs, model).exceptAll(language.identify(other, model))
    assert same.count() == 0


def random_field(seed: int) -> dict:
    pick = np.random.default_rng(seed)
    kinds = len(toxicity.EDGES) + 1
    return {
        "bias": -1.0,
        "own": pick.normal(size=kinds),
        "before": pick.normal(size=kinds),
        "after": pick.normal(size=kinds),
        "transitions": pick.normal(size=4),
        "start": 0.3,
    }


def test_marginals_equal_enumeration():
    pick, model = random.Random(3), random_field(3)
    texts = [[pick.randrange(8) for _ in range(n)] for n in (1, 7, 3, 9, 2)]
    flat = np.array(sum(texts, []), np.int8)
    sizes = np.array([len(t) for t in texts])
    ends = np.concatenate([[0], np.cumsum(sizes)])
    scores = toxicity.emissions(flat, ends, model)
    got = toxicity.marginals(scores, ends[:-1], sizes, model)
    stay0, to1, to0, stay1 = model["transitions"]
    step = {(0, 0): stay0, (0, 1): to1, (1, 0): to0, (1, 1): stay1}
    for n, text in enumerate(texts):
        emit = [
            model["bias"]
            + model["own"][c]
            + model["before"][text[t - 1] if t else 0]
            + model["after"][text[t + 1] if t + 1 < len(text) else 0]
            for t, c in enumerate(text)
        ]
        total, marked = 0.0, np.zeros(len(text))
        for path in itertools.product((0, 1), repeat=len(text)):
            value = path[0] * model["start"] + sum(e * y for e, y in zip(emit, path, strict=True))
            value = math.exp(value + sum(step[pair] for pair in itertools.pairwise(path)))
            total += value
            marked += value * np.array(path)
        assert np.allclose(got[ends[n] : ends[n + 1]], marked / total)


def test_toxicity_on_held_out_rows(spark):
    docs, labels = table(spark, "/root/testdata/sf0.1", "documents"), table(spark, "/root/testdata/sf0.1", "labels")
    model = toxicity.train(docs, labels, toxicity.training_fold())
    found = toxicity.score(docs, model).join(labels, "doc_id").filter(fold(5) == 0).collect()
    toxic = [r for r in found if r.toxic]
    clean = [r for r in found if not r.toxic]
    assert len(toxic) > 60
    assert sum(r.predicted for r in toxic) >= 0.85 * len(toxic)
    assert sum(r.predicted for r in clean) <= 0.03 * len(clean)
    assert all(r.spans for r in found if r.score > 0.9)


def test_toxicity_of_odd_rows(spark, docs, corpus, no_docs):
    rude = "vile"
    rows = [(i, f"{t} {rude} {t} {rude}ness" if i and i % 4 == 0 and t else t) for i, t, _ in corpus]
    mine = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = [(i, int(bool(i % 4 == 0 and t))) for i, t, _ in corpus if i is not None and i < 60]
    labels = spark.createDataFrame([*labels, (1, None), (None, 1), (3, 0)], "doc_id bigint, toxic int")
    model = toxicity.train(mine, labels)
    found = toxicity.score(mine, model).collect()
    assert len(found) == len(rows)
    text_of = {(r.doc_id): r for r in found}
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)
    assert text_of[8].predicted == 1 and text_of[7].predicted == 0
    start, end = map(int, text_of[8].spans.split(",")[0].split(":"))
    assert dict(rows)[8][start:end].startswith(rude)
    assert text_of[200].spans == "" and text_of[201].spans == ""
    assert toxicity.score(no_docs, model).count() == 0
    one_label = toxicity.train(mine, labels.filter("toxic = 0"))
    assert one_label is None
    assert {r.score for r in toxicity.score(docs, one_label).collect()} == {0.0}


def test_folds_are_the_contracts(spark):
    rows = spark.range(200).selectExpr("id AS doc_id")
    for r in rows.select("doc_id", fold(4).alias("a"), fold(5).alias("b")).collect():
        code = zlib.crc32(str(r.doc_id).encode())
        assert (r.a, r.b) == (code % 4, code % 5)
