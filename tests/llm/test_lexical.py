"""Ranked search against brute force."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfcast.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(rows, items, best):
    docs = [(i, Counter(terms(t))) for i, t, *_ in rows]
    docs = [(i, c, sum(c.values())) for i, c in docs if c]
    count, total = len(docs), sum(n for *_, n in docs)
    holders = Counter(t for _, c, _ in docs for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c, n in docs:
            m = 75 + 25 * n * count // total
            score = sum(
                math.floor(1000 * math.log((2 * count + 2) / (2 * holders[t] + 1)))
                * (1000000000 * c[t] // (1000 * c[t] + 12 * m))
                for t in terms(text)
                if c[t]
            )
            if score > 0:
                found.append((-score, i is None, i, score))
        found.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, k + 1, i, score) for k, (_, _, i, score) in enumerate(found[:best])]
    return sorted(out, key=lambda r: r[:2])


@pytest.fixture(scope="module")
def items(corpus):
    asked = [(i, corpus[i][1][:200]) for i in range(0, 60, 4)]
    asked += [(500, None), (501, ""), (502, "nowhereatall"), (503, "the the THE house Straße İstanbul 日本語 don't")]
    asked += [(504, corpus[66][1] or "word"), (505, "word"), (506, "x" * 30000), (507, " ".join(t for _, t, _ in corpus[:5]))]
    return asked


def asked_frame(spark, items):
    rows = [(i, t, 1, "s", "w") for i, t in [*items, items[0]]]
    return spark.createDataFrame(rows, "item_id bigint, text string, item int, score string, rank string")


@pytest.mark.parametrize("best, block", [(20, 1024), (3, 8), (200, 16)])
def test_search_equals_brute_force(spark, docs, corpus, items, monkeypatch, best, block):
    monkeypatch.setattr(lexical, "BLOCK", block)
    got = lexical.search(docs, asked_frame(spark, items), best).collect()
    assert sorted((tuple(r) for r in got), key=lambda r: r[:2]) == brute(corpus, items, best)


def test_items_in_several_blocks(spark, docs, corpus, items, monkeypatch):
    monkeypatch.setattr(lexical, "ITEMS", 9)
    monkeypatch.setattr(lexical, "CHUNK", 4)
    got = lexical.search(docs, asked_frame(spark, items), 5).collect()
    assert sorted((tuple(r) for r in got), key=lambda r: r[:2]) == brute(corpus, items, 5)


def test_texts_of_one_item_are_one_query(spark, docs, corpus):
    asked = spark.createDataFrame([(1, "north house"), (1, "stone"), (1, None)], "item_id bigint, text string")
    got = lexical.search(docs, asked, 5).collect()
    assert sorted((tuple(r) for r in got), key=lambda r: r[:2]) == brute(corpus, [(1, "north house stone")], 5)


def test_nothing_to_search(spark, docs, no_docs, items):
    assert lexical.search(no_docs, asked_frame(spark, items)).collect() == []
    assert lexical.search(docs, asked_frame(spark, items).limit(0)).collect() == []
    odd = docs.filter("text IS NULL OR trim(text) = ''")
    assert lexical.search(odd, asked_frame(spark, items)).collect() == []


@settings(max_examples=40, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aAbZ09 .é日\x00\x1c \n", max_size=40)), max_size=8))
def test_counts_equal_the_pattern(texts):
    words, owner, code, times, lengths = lexical.counted(pa.array(["skipped", *texts], pa.string()).slice(1))
    got = Counter({(int(o), words[c].decode()): int(n) for o, c, n in zip(owner, code, times)})
    assert got == Counter((i, t) for i, text in enumerate(texts) for t in terms(text))
    assert lengths.tolist() == [len(terms(t)) for t in texts]


def test_bounds_are_never_too_low(corpus, monkeypatch):
    """Of every document, and equal to its score where the filter is empty enough and counts are at a level's end."""
    queries = lexical.Queries.of([(i, [t]) for i, t, _ in corpus if t])
    docs = [Counter(lexical.terms_of(t)) for _, t, _ in corpus]
    docs = [c for c in docs if c]
    lengths = np.array([sum(c.values()) for c in docs])
    held = Counter(t for c in docs for t in c)
    queries.weigh(len(docs), int(lengths.sum()), np.array([held[t] for t in queries.terms]))
    monkeypatch.setattr(lexical, "filter_bits", lambda entries: 4096)
    found = [(d, t, n) for d, c in enumerate(docs) for t, n in c.items()]
    owner, times = (np.array([f[k] for f in found]) for k in (0, 2))
    _, filters = lexical.signatures(owner, lexical.hashes([f[1] for f in found]), times, len(docs))
    block = lexical.Block(4096)
    for n, filter_ in zip(lengths.tolist(), filters, strict=True):
        block.add(0, 0, n, filter_)
    row = block.row(pa.int64())
    bounds = np.vstack([b for _, b in queries.bounds(4096, row[4][0].as_buffer(), lengths)])
    for d, c in enumerate(docs):
        often = np.array([c[t] for t in queries.terms])
        score = queries.scores(queries.weights * queries.shares(often, lengths[d]))
        assert (bounds[:, d] >= score).all()
        if max(c.values()) <= 2:
            assert (bounds[:, d] == score).mean() > 0.9
