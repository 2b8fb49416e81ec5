"""Exact and SimHash near-dedup against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfcast.llm import exact_dedup, simhash


def digest(text):
    return hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", text or "").encode()).hexdigest()


def order(i):
    return (i is None, i or 0)


def test_exact_dedup_equals_brute_force(docs, corpus):
    groups: dict = {}
    for i, text, _ in corpus:
        groups.setdefault(digest(text), []).append((-len(text or ""), order(i), i))
    want = Counter(
        (i, min(groups[digest(t)])[2], len(groups[digest(t)]), digest(t)) for i, t, _ in corpus
    )
    got = exact_dedup.exact_dedup(docs).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    assert all(r.doc_id == r.keep_id for r in got if r.kept)
    assert Counter(r.text_sha256 for r in got if r.kept) == Counter(set(groups))


def test_exact_dedup_keeps_one_row_each_with_all_columns(docs, corpus):
    kept = exact_dedup.keep_first_copies(docs)
    assert kept.columns == docs.columns
    texts = [r.text for r in kept.collect()]
    assert Counter(map(digest, texts)) == Counter({digest(t) for _, t, _ in corpus})


def test_repeated_rows_come_back_each(spark):
    """As the query's SQL has them."""
    rows = [(1, "a b"), (1, "a b"), (2, "ab"), *[(7, "x")] * 450, (3, None), (4, "")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = Counter((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_dedup(frame).collect())
    want = {(1, 1, 3, True): 1, (1, 1, 3, False): 1, (2, 1, 3, False): 1, (7, 7, 450, True): 1, (7, 7, 450, False): 449}
    assert got == want | {(3, 3, 2, True): 1, (4, 3, 2, False): 1}


def test_ids_may_be_texts(spark):
    frame = spark.createDataFrame([("b", "x y"), ("a", "xy"), ("c", "z")], "doc_id string, text string")
    got = {(r.doc_id, r.keep_id, r.kept) for r in exact_dedup.exact_dedup(frame).collect()}
    assert got == {("b", "b", True), ("a", "b", False), ("c", "c", True)}


def test_index_outlives_a_batch(spark, docs, tmp_path):
    path = f"file://{tmp_path}/index"
    first = exact_dedup.DigestIndex(spark, path, buckets=4)
    first.ingest(docs.filter("doc_id < 60")).collect()
    again = exact_dedup.DigestIndex(spark, path, buckets=4)
    found = {r.doc_id: r for r in again.ingest(docs.filter("doc_id >= 60")).collect()}
    assert not found[103].kept and found[103].keep_id == 3
    # Documents 101 and 121 of this batch both copy document 1 of the first.
    assert not found[121].kept and found[121].keep_id == 1 and found[121].group_size == 2
    assert found[204].kept and found[204].keep_id == 204
    plan = again.table().groupBy("digest").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan  # the buckets are the partitioning
    assert again.table().count() == again.table().select("digest").distinct().count()


def test_dedup_of_nothing(no_docs):
    assert exact_dedup.exact_dedup(no_docs).count() == 0
    assert exact_dedup.keep_first_copies(no_docs).count() == 0
    assert simhash.near_duplicates(no_docs).count() == 0
    assert simhash.keep_one_each(no_docs).count() == 0


def slow_fingerprint(text: str) -> int:
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["a", "B", "É", "ñ ", "\t", " c", "\x1c", " "]), max_size=40).map(" ".join))
def test_fingerprint(text):
    assert simhash.text_fingerprint(text) == slow_fingerprint(text)


def test_fingerprint_of_long_text():
    text = " ".join(map(str, random.Random(1).choices(range(50), k=3000)))
    assert simhash.text_fingerprint(text) == slow_fingerprint(text)


def brute_components(prints: list[int], radius: int) -> list[int]:
    label = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    return label


def clustered(seed: int, size: int) -> list[int]:
    pick = random.Random(seed)
    centres = [pick.getrandbits(64) for _ in range(6)]
    out = set()
    while len(out) < size:
        value = pick.choice(centres)
        for _ in range(pick.randint(0, 5)):
            value ^= 1 << pick.randrange(64)
        out.add(value)
    return sorted(out)


@pytest.mark.parametrize(("blocks", "radius", "limit"), [(5, 3, 50_000), (4, 3, 50_000), (5, 3, 8), (3, 1, 50_000)])
def test_links_equal_brute_force(spark, blocks, radius, limit):
    prints = clustered(blocks + limit, 120)
    signed = [int(x) for x in np.array(prints, "<u8").view("<i8")]
    edges = simhash.links(spark.createDataFrame([(x,) for x in signed], "fp bigint"), radius, blocks, limit)
    roots = {r.node: r.root for r in simhash.components(edges).collect()}
    got = [signed.index(roots.get(x, x)) for x in signed]
    want = brute_components(prints, radius)
    assert [got.index(x) for x in got] == [want.index(x) for x in want]


def test_components_of_a_path(spark):
    """Long paths need many rounds."""
    edges = spark.createDataFrame([(i + 1, i) for i in range(200)] + [(1000, 999)], "a bigint, b bigint")
    roots = {r.node: r.root for r in simhash.components(edges).collect()}
    assert roots == {i: 0 for i in range(1, 201)} | {1000: 999}


def test_near_duplicates_equal_brute_force(docs, corpus):
    prints = [slow_fingerprint(t or "") for _, t, _ in corpus]
    label = brute_components(prints, 3)
    least = {}
    for (i, _, _), x in zip(corpus, label, strict=True):
        least[x] = min(least.get(x, (True, 0)), order(i))
    want = Counter(
        (i, p, None if least[x][0] else least[x][1]) for (i, _, _), p, x in zip(corpus, prints, label, strict=True)
    )
    got = simhash.near_duplicates(docs).collect()
    assert Counter((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in got) == want
    kept = simhash.keep_one_each(docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(
        None if none else i for none, i in least.values()
    )


def test_trees_follow_only_edges_within_the_radius():
    prints = np.array(clustered(9, 400), np.uint64)
    root = np.zeros(len(prints), np.int64)
    first, children = simhash.build_forest(root, prints)
    for node in range(len(prints)):
        for d in range(66):
            for child in children[first[66 * node + d] : first[66 * node + d + 1]]:
                assert int(prints[node] ^ prints[child]).bit_count() == d
    found = {
        (int(a), int(b)) for x, y in simhash.search_forest(root, prints, first, children, 3, 64) for a, b in zip(x, y)
    }
    want = {
        (i, j) for i in range(len(prints)) for j in range(i) if int(prints[i] ^ prints[j]).bit_count() <= 3
    }
    assert found == want
