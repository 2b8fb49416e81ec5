"""Tokenising, packing and the token files."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from shelfcast.llm import packing, token_file
from shelfcast.llm.common import Coder, vocabulary_path

PATH = vocabulary_path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


CODER = Coder(PATH, limit=20)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="aZé'.,!?1½ \nİΣßs|-\x1ć 日<>endoftext", max_size=40), max_size=6))
def test_coder_equals_the_tokenizer(texts):
    tokenizer = CODER.tokenizer
    for first, ids, ends in CODER.encode(texts, rows=2):
        for row, text in enumerate(texts[first : first + 2]):
            want = tokenizer.encode(text, add_special_tokens=False).ids
            assert ids[ends[row] : ends[row + 1]].tolist() == want


def test_pieces_and_sequences(docs, corpus, plain):
    got = packing.pack(docs, keep_ids=True).collect()
    want = Counter()
    for i, text, _ in corpus:
        ids = [*plain(text), 0]
        for piece, start in enumerate(range(0, len(ids), 2048)):
            raw = np.array(ids[start : start + 2048], "<u4").tobytes()
            want[(i, piece, start, len(raw) // 4, zlib.crc32(raw), raw)] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, bytes(r.ids)) for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 2048


def test_packing_nothing(no_docs):
    assert packing.pack(no_docs).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 60).flatmap(lambda c: st.tuples(st.just(c), st.lists(st.integers(1, c), max_size=80))))
def test_plan_places_every_piece_once(case):
    capacity, lengths = case
    counts = Counter(lengths)
    slots, used = packing.plan(counts, capacity)
    ranks, fill = Counter(), defaultdict(list)
    for length, rank, count, sequence, offset in slots:
        assert rank == ranks[length]
        ranks[length] += count
        for k in range(count):
            fill[sequence + k].append((offset, length))
    assert ranks == counts and sorted(fill) == list(range(used))
    for places in fill.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    # No worse than first fit decreasing is bound to be.
    assert used <= 11 / 9 * best(lengths, capacity) + 1


def best(lengths: list[int], capacity: int) -> int:
    """A lower bound of the sequences needed."""
    large = sum(2 * x > capacity for x in lengths)
    return max(large, -(-sum(lengths) // capacity), first_fit(lengths, capacity) * 9 // 11 - 1, 0)


def first_fit(lengths: list[int], capacity: int) -> int:
    gaps: list[int] = []
    for x in sorted(lengths, reverse=True):
        for i, gap in enumerate(gaps):
            if gap >= x:
                gaps[i] -= x
                break
        else:
            gaps.append(capacity - x)
    return len(gaps)


def test_large_items_pair_at_most_twice():
    slots, used = packing.plan({1400: 3, 1000: 2, 700: 4, 640: 3}, 2048)
    # 1000 pairs with 1000, the rest of the large ones cannot share; 640 fits with 1400.
    assert used == 6


def test_token_files_round_trip(spark, docs, corpus, plain, tmp_path):
    files = token_file.TokenFolder(spark, f"file://{tmp_path}/tokens", parts=5)
    files.write(docs)
    found = {(r.doc_id, r.occurrence): r for r in files.read(token_file.every_key(docs), keep_ids=True).collect()}
    start, seen = 0, Counter()
    for i, text, _ in sorted(corpus, key=lambda r: (r[0] is None, r[0] or 0, r[1] or "")):
        ids = np.array([*plain(text), 2], "<u4").tobytes()
        r = found[(i, seen[i])]
        seen[i] += 1
        assert (r.start, r.n_tokens, r.ids_crc32, bytes(r.ids)) == (start, len(ids) // 4, zlib.crc32(ids), ids)
        start += len(ids) // 4
    assert len(found) == len(corpus)
    raw = b"".join(p.read_bytes() for p in sorted((tmp_path / "tokens").glob("shard-*.bin")))
    assert len(raw) == 2 * start
    assert files.manifest().agg({"n_ids": "sum"}).first()[0] == start


def test_keys_that_were_never_written(spark, docs, tmp_path):
    files = token_file.TokenFolder(spark, f"file://{tmp_path}/tokens", parts=3)
    files.write(docs)
    strange = spark.range(10_000, 12_000).selectExpr("id AS doc_id", "0 AS occurrence")
    assert files.lookup(strange).count() == 0


def test_token_files_of_nothing(spark, no_docs):
    assert token_file.write_and_read(no_docs).count() == 0


@settings(max_examples=30, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), max_size=2000))
def test_perfect_hash_is_minimal(values):
    keys = np.array(sorted(values), np.uint64)
    numbers = token_file.PerfectHash.build(keys).numbers(keys)
    assert sorted(numbers.tolist()) == list(range(len(keys)))


def test_equal_keys_are_refused():
    with pytest.raises(ValueError, match="distinct"):
        token_file.PerfectHash.build(np.array([7, 7], np.uint64))
