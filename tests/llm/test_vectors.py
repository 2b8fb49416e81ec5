"""Whitening and embedding near-dedup against brute force."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from shelfcast.llm import embedding_dedup, whitening

SCHEMA = "vec_id bigint, embedding array<double>, node bigint, unit string, component string, x int, code string"
ODD = [None, [], [0.0] * 8, [1.0, None] + [0.5] * 6, [math.nan] + [1.0] * 7, [math.inf] + [1.0] * 7]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "u", "c", 2, "k") for i, v in rows], SCHEMA)


def crowd(count: int = 400, width: int = 8, seed: int = 3):
    """Vectors off the origin with groups of near copies, exact copies, scaled copies and odd rows."""
    pick = np.random.default_rng(seed)
    base = pick.standard_normal((count, width)) * np.linspace(2, 0.3, width) + 0.4
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    for group in range(6):
        near = base[group] + pick.standard_normal((25, width)) * 0.2 * np.linalg.norm(base[group]) / math.sqrt(width)
        rows += [(1000 + 100 * group + i, v.tolist()) for i, v in enumerate(near)]
    rows += [(2000 + i, base[7].tolist()) for i in range(60)]  # a hot vector
    rows += [(3000, (base[8] * 3).tolist()), (3001, (base[8] * 1e-200).tolist()), (3002, (base[8] * 1e200).tolist())]
    rows += [(4000 + i, v) for i, v in enumerate(ODD)]
    rows += [(None, base[9].tolist()), (5, base[5].tolist()), (5, base[5].tolist()), (6, (base[6] + 9).tolist())]
    random.Random(1).shuffle(rows)
    return rows


def usable(v, zero=False):
    return v is not None and len(v) and all(c is not None and math.isfinite(c) for c in v) and (zero or any(v))


def brute_links(rows, cosine=0.95):
    ok = [i for i, (_, v) in enumerate(rows) if usable(v)]
    units = np.array([np.array(rows[i][1]) / max(map(abs, rows[i][1])) for i in ok])
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    near = units @ units.T >= cosine
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    count = [0] * len(rows)
    for a, b in np.argwhere(near):
        if a != b:
            count[ok[a]] += 1
            root[find(ok[a])] = find(ok[b])
    names = {}
    for i, (name, _) in enumerate(rows):
        names.setdefault(find(i), []).append(name)
    least = {r: min((n for n in found if n is not None), default=None) for r, found in names.items()}
    return [(rows[i][0], count[i], least[find(i)], rows[i][0] == least[find(i)]) for i in range(len(rows))]


def key(row):
    return tuple((v is None, v or 0) for v in row)


@pytest.mark.parametrize("limit", [embedding_dedup.CELL_LIMIT, 40])
def test_links_equal_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(embedding_dedup.candidates, "__defaults__", (limit,))
    rows = crowd()
    got = [tuple(r) for r in embedding_dedup.near_duplicates(frame(spark, rows), recall=1.0).collect()]
    want = brute_links(rows)
    assert sorted(got, key=key) == sorted(want, key=key)


def test_recall_at_the_least_cosine(spark):
    """Pairs just above the least cosine, where a link is hardest to find."""
    pick = np.random.default_rng(11)
    base = pick.standard_normal((2000, 32))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    away = pick.standard_normal(base.shape)
    away -= base * (away * base).sum(axis=1, keepdims=True)
    away /= np.linalg.norm(away, axis=1, keepdims=True)
    angle = math.acos(0.9501)
    partner = math.cos(angle) * base + math.sin(angle) * away
    rows = [(2 * i, v.tolist()) for i, v in enumerate(base)] + [(2 * i + 1, v.tolist()) for i, v in enumerate(partner)]
    found = embedding_dedup.near_duplicates(frame(spark, rows)).filter("n_links = 1 AND component_id = 2 * (vec_id div 2)")
    assert found.count() >= 0.995 * len(rows)


def test_no_vectors(spark):
    assert embedding_dedup.near_duplicates(frame(spark, [])).collect() == []
    odd = embedding_dedup.near_duplicates(frame(spark, list(enumerate(ODD)))).collect()
    assert sorted(tuple(r) for r in odd) == [(i, 0, i, True) for i in range(len(ODD))]
    assert whitening.whiten(frame(spark, [])).collect() == []
    assert whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, None)])).collect() == []


def test_vectors_of_several_lengths_do_not_meet(spark):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.01]), (3, [1.0, 0.0, 0.0]), (4, [1.0, 0.01, 0.0])]
    got = embedding_dedup.near_duplicates(frame(spark, rows)).collect()
    assert sorted(tuple(r) for r in got) == [(1, 1, 1, True), (2, 1, 1, False), (3, 1, 3, True), (4, 1, 3, False)]
    with pytest.raises(ValueError, match="2 to 3"):
        whitening.whiten(frame(spark, rows))


def whitened_by_brute_force(rows):
    kept = [(i, [math.floor(64 * c) + 1000000 for c in v]) for i, v in rows if usable(v, zero=True)]
    fit = sorted({tuple(x) for _, x in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[n * c - s for c, s in zip(x, sums)] for x in fit]) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    return kept, n, sums, values[::-1], vectors[:, ::-1]


def check_whitening(spark, rows, count):
    kept, n, sums, values, vectors = whitened_by_brute_force(rows)
    got = whitening.whiten(frame(spark, rows)).collect()
    assert sorted({r.component for r in got}) == list(range(1, count + 1))
    assert sorted(key((r.vec_id, r.component)) for r in got) == sorted(
        key((i, c)) for i, _ in kept for c in range(1, count + 1)
    )
    sign = {}
    found = {}
    for r in got:
        found.setdefault((r.vec_id, r.deviation), {}).setdefault(r.component, r)
    for i, x in kept:
        deviation = sum((n * c - s) ** 2 for c, s in zip(x, sums))
        row = found[(i, deviation)]
        centred = np.array([(n * c - s) / n for c, s in zip(x, sums)])
        for c in range(1, count + 1):
            want = centred @ vectors[:, c - 1] / math.sqrt(values[c - 1])
            assert row[c].n == n
            assert row[c].explained == pytest.approx(values[c - 1] / values.sum(), rel=1e-9)
            if abs(want) > 1e-6:
                turned = sign.setdefault(c, math.copysign(1, want * row[c].whitened))
                assert turned * row[c].whitened == pytest.approx(want, abs=1e-8)
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-9


def test_whitening_equals_eigenvectors(spark):
    check_whitening(spark, [(i, v) for i, v in crowd() if not usable(v) or max(map(abs, v)) < 1e9], 8)


def test_whitening_of_more_entries_than_the_block(spark):
    pick = np.random.default_rng(2)
    wide = pick.standard_normal((700, 96)) * np.geomspace(40, 0.5, 96)
    check_whitening(spark, [(i, v.tolist()) for i, v in enumerate(wide)], 16)


def test_whitening_of_few_directions(spark):
    """Two directions with variance in twelve entries, and one that is a copy."""
    pick = np.random.default_rng(2)
    flat = pick.integers(-40, 40, (50, 2)) @ np.eye(2, 12)
    check_whitening(spark, [(i, v.tolist()) for i, v in enumerate(flat)], 2)


def test_deviation_is_exact_or_an_error():
    centre = whitening.Centre(3, [10, -7])
    rows = np.array([[5, 1], [2**26, -(2**26)]])
    want = [(3 * a - 10) ** 2 + (3 * b + 7) ** 2 for a, b in rows.tolist()]
    assert centre.deviation(rows).tolist() == want
    with pytest.raises(OverflowError):
        centre.deviation(np.array([[2**40, 0]]))
