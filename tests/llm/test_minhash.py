"""MinHash near duplicates against all pairs of full sets."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pairs import edited, expected, odd_rows, shingles, words

from orderlens.llm import minhash
from orderlens.llm.word_sets import PIECE, shingle_sets

SCHEMA = "doc_id long, text string, set_name string, band long, n int, root long, kept int"


def frame(spark, rows):
    """Rows of (doc_id, text), with extra columns named like internal ones."""
    return spark.createDataFrame([(i, t, "x", 1, 2, 3, 4) for i, t in rows], SCHEMA)


def same(got, want):
    assert sorted(map(str, got)) == sorted(map(str, want))


@pytest.fixture(scope="module")
def texts():
    return odd_rows()


def test_components_match_all_pairs(spark, rows, texts):
    same(rows(minhash.near_duplicates(frame(spark, texts).repartition(5))), expected(texts, 85))


def test_small_blocks_give_the_same_components(spark, rows, texts, monkeypatch):
    monkeypatch.setattr(minhash, "MOST_SIGNATURES", 3)
    monkeypatch.setattr(minhash, "MOST_SETS", 4)
    same(rows(minhash.near_duplicates(frame(spark, texts))), expected(texts, 85))


def test_a_chain_of_partly_similar_copies_is_followed(spark, rows):
    """Each text links with the next few only; the ends have little in common."""
    base, rows_in = words(9, 200), []
    for k in range(60):
        base = list(base)
        base[3 * k % 200] = f"step{k}"
        rows_in.append((1000 - k, " ".join(base)))
    got = rows(minhash.near_duplicates(frame(spark, rows_in)))
    same(got, expected(rows_in, 85))
    assert {r[2] for r in got} == {941}


def test_similar_texts_below_the_threshold_stay_apart(spark, rows):
    rng = random.Random(8)
    rows_in = [(k, edited(words(3, 150), rng, 6)) for k in range(120)]
    same(rows(minhash.near_duplicates(frame(spark, rows_in))), expected(rows_in, 85))


def test_long_texts_and_an_empty_table(spark, rows):
    long = words(1, 60_000)
    assert len(" ".join(long)) > PIECE
    changed = long[:100] + ["other"] + long[101:]
    rows_in = [(1, " ".join(long)), (2, " ".join(changed)), (3, "x" * (PIECE + 5000) + " end"), (4, "y" * (PIECE + 5000) + " end")]
    same(rows(minhash.near_duplicates(frame(spark, rows_in))), expected(rows_in, 85))
    assert minhash.near_duplicates(frame(spark, [])).collect() == []


def test_shingle_sets_count_distinct_runs():
    rng = random.Random(2)
    texts = [" \n".join(rng.choices(["a", "b", "ab", "Ba", "é", "q" * 400, "q" * 401], k=rng.randint(0, 30))) for _ in range(300)]
    sets = list(shingle_sets([t.encode() for t in texts]))
    assert [len(s) for s in sets] == [len(shingles(t)) for t in texts]
    names = {}
    for s, t in zip(sets, texts):
        assert names.setdefault(frozenset(shingles(t)), s.tobytes()) == s.tobytes()
    assert len(set(names.values())) == len(names)


def test_equal_minima_estimate_the_similarity():
    rng = np.random.default_rng(6)
    a = rng.integers(0, 1 << 64, 3000, dtype=np.uint64)
    b = np.concatenate([a[:2400], rng.integers(0, 1 << 64, 600, dtype=np.uint64)])
    least = minhash.minima([np.unique(a), np.unique(b)])
    assert abs((least[0] == least[1]).mean() - 2400 / 3600) < 0.15
    plain = min((int(x) >> 32) * int(minhash._A[5]) + int(minhash._B[5]) & (1 << 64) - 1 for x in a)
    assert plain >> 32 == least[0][5]


def test_components_of_paths_stars_and_rings(spark):
    from orderlens.llm.links import components

    rng, edges = random.Random(3), []
    edges += [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(200 + k, 200 + (k + 1) % 25) for k in range(25)]
    edges += [(300 + rng.randrange(60), 300 + rng.randrange(60)) for _ in range(50)] + [(7, 7), (5, 6), (6, 5)]
    label = {n: n for e in edges for n in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = {n for a, b in edges if a != b for n in (a, b)}
    assert got == {n: label[n] for n in linked}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
