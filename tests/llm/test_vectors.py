"""Vector compression and centroid clustering against plain comparison with every centre."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderlens.llm import centroid_tree, vector_codes
from orderlens.llm.integer_vectors import MOST

SCHEMA = "vec_id long, embedding array<float>, label int, g int, n long, cluster string, code string, of_label int, values string"


def frame(spark, rows):
    """Rows of (vec_id, embedding, label), with extra columns named like internal ones."""
    return spark.createDataFrame([(i, v, label, 1, 2, "x", "y", 3, "z") for i, v, label in rows], SCHEMA)


def coarse(rng, width):
    """Few distinct components, so that distances tie often."""
    return [rng.choice([-0.5, -0.25, 0.0, 0.25, 0.5]) for _ in range(width)]


@pytest.fixture
def vectors():
    rng = random.Random(12)
    rows = [(i, coarse(rng, 64), rng.choice([1, 2, None])) for i in range(300)]
    rows += [(1000 + i, rows[7][1], 1) for i in range(150)]  # a third are copies
    rows += [(5, rows[9][1], 2), (None, coarse(rng, 64), 4), (8, rows[8][1], rows[8][2])]
    rows += [(2000, None, 1), (2001, [0.1] * 63 + [None], 1), (2002, [float("nan")] * 64, 1), (2003, [0.1] * 63 + [float("-inf")], None)]
    rows += [(2004, [], 1), (2005, [0.5] * 60, 1), (2006, [1e30, -1e30] * 32, 7)]
    return rows


def usable(rows, width, scale):
    found = []
    for i, v, label in rows:
        if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v):
            found.append((i, [max(-MOST, min(MOST, math.floor(float(np.float32(x)) * scale))) for x in v], label))
    return found


def moved(centers, values, rounds):
    """(centers, nearest number and distance of every value) after some rounds of means."""
    table = np.array(values, np.int64)

    def told():
        apart = [((table - np.array(c, np.int64)) ** 2).sum(axis=1).tolist() for c in centers]
        return [min((d[i], k) for k, d in enumerate(apart)) for i in range(len(values))]

    for _ in range(rounds):
        near = told()
        for k in range(len(centers)):
            own = [v for v, (_, n) in zip(values, near) if n == k]
            if own:
                centers[k] = [sum(x) // len(own) for x in zip(*own)]
    return centers, told()


def digest(numbers):
    return hashlib.sha256(",".join(map(str, numbers)).encode()).hexdigest()


def coded(rows, entries):
    kept = usable(rows, 64, 1024)
    ids = sorted(((i, v) for i, v, _ in kept if i is not None))[:entries]
    books, near = [], []
    for p in range(4):
        cut = slice(16 * p, 16 * p + 16)
        centers, told = moved([v[cut] for _, v in ids], [v[cut] for _, v, _ in kept], 4)
        books.append(centers)
        near.append(told)
    errors = [sum(near[p][k][0] for p in range(4)) for k in range(len(kept))]
    by_label = {}
    for (_, _, label), e in zip(kept, errors):
        by_label[label] = by_label.get(label, 0) + e
    sha = digest(x for book in books for c in book for x in c)
    return [
        (i, "".join("%02x" % near[p][k][1] for p in range(4)), errors[k], by_label[label], sha)
        for k, (i, _, label) in enumerate(kept)
    ]


def clustered(rows, count):
    kept = usable(rows, 64, 256)
    first = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), v) for i, v, _ in kept if i is not None)[:count]
    centers, near = moved([v for _, v in first], [v for _, v, _ in kept], 5)
    inertia = {}
    for d, k in near:
        inertia[k] = inertia.get(k, 0) + d
    return [(i, k, d, inertia[k], sum(inertia.values()), digest(centers[k])) for (i, _, _), (d, k) in zip(kept, near)]


def same(got, want):
    assert sorted(map(str, got)) == sorted(map(str, want))


@pytest.mark.parametrize("entries", [256, 9])
def test_codes_match_plain_loops(spark, rows, vectors, entries):
    same(rows(vector_codes.compress(frame(spark, vectors).repartition(3), entries=entries)), coded(vectors, entries))


def test_few_vectors_make_few_entries(spark, rows, vectors):
    same(rows(vector_codes.compress(frame(spark, vectors[:5]))), coded(vectors[:5], 256))


@pytest.mark.parametrize("count", [40, 3])
def test_clusters_match_plain_loops(spark, rows, vectors, count):
    got = rows(centroid_tree.cluster(frame(spark, vectors).repartition(3), centroids=count))
    same(got, clustered(vectors, count))


def test_without_usable_vectors_nothing_comes_out(spark, vectors):
    for few in ([], vectors[-7:-2], [(None, vectors[0][1], 1)]):
        for result in (vector_codes.compress(frame(spark, few)), centroid_tree.cluster(frame(spark, few))):
            assert result.collect() == [] and result.columns[0] == "vec_id"


def test_mixed_lengths_follow_the_most_frequent(spark, vectors):
    short = [(3000 + i, [0.25] * 8, 1) for i in range(600)] + [(4000 + i, [0.5] * 7, 1) for i in range(900)]
    got = vector_codes.compress(frame(spark, vectors + short))
    assert got.count() == 600 and got.agg(F.sum("error")).first()[0] == 0


def test_dictionaries_give_plain_distances():
    rng = np.random.default_rng(1)
    for span in (50, vector_codes.DENSE, MOST):
        values = rng.integers(-span, span, (2500, 12))
        books = rng.integers(-span, span, (3, 40, 4))
        code, distance = vector_codes.nearest(values, books)
        for p in range(3):
            plain = ((values[:, None, 4 * p : 4 * p + 4] - books[p][None]) ** 2).sum(axis=2)
            assert (plain.argmin(axis=1) == code[:, p]).all() and (plain.min(axis=1) == distance[:, p]).all()


@pytest.mark.parametrize("span,count,leaf", [(2, 40, 4), (2, 40, 1), (MOST, 300, 4), (5, 1, 4), (5, 5, 1)])
def test_tree_search_is_exact_with_ties(span, count, leaf):
    rng = np.random.default_rng(count + leaf)
    points, centers = rng.integers(-span, span + 1, (1500, 6)), rng.integers(-span, span + 1, (count, 6))
    centers[count // 2 :: 3] = centers[0]
    who, best = centroid_tree.VantageTree(centers, leaf).nearest(points)
    plain = centroid_tree.squared(points, centers)
    assert (who == plain.argmin(axis=1)).all() and (best == plain.min(axis=1)).all()


def test_tree_leaves_far_centroids_unopened():
    rng = np.random.default_rng(3)
    centers = np.repeat(rng.integers(-1000, 1000, (20, 8)) * 100, 20, axis=0) + rng.integers(-9, 10, (400, 8))
    tree = centroid_tree.VantageTree(centers)
    tree.nearest(centers + 1)
    assert tree.opened < len(centers) * len(tree.nodes) / 4


def test_decoded_vectors_are_near_and_codes_are_their_entries(spark, vectors):
    whole = vector_codes.whole(frame(spark, vectors), 1024, 64, "vec_id", "label")
    books = vector_codes.learn(whole, 64, entries=16)
    back = vector_codes.decode(vector_codes.encode(whole, books), books)
    again = vector_codes.encode(vector_codes.whole(back.withColumn("label", F.lit(0)), 1024, 64, "vec_id", "label"), books)
    assert back.count() == whole.count() and again.agg(F.sum("error")).first()[0] == 0
