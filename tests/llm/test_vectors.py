"""Centroid clusters and the multi-index against plain Python."""

import hashlib
import math
import random

import numpy as np
import pytest

from crawlflow.llm import centroid_clusters as clusters
from crawlflow.llm import multi_index

SCHEMA = "vec_id long, embedding array<float>, label int, cluster int, c1 string, distance string, query_id int"


def groups(seed: int, n: int, centres: int = 12, spread: float = 0.05, dims: int = 64) -> np.ndarray:
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, dims)) * 0.2
    return (middle[rng.integers(centres, size=n)] + rng.normal(size=(n, dims)) * spread).astype(np.float32)


def as_rows(x: np.ndarray, first: int = 0) -> list[tuple]:
    return [(first + i, [float(v) for v in row], 0, 99, "c", "d", 5) for i, row in enumerate(x)]


def odd_rows(like: np.ndarray) -> list[tuple]:
    bad = [None, [], [0.5] * 63, [0.5] * 65, [math.nan] * 64, [0.1] * 63 + [math.inf], [0.1] * 63 + [None]]
    good = [float(v) for v in like]
    return [(90_000 + i, v, None, None, None, None, None) for i, v in enumerate(bad)] + [(0, good, 1, 1, "x", "y", 2), (0, good, 1, 1, "x", "y", 2)]


def plain_clusters(rows: list[tuple], k: int, rounds: int):
    """(vec_id, cluster, distance) of every row and the final centroids, in Python's whole numbers."""
    kept = [(r[0], [math.floor(256 * float(np.float32(x))) for x in r[1]]) for r in rows if usable(r[1])]
    kept.sort(key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [q for _, q in kept[:k]]

    def nearest(q):
        return min((sum((a - b) ** 2 for a, b in zip(q, c)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        of = [nearest(q)[1] for _, q in kept]
        for j in range(len(centroids)):
            mine = [q for (_, q), c in zip(kept, of) if c == j]
            if mine:
                centroids[j] = [sum(column) // len(mine) for column in zip(*mine)]
    return [(i, nearest(q)[1], nearest(q)[0]) for i, q in kept], centroids


def usable(vector) -> bool:
    return vector is not None and len(vector) == 64 and all(x is not None and math.isfinite(x) for x in vector)


@pytest.mark.parametrize(("n", "k", "spread"), [(250, 12, 0.01), (250, 12, 0.3), (5, 40, 0.1), (1, 3, 0.1)])
def test_clusters(spark, n, k, spread):
    rows = as_rows(groups(n, n, spread=spread)) + (odd_rows(groups(n, n)[0]) if n > 5 else [])
    got = clusters.cluster_vectors(spark.createDataFrame(rows, SCHEMA), k=k).collect()
    expected, centroids = plain_clusters(rows, k, 5)
    assert sorted((r.vec_id, r.cluster, r.distance) for r in got) == sorted(expected)
    inertia = sum(d for _, _, d in expected)
    for r in got:
        assert r.inertia == inertia and r.cluster_inertia == sum(d for _, c, d in expected if c == r.cluster)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, centroids[r.cluster])).encode()).hexdigest()
    if spread == 0.01:
        assert got[0].looked < 0.6


def test_clusters_of_large_components(spark):
    """Numbers that doubles do not hold exactly are compared as whole numbers."""
    x = groups(4, 40) * 2.0**20
    rows = as_rows(x)
    got = clusters.cluster_vectors(spark.createDataFrame(rows, SCHEMA), k=4).collect()
    assert sorted((r.vec_id, r.cluster, r.distance) for r in got) == sorted(plain_clusters(rows, 4, 5)[0])
    huge = as_rows((x * 2.0**26).astype(np.float32))
    assert all(r.distance is None or r.distance >= 0 for r in clusters.cluster_vectors(spark.createDataFrame(huge, SCHEMA), k=4).collect())


def test_clusters_of_nothing(spark):
    assert clusters.cluster_vectors(spark.createDataFrame([], SCHEMA)).count() == 0
    assert clusters.cluster_vectors(spark.createDataFrame(odd_rows(np.zeros(64))[:7], SCHEMA)).count() == 0


def test_loosening_bounds_every_vector_and_is_less_than_the_drift():
    rng = np.random.default_rng(1)
    tighter = 0
    for _ in range(200):
        k, dims = 5, rng.integers(2, 6)
        old = rng.normal(size=(k, dims))
        new = old + rng.normal(size=(k, dims)) * rng.choice([0.0, 0.05, 0.5])
        radius = rng.uniform(0, 1, size=k)
        loose = clusters.loosening(old, new, radius)
        drift = np.sqrt(((new - old) ** 2).sum(1))
        for i in range(k):
            x = rng.normal(size=(200, dims))
            x = old[i] + x / np.linalg.norm(x, axis=1)[:, None] * radius[i] * rng.uniform(0, 1, size=(200, 1)) ** 0.3
            others = [j for j in range(k) if j != i]
            gain = max((np.linalg.norm(x - old[j], axis=1) - np.linalg.norm(x - new[j], axis=1)).max() for j in others)
            full = max(drift[j] for j in others)
            assert gain <= loose[i] + 1e-12 <= full * (1 + 1e-6) + 1e-9
            tighter += loose[i] < 0.9 * full
    assert tighter > 100


def plain_neighbours(rows: list[tuple], every: int, top: int) -> dict[int, list[int]]:
    kept = [(r[0], np.array(r[1], dtype=np.float32).astype(np.float64)) for r in rows if r[0] is not None and usable(r[1]) and any(r[1])]
    ids, x = np.array([i for i, _ in kept]), np.stack([v for _, v in kept])
    out = {}
    for own, q in sorted(kept, key=lambda r: (r[0], list(r[1])), reverse=True):
        if own % every == 0:
            d = np.sqrt(((x - q) ** 2).sum(1))
            order = [i for i in np.lexsort((ids, d)) if ids[i] != own][:top]
            out[own] = [(int(ids[i]), float(d[i])) for i in order]
    return out


@pytest.mark.parametrize("spread", [0.02, 1.0])
def test_neighbours(spark, spread):
    x = groups(7, 3000, centres=40, spread=spread)
    x[50:400] = x[49]  # equal vectors
    rows = as_rows(x) + odd_rows(x[0]) + [(100, [0.0] * 64, 0, 0, "", "", 0), (None, [1.0] * 64, 0, 0, "", "", 0)]
    got = multi_index.nearest_neighbours(spark.createDataFrame(rows, SCHEMA), every=50).collect()
    expected = plain_neighbours(rows, 50, 10)
    found = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(found[r.query_id])
    assert set(found) == set(expected)
    true = {(q, i): d for q, pairs in expected.items() for i, d in pairs}
    hits = [(q, i) for q, pairs in found.items() for i, _ in pairs if (q, i) in true]
    assert len(hits) / len(true) >= 0.9
    assert all(len(found[q]) == len(pairs) for q, pairs in expected.items())
    scores = {(q, i): d for q, pairs in found.items() for i, d in pairs}
    assert all(abs(scores[pair] - true[pair]) < 1e-12 for pair in hits)
    assert got[0].measured_recall >= 0.95
    if spread == 0.02:
        assert got[0].looked_at < 0.5


def test_neighbours_of_few_rows(spark):
    rows = as_rows(groups(3, 4)) + [(200, [0.0] * 64, 0, 0, "", "", 0)]
    got = multi_index.nearest_neighbours(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in got) == [(0, k + 1, i) for k, (i, _) in enumerate(plain_neighbours(rows, 100, 10)[0])]
    assert multi_index.nearest_neighbours(spark.createDataFrame([], SCHEMA)).count() == 0
    assert multi_index.nearest_neighbours(spark.createDataFrame(rows[:1], SCHEMA)).count() == 0


def test_traversal_gives_every_cell_in_order():
    rng = random.Random(2)
    books = multi_index.Codebooks(np.zeros((9, 2)), np.zeros((9, 2)))
    books.counts += 1
    first, second = (np.array([rng.random() for _ in range(9)]) for _ in range(2))
    cells = list(books.traverse(first, second, math.inf))
    sums = [first[i] + second[j] for i, j, _ in cells]
    assert sums == sorted(sums) and len({c[:2] for c in cells}) == 81 and cells[-1][2] == 81
    assert len(list(books.traverse(first, second, 7))) == 7
