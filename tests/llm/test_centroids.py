"""Orchard's search against all distances, rounds against plain Python, odd inputs."""

import hashlib
import random

import numpy as np

from orderweir.llm.centroids import Orchard, cluster, described, first_centroids, kept_vectors

KIND = "vec_id long, embedding array<float>, label int, cluster string, distance string"


def whole(x):
    return [int(np.floor(np.float64(np.float32(c)) * 1024)) for c in x]


def plain_rounds(rows, k, rounds, seed):
    """All distances in Python integers."""
    ids = [i for i, _ in rows]
    v = [whole(x) for _, x in rows]
    order = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), x) for i, x in zip(ids, v) if i is not None)
    centroids = [x for _, x in order[:k]]

    def place(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for x in v:
            groups.setdefault(place(x)[1], []).append(x)
        for j, own in groups.items():
            centroids[j] = [sum(column) // len(own) for column in zip(*own)]
    return [(i, place(x)[1], place(x)[0]) for i, x in zip(ids, v)], centroids


def test_search_finds_the_nearest_and_ties_go_to_the_smaller_number():
    draw = np.random.default_rng(5)
    for k in (1, 2, 7, 40):
        centroids = draw.integers(-4, 5, (k, 3))  # many ties and equal centroids
        v = draw.integers(-6, 7, (500, 3))
        best, far = Orchard(centroids)(v)
        all_of = ((v[:, None, :] - centroids[None]) ** 2).sum(axis=2)
        assert (best == all_of.argmin(axis=1)).all() and (far == all_of.min(axis=1)).all()


def test_search_measures_few_distances_where_centroids_lie_apart():
    draw = np.random.default_rng(6)
    centroids = draw.integers(-100_000, 100_000, (100, 4))
    v = centroids[draw.integers(0, 100, 2_000)] + draw.integers(-50, 51, (2_000, 4))
    search = Orchard(centroids)
    best, _ = search(v)
    assert (best == ((v[:, None, :] - centroids[None]) ** 2).sum(axis=2).argmin(axis=1)).all()
    assert search.measured < 0.4 * 2_000 * 100


def test_distances_at_the_largest_components_do_not_overflow():
    top = 1 << 27
    centroids = np.array([[top] * 64, [-top] * 64])
    best, far = Orchard(centroids)(np.array([[top] * 64, [-top] * 64, [-top] * 63 + [top]]))
    assert best.tolist() == [0, 1, 1] and far.tolist() == [0, 0, (2 * top) ** 2]


def test_rounds_equal_plain_python(spark):
    draw = random.Random(3)
    rows = [(i, [draw.gauss(i % 5, 0.7) for _ in range(6)]) for i in range(300)]
    rows += [(i, list(rows[0][1])) for i in range(300, 420)]  # a large group of copies
    frame = spark.createDataFrame([(i, x, 0, "mine", "mine") for i, x in rows], KIND).repartition(5)
    found, centroids = cluster(frame, k=8, rounds=6, components=6)
    want, last = plain_rounds(rows, 8, 6, 3)
    assert sorted(map(tuple, found.collect())) == want
    assert centroids.tolist() == last
    full = described(found, centroids).collect()
    total = sum(d for _, _, d in want)
    for row in full:
        assert row["inertia"] == total
        assert row["cluster_inertia"] == sum(d for _, c, d in want if c == row["cluster"])
        assert row["centroid_sha256"] == hashlib.sha256(",".join(map(str, last[row["cluster"]])).encode()).hexdigest()


def test_odd_vectors_and_few_of_them(spark):
    x, inf, nan = [0.5, -0.25], float("inf"), float("nan")
    rows = [(1, x), (1, x), (None, [9.0, 9.0]), (2, None), (3, []), (4, [1.0]), (5, [1.0, 2.0, 3.0]),
            (6, [1.0, None]), (7, [1.0, inf]), (8, [nan, 1.0]), (9, [1e30, -1e30])]
    frame = spark.createDataFrame([(i, v, 0, "mine", "mine") for i, v in rows], KIND)
    kept = kept_vectors(frame, components=2)
    assert sorted((r["vec_id"] or 0, r["v"]) for r in kept.collect()) == [
        (0, [9216, 9216]), (1, [512, -256]), (1, [512, -256]), (9, [1 << 27, -(1 << 27)])
    ]
    assert len(first_centroids(kept, 8, 3)) == 3  # the null id starts none
    result = described(*cluster(frame, k=8, rounds=3, components=2)).collect()
    assert sorted(r["vec_id"] or 0 for r in result) == [0, 1, 1, 9]
    assert len({r["cluster"] for r in result if r["vec_id"] == 1}) == 1


def test_sums_that_do_not_fit_are_null(spark):
    rows = [(i, [1e30 if (i + j) % 2 else -1e30 for j in range(64)], 0, "m", "m") for i in range(8)]
    result = described(*cluster(spark.createDataFrame(rows, KIND), k=1, rounds=1)).collect()
    assert len(result) == 8 and all(r["distance"] > 0 for r in result)


def test_no_vectors(spark):
    result = described(*cluster(spark.createDataFrame([], KIND)))
    assert result.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert result.count() == 0
