import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from orderweir.llm import nn_descent

KIND = "vec_id long, embedding array<float>, label int, node string, query string"


def frame(spark, vectors):
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], 0, "n", "q") for i, v in vectors]
    return spark.createDataFrame(rows, KIND)


def exact(vectors, query, k):
    own = dict(vectors)[query]
    scores = sorted((-float(np.dot(np.float32(own).astype(float), np.float32(v).astype(float))), i) for i, v in vectors if i != query)
    return [(i, -s) for s, i in scores[:k]]


def found(spark, vectors, queries, k=20):
    docs = frame(spark, vectors)
    rows = nn_descent.neighbours(docs, docs.where(F.col("vec_id").isin(queries)), k).collect()
    out = {}
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        assert r["rank"] == len(out.setdefault(r["query_id"], [])) + 1
        out[r["query_id"]].append((r["vec_id"], r["score"]))
    return out


def test_recall_on_vectors_of_unequal_lengths(spark, monkeypatch):
    """Small cells, so that the graph and its descent do the work."""
    monkeypatch.setattr(nn_descent, "CELL", 150)
    draw = np.random.default_rng(4)
    vectors = [(i, draw.normal(size=16) * draw.uniform(0.5, 2)) for i in range(1500)]
    queries = list(range(0, 1500, 50))
    got = found(spark, vectors, queries)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in exact(vectors, q, 20)}) for q in queries)
    assert hits >= 0.9 * 20 * len(queries)
    for q in queries:
        assert all(abs(dict(exact(vectors, q, 1500))[i] - s) < 1e-9 for i, s in got[q])


@pytest.mark.parametrize("case", ["outlier", "short groups"])
def test_recall_beside_a_very_long_vector_and_in_groups(spark, monkeypatch, case):
    """Small cells and few starts: one vector of length 3,000; groups of 40 short near copies."""
    monkeypatch.setattr(nn_descent, "CELL", 150)
    monkeypatch.setattr(nn_descent, "STARTS", 32)
    draw = np.random.default_rng(7)
    unit = lambda x: x / np.linalg.norm(x)
    if case == "outlier":
        vectors = [(i, unit(draw.normal(size=16))) for i in range(1_200)] + [(1_200, 3_000 * unit(draw.normal(size=16)))]
    else:
        centres = [unit(draw.normal(size=16)) * draw.uniform(0.2, 1) for _ in range(30)]
        vectors = [(i, centres[i % 30] + draw.normal(size=16) * 0.01) for i in range(1_200)]
    queries = list(range(0, 1_200, 40))
    got = found(spark, vectors, queries)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in exact(vectors, q, 20)}) for q in queries)
    assert hits >= 0.9 * 20 * len(queries), hits / (20 * len(queries))


def test_a_large_group_of_equal_vectors_and_odd_rows(spark):
    draw = np.random.default_rng(5)
    same = draw.normal(size=4)
    good = [(i, same) for i in range(0, 200)] + [(i, draw.normal(size=4)) for i in range(200, 260)]
    odd = [(300, None), (301, []), (302, [0, 0, 0, 0]), (303, [1, None, 1, 1]), (304, [1, float("nan"), 1, 1]),
           (305, [float("inf"), 1, 1, 1]), (306, [1, 2]), (None, same)]
    queries = [0, 100, 220, 259, 302, 306]
    got = found(spark, [*good, *odd, (220, good[220][1])], queries)
    assert set(got) == {0, 100, 220, 259}
    for q, own in got.items():
        want = exact(good, q, 20)
        assert [i for i, _ in own] == [i for i, _ in want] or np.allclose([s for _, s in own], [s for _, s in want])
    assert [i for i, _ in got[100]] == [i for i, _ in exact(good, 100, 20)]


@pytest.mark.parametrize("n", [0, 1, 2, 5])
def test_few_vectors(spark, n):
    draw = np.random.default_rng(6)
    vectors = [(i, draw.normal(size=3)) for i in range(n)]
    got = found(spark, vectors, [0])
    assert got == {} if n < 2 else len(got[0]) == n - 1


def test_nodes_of_one_smallest_neighbour_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(nn_descent, "BLOCK", 16)
    graph = spark.range(1, 401).select(F.col("id").alias("node"), F.array(F.lit(0).cast("long")).alias("nbrs"))
    sizes = [r["count"] for r in nn_descent.blocked(graph, 400).groupBy("block").count().collect()]
    assert sum(sizes) == 400 and max(sizes) <= 8 * 16


def test_opened_nodes_are_scored_a_few_at_a_time(monkeypatch):
    """A batch of many opened nodes is worked on in slices, with the scores of each row."""
    monkeypatch.setattr(nn_descent, "SLICE", 4)
    draw = np.random.default_rng(8)
    asked = draw.normal(size=(11, 3)).astype(np.float32)
    near = [draw.normal(size=(i % 3 + 1, 3)).astype(np.float16) for i in range(11)]
    nbrs = [[{"nbr": 10 * i + j, "half": x.tobytes()} for j, x in enumerate(rows)] for i, rows in enumerate(near)]
    kind = pa.list_(pa.struct([("nbr", pa.int64()), ("half", pa.binary())]))
    columns = [pa.array(range(11), pa.int64()), pa.array([a.tobytes() for a in asked], pa.binary()), pa.array(nbrs, kind)]
    got = list(nn_descent._scored(iter([pa.RecordBatch.from_arrays(columns, names=["query", "body", "nbrs"])])))
    assert [len(b) for b in got] == [4, 4, 3]
    rows = [row for b in got for row in b.to_pylist()]
    for i, row in enumerate(rows):
        assert row["query"] == i and row["nodes"] == [10 * i + j for j in range(len(near[i]))]
        assert np.allclose(row["scores"], near[i].astype(np.float32) @ asked[i], atol=1e-5)


def test_batches_between_spark_and_its_workers_are_small(spark, monkeypatch):
    """While the graph is built and searched no worker is handed thousands of rows at once; afterwards the session is as it was."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    usual, most = spark.conf.get(name), []

    def lengths(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([len(batch)], pa.int64())})

    def seen(step):
        def run(*parts):
            most.append(max(r["n"] for r in spark.range(5_000, numPartitions=1).mapInArrow(lengths, "n long").collect()))
            return step(*parts)

        return run

    for step in ("build", "search"):
        monkeypatch.setattr(nn_descent, step, seen(getattr(nn_descent, step)))
    draw = np.random.default_rng(2)
    found(spark, [(i, draw.normal(size=4)) for i in range(60)], [0, 20])
    assert len(most) == 2 and max(most) <= nn_descent.BATCH
    assert spark.conf.get(name) == usual
