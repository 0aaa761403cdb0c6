"""Approximate nearest neighbours: an NN-descent graph, searched greedily."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderweir.session import stored

#: Neighbours of a node in the graph.
NEIGHBOURS = 32
#: Rough vectors per cell of the first graph, cells drawn at most, and how often cells are drawn.
CELL, MOST_PIVOTS, DRAWS = 4_000, 1_024, 4
#: Rounds of NN-descent; nodes whose neighbourhoods one task call joins; most reverse links in one of them.
DESCENTS, BLOCK, CHUNK = 2, 512, 64
#: Candidates that a neighbourhood offers each of its members per round.
OFFERS = 8
#: Rows of an Arrow batch between Spark and its Python workers, and those of them that a task works on at a time.
BATCH, SLICE = 1_024, 256
#: Beam of the search, nodes opened per round, rounds at most.
BEAM, OPEN, ROUNDS = 256, 32, 8
#: Longest vectors, among which every search finds its first nodes to open.
STARTS = 256
#: Share of vectors by length that the graph's common length covers; longer ones count by direction there.
USUAL_LENGTH = 0.99
#: Bytes of packed neighbourhoods in a bucket of the graph table.
BUCKET_BYTES = 64 << 20


def clean(vectors: DataFrame) -> DataFrame:
    """(vec_id, vec): rows with an id and a vector that is not null, not zero, wholly finite and of the usual length."""
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("vec")).where(
        "vec_id is not null and vec is not null and size(vec) > 0"
        " and forall(vec, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
        " and exists(vec, x -> x <> 0)"
    )
    usual = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return rows.where(F.size("vec") == (usual[0]["d"] if usual else 0)).groupBy("vec_id").agg(F.min("vec").alias("vec"))


def matrix(column: pa.ChunkedArray | pa.Array, kind: type) -> np.ndarray:
    """Equally long binaries as the rows of a float32 matrix."""
    bodies = column.to_pylist()
    return np.frombuffer(b"".join(bodies), kind).reshape(len(bodies), -1).astype(np.float32)


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of the batches, SLICE at a time: what a task makes of them may be many times as large."""
    for batch in batches:
        for at in range(0, len(batch), SLICE):
            yield batch.slice(at, SLICE)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Inside, Arrow batches have BATCH rows at most: a row with its neighbours' vectors is several KB, and both sides hold whole batches."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    usual = spark.conf.get(name)
    spark.conf.set(name, min(int(usual), BATCH) if int(usual) > 0 else BATCH)
    try:
        yield
    finally:
        spark.conf.set(name, usual)


def best(scores: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k largest values of each row."""
    return np.argpartition(-scores, min(k, scores.shape[1]) - 1, axis=1)[:, :k] if scores.shape[1] else np.zeros((len(scores), 0), int)


def packed(nodes: DataFrame, largest: float) -> DataFrame:
    """(node, body): float32 vectors with one more component, after which all are of the same length.

    Among such vectors the largest inner product is the smallest distance, so a graph of near
    vectors also leads to large inner products with a query. largest: the squared length that most vectors stay
    below; longer ones are scaled down to it, so that a few very long ones do not make all others look alike.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vecs = batch.column(1)
            rows = vecs.flatten().to_numpy().reshape(len(vecs), -1)
            own = np.linalg.norm(rows / np.abs(rows).max(axis=1, keepdims=True), axis=1) * np.abs(rows).max(axis=1)
            rows = rows / np.maximum(own, np.sqrt(largest))[:, None]
            more = np.sqrt(np.maximum(1 - (rows**2).sum(axis=1), 0))
            rows = np.column_stack((rows, more)).astype(np.float32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in rows], pa.binary())], names=["node", "body"])

    return nodes.select("node", "vec").mapInArrow(run, "node long, body binary")


def first_graph(nodes: DataFrame, count: int, k: int) -> DataFrame:
    """(node, nbr, sim): neighbours within cells around drawn pivots, several draws; a large cell is cut by hash."""
    found = None
    for draw in range(DRAWS):
        pivots = nodes.orderBy(F.xxhash64("node", F.lit(draw)), "node").limit(min(MOST_PIVOTS, count // CELL + 1))
        centres = np.stack([np.frombuffer(r["body"], np.float32) for r in pivots.select("body").collect()])

        def assign(batches: Iterator[pa.RecordBatch], centres=centres) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                cell = (matrix(batch.column(1), np.float32) @ centres.T).argmax(axis=1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], names=["node", "body", "cell"])

        placed = stored(nodes.mapInArrow(assign, "node long, body binary, cell long"), "ann-cells")
        parts = placed.groupBy("cell").agg(F.ceil(F.count("*") / (2 * CELL)).alias("parts"))
        split = placed.join(F.broadcast(parts), "cell").withColumn(  # MOST_PIVOTS rows at most
            "part", F.pmod(F.xxhash64("node", F.lit(-draw - 1)), "parts")
        )

        def near(table: pa.Table) -> pa.Table:
            ids, x = table["node"].to_numpy(), matrix(table["body"], np.float32)
            out = []
            for i in range(0, len(x), SLICE):
                sims = x[i : i + SLICE] @ x.T
                sims[np.arange(len(sims)), np.arange(i, i + len(sims))] = -np.inf
                at = best(sims, min(k, len(x) - 1))
                out.append((np.repeat(ids[i : i + SLICE], at.shape[1]), ids[at].ravel(), np.take_along_axis(sims, at, 1).ravel()))
            columns = [pa.array(np.concatenate(c)) for c in zip(*out)]
            return pa.table(columns, names=["node", "nbr", "sim"])

        edges = split.groupBy("cell", "part").applyInArrow(near, "node long, nbr long, sim float")
        found = edges if found is None else found.unionByName(edges)
    return found


def kept(edges: DataFrame, k: int) -> DataFrame:
    """(node, nbrs, sims, least): the k most similar neighbours of each node and the similarity of the last."""

    def top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column(1)
            nbr, sim = (found.flatten().field(c).to_numpy() for c in ("nbr", "sim"))
            offsets = found.offsets.to_numpy() - found.offsets[0].as_py()
            nbrs, sims, least = [], [], []
            for i, j in zip(offsets[:-1], offsets[1:]):
                order = np.lexsort((nbr[i:j], -sim[i:j]))
                own, value = nbr[i:j][order], sim[i:j][order]
                first = np.sort(np.unique(own, return_index=True)[1])[:k]
                nbrs.append(own[first])
                sims.append(value[first])
                least.append(value[first[-1]] if len(first) == k else -9.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(nbrs, pa.list_(pa.int64())), pa.array(sims, pa.list_(pa.float32())), pa.array(least, pa.float32())],
                names=["node", "nbrs", "sims", "least"],
            )

    # A node has k entries per draw, or its k and what its neighbourhoods offered.
    rows = edges.groupBy("node").agg(F.collect_list(F.struct("nbr", "sim")).alias("found"))
    return rows.mapInArrow(top, "node long, nbrs array<long>, sims array<float>, least float")


def _join_neighbourhoods(key: tuple, links: pa.Table, bodies: pa.Table) -> pa.Table:
    """Of every neighbourhood each member is offered the other members most like it, if it has worse neighbours."""
    node, least, x = bodies["node"].to_numpy(), bodies["least"].to_numpy(), matrix(bodies["body"], np.float32)
    order = np.argsort(node)
    node, least, x = node[order], least[order], x[order]
    centre, chunk = links["centre"].to_numpy(), links["chunk"].to_numpy()
    member = np.searchsorted(node, links["member"].to_numpy())
    by = np.lexsort((chunk, centre))
    centre, chunk, member = centre[by], chunk[by], member[by]
    cuts = np.flatnonzero((np.diff(centre) != 0) | (np.diff(chunk) != 0)) + 1
    out = []
    for own in np.split(member, cuts):
        own = np.unique(own)
        if len(own) < 2:
            continue
        sims = x[own] @ x[own].T
        np.fill_diagonal(sims, -np.inf)
        at = best(sims, min(OFFERS, len(own) - 1))
        value = np.take_along_axis(sims, at, 1)
        better = value > least[own][:, None]
        row, column = np.nonzero(better)
        out.append((own[row] * len(node) + own[at[row, column]], value[row, column]))
    if not out:
        return pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float32())], names=["node", "nbr", "sim"])
    pairs, sim = (np.concatenate(c) for c in zip(*out))
    pairs, where = np.unique(pairs, return_index=True)
    return pa.table([pa.array(node[pairs // len(node)]), pa.array(node[pairs % len(node)]), pa.array(sim[where])], names=["node", "nbr", "sim"])


def descend(nodes: DataFrame, graph: DataFrame, cells: DataFrame, count: int, k: int) -> DataFrame:
    """One round: the neighbours of a node, in either direction, get to know each other.

    Neighbourhoods come together by block, a piece of one cell, so that a vector goes to a block
    once. A node that is a neighbour of very many is cut into chunks of its reverse links.
    """
    out = graph.select(F.col("node").alias("centre"), F.explode("nbrs").alias("member"))
    back = out.select(F.col("member").alias("centre"), F.col("centre").alias("member"))
    chunks = back.groupBy("centre").agg(F.ceil(F.count("*") / CHUNK).alias("chunks"))
    back = back.join(chunks, "centre").withColumn("chunk", F.pmod(F.xxhash64("member"), "chunks"))
    out = out.join(chunks, "centre", "left").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.coalesce("chunks", F.lit(1)) - 1)))
    links = out.select("centre", "member", "chunk").unionByName(back.select("centre", "member", "chunk"))
    block = F.when(F.col("chunk") == 0, F.col("block")).otherwise(F.pmod(F.xxhash64("centre", "chunk"), F.lit(count // BLOCK + 1)))
    links = stored(links.join(cells.withColumnRenamed("node", "centre"), "centre").withColumn("block", block), "ann-links")
    needed = links.select("block", F.col("member").alias("node")).distinct().toDF("home", "node").join(nodes, "node").join(graph.select("node", "least"), "node")
    offered = links.groupBy("block").cogroup(needed.groupBy("home")).applyInArrow(
        _join_neighbourhoods, "node long, nbr long, sim float"
    )
    old = graph.select("node", F.explode(F.arrays_zip("nbrs", "sims")).alias("e")).select("node", F.col("e.nbrs").alias("nbr"), F.col("e.sims").alias("sim"))
    return kept(old.unionByName(offered), k)


def blocked(graph: DataFrame, count: int) -> DataFrame:
    """(node, block): blocks of like nodes, those of one smallest neighbour; where that are more than BLOCK, they are cut by hash."""
    leads = graph.select("node", F.least("node", F.array_min("nbrs")).alias("lead"))
    parts = leads.groupBy("lead").agg(F.ceil(F.count("*") / BLOCK).alias("parts"))
    part = F.pmod(F.xxhash64("node"), "parts")
    return leads.join(parts, "lead").select("node", F.pmod(F.xxhash64("lead", part), F.lit(count // BLOCK + 1)).alias("block"))


def build(nodes: DataFrame, count: int, k: int = NEIGHBOURS) -> DataFrame:
    """(node, nbrs): the neighbour graph. nodes: (node, body), bodies all different."""
    graph = stored(kept(first_graph(nodes, count, k), k), "ann-graph")
    cells = stored(blocked(graph, count), "ann-blocks")
    for _ in range(DESCENTS):
        graph = stored(descend(nodes, graph, cells, count, k), "ann-graph")
    return graph.select("node", "nbrs")


def graph_table(nodes: DataFrame, graph: DataFrame, count: int, name: str, k: int = NEIGHBOURS) -> None:
    """Save each node's neighbours with their vectors (16-bit floats), bucketed by node."""
    links = graph.select("node", F.explode("nbrs").alias("nbr"))

    def halve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            half = matrix(batch.column(1), np.float32).astype(np.float16)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([h.tobytes() for h in half], pa.binary())], names=["nbr", "half"])

    halves = nodes.mapInArrow(halve, "nbr long, half binary")
    packs = links.join(halves, "nbr").groupBy("node").agg(F.collect_list(F.struct("nbr", "half")).alias("nbrs"))
    wide = len(nodes.select("body").first()["body"]) // 2 + 8
    buckets = int(max(8, count * k * wide // BUCKET_BYTES + 1))
    packs.repartition(buckets, "node").write.bucketBy(buckets, "node").saveAsTable(name)


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Scores of the neighbours of an opened node for the query that asked."""
    for batch in slices(batches):
        asked, nbrs = matrix(batch.column("body"), np.float32), batch.column("nbrs")
        flat, sizes = nbrs.flatten(), np.diff(nbrs.offsets.to_numpy())
        scores = np.einsum("ij,ij->i", matrix(flat.field("half"), np.float16), np.repeat(asked, sizes, axis=0))
        offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32())
        yield pa.RecordBatch.from_arrays(
            [batch.column("query"), pa.ListArray.from_arrays(offsets, flat.field("nbr")),
             pa.ListArray.from_arrays(offsets, pa.array(scores.astype(np.float32)))],
            names=["query", "nodes", "scores"],
        )


STATE = "query long, body binary, nodes array<long>, scores array<float>, opened array<boolean>, asks array<long>"


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The beam after a round: old and new nodes, the best BEAM of them, and which ones to open next."""
    for batch in slices(batches):
        rows = []
        for row in batch.to_pylist():
            nodes = np.concatenate((row["nodes"], *(row["met_nodes"] or ()))).astype(np.int64)
            scores = np.concatenate((row["scores"], *(row["met_scores"] or ()))).astype(np.float32)
            opened = np.zeros(len(nodes), bool)
            opened[: len(row["opened"])] = np.array(row["opened"], bool) | np.isin(row["nodes"], row["asks"])
            nodes, first = np.unique(nodes, return_index=True)  # an old node comes before its new copy
            order = np.lexsort((nodes, -scores[first]))[:BEAM]
            at = first[order]
            nodes, scores, opened = nodes[order], scores[at], opened[at]
            rows.append((nodes, scores, opened, nodes[~opened][:OPEN]))
        kinds = (pa.int64(), pa.float32(), pa.bool_(), pa.int64())
        columns = [pa.array(c, pa.list_(t)) for c, t in zip(zip(*rows), kinds)] if rows else [pa.array([], pa.list_(t)) for t in kinds]
        yield pa.RecordBatch.from_arrays(
            [batch.column("query"), batch.column("body"), *columns], names=["query", "body", "nodes", "scores", "opened", "asks"]
        )


def search(table: DataFrame, queries: DataFrame, starts: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """(query, nodes): the best nodes that a greedy search has met, from the query's own node and the best of `starts`.

    Each round opens the OPEN best nodes of a beam that are not open yet: the requests go to the
    graph table's buckets, which stay in place, and bring back the scores of the neighbours.
    queries: (query, body), where query is a node; starts: numbers and bodies of a bounded number of nodes.
    """
    numbers, bodies = starts

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = matrix(batch.column(1), np.float32) @ bodies.T
            at = best(scores, OPEN)
            rows = []
            for query, spots, values in zip(batch.column(0).to_pylist(), at, np.take_along_axis(scores, at, 1)):
                other = numbers[spots] != query
                nodes = np.concatenate(([query], numbers[spots][other]))
                rows.append((nodes, np.concatenate(([9.0], values[other])), np.zeros(len(nodes), bool), nodes))
            kinds = (pa.int64(), pa.float32(), pa.bool_(), pa.int64())
            columns = [pa.array(c, pa.list_(t)) for c, t in zip(zip(*rows), kinds)] if rows else [pa.array([], pa.list_(t)) for t in kinds]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=["query", "body", "nodes", "scores", "opened", "asks"])

    state = queries.select("query", "body").mapInArrow(begin, STATE)
    for _ in range(ROUNDS):
        asks = state.select("query", "body", F.explode("asks").alias("node"))
        met = asks.join(table, "node").select("query", "body", "nbrs")
        met = met.mapInArrow(_scored, "query long, nodes array<long>, scores array<float>").groupBy("query")
        met = met.agg(F.collect_list("nodes").alias("met_nodes"), F.collect_list("scores").alias("met_scores"))  # OPEN at most
        state = stored(state.join(met, "query", "left").mapInArrow(_merged, STATE), "ann-beam")
        if state.where("size(asks) > 0").isEmpty():
            break
    return state.select("query", "nodes")


def squared_length() -> Column:
    return F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)


def _found(own: DataFrame, starts: DataFrame, count: int, largest: float) -> DataFrame:
    """(query, node): what the search from `starts` (query) has met in the graph of `own` (node, vec). Nothing is left to compute."""
    spark = own.sparkSession
    nodes = stored(packed(own, largest), "ann-nodes")
    name = f"ann_graph_{uuid.uuid4().hex}"
    graph_table(nodes, build(nodes, count), count, name)
    # The added component is part of the graph's distances, not of the product that is asked for.
    plain = F.concat(F.substring("body", F.lit(1), F.length("body") - 4), F.lit(b"\x00\x00\x00\x00")).alias("body")
    asks = nodes.select(F.col("node").alias("query"), plain)
    longest = own.orderBy(squared_length().desc(), "node").limit(STARTS).select("node").join(nodes, "node").orderBy("node").collect()
    first = np.array([r["node"] for r in longest]), np.stack([np.frombuffer(r["body"], np.float32) for r in longest])
    found = search(spark.table(name), starts.join(asks, "query"), first)
    found = stored(found.select("query", F.explode(F.array_union("nodes", F.array("query"))).alias("node")), "ann-found")
    spark.sql(f"drop table {name}")
    return found


def neighbours(vectors: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query its k rows of largest inner product, itself left out.

    vectors: vec_id, embedding; queries: vec_id of rows of `vectors`.

    Equal vectors are one node of the graph. First neighbours come from drawn cells; in rounds of
    NN-descent the neighbours of a node, found by joins, get to know each other; queries then go
    through the graph greedily, best first, from their own node and from the longest vectors that suit them. What they met is scored again in double precision on the
    original vectors, for every copy that can be among the k.

    * null id, null, empty, zero, or not wholly finite vector, or one of an unusual length: no part, neither as query
      nor as result; of an id with several vectors the smallest counts. Ties go to the smaller vec_id.
    * fewer candidates than k: all of them. Empty table: empty result. Other columns are not read.
    """
    spark = vectors.sparkSession
    rows = stored(_noded(clean(vectors)), "ann-rows")
    own = rows.where("vec_id = node").select("node", "vec")
    sizes = own.agg(F.count("*").alias("n"), F.percentile_approx(squared_length(), USUAL_LENGTH, 10_000).alias("largest")).first()
    asked = rows.join(queries.select("vec_id").distinct(), "vec_id", "left_semi").select(F.col("vec_id").alias("query_id"), "node")
    starts = asked.select(F.col("node").alias("query")).distinct()
    if sizes["n"] > 1:
        with small_batches(spark):
            found = _found(own, starts, sizes["n"], min(sizes["largest"] or 1.0, 1e300))
    else:
        found = starts.select("query", F.col("query").alias("node"))
    product = F.aggregate(F.zip_with("a", "b", lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)
    pairs = found.join(own.select(F.col("node").alias("query"), F.col("vec").alias("a")), "query").join(
        own.select("node", F.col("vec").alias("b")), "node"
    )
    first = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    copies = Window.partitionBy("node").orderBy("vec_id")
    few = rows.select("node", "vec_id").withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= k + 1).drop("copy")
    ranked = (
        pairs.select("query", "node", product.alias("score"))
        .join(few, "node")
        .withColumn("place", F.row_number().over(first))
        .where(F.col("place") <= k + 1)
    )
    own_first = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        asked.withColumnRenamed("node", "query")
        .join(ranked.select("query", "vec_id", "score"), "query")
        .where("vec_id <> query_id")
        .withColumn("rank", F.row_number().over(own_first))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


def _noded(rows: DataFrame) -> DataFrame:
    """Adds `node`: the smallest vec_id of an equal vector."""
    first = rows.groupBy("vec").agg(F.min("vec_id").alias("node"))
    return rows.join(first, "vec")
