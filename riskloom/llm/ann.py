"""Approximate nearest neighbours: NN-descent builds a neighbour graph with joins, queries search it greedily.

*Graph.*  Equal vectors form one node (its smallest vec_id).  Nodes are dealt at random to blocks, ``deals`` times,
and the nearest ``degree`` of a node's blocks are its first neighbours.  In each round every node introduces its
neighbours, forward and backward, to each other: a join puts their coded vectors (one byte a component, in parts
of the vector's own largest component, so that one long vector does not blur the others) beside each other, and pairs nearer than the farthest neighbour of either are proposed.  The best
``degree`` stay.  Rounds end when few neighbours change.  A round looks at ``degree`` forward and at most
``degree`` backward neighbours of a node (the sampling that belongs to NN-descent), so its work is linear in the
nodes, and popular nodes are cut to that number in two steps, never in one task.

*Search.*  A query begins at the nearest of ``pivots`` sampled nodes (a documented bound) and, if it is indexed
itself, at its own node.  Each step expands its nearest ``width`` nodes not yet expanded along the graph in both
directions, computes exact distances, and keeps the best ``beam`` (more than k); it ends when all of them are expanded.
The nodes found are opened to their vec_ids, of which as many as the answer needs are kept for each
node, and ranked by exact distance and vec_id.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components, and those whose
length is not the most frequent one (the longer on a tie), take no part; null vec_ids take none either;
repeated rows count once; a query with no other candidate gives no rows, and one with fewer than k
gives all; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise, read_table

EDGE = "node long, nbr long, d double"


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, vec) of the rows that take part."""
    v = vectors.where("vec_id is not null and embedding is not null and size(embedding) > 0").select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    v = v.where(F.coalesce(finite, F.lit(False))).where(F.exists("vec", lambda x: x != 0))
    sizes = v.groupBy(F.size("vec").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).limit(1).collect()
    return v.where(F.size("vec") == (sizes[0]["dim"] if sizes else 0))


def _first(df: DataFrame, by: str, spread: str, order: list, n: int, salts: int = 32) -> DataFrame:
    """The first n rows of each ``by`` group in ``order``, in two steps so that no group meets whole in one task."""
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)))
    for keys in ([by, "_salt"], [by]):
        salted = salted.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_n") <= n)
    return salted.drop("_n", "_salt")


def _distances(x: np.ndarray) -> np.ndarray:
    """Squared distances between the rows of x."""
    s = (x * x).sum(1)
    return np.maximum(s[:, None] + s[None, :] - 2 * (x @ x.T), 0)


def _code(vec: list) -> bytes:
    """A vector as its scale (8 bytes) and one byte a component."""
    v = np.asarray(vec, np.float64)
    peak = np.abs(v).max()
    return (peak / 127).tobytes() + np.rint(v / peak * 127).astype(np.int8).tobytes()


def _decoded(codes: list[bytes]) -> np.ndarray:
    raw = np.frombuffer(b"".join(codes), np.int8).reshape(len(codes), -1)
    return raw[:, 8:] * np.ascontiguousarray(raw[:, :8]).view(np.float64)


def _blocks(nodes: DataFrame, degree: int, block: int, count: int, deals: int) -> DataFrame:
    """First neighbours: the nearest within random blocks of about ``block`` nodes, dealt anew ``deals`` times."""
    blocks = max(1, round(count / block))
    deals = deals if blocks > 1 else 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, codes in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                x = _decoded(codes)
                d = _distances(x)
                np.fill_diagonal(d, np.inf)
                k = min(degree, len(ids) - 1)
                if k < 1:
                    continue
                near = np.argpartition(d, k - 1, axis=1)[:, :k]
                own = np.asarray(ids, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(own, k)), pa.array(own[near].ravel()), pa.array(np.take_along_axis(d, near, 1).ravel().astype(np.float64))], names=["node", "nbr", "d"])

    dealt = nodes.withColumn("deal", F.explode(F.sequence(F.lit(1), F.lit(deals)))).groupBy("deal", F.pmod(F.xxhash64("deal", "node"), F.lit(blocks)).alias("b"))
    dealt = dealt.agg(F.collect_list(F.struct("node", "code")).alias("rows"))
    return dealt.select(F.col("rows.node").alias("ids"), F.col("rows.code").alias("codes")).mapInArrow(run, EDGE)


def _introduce(met: DataFrame) -> DataFrame:
    """Rows of (ids, codes, radii) -> pairs nearer than either's radius."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list[np.ndarray]] = [[], [], []]
            for ids, codes, radii, fresh in zip(*(batch.column(i).to_pylist() for i in range(4))):
                x = _decoded(codes)
                d, r, new, own = _distances(x), np.asarray(radii), np.asarray(fresh, bool), np.asarray(ids, np.int64)
                np.fill_diagonal(d, np.inf)
                a, b = np.nonzero((d < r[:, None]) & (new[:, None] | new[None, :]))
                out[0].append(own[a]), out[1].append(own[b]), out[2].append(d[a, b].astype(np.float64))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(o)) for o in out], names=["node", "nbr", "d"])

    return met.select("ids", "codes", "radii", "fresh").mapInArrow(run, EDGE)


def _best(edges: DataFrame, degree: int) -> DataFrame:
    """Each node's nearest ``degree`` of its distinct neighbours; ``fresh`` where the edge is new."""
    one = edges.groupBy("node", "nbr").agg(F.min("d").alias("d"), F.min("fresh").alias("fresh"))
    n = F.row_number().over(Window.partitionBy("node").orderBy("d", "nbr"))
    return one.withColumn("_n", n).where(F.col("_n") <= degree).drop("_n")


def build_graph(nodes: DataFrame, degree: int = 32, block: int = 512, deals: int = 4, max_rounds: int = 10, settle: float = 0.01) -> DataFrame:
    """nodes (node, vec) -> edges (node, nbr, d): each node's near neighbours by coded vectors."""
    count = nodes.count()

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = [_code(v) for v in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(codes, pa.binary())], names=["node", "code"])

    coded = materialise(nodes.select("node", "vec").mapInArrow(code, "node long, code binary"), "codes")
    graph = materialise(_best(_blocks(coded, degree, block, count, deals).withColumn("fresh", F.lit(True)), degree), "graph")
    for _ in range(max_rounds):
        radius = graph.groupBy("node").agg(F.when(F.count("*") >= degree, F.max("d")).otherwise(F.lit(float("inf"))).alias("radius"))
        described = materialise(coded.join(radius, "node", "left").select(F.col("node").alias("nbr"), "code", F.coalesce("radius", F.lit(float("inf"))).alias("radius")), "described")
        back = _first(graph.select(F.col("nbr").alias("node"), F.col("node").alias("nbr"), "d", "fresh"), "node", "nbr", [F.desc("fresh"), F.col("d"), F.col("nbr")], degree)
        near = graph.unionByName(back).groupBy("node", "nbr").agg(F.max("fresh").alias("fresh"))
        met = near.join(described, "nbr").groupBy("node").agg(F.collect_list(F.struct("nbr", "code", "radius", "fresh")).alias("m"), F.max("fresh").alias("any"))
        met = met.where("any").select(F.col("m.nbr").alias("ids"), F.col("m.code").alias("codes"), F.col("m.radius").alias("radii"), F.col("m.fresh").alias("fresh"))
        proposed = _introduce(met).withColumn("fresh", F.lit(True))
        graph = materialise(_best(graph.withColumn("fresh", F.lit(False)).unionByName(proposed), degree), "graph")
        if graph.where("fresh").count() <= settle * degree * count:
            break
    return graph.select("node", "nbr", "d")


def _exact():
    return F.sqrt(F.aggregate(F.zip_with("qvec", "vec", lambda a, b: F.pow(a.cast("double") - b.cast("double"), F.lit(2.0))), F.lit(0.0), lambda s, x: s + x))


def search(graph: DataFrame, nodes: DataFrame, queries: DataFrame, beam: int = 96, width: int = 48, pivots: int = 256, degree: int = 32, max_steps: int = 24) -> DataFrame:
    """queries (query, qvec, own: its node or null) -> (query, node, d), the nearest ``beam`` nodes reached."""
    sample = nodes.orderBy(F.xxhash64(F.lit(11), "node"), "node").limit(pivots).collect()
    if not sample:
        return queries.sparkSession.createDataFrame([], "query long, node long, d double")
    ids, points = np.array([r["node"] for r in sample], np.int64), np.array([r["vec"] for r in sample])

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                q = np.array(batch.column(1).to_pylist())
                d = (q * q).sum(1)[:, None] + (points * points).sum(1)[None, :] - 2 * q @ points.T
                near = np.argsort(d, axis=1, kind="stable")[:, :4]
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(batch.column(0).to_numpy(), near.shape[1])), pa.array(ids[near].ravel())], names=["query", "node"])

    linked = graph.select("node", "nbr", "d").union(graph.select(F.col("nbr"), F.col("node"), F.col("d"))).distinct()
    # Backward edges of popular nodes: the nearest, twice as many as forward ones.
    linked = materialise(_first(linked, "node", "nbr", [F.col("d"), F.col("nbr")], 2 * degree).select("node", "nbr"), "adjacency")
    queries = materialise(queries, "queries")
    start = queries.select("query", "qvec").mapInArrow(enter, "query long, node long")
    start = start.union(queries.where("own is not null").select("query", "own")).distinct()
    measured = lambda c: c.join(nodes, "node").join(queries.select("query", "qvec"), "query").select("query", "node", _exact().alias("d"))
    state = materialise(measured(start).withColumn("expanded", F.lit(False)), "search")
    order = Window.partitionBy("query").orderBy("d", "node")
    for _ in range(max_steps):
        ranked = state.withColumn("_r", F.row_number().over(order))
        pick = (~F.col("expanded")) & (F.col("_r") <= beam)
        ranked = ranked.withColumn("_p", F.sum(pick.cast("int")).over(order)).withColumn("now", pick & (F.col("_p") <= width))
        ranked = materialise(ranked.where(F.col("_r") <= beam).drop("_r", "_p"), "search")
        if ranked.where("now").isEmpty():
            return ranked.select("query", "node", "d")
        new = ranked.where("now").join(linked, "node").select("query", F.col("nbr").alias("node")).distinct().join(ranked.select("query", "node"), ["query", "node"], "left_anti")
        state = ranked.select("query", "node", "d", (F.col("expanded") | F.col("now")).alias("expanded")).unionByName(measured(new).withColumn("expanded", F.lit(False)))
    return materialise(state, "search").select("query", "node", "d")


def nearest(vectors: DataFrame, is_query, k: int = 10, degree: int = 32, **options) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every row of ``vectors`` where ``is_query`` holds."""
    v = usable(vectors).withColumn("h", F.xxhash64("vec")).withColumn("g", F.hash("vec"))
    v = materialise(v, "vectors")
    firsts = materialise(v.groupBy("h", "g").agg(F.min("vec_id").alias("node")), "nodes")
    nodes = materialise(v.join(firsts, ["h", "g"]).where("vec_id = node").select("node", "vec").dropDuplicates(["node"]), "nodes")
    named = materialise(v.join(firsts, ["h", "g"]).select("vec_id", "node", "vec").distinct(), "named")
    graph = build_graph(nodes, degree)
    queries = named.where(is_query).select(F.col("vec_id").alias("query"), F.col("vec").alias("qvec"), F.col("node").alias("own")).dropDuplicates(["query"])
    reached = search(graph, nodes, queries, degree=degree, **options)
    members = _first(named.select("node", "vec_id").distinct(), "node", "vec_id", [F.col("vec_id")], k + 1)
    out = reached.join(members, "node").where("vec_id <> query")
    rank = F.row_number().over(Window.partitionBy("query").orderBy("d", "vec_id"))
    return out.withColumn("rank", rank).where(F.col("rank") <= k).select(F.col("query").alias("query_id"), "rank", "vec_id", F.col("d").alias("score"))


def op9_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 100 == 0)
