"""Approximate nearest neighbours by NN-descent and greedy graph search.

*Index.* Equal vectors are one node. A first graph comes from blocks: nodes in
the order of random projections are cut into blocks of equal size, and nearest
nodes of a block are neighbours. NN-descent then improves it by Spark joins:
every node brings its neighbours, forward and reverse, together; pairs of which
one is a new neighbour are measured, and a pair that beats the worst neighbour of
either side becomes an edge. Forward and reverse lists are cut to the nearest
few by windows with partial limits, so a popular node is not a hot group.

*Search.* A query keeps a beam of the nearest nodes seen. Every round the nodes
of the beam that were not yet expanded are joined with the graph, their
neighbours are measured if new, and the beam is cut again, until nothing in it
is left to expand. Queries go in blocks of a fixed number, whose vectors and
worst distances are what each task gets to know. Results are measured again in
double precision on the original vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martweave.llm.common import numbered, partitions, settled

NEIGHBOURS, SIDE, ROUNDS, BEAM = 24, 16, 4, 448
BLOCK, PROJECTIONS = 200, 4
QUERY_BLOCK = 4096
_EDGES = "u bigint, v bigint, d double"


def _vectors(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _edges(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    u, v, d = (np.concatenate(x) for x in zip(*parts, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v), pa.array(d)], names=["u", "v", "d"])


def _groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """The rows of each value of ``key``, from rows sorted by it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        if held and held[-1].column(key)[0].as_py() != keys[0]:
            yield _joined(held)
            held = []
        for a, b in zip(cuts[:-1], cuts[1:]):
            if a:
                yield _joined(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield _joined(held)


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def _distances(x: np.ndarray) -> np.ndarray:
    squares = (x * x).sum(1)
    return np.sqrt(np.maximum(0.0, squares[:, None] + squares[None, :] - 2 * x @ x.T))


def usable(frame: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, vec`` of the rows that take part.

    Null ids and null, empty or zero vectors do not, nor vectors with null or
    non-finite components or with another length than most. Of rows that repeat
    an id the least vector counts.
    """
    finite = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = frame.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).where(
        finite & F.exists(vector_col, lambda x: x != 0)
    )
    rows = rows.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).alias("vec"))
    lengths = rows.groupBy(F.size("vec").alias("length")).count().orderBy(F.desc("count"), "length").first()
    return rows.where(F.size("vec") == (lengths["length"] if lengths else 0)).groupBy("vec_id").agg(F.min("vec").alias("vec"))


def nodes_of(rows: DataFrame, keep: int) -> DataFrame:
    """``node, vec, ids``: distinct vectors; the node is the smallest id, ``ids`` the ``keep`` smallest."""
    # Two limits, the first within parts of a group, so equal vectors need not meet in one task.
    rows = rows.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(64))).withColumn("key", F.xxhash64("vec"))
    few = Window.partitionBy("key", "vec", "part").orderBy("vec_id")
    rows = rows.withColumn("nth", F.row_number().over(few)).where(F.col("nth") <= keep)
    grouped = rows.groupBy("vec").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    return grouped.select(F.element_at("ids", 1).alias("node"), "vec", F.slice("ids", 1, keep).alias("ids"))


def nearest_per(edges: DataFrame, key: str, by: str, k: int) -> DataFrame:
    first = Window.partitionBy(key).orderBy("d", by)
    return edges.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= k).drop("nth")


def _first_graph(nodes: DataFrame, k: int, n_nodes: int) -> DataFrame:
    spark = nodes.sparkSession
    bits = max(0, int(np.log2(max(1, n_nodes / BLOCK))))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _vectors(batch.column("vec"))
            ids = batch.column("node").to_numpy()
            for r in range(PROJECTIONS):
                axes = np.random.default_rng(r).normal(size=(x.shape[1], bits + 1))
                y = x @ axes
                code = ((y[:, :bits] > 0) * (1 << np.arange(bits))).sum(1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids), pa.array(np.full(len(ids), r, np.int32)), pa.array(code.astype(np.int64)), pa.array(y[:, -1])],
                    names=["node", "r", "code", "along"],
                )

    placed = nodes.select("node", "vec").mapInArrow(project, "node bigint, r int, code bigint, along double")
    placed = numbered(placed, [F.col("code"), F.col("along"), F.col("node")], "r", "at")
    blocks = placed.select("node", "r", F.floor(F.col("at") / BLOCK).alias("block"))
    dealt = (
        blocks.join(nodes.select("node", "vec"), "node")
        .withColumn("key", F.col("block") * PROJECTIONS + F.col("r"))
        .select("key", "node", "vec")
        .repartition(partitions(spark), "key")
        .sortWithinPartitions("key", "node")
    )

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, "key"):
            ids, d = group.column("node").to_numpy(zero_copy_only=False), _distances(_vectors(group.column("vec")))
            np.fill_diagonal(d, np.inf)
            take = np.argsort(d, axis=1)[:, : min(k, len(ids) - 1)]
            if take.size:
                yield _edges([(np.repeat(ids, take.shape[1]), ids[take].ravel(), np.take_along_axis(d, take, 1).ravel())])

    edges = dealt.mapInArrow(near, _EDGES).groupBy("u", "v").agg(F.min("d").alias("d"))
    return settled(nearest_per(edges, "u", "v", k).withColumn("fresh", F.lit(True)), "graph")


def _descend(graph: DataFrame, nodes: DataFrame, k: int, side: int) -> DataFrame:
    """One round of NN-descent."""
    worst = graph.groupBy("u").agg(F.max("d").alias("worst"), F.count(F.lit(1)).alias("n"))
    worst = worst.select(F.col("u").alias("member"), F.when(F.col("n") < k, float("inf")).otherwise(F.col("worst")).alias("worst"))
    forward = nearest_per(graph, "u", "v", side).select(F.col("u").alias("x"), F.col("v").alias("member"), "fresh")
    reverse = nearest_per(graph, "v", "u", side).select(F.col("v").alias("x"), F.col("u").alias("member"), "fresh")
    members = forward.union(reverse).groupBy("x", "member").agg(F.max("fresh").alias("fresh"))
    bearing = nodes.select(F.col("node").alias("member"), "vec").join(worst, "member", "left")
    dealt = (
        members.join(bearing, "member")
        .select("x", "member", "fresh", F.coalesce("worst", F.lit(float("inf"))).alias("worst"), "vec")
        .repartition(partitions(graph.sparkSession), "x")
        .sortWithinPartitions("x", "member")
    )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for group in _groups(batches, "x"):
            fresh = group.column("fresh").to_numpy(zero_copy_only=False)
            if not fresh.any():
                continue
            ids = group.column("member").to_numpy(zero_copy_only=False)
            d = _distances(_vectors(group.column("vec")))
            better = (d < group.column("worst").to_numpy(zero_copy_only=False)[:, None]) & (fresh[:, None] | fresh[None, :])
            np.fill_diagonal(better, False)
            a, b = np.nonzero(better)
            parts.append((ids[a], ids[b], d[a, b]))
            size += len(a)
            if size > 100_000:
                yield _edges(parts)
                parts, size = [], 0
        if size:
            yield _edges(parts)

    found = dealt.mapInArrow(meet, _EDGES).withColumn("fresh", F.lit(True))
    merged = graph.unionByName(found).groupBy("u", "v").agg(F.min("d").alias("d"), F.min("fresh").alias("fresh"))
    # Edges that were compared in this round are no longer new.
    old = graph.select("u", "v", F.lit(False).alias("was"))
    kept = nearest_per(merged, "u", "v", k)
    kept = kept.join(old, ["u", "v"], "left").select("u", "v", "d", F.coalesce("was", F.lit(True)).alias("fresh"))
    return settled(kept, "graph")


def build_index(
    frame: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    neighbours: int = NEIGHBOURS,
    rounds: int = ROUNDS,
    keep: int = 11,
) -> tuple[DataFrame, DataFrame]:
    """(nodes, graph) of all usable vectors: ``node, vec, ids`` and ``u, v, d``."""
    nodes = settled(nodes_of(usable(frame, id_col, vector_col), keep), "nodes")
    graph = _first_graph(nodes, neighbours, nodes.count())
    for _ in range(rounds):
        graph = _descend(graph, nodes, neighbours, SIDE)
    return nodes, graph


def _search_block(queries: DataFrame, nodes: DataFrame, links: DataFrame, beam: int) -> DataFrame:
    """``q, node``: the beams of one block of queries ``query_id, q, node, vec``, each starting at its own node."""
    rows = queries.orderBy("q").collect()  # at most QUERY_BLOCK vectors
    vectors = np.array([r["vec"] for r in rows], dtype=np.float64)
    state = settled(
        queries.select("q", "node", F.lit(0.0).cast("double").alias("d"), F.lit(False).alias("expanded")), "beam"
    )
    while True:
        ahead = state.where("not expanded").select("q", F.col("node").alias("u"))
        if ahead.isEmpty():
            return state.select("q", "node")
        worst = np.full(len(rows), np.inf)
        for r in state.groupBy("q").agg(F.max("d").alias("d"), F.count(F.lit(1)).alias("n")).where(f"n >= {beam}").collect():
            worst[r["q"]] = r["d"]
        asked = links.join(ahead, "u").groupBy(F.col("v").alias("node")).agg(F.collect_set("q").alias("asked"))

        def measure(batches: Iterator[pa.RecordBatch], vectors=vectors, worst=worst) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                node, x = batch.column("node").to_numpy(zero_copy_only=False), _vectors(batch.column("vec"))
                asked = batch.column("asked")
                q = asked.flatten().to_numpy(zero_copy_only=False)
                counts = asked.value_lengths().to_numpy(zero_copy_only=False)
                at = np.repeat(np.arange(len(node)), counts)
                parts = []
                for low in range(0, len(q), 1 << 16):
                    i, j = q[low : low + (1 << 16)], at[low : low + (1 << 16)]
                    d = np.sqrt(((vectors[i] - x[j]) ** 2).sum(1))
                    near = d < worst[i]
                    parts.append((i[near].astype(np.int64), node[j[near]], d[near]))
                if parts:
                    q, v, d = (np.concatenate(p) for p in zip(*parts, strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array(q.astype(np.int32)), pa.array(v), pa.array(d)], names=["q", "node", "d"])

        found = asked.join(nodes.select("node", "vec"), "node").mapInArrow(measure, "q int, node bigint, d double")
        seen = state.withColumn("expanded", F.lit(True)).unionByName(found.withColumn("expanded", F.lit(False)))
        merged = seen.groupBy("q", "node").agg(F.min("d").alias("d"), F.max("expanded").alias("expanded"))
        state = settled(nearest_per(merged, "q", "node", beam), "beam")


def search(
    queries: DataFrame, nodes: DataFrame, graph: DataFrame, k: int = 10, beam: int = BEAM, query_block: int = QUERY_BLOCK
) -> DataFrame:
    """``query_id, rank, vec_id, score`` for queries that are rows of the index.

    ``queries(query_id, vec)`` are rows that the index was built from; a query is
    no candidate of its own. Vectors that the index does not hold get no row.
    """
    spark = nodes.sparkSession
    homes = queries.dropDuplicates(["query_id"]).join(nodes.select("node", "vec"), "vec")
    asked = settled(numbered(homes.select("query_id", "node", "vec"), [F.col("query_id")], name="at"), "queries")
    both = graph.select("u", "v").union(nearest_per(graph, "v", "u", NEIGHBOURS).select(F.col("v").alias("u"), F.col("u").alias("v")))
    links = settled(both.distinct(), "links")
    total, out = asked.count(), None
    for low in range(0, total, query_block):
        block = asked.where((F.col("at") >= low) & (F.col("at") < low + query_block))
        block = block.withColumn("q", (F.col("at") - low).cast("int"))
        beams = _search_block(block, nodes, links, beam)
        found = (
            beams.join(block.select("q", "query_id", F.col("vec").alias("query_vec")), "q")
            .join(nodes, "node")
            .withColumn("vec_id", F.explode("ids"))
            .where("vec_id <> query_id")
            .select("query_id", "vec_id", "query_vec", "vec")
        )
        out = found if out is None else out.unionByName(found)
    if out is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    squares = F.aggregate(
        F.zip_with("query_vec", "vec", lambda a, b: (a.cast("double") - b.cast("double")) * (a.cast("double") - b.cast("double"))),
        F.lit(0.0).cast("double"),
        lambda s, x: s + x,
    )
    scored = out.select("query_id", "vec_id", F.sqrt(squares).alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
