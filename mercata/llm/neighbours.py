"""Approximate nearest neighbours by largest inner product: one graph per shard, results merged.

Equal vectors are one node that keeps its smallest ids, as many as a result can hold; they are chosen
by a limit that Spark applies before the shuffle, so a vector that a third of the rows share costs a
few rows per task. Nodes are dealt out by hash to shards of about ``SHARD`` nodes, so the number of shards
grows with the table and no graph does. Queries go in blocks to all shards of their dimension; each
pair of block and shard is one row of bounded size, and each shard returns its best for each query
with exact scores, of which the best are kept. Vectors that are null, zero or hold null or
non-finite components take no part, nor do rows without an id; rows of equal id count once, and a
query never finds its own id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercata.llm import hnsw
from mercata.llm.common import read_table
from mercata.session import cut_lineage

SHARD = 8192
BLOCK = 2048
INDEX = "dim int, shard int, n int, vectors binary, ids array<array<long>>, sizes array<int>, nodes binary, links binary"
FOUND = "query_id long, ids array<long>, scores array<double>"


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id and vector (array<double>) of the rows that take part."""
    rows = df.select(df[id_col].cast("long").alias("vec_id"), df[vector_col].cast("array<double>").alias("vector"))
    return rows.where(
        "vec_id IS NOT NULL AND size(vector) > 0 "
        "AND forall(vector, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity')) "
        "AND exists(vector, x -> x <> 0)"
    )


def indexed(rows: DataFrame, k: int) -> DataFrame:
    """One row per shard: its vectors, their ids (the ``k`` + 1 smallest of each) and its graph."""
    place = Window.partitionBy("vector").orderBy("vec_id")
    first = rows.dropDuplicates(["vec_id", "vector"]).withColumn("at", F.row_number().over(place)).where(F.col("at") <= k + 1)
    nodes = cut_lineage(
        first.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).withColumn("dim", F.size("vector")), "vectors"
    )
    sizes = {r["dim"]: r["count"] for r in nodes.groupBy("dim").count().collect()}  # one row per dimension
    shards = F.create_map(*[F.lit(x) for d, c in sizes.items() for x in (int(d), -(-int(c) // SHARD))]) if sizes else None
    dealt = F.pmod(F.xxhash64("vector"), shards[F.col("dim")]).cast("int") if sizes else F.lit(0)

    def run(table: pa.Table) -> pa.Table:
        dim, shard = (table.column(c)[0].as_py() for c in ("dim", "shard"))
        vectors = _matrix(table.column("vector").combine_chunks(), dim)
        order = np.lexsort(vectors.T[::-1])  # the graph does not depend on the order rows come in
        ids = table.column("ids").take(pa.array(order))
        graph = hnsw.build(vectors[order].astype(np.float32))
        return pa.table(
            {
                "dim": pa.array([dim], pa.int32()),
                "shard": pa.array([shard], pa.int32()),
                "n": pa.array([len(order)], pa.int32()),
                "vectors": pa.array([np.ascontiguousarray(vectors[order]).tobytes()], pa.binary()),
                "ids": pa.array([ids.to_pylist()], pa.list_(pa.list_(pa.int64()))),
                "sizes": pa.array([[len(nodes) for nodes, _ in graph.levels]], pa.list_(pa.int32())),
                "nodes": pa.array([b"".join(nodes.tobytes() for nodes, _ in graph.levels)], pa.binary()),
                "links": pa.array([b"".join(links.tobytes() for _, links in graph.levels)], pa.binary()),
            }
        )

    return cut_lineage(nodes.withColumn("shard", dealt).groupBy("dim", "shard").applyInArrow(run, INDEX), "graphs")


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _graph(row: dict, vectors: np.ndarray) -> hnsw.Graph:
    sizes = row["sizes"]
    nodes = np.split(np.frombuffer(row["nodes"], np.int32), np.cumsum(sizes)[:-1])
    widths = [hnsw.LINKS * (1 if k else 2) for k in range(len(sizes))]
    flat = np.split(np.frombuffer(row["links"], np.int32), np.cumsum([s * w for s, w in zip(sizes, widths, strict=True)])[:-1])
    return hnsw.Graph(vectors, [(a, b.reshape(-1, w)) for a, b, w in zip(nodes, flat, widths, strict=True)])


def query_blocks(queries: DataFrame) -> DataFrame:
    """Queries (vec_id, vector) in rows of about ``BLOCK``: dim, query_ids, queries."""
    blocks = max(1, -(-queries.count() // BLOCK))
    placed = queries.select(
        "vec_id", "vector", F.size("vector").alias("dim"), F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).alias("block")
    )

    def run(table: pa.Table) -> pa.Table:
        dim = table.column("dim")[0].as_py()
        vectors = _matrix(table.column("vector").combine_chunks(), dim)
        return pa.table(
            {
                "dim": pa.array([dim], pa.int32()),
                "query_ids": pa.array([table.column("vec_id").to_pylist()], pa.list_(pa.int64())),
                "queries": pa.array([vectors.tobytes()], pa.binary()),
            }
        )

    return placed.groupBy("dim", "block").applyInArrow(run, "dim int, query_ids array<long>, queries binary")


def best_of_shard(row: dict, k: int) -> pa.RecordBatch:
    """Each query's ``k`` best ids of one shard, with scores in double precision."""
    dim, ids = row["dim"], row["ids"]
    exact = np.frombuffer(row["vectors"], np.float64).reshape(-1, dim)
    queries = np.frombuffer(row["queries"], np.float64).reshape(-1, dim)
    near = _graph(row, exact.astype(np.float32)).search(queries, max(hnsw.EF_SEARCH, 2 * k))
    found_ids, found_scores = [], []
    for query_id, query, nodes in zip(row["query_ids"], queries, near, strict=True):
        nodes = nodes[nodes >= 0]
        scores = exact[nodes] @ query
        best = np.argsort(-scores, kind="stable")[: k + 1]
        # Ties at the end of the list stay, so that the smaller id can win.
        best = np.flatnonzero(scores >= scores[best[-1]]) if len(best) else best
        pairs = sorted((-scores[b], i) for b in best.tolist() for i in ids[nodes[b]] if i != query_id)[:k]
        found_ids.append([i for _, i in pairs])
        found_scores.append([-s for s, _ in pairs])
    return pa.RecordBatch.from_arrays(
        [pa.array(row["query_ids"], pa.int64()), pa.array(found_ids, pa.list_(pa.int64())), pa.array(found_scores, pa.list_(pa.float64()))],
        ["query_id", "ids", "scores"],
    )


def search(index: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the ``k`` nearest found of each query."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                yield best_of_shard(batch.slice(i, 1).to_pylist()[0], k)

    blocks = query_blocks(queries)
    shards = index.groupBy("dim").agg(F.collect_set("shard").alias("shards"))  # numbers only
    # Every pair of a block and a shard of the same dimension, dealt out evenly.
    pairs = blocks.join(shards, "dim").withColumn("shard", F.explode("shards")).drop("shards").join(index, ["dim", "shard"])
    columns = ["dim", "query_ids", "queries", "n", "vectors", "ids", "sizes", "nodes", "links"]
    found = pairs.select(*columns).mapInArrow(run, FOUND)
    hits = found.select("query_id", F.explode(F.arrays_zip("ids", "scores")).alias("hit"))
    hits = hits.select("query_id", F.col("hit.ids").alias("vec_id"), F.col("hit.scores").alias("score"))
    hits = hits.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def query(spark, sf_dir: str) -> DataFrame:
    rows = usable(read_table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    queries = rows.where("vec_id % 20 = 0").dropDuplicates(["vec_id", "vector"])
    return search(indexed(rows, 20), queries, 20)
