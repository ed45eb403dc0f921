"""Operator 4, exact top-k search: ball trees per shard, branch and bound.

Vectors are turned into integers and dealt by a hash of their id into shards
of about ``SHARD`` vectors; every shard builds one ball tree (split at the
median of the widest axis, ``LEAF`` vectors in a leaf).  No vector of a node
has a larger inner product with a query ``q`` than ``q . centre + |q| *
radius``.  A block of queries visits the nodes of a tree in the order of that
bound; a query skips what cannot reach its current k-th score, equal scores
included.

The k-th score is shared between the shards in two steps: every block first
searches one shard, and the scores found there are the lower limits with
which it searches all others.  Of each pair of shard and block at most k
results a query leave; Spark merges them with a ranked window.  Blocks and
shards meet by a sort-merge join, whatever their estimated sizes: a broadcast
would bring every block, once for each shard, to the driver.

Exact: integer scores are computed in doubles while they are below 2**53 and
as Python integers beyond; the bound has a margin for rounding.  Scores beyond
64 bits are cut to the range of a long.

Vectors that are null or hold null or non-finite components (times 256), and
rows without an id, take no part.  Vectors of different lengths do not meet.
Ties go to the smaller vec_id.  A repeated vec_id is one query, never its own
candidate, and a candidate as often as it is there.  Fewer than k candidates:
all of them.  Empty table: no rows.
"""

from __future__ import annotations

import heapq
from typing import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tokenloom.llm.tables import map_arrow, read
from tokenloom.session import SCAN_ELEMENTS, bound_batch_bytes, land

SHARD = 8192
LEAF = 128
BLOCK = 512
EXACT = float(1 << 53)
#: Bytes of an Arrow batch: a row is a whole shard and a block, so one or a few are enough to hold at a time.
BATCH_BYTES = 4 << 20


class BallTree:
    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF):
        self.nodes: list[tuple[int, int, int, int]] = []   # first, end, left, right
        order = np.arange(len(ids))
        centres, radii, stack = [], [], [(0, len(ids), -1, 0)]
        while stack:
            lo, hi, parent, side = stack.pop()
            own = vectors[order[lo:hi]]
            centre = own.mean(axis=0)
            here = len(self.nodes)
            centres.append(centre)
            radii.append(float(np.sqrt(((own - centre) ** 2).sum(axis=1).max())))
            self.nodes.append((lo, hi, -1, -1))
            if parent >= 0:
                a, b, left, right = self.nodes[parent]
                self.nodes[parent] = (a, b, here, right) if side == 0 else (a, b, left, here)
            if hi - lo > leaf and radii[-1] > 0:
                axis = int(np.argmax(own.max(axis=0) - own.min(axis=0)))
                mid = (hi - lo) // 2
                order[lo:hi] = order[lo:hi][np.argpartition(own[:, axis], mid)]
                stack.append((lo + mid, hi, here, 1))
                stack.append((lo, lo + mid, here, 0))
        self.ids, self.vectors = ids[order], vectors[order]
        self.centres, self.radii = np.array(centres), np.array(radii)

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores and ids of each query's k best that are not below ``floor``;
        missing ones have id -1 and score -inf."""
        n = len(queries)
        scores, ids = np.full((n, k), -np.inf), np.full((n, k), -1, np.int64)
        bound = queries @ self.centres.T + np.sqrt((queries ** 2).sum(axis=1))[:, None] * self.radii
        bound += 1e-9 * np.abs(bound) + 1e-6
        limit = floor.copy()
        heap = [(-float(bound[:, 0].max()), 0)]
        while heap:
            _, node = heapq.heappop(heap)
            live = np.flatnonzero(bound[:, node] >= limit)
            if not len(live):
                continue
            lo, hi, left, right = self.nodes[node]
            if left >= 0:
                for child in (left, right):
                    heapq.heappush(heap, (-float(bound[live, child].max()), child))
                continue
            found = queries[live] @ self.vectors[lo:hi].T
            own = self.ids[lo:hi]
            found[query_ids[live][:, None] == own] = -np.inf
            found[found < limit[live][:, None]] = -np.inf
            all_scores = np.concatenate([scores[live], found], axis=1)
            all_ids = np.concatenate([ids[live], np.where(np.isfinite(found), own, -1)], axis=1)
            best = np.lexsort((all_ids, -all_scores), axis=1)[:, :k]
            scores[live] = np.take_along_axis(all_scores, best, axis=1)
            ids[live] = np.take_along_axis(all_ids, best, axis=1)
            limit[live] = np.maximum(limit[live], scores[live, k - 1])
        return scores, ids


def exactly(query_ids, queries: list[list[int]], ids, vectors: list[list[int]], k: int):
    """The same with Python integers, for components too large for doubles."""
    for qid, q in zip(query_ids, queries):
        scored = sorted((-sum(a * b for a, b in zip(q, v)), i) for i, v in zip(ids, vectors) if i != qid)[:k]
        yield qid, [(max(min(-s, (1 << 63) - 1), -(1 << 63)), i) for s, i in scored]


def integers(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(vec_id, dim, v)`` of the vectors that take part; ``v`` as doubles."""
    v = F.col(vector_col).cast("array<double>")
    usable = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(256.0 * x) < float("inf")))
    scaled = F.transform(v, lambda x: 256.0 * x)
    whole = F.transform(scaled, lambda x: F.when(F.abs(x) < EXACT, F.floor(x).cast("double")).otherwise(x))
    return (vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & usable)
            .select(F.col(id_col).cast("bigint").alias("vec_id"), F.size(v).alias("dim"), whole.alias("v")))


def _matrix(values: pa.Array, rows: int, dim: int) -> np.ndarray:
    return np.asarray(values, float).reshape(rows, dim)


def _search(batches: Iterable[pa.RecordBatch], k: int) -> Iterable[pa.RecordBatch]:
    last, tree = None, None
    for batch in batches:
        for r in range(batch.num_rows):
            row = {name: batch.column(c)[r] for c, name in enumerate(batch.schema.names)}
            dim, shard = row["dim"].as_py(), row["shard"].as_py()
            ids, query_ids = np.asarray(row["ids"].values), np.asarray(row["query_ids"].values)
            vectors, queries = _matrix(row["vectors"].values, len(ids), dim), _matrix(row["queries"].values, len(query_ids), dim)
            most = np.abs(vectors).max(initial=0) * np.abs(queries).max(initial=0) * max(dim, 1)
            out = []
            if most < EXACT:
                if last != (dim, shard):
                    last, tree = (dim, shard), BallTree(ids, vectors)
                floor = np.array([-np.inf if x is None else float(x) for x in row["floors"].as_py()])
                scores, found = tree.search(query_ids, queries, k, floor)
                at, col = np.nonzero(found >= 0)
                out = (query_ids[at], found[at, col], scores[at, col].astype(np.int64))
            else:
                whole = lambda m: [[int(x) for x in v] for v in m.tolist()]
                rows = [(q, i, s) for q, best in exactly(query_ids.tolist(), whole(queries), ids.tolist(), whole(vectors), k) for s, i in best]
                out = tuple(np.array([x[c] for x in rows], np.int64) for c in range(3))
            yield pa.record_batch([pa.array(out[0]), pa.array(out[1]), pa.array(out[2])], names=["query_id", "vec_id", "score"])


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
          shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """``(query_id, rank, vec_id, score)``; ``is_query`` is a condition over ``vec_id``."""
    bound_batch_bytes(vectors.sparkSession, BATCH_BYTES)
    whole = land(integers(vectors, id_col, vector_col), "vectors")
    sizes = whole.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / shard).cast("int").alias("shards"),
                                     F.ceil(F.count(F.when(is_query, 1)) / block).cast("int").alias("blocks"))
    sizes = F.broadcast(land(sizes, "sizes"))   # one row per vector length
    dealt = lambda of, seed: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.col(of)).cast("int")
    trees = whole.join(sizes, "dim").groupBy("dim", dealt("shards", 1).alias("shard")).agg(F.collect_list(F.struct("vec_id", "v")).alias("rows"))
    # a shard is a row group, so that a scan decodes one at a time
    trees = land(trees.select("dim", "shard", F.col("rows.vec_id").alias("ids"), F.flatten("rows.v").alias("vectors")), "shards", SCAN_ELEMENTS)
    queries = whole.where(is_query).groupBy("dim", "vec_id").agg(F.min("v").alias("v"))
    # a repeated id with vectors of several lengths: the shortest asks
    queries = queries.groupBy("vec_id").agg(F.min(F.struct("dim", "v")).alias("q")).select("vec_id", "q.dim", "q.v")
    queries = land(queries.join(sizes, "dim").withColumn("block", dealt("blocks", 2)), "queries")

    def against(limits: DataFrame | None) -> DataFrame:
        q = queries if limits is None else queries.join(limits.hint("merge"), F.col("vec_id") == F.col("query_id"), "left")
        floor = F.lit(None).cast("bigint") if limits is None else F.col("floor")
        blocks = q.groupBy("dim", "block", "shards").agg(F.collect_list(F.struct("vec_id", "v", floor.alias("floor"))).alias("rows"))
        home = F.pmod(F.col("block"), F.col("shards"))
        every = F.sequence(F.lit(0), F.col("shards") - 1)
        visits = F.array(home) if limits is None else F.array_except(every, F.array(home))
        return blocks.select("dim", "block", F.explode(visits).alias("shard"), F.col("rows.vec_id").alias("query_ids"),
                             F.flatten("rows.v").alias("queries"), F.col("rows.floor").alias("floors"))

    schema = "query_id bigint, vec_id bigint, score bigint"
    search = lambda pairs: map_arrow(pairs.join(trees.hint("merge"), ["dim", "shard"]), lambda it: _search(it, k), schema)
    first = land(search(against(None)), "first-shard")
    limits = land(_ranked(first, k).where(F.col("rank") == k).select("query_id", F.col("score").alias("floor")), "limits")
    found = first.unionByName(search(against(limits)))
    return _ranked(found, k).select("query_id", "rank", "vec_id", "score")


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 50 == 0)
