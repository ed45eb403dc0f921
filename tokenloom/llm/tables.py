"""Small shared helpers of the operators: tables, landings, connected groups."""

from __future__ import annotations

from contextlib import contextmanager
from typing import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.session import land, ship_package

#: Lets any scan take a filter made of the other side of its join.
RUNTIME_FILTER = {
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
}


#: Rows of a few numbers that one task may write, and links that one task may hold (16 bytes each).
ROWS_PER_TASK, EDGES_PER_TASK = 200_000, 1_000_000
BATCH_CONF, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "16m"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def map_arrow(df: DataFrame, fn: Callable[[Iterable[pa.RecordBatch]], Iterable[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` with the package at hand on the executors, in batches of
    at most ``BATCH_BYTES`` of input where the session leaves Spark's default."""
    ship_package(df.sparkSession)
    if df.sparkSession.conf.get(BATCH_CONF, None) in ("67108864b", "64m", "64MB"):
        df.sparkSession.conf.set(BATCH_CONF, BATCH_BYTES)
    return df.mapInArrow(fn, schema)


@contextmanager
def runtime_filters(spark: SparkSession):
    """Let Spark put a Bloom filter of a join's small side on the scan of the
    other side, so that texts that will find no partner are not shuffled."""
    before = {k: spark.conf.get(k, None) for k in RUNTIME_FILTER}
    for k, v in RUNTIME_FILTER.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def forget(df: DataFrame) -> None:
    """Delete a landed table that nothing reads any more."""
    spark = df.sparkSession
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def few(df: DataFrame, rows: int) -> DataFrame:
    """``df``, the outcome of a shuffle with at most ``rows`` short rows, in as
    few partitions as these take, one for each core at least."""
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // ROWS_PER_TASK)))


def _contract(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
    """``(node, smallest node that this task's edges connect it to)``."""
    parts = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows]
    if not parts:
        return
    nodes, ends = np.unique(np.concatenate([x for p in parts for x in p]), return_inverse=True)
    ends = np.split(ends.reshape(-1), np.cumsum([len(x) for p in parts for x in p])[:-1])
    a, b = np.concatenate(ends[::2]), np.concatenate(ends[1::2])
    label = np.arange(len(nodes))
    while True:
        x, y = label[a], label[b]
        if (x == y).all():
            break
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label[label] != label).any():
            label = label[label]
    yield pa.record_batch([pa.array(nodes), pa.array(nodes[label])], names=["a", "b"])


def components(links: DataFrame, name: str = "components", per_task: int = EDGES_PER_TASK) -> DataFrame:
    """Connected groups of ``links(a, b)``: ``(id, component)`` with the
    smallest id of the group, for every id that has a link.

    Each turn deals the edges at random into tasks of about ``per_task``, which
    replace theirs by a tree of depth one; where a single task holds all,
    that is the result.  Otherwise an alternating large-star and small-star
    step follows, one aggregation and one join each, and the turns go on with
    the edges that are left, at most one for each id.  ``links`` is a written
    table, repeated links do no harm.
    """
    edges, own = links.where("a <> b").select("a", "b"), []
    while True:
        n = edges.count()
        tasks = max(1, -(-n // per_task))
        dealt = edges.coalesce(1) if tasks == 1 else edges.repartition(tasks, F.xxhash64("a", "b"))
        trees = land(map_arrow(dealt, _contract, "a bigint, b bigint"), name)
        for t in own:
            forget(t)
        if tasks == 1:
            return trees.select(F.col("a").alias("id"), F.col("b").alias("component"))
        edges = trees.where("a <> b")
        # large star: greater neighbours of a vertex are linked to its smallest neighbour
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(low, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = land(large, name)
        # small star: smaller neighbours of a vertex, and the vertex, are linked to the smallest
        low = land(large.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n")), name)
        small = (large.join(low.where("n > 1"), "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(low.select("a", F.col("m").alias("b"))).distinct())
        small = land(small, name)
        done = low.where("n > 1").isEmpty() and small.join(small.select(F.col("a").alias("b")), "b", "left_semi").isEmpty()
        for t in (trees, large, low):
            forget(t)
        edges, own = small, [small]
        if done:
            ids = edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
            return ids.union(edges.select("b", "b").distinct())
