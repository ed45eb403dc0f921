"""Numbered chunks with a manifest, written exactly once.

A chunk's line in the manifest says what it was made of: the range of its
order column, its number of rows and a digest of them (sums and exclusive ors
of row hashes, so that it neither depends on the order nor needs a sort).  The
lines of a group of chunks are written after their data, as one small file.

A call first takes the digests of the table at hand, one aggregation with one
row for each chunk, and leaves out chunks whose line says the same; the others
are written, ``group`` at a time, each replacing what stands under its number.
What a call writes is first dealt by group into ``_todo``, so that a commit reads its
own group's files and the work of a call goes by its rows, not by rows times commits.
So a run that was killed goes on where it stopped, a half-written chunk is
written anew, a changed input rewrites the chunks that changed, and a finished
run repeated writes nothing.  ``read_chunks`` returns committed chunks only.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.sinks.tables import write_chunks

MANIFEST = "chunk bigint, first bigint, last bigint, n_rows bigint, digest string, at bigint"
GROUP = 64      # chunks of one commit, at least
COMMITS = 32    # commits of one call, at most, where no group size is given


def chunk_digests(df: DataFrame, chunk_col: str, order_col: str) -> DataFrame:
    """``(chunk, first, last, n_rows, digest)`` of every chunk of ``df``."""
    h = F.xxhash64(*[F.col(c) for c in df.columns])
    low = F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF)))
    high = F.sum(F.shiftrightunsigned(h, 32))
    digest = F.concat_ws("-", F.hex(F.bit_xor(h)), F.hex(low), F.hex(high))
    return df.groupBy(F.col(chunk_col).cast("bigint").alias("chunk")).agg(
        F.min(order_col).cast("bigint").alias("first"), F.max(order_col).cast("bigint").alias("last"),
        F.count(F.lit(1)).alias("n_rows"), digest.alias("digest"))


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """The last committed line of every chunk."""
    folder = f"{path.rstrip('/')}/_manifest"
    if not _exists(spark, folder):
        return spark.createDataFrame([], MANIFEST)
    lines = spark.read.schema(MANIFEST).json(f"{folder}/*")
    return lines.groupBy("chunk").agg(F.max_by(F.struct("first", "last", "n_rows", "digest", "at"), "at").alias("l")).select("chunk", "l.*")


def write_chunks_once(df: DataFrame, path: str, chunk_col: str = "batch", order_col: str = "row_idx", group: int | None = None) -> list[int]:
    """Write the chunks of ``df`` that ``path`` does not hold as they are; their
    numbers, in the order written.  ``order_col`` stays in the chunks.  ``group``:
    chunks of one commit (``GROUP``, or more where that would take more than
    ``COMMITS``).  The number of chunks is bounded by what one manifest can list
    (a line each)."""
    spark, base = df.sparkSession, path.rstrip("/")
    found = chunk_digests(df, chunk_col, order_col)
    known = manifest(spark, path).select("chunk", "n_rows", "digest", "at")
    todo = sorted(found.join(known.select("chunk", "n_rows", "digest"), ["chunk", "n_rows", "digest"], "left_anti").collect(), key=lambda r: r["chunk"])
    at = (known.agg(F.max("at")).first()[0] or 0) + 1
    written: list[int] = []
    if not todo:
        return written
    group = group or max(GROUP, -(-len(todo) // COMMITS))
    of_commit = spark.createDataFrame([(r["chunk"], k // group) for k, r in enumerate(todo)], "_chunk bigint, _commit int")
    dealt = f"{base}/_todo"
    (df.join(F.broadcast(of_commit), F.col(chunk_col).cast("bigint") == F.col("_chunk")).drop("_chunk")
     .hint("rebalance", F.col("_commit")).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("_commit").parquet(dealt))
    for lo in range(0, len(todo), group):
        part = todo[lo:lo + group]
        numbers = [r["chunk"] for r in part]
        rows = spark.read.schema(df.schema).parquet(f"{dealt}/_commit={lo // group}")
        write_chunks(rows, f"{base}/data", chunk_col)
        lines = [(r["chunk"], r["first"], r["last"], r["n_rows"], r["digest"], at) for r in part]
        spark.createDataFrame(lines, MANIFEST).coalesce(1).write.json(f"{base}/_manifest/{at:08d}-{lo:08d}-{uuid.uuid4().hex[:8]}")
        written += numbers
    fs, p = _fs(spark, dealt)
    fs.delete(p, True)
    return written


def read_chunks(spark: SparkSession, path: str, chunk_col: str = "batch") -> DataFrame:
    """The rows of committed chunks."""
    rows = spark.read.parquet(f"{path.rstrip('/')}/data")
    done = manifest(spark, path).select(F.col("chunk").alias("_chunk"))
    return rows.join(done, F.col(chunk_col).cast("bigint") == F.col("_chunk"), "left_semi")
