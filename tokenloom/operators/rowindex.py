"""Order as data: row indexes, dense renumbering, chunks, splits, caps.

Spark has no row order, so every order the reference relies on (position in
a file, position in a list, batch of 1,000 rows) is made an explicit column
here.  None of these functions uses a window without ``partitionBy`` on a
large table: global orders are built in two levels (small per-partition or
per-bucket tables of counts, then a local rank).

O1 file_row_index, O2 dense_index / ordered_index, O3 chunk_id,
O4 cut_at_wraparound, O5 batch_id, P7 cap_rows, P8 positional_split.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.constants import (DEFAULT_BATCH_ROWS, DEFAULT_BUCKET_ROWS,
                                 DEFAULT_CHUNK_SIZE, DEFAULT_VALIDATION_PERCENT)
from tokenloom.session import default_parallelism, land

# largest small side (rows) that is broadcast without further thought
SMALL_TABLE_MAX_ROWS = 1_000_000
# largest rank limit that Spark applies in the tasks before a shuffle
GROUP_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"


# --------------------------------------------------------------------------
# O1: position of a row inside its file
# --------------------------------------------------------------------------

def tag_scan_position(df: DataFrame) -> DataFrame:
    """Columns needed by :func:`file_row_index`; call right after a file read
    (before any shuffle), so the id reflects the scan order."""
    return (df.withColumn("file", F.col("_metadata.file_name"))
              .withColumn("_split_start", F.col("_metadata.file_block_start"))
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_mid", F.monotonically_increasing_id()))


def file_row_index(tagged: DataFrame, out_col: str = "row_idx") -> DataFrame:
    """O1: 0-based position of each row inside its file.

    A file split is read by one task in file order, so inside a task the
    scan id grows by one per row.  Per (file, task) the first id and row
    count form a table with one row per file split; a window over it (per
    file, ordered by split start) gives each split's offset.  The scan is
    deterministic, so a lost task recomputes the same ids.
    """
    pieces = (tagged.groupBy("file", "_pid")
              .agg(F.min("_mid").alias("_mid0"), F.count(F.lit(1)).alias("_n"),
                   F.min("_split_start").alias("_start")))
    w = Window.partitionBy("file").orderBy("_start", "_pid").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0))).drop("_n", "_start")
    # one row per file split: at most (input files + scan partitions) rows,
    # both known from planning metadata, so the size check runs no job
    bound = len(tagged.inputFiles()) + tagged.rdd.getNumPartitions()
    small = F.broadcast(pieces) if bound <= SMALL_TABLE_MAX_ROWS else pieces
    out = tagged.join(small, ["file", "_pid"])
    return (out.withColumn(out_col, (F.col("_off") + F.col("_mid") - F.col("_mid0")).cast("bigint"))
               .drop("_pid", "_mid", "_mid0", "_off", "_split_start"))


# --------------------------------------------------------------------------
# O2: dense renumbering
# --------------------------------------------------------------------------

def dense_index(df: DataFrame, order_col: str, partition_cols: Sequence[str] = (),
                out_col: str = "dense_idx", bucket_rows: int = DEFAULT_BUCKET_ROWS,
                bucket_col: str | None = None, rows: DataFrame | None = None) -> DataFrame:
    """O2: 0-based dense rank by an integral, unique ``order_col`` within each
    group of ``partition_cols``.

    Two levels: rows are put in buckets of ``bucket_rows`` consecutive order
    values, a small table of per-bucket counts gives each bucket's offset,
    and ``row_number`` runs inside a bucket only.  No task ever holds more
    than one bucket of one group, whatever the size of the group.  ``rows``:
    the same rows' order and partition columns, if a cheaper table has them.
    """
    pcols = list(partition_cols)
    bkt = F.col(bucket_col) if bucket_col else F.floor(F.col(order_col) / F.lit(bucket_rows))
    t = df.withColumn("_bkt", bkt.cast("bigint"))
    narrow = t if rows is None else rows.withColumn("_bkt", bkt.cast("bigint"))
    counts = narrow.groupBy(*pcols, "_bkt").agg(F.count(F.lit(1)).alias("_cnt"))
    w = Window.partitionBy(*pcols).orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.withColumn("_off", F.coalesce(F.sum("_cnt").over(w), F.lit(0))).drop("_cnt")
    j = t.join(offs, [*pcols, "_bkt"])
    w2 = Window.partitionBy(*pcols, "_bkt").orderBy(order_col)
    return (j.withColumn(out_col, (F.col("_off") + F.row_number().over(w2) - 1).cast("bigint"))
             .drop("_bkt", "_off"))


def ordered_index(df: DataFrame, order_by: Sequence[Column], out_col: str = "rank",
                  num_partitions: int | None = None) -> DataFrame:
    """O2 for any sort order: 0-based global rank.

    Range-partition and sort, tag each row with its partition and position
    (``monotonically_increasing_id``), land the tagged table in the shared
    checkpoint folder so the tags cannot change on recomputation, then add
    each partition's offset from a table with one row per partition.
    """
    n = num_partitions or default_parallelism(df.sparkSession)
    tagged = (df.repartitionByRange(n, *order_by).sortWithinPartitions(*order_by)
                .withColumn("_pid", F.spark_partition_id())
                .withColumn("_mid", F.monotonically_increasing_id()))
    tagged = land(tagged, "ordered")
    sizes = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: a global window over it is bounded
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = sizes.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0))).drop("_n")
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), 33)
    return (tagged.join(F.broadcast(offs), "_pid")
                  .withColumn(out_col, (F.col("_off") + local).cast("bigint"))
                  .drop("_pid", "_mid", "_off"))


# --------------------------------------------------------------------------
# Chunk and batch numbers
# --------------------------------------------------------------------------

def chunk_id(row_idx, chunk_size: int = DEFAULT_CHUNK_SIZE) -> Column:
    """O3: chunk number of a 0-based row index (lossless chunks)."""
    c = F.col(row_idx) if isinstance(row_idx, str) else row_idx
    return F.floor(c / F.lit(chunk_size)).cast("bigint")


def batch_id(dense_idx, batch_rows: int | None = DEFAULT_BATCH_ROWS) -> Column:
    """Batch number of a dense row index; ``None`` = one batch."""
    if batch_rows is None:
        return F.lit(0).cast("bigint")
    c = F.col(dense_idx) if isinstance(dense_idx, str) else dense_idx
    return F.floor(c / F.lit(batch_rows)).cast("bigint")


# --------------------------------------------------------------------------
# Stop at wrap-around
# --------------------------------------------------------------------------

def cut_at_wraparound(df: DataFrame, row_idx: str = "row_idx", text: str = "text",
                      chunk_size: int = DEFAULT_CHUNK_SIZE, min_batch: int = 0) -> DataFrame:
    """Drop everything from the first later row whose text equals the
    text of row 0, counting only rows in chunks ``>= min_batch``.

    The first text is a one-row table joined on text equality (an equi-join,
    broadcast); the stop position is one scalar; the final filter is a plain
    predicate on the row index.
    """
    first = df.where(F.col(row_idx) == 0).select(F.col(text).alias("_t0"))
    hits = (df.where((F.col(row_idx) > 0) & (chunk_id(row_idx, chunk_size) >= min_batch))
              .select(row_idx, text)
              .join(F.broadcast(first), F.col(text) == F.col("_t0"), "left_semi"))
    stop = hits.agg(F.min(row_idx).alias("stop")).first()["stop"]
    return df if stop is None else df.where(F.col(row_idx) < F.lit(stop))


# --------------------------------------------------------------------------
# P7, P8
# --------------------------------------------------------------------------

def validation_cut(n_rows: int, percent: float = DEFAULT_VALIDATION_PERCENT) -> int:
    """Rows in the first ``percent`` %: nearest integer, halves to even."""
    return int(round(percent * n_rows / 100.0))


def positional_split(df: DataFrame, order_col: str = "row_idx",
                     percent: float = DEFAULT_VALIDATION_PERCENT,
                     n_rows: int | None = None, split_col: str = "split") -> DataFrame:
    """The first ``percent`` % of rows (by a dense 0-based ``order_col``)
    become ``validation``, the rest ``train``.  Also adds ``split_idx``, the
    dense position inside the split, so caps need no further ranking."""
    n = df.count() if n_rows is None else n_rows
    cut = validation_cut(n, percent)
    idx = F.col(order_col)
    return (df.withColumn(split_col, F.when(idx < cut, F.lit("validation")).otherwise(F.lit("train")))
              .withColumn("split_idx", F.when(idx < cut, idx).otherwise(idx - F.lit(cut)).cast("bigint")))


def require_dense(df: DataFrame, order_col: str) -> int:
    """The number of rows, if ``order_col`` holds 0 .. n-1; else an error.

    One aggregate row: count, least and greatest value, and the first two
    moments, which no table with repeated or missing positions is known to
    share by accident.  Nothing is shuffled."""
    i = F.col(order_col).cast("decimal(38,0)")
    n, low, high, total, squares = df.agg(F.count(F.lit(1)), F.min(order_col), F.max(order_col), F.sum(i),
                                          F.sum(F.col(order_col).cast("decimal(18,0)") * F.col(order_col).cast("decimal(18,0)"))).first()
    if n and (low, high, int(total), int(squares)) != (0, n - 1, n * (n - 1) // 2, (n - 1) * n * (2 * n - 1) // 6):
        raise ValueError(f"{order_col} must hold 0 to {n - 1}, each once; it goes from {low} to {high}")
    return n


def cap_rows(df: DataFrame, cap: int | None, dense_col: str = "split_idx") -> DataFrame:
    """Keep the first ``cap`` rows of each split (by dense position).
    ``min(cap, n)`` rows remain; ``None`` keeps all."""
    return df if cap is None else df.where(F.col(dense_col) < F.lit(cap))


def cap_sorted(df: DataFrame, cap: int, order_by: Sequence[str], split_col: str = "split") -> DataFrame:
    """P7 after filters and packing, where no dense position exists: the
    first ``cap`` rows of each split by ``order_by`` (unique in a split).

    Each task keeps the first ``cap`` keys of its own rows of a split before
    anything is shuffled (Spark's window group limit, whose threshold is
    raised to ``cap`` for this), so a split's final rank sees at most ``cap``
    keys a task."""
    spark, keys = df.sparkSession, [split_col, *order_by]
    rank = F.row_number().over(Window.partitionBy(split_col).orderBy(*order_by))
    first = df.select(*keys).withColumn("_rank", rank).where(F.col("_rank") <= cap).select(*keys)
    before = spark.conf.get(GROUP_LIMIT, None)
    spark.conf.set(GROUP_LIMIT, str(max(cap, int(before or 0))))
    try:
        kept = land(first, "capped")
    finally:
        spark.conf.unset(GROUP_LIMIT) if before is None else spark.conf.set(GROUP_LIMIT, before)
    return df.join(kept, keys, "left_semi")
