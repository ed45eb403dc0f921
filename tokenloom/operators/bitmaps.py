"""Row indexes as bitmaps.

An index ``(file, row_idx)`` becomes one row for each 32,768 positions of a file:
``(file, bucket, bitmap)``, a bitmap of 4 KB.  It is built by a partial
aggregation in the map tasks, whatever is listed twice is set once, and
indexes are united, intersected and counted without going back to rows.  A
probe joins on ``(file, bucket)``, of which the index has up to 32,768 times
fewer rows than the list, and tests one bit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Positions of one bitmap; fixed by Spark's bitmap functions.
BUCKET_ROWS = 32768


def _place(row_idx: str = "row_idx") -> Column:
    """Spark's bitmap functions count from 1."""
    return F.col(row_idx) + 1


def bitmap_index(index: DataFrame) -> DataFrame:
    """``(file, bucket, bitmap)`` of ``index(file, row_idx)``."""
    at = index.select("file", F.bitmap_bucket_number(_place()).alias("bucket"), F.bitmap_bit_position(_place()).alias("bit"))
    return at.groupBy("file", "bucket").agg(F.bitmap_construct_agg("bit").alias("bitmap"))


def has_bit(bitmap: str, bit: Column) -> Column:
    """Whether the bit is set: byte ``bit div 8``, lowest bit first."""
    byte = F.conv(F.hex(F.substring(F.col(bitmap), (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.expr("1") == F.call_function("bit_get", byte, (bit % 8).cast("int"))


def keep_in_bitmaps(df: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """Rows of ``df(file, row_idx, ...)`` whose position is set."""
    probe = df.withColumns({"_bucket": F.bitmap_bucket_number(_place()), "_bit": F.bitmap_bit_position(_place())})
    side = bitmaps.select(F.col("file").alias("_file"), F.col("bucket").alias("_b"), F.col("bitmap").alias("_bitmap"))
    hit = probe.join(side, (F.col("file") == F.col("_file")) & (F.col("_bucket") == F.col("_b"))).where(has_bit("_bitmap", F.col("_bit")))
    return hit.select(*df.columns)


def unite(*bitmaps: DataFrame) -> DataFrame:
    """Positions that any of the indexes has."""
    every = bitmaps[0]
    for b in bitmaps[1:]:
        every = every.unionByName(b)
    return every.groupBy("file", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def intersect(a: DataFrame, b: DataFrame) -> DataFrame:
    """Positions that both indexes have (buckets with none may stay, all zero)."""
    both = a.unionByName(b).groupBy("file", "bucket").agg(F.bitmap_and_agg("bitmap").alias("bitmap"), F.count(F.lit(1)).alias("n"))
    return both.where("n = 2").drop("n")


def positions(bitmaps: DataFrame) -> DataFrame:
    """``(file, row_idx)`` of all set bits; a task expands one bitmap at a time."""
    bits = F.explode(F.filter(F.sequence(F.lit(0), F.lit(BUCKET_ROWS - 1)), lambda k: has_bit("bitmap", k)))
    first = (F.col("bucket") - 1) * BUCKET_ROWS
    return bitmaps.select("file", first.alias("_first"), bits.alias("_bit")).select("file", (F.col("_first") + F.col("_bit")).cast("bigint").alias("row_idx"))


def rows_per_file(bitmaps: DataFrame, name: str) -> DataFrame:
    return bitmaps.groupBy("file").agg(F.sum(F.bitmap_count("bitmap")).cast("bigint").alias(name))


def reconcile_bitmaps(inputs: DataFrame, outputs: DataFrame, index: DataFrame) -> DataFrame:
    """A3 from three bitmap tables: rows in, rows out, rows listed per file, and
    whether the rows out are those listed that exist."""
    tables = [rows_per_file(inputs, "in_rows"), rows_per_file(outputs, "out_rows"), rows_per_file(index, "index_rows"),
              rows_per_file(intersect(inputs, index), "hit_rows")]
    j = tables[0]
    for t in tables[1:]:
        j = j.join(t, "file", "full_outer")
    zero = F.lit(0).cast("bigint")
    j = j.select("file", *[F.coalesce(c, zero).alias(c) for c in ("in_rows", "out_rows", "index_rows", "hit_rows")])
    return j.withColumn("ok", F.col("out_rows") == F.col("hit_rows")).drop("hit_rows")
