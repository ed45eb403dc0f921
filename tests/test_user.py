"""U1 / U2 entry points."""

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from tokenloom.operators.user import filter_rows, map_batches


def test_map_batches_changes_rows(spark):
    df = spark.range(10).withColumnRenamed("id", "x")

    def evens_doubled(b):
        x = b.column("x")
        keep = pc.equal(pc.bit_wise_and(x, 1), 0)
        return pa.RecordBatch.from_arrays([pc.multiply(pc.filter(x, keep), 2)], names=["y"])

    got = sorted(r["y"] for r in map_batches(df, evens_doubled, "y long").collect())
    assert got == [0, 4, 8, 12, 16]


def test_filter_rows(spark):
    df = spark.range(10).withColumnRenamed("id", "x")
    assert filter_rows(df, F.col("x") > 6).count() == 3
    assert sorted(r["x"] for r in filter_rows(df, lambda s: s % 3 == 0, "x").collect()) == [0, 3, 6, 9]
