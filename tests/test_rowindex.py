"""Row indexes, splits, caps, wrap-around cut."""

from pyspark.sql import functions as F

from tokenloom.operators.rowindex import (cap_rows, cut_at_wraparound, dense_index, ordered_index,
                                          positional_split, validation_cut)


def test_dense_index_multi_bucket(spark):
    rows = [("a" if i % 3 else "b", 7 * i + (i % 2)) for i in range(200)]
    df = spark.createDataFrame(rows, "g string, k bigint")
    out = dense_index(df, "k", ["g"], "d", bucket_rows=16).collect()
    for g in ("a", "b"):
        ks = sorted(r["k"] for r in out if r["g"] == g)
        got = {r["k"]: r["d"] for r in out if r["g"] == g}
        assert [got[k] for k in ks] == list(range(len(ks)))


def test_ordered_index(spark):
    rows = [(f"t{i % 37}", i % 11) for i in range(300)]
    df = spark.createDataFrame(rows, "token string, n bigint").distinct()
    order = [F.col("n").desc(), F.col("token").asc()]
    out = ordered_index(df, order, "r", num_partitions=5).collect()
    expected = sorted(((r["n"], r["token"]) for r in out), key=lambda x: (-x[0], x[1]))
    got = sorted(out, key=lambda r: r["r"])
    assert [(r["n"], r["token"]) for r in got] == expected
    assert [r["r"] for r in got] == list(range(len(got)))


def test_validation_cut_rounding():
    assert validation_cut(1000, 5) == 50
    assert validation_cut(10, 5) == 0       # 0.5 -> 0 (half to even)
    assert validation_cut(30, 5) == 2       # 1.5 -> 2
    assert validation_cut(50, 5) == 2       # 2.5 -> 2


def test_split_and_cap(spark):
    df = spark.range(0, 100).withColumnRenamed("id", "row_idx")
    s = positional_split(df, "row_idx", 10)
    counts = {r["split"]: r["count"] for r in s.groupBy("split").count().collect()}
    assert counts == {"validation": 10, "train": 90}
    capped = cap_rows(s, 5).collect()
    assert sorted(r["row_idx"] for r in capped) == [0, 1, 2, 3, 4, 10, 11, 12, 13, 14]


def test_wraparound(spark):
    texts = ["x", "y", "z", "x", "w", "x", "v"]
    df = spark.createDataFrame(list(enumerate(texts)), "row_idx bigint, text string")
    assert cut_at_wraparound(df, chunk_size=2, min_batch=0).count() == 3
    assert cut_at_wraparound(df, chunk_size=2, min_batch=2).count() == 5
    assert cut_at_wraparound(df, chunk_size=2, min_batch=9).count() == 7
