"""Bitmap indexes, nested values, capped splits, observed checks, chunk manifests."""

import glob
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from tokenloom.operators import bitmaps as bm
from tokenloom.operators.checks import land_checked, land_counted, quality_counts
from tokenloom.operators.indexing import keep_indexed, reconcile
from tokenloom.operators.nested import INTS, INTS_AND_STRINGS, flatten_nested
from tokenloom.operators.rowindex import cap_sorted
from tokenloom.sinks import chunk_manifest
from tokenloom.sinks.chunk_manifest import manifest, read_chunks, write_chunks_once
from tokenloom.sinks.tables import write_chunks


def _rows(df):
    return sorted(map(tuple, df.collect()))


def test_bitmaps_equal_the_row_index(spark):
    r = random.Random(1)
    rows = [(f"f{k % 3}", r.choice([k, 32767, 32768, 70000 + k]), k) for k in range(300)]
    rows = sorted({(f, i): (f, i, k) for f, i, k in rows}.values())
    docs = spark.createDataFrame(rows, "file string, row_idx bigint, k int")
    listed = [(f, i) for f, i, _ in rows if r.random() < 0.4] + [("f0", 999_999), ("gone", 3)]
    index = spark.createDataFrame(listed + listed[:5], "file string, row_idx bigint")
    b = bm.bitmap_index(index)
    assert _rows(bm.positions(b)) == sorted(listed)
    assert _rows(bm.keep_in_bitmaps(docs, b)) == _rows(keep_indexed(docs, index).select("file", "row_idx", "k"))
    kept = bm.keep_in_bitmaps(docs, b)
    want = {x["file"]: x.asDict() for x in reconcile(docs, kept, index).collect()}
    got = {x["file"]: x.asDict() for x in bm.reconcile_bitmaps(bm.bitmap_index(docs), bm.bitmap_index(kept), b).collect()}
    assert got == want
    other = bm.bitmap_index(docs.where("k % 2 = 0"))
    assert set(_rows(bm.positions(bm.unite(b, other)))) == set(listed) | {(f, i) for f, i, k in rows if k % 2 == 0}
    assert set(_rows(bm.positions(bm.intersect(b, other)))) == set(listed) & {(f, i) for f, i, k in rows if k % 2 == 0}
    assert bm.positions(bm.bitmap_index(index.limit(0))).count() == 0


def unravel(x, strings):
    if isinstance(x, list):
        return [y for e in x for y in unravel(e, strings)]
    return [x] if isinstance(x, int) or strings and isinstance(x, str) else []


def test_nested_values(spark):
    r = random.Random(4)

    def value(depth):
        kind = r.random()
        if depth and kind < 0.5:
            return [value(depth - 1) for _ in range(r.randint(0, 4))]
        return r.choice([r.randint(-10 ** 12, 10 ** 12), "s,[1]", "é\"\n", 1.5, None, True, {"a": [1, "x"]}, ""])

    values = [value(d) for d in (0, 1, 2, 3, 7) for _ in range(40)] + [[[[[[[[[[3]]]]]]]]]]
    rows = [(k, json.dumps(v)) for k, v in enumerate(values)] + [(1000, None), (1001, ""), (1002, "[1, ")]
    df = spark.createDataFrame(rows, "k int, text string")
    text = lambda x: str(x).lower() if isinstance(x, bool) else str(x)
    for keep, strings in ((INTS, False), (INTS_AND_STRINGS, True)):
        got = {x.k: x.elements for x in flatten_nested(df, ["k"], "text", keep).collect()}
        assert got == {**{k: [text(e) for e in unravel(v, strings)] for k, v in enumerate(values)}, 1000: [], 1001: [], 1002: []}


def test_cap_ranks_in_the_tasks(spark):
    rows = [(s, (k * 7919) % 5000, k) for s in ("train", "validation") for k in range(5000)]
    df = spark.createDataFrame(rows, "split string, batch_id int, v int").repartition(8)
    for cap in (1, 1500):
        got = cap_sorted(df, cap, ["batch_id"])
        assert sorted(r.batch_id for r in got.where("split = 'train'").collect()) == list(range(cap))
        assert got.count() == 2 * cap
    ranked = df.withColumn("_rank", F.expr("row_number() over (partition by split order by batch_id)")).where("_rank <= 100")
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "rangepartitioning" not in plan, plan


def test_counts_come_from_the_write(spark):
    df = spark.createDataFrame([(k, k % 3 == 0, k % 2 == 0) for k in range(60)], "k int, without_dff boolean, invalid boolean")
    landed, counters = land_counted(df, "t")
    assert tuple(counters.first()) == tuple(quality_counts(df).first()) == (60, 20, 30) and landed.count() == 60
    schema = "split string, batch_id bigint, block_id bigint, input_ids array<int>, attention_mask array<int>, labels array<int>"
    good = [("train", 0, 0, [1, 2], [1, 1], [1, 2]), ("train", 1, 0, [1], [1], [1])]
    assert land_checked(spark.createDataFrame(good, schema), 2, short_ok=True).count() == 2
    for bad, short in ((good, False), ([("train", 0, 1, [1], [1], [1])], True), ([("train", 0, 0, [1, 2], [1], [1, 2])], False),
                       ([("validation", 0, 0, [1, 2], [1, 1], [1, 2])], False)):
        with pytest.raises(ValueError):
            land_checked(spark.createDataFrame(bad, schema), 2, short_ok=short)


def test_killed_chunk_run_ends_like_an_unbroken_one(spark, tmp_dir, monkeypatch):
    df = spark.range(1000).select(F.col("id").alias("row_idx"), (F.col("id") * 3).alias("v"), F.floor(F.col("id") / 100).alias("batch")).repartition(4)
    whole = f"{tmp_dir}/whole"
    assert write_chunks_once(df, whole, group=3) == list(range(10))
    path, commits = f"{tmp_dir}/broken", []
    real = chunk_manifest.uuid.uuid4

    def dies():
        commits.append(1)
        if len(commits) == 2:                       # data of the second group is there, its lines are not
            raise RuntimeError("killed")
        return real()
    monkeypatch.setattr(chunk_manifest.uuid, "uuid4", dies)
    with pytest.raises(RuntimeError):
        write_chunks_once(df, path, group=3)
    monkeypatch.undo()
    assert sorted({r.batch for r in read_chunks(spark, path).collect()}) == [0, 1, 2]
    files = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/data/batch=[012]/*.parquet")}
    assert write_chunks_once(df, path, group=3) == list(range(3, 10))
    assert files == {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/data/batch=[012]/*.parquet")}
    assert _rows(read_chunks(spark, path)) == _rows(read_chunks(spark, whole)) and read_chunks(spark, path).count() == 1000
    assert write_chunks_once(df, path) == []        # done: nothing is written
    changed = df.withColumn("v", F.when(F.col("row_idx") == 250, -1).otherwise(F.col("v")))
    assert write_chunks_once(changed, path) == [2]
    assert read_chunks(spark, path).where("v = -1").count() == 1 and manifest(spark, path).count() == 10
    one = manifest(spark, path).where("chunk = 4").first()
    assert (one["first"], one["last"], one.n_rows) == (400, 499, 100)


def test_a_chunk_is_one_file_and_commits_are_bounded(spark, tmp_dir, monkeypatch):
    df = spark.range(1000).select(F.col("id").alias("row_idx"), F.floor(F.col("id") / 50).alias("batch")).repartition(8)
    write_chunks(df, f"{tmp_dir}/chunks")
    assert len(glob.glob(f"{tmp_dir}/chunks/batch=*/*.parquet")) == 20
    monkeypatch.setattr(chunk_manifest, "GROUP", 1)
    monkeypatch.setattr(chunk_manifest, "COMMITS", 3)
    assert write_chunks_once(df, f"{tmp_dir}/once") == list(range(20))
    assert len(glob.glob(f"{tmp_dir}/once/data/batch=*/*.parquet")) == 20
    assert len(glob.glob(f"{tmp_dir}/once/_manifest/*")) == 3
    assert read_chunks(spark, f"{tmp_dir}/once").count() == 1000
